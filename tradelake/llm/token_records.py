"""Token ids as length-delimited binary records with masked checksums and an offset index.

A folder holds ``records/part-NNNNN*`` and ``index/``.  A record file is a run of frames

    length  u64 little-endian, bytes of the payload
    check   u32, masked crc32 of the eight length bytes
    payload
    check   u32, masked crc32 of the payload
    0x0A

and a payload is ``doc_id i64, flags u8 (1: the id is null), width u8 (2 or 4), ids`` with ids of that
width, little-endian.  Masked means ``rotate_right(crc, 15) + 0xA282EAD8`` so that a checksum of data that
hold checksums stays useful.  File numbers and positions in a file ascend with ``doc_id``.  The index is a
Parquet table of ``shard, ordinal, offset, length, doc_id, n_tokens, ids_crc32, local_start``.

Records are written by Spark's own text writer, of which the frame's last byte is the line end: bytes go
through Hadoop's file systems and the commit protocol, so files reach any shared store and a task that is
lost or run twice leaves no half-written or doubled file.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import TextEncoder, Workspace, packed_parts, total_bytes, worker_value

#: Bytes of text that go to one record file.
SHARD_TEXT_BYTES = 8 << 20
#: Rows written at once; texts are encoded in chunks of so many times ``CHUNK_BYTES``, which has a shard in one.
WRITE_ROWS, CHUNKS = 500, 3
#: First words of texts that a worker keeps in each of two generations, times 8.
CACHE_SEGMENTS = 220_000
#: Bytes of words that the library gets as one text, and words as one pre-token where their ends are ends of tokens anyway.
PART_BYTES, GROUP_WORDS = 1 << 19, 64
#: Characters on whose kind all libraries agree: letters, digits, marks (an apostrophe may begin a pre-token of its own).
LETTERS, DIGITS, MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9", "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
MASK_DELTA = 0xA282EAD8
HEAD_BYTES, ID_FORMAT, ID_BYTES = 12, "<qBB", 10
INDEX_SCHEMA = "shard int, ordinal long, offset long, length long, doc_id long, n_tokens long, ids_crc32 long, local_start long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """A record without the line end that the writer adds."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of each record; ValueError on any damage."""
    at, end = 0, len(data)
    while at < end:
        if end - at < HEAD_BYTES:
            raise ValueError(f"cut short at byte {at}")
        n, check = struct.unpack_from("<QI", data, at)
        if masked(data[at : at + 8]) != check:
            raise ValueError(f"damaged length at byte {at}")
        body = at + HEAD_BYTES
        payload = data[body : body + n]
        if len(payload) < n or data[body + n : body + n + 5] != struct.pack("<I", masked(payload)) + b"\n":
            raise ValueError(f"damaged record at byte {at}")
        yield at, payload
        at = body + n + 5


def parse_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags, width = struct.unpack_from(ID_FORMAT, payload)
    return None if flags & 1 else doc_id, np.frombuffer(payload, "<u2" if width == 2 else "<u4", offset=ID_BYTES)


def byte_characters() -> dict[int, str]:
    """The character that a byte-level vocabulary writes for each byte: itself if it's visible, else the next from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def crosses(token: bytes, marks: str) -> bool:
    """Whether this token could be in a text of letters, digits, these marks and single white space, in two pre-tokens at once."""
    text = re.sub(rb"^[\x80-\xbf]|[\xc3-\xc9]$", b"a", token).decode(errors="replace")  # parts of a letter of two bytes
    kinds = LETTERS, DIGITS, re.escape(marks)
    inside = re.fullmatch(f"[ \\n]?([{''.join(kinds)}]+([ \\n]|$))*", text)
    return inside is not None and re.fullmatch(f" ?|\\n|{'|'.join(f' ?[{k}]+' for k in kinds)}", text) is None


def tokenizer_encoder(tokenizer_path: str, end_id: int, special_as_text: bool) -> TextEncoder:
    """An encoder by a byte-level tokenizer of the tokenizers library.

    A chunk's distinct segments are encoded as one text.  Their ends are ends of pre-tokens, so of tokens too;
    the bytes that tokens stand for tell which ids are whose.  Where no token of the vocabulary has parts of two
    pre-tokens, words of letters, digits and marks needn't be cut by the pattern: the library's model gets many
    of them at once, and no merge joins what the pattern would have parted.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.encode_special_tokens = special_as_text
    special = {t.content: len(t.content.encode()) for t in tokenizer.get_added_tokens_decoder().values()}
    vocabulary = tokenizer.get_vocab()
    n = max(vocabulary.values(), default=0) + 1
    kind = "<u2" if max(n, end_id + 1) <= 1 << 16 else "<u4"
    sizes = np.zeros(n, np.int64)
    for token, i in vocabulary.items():
        sizes[i] = special.get(token) or len(token)  # a byte-level vocabulary writes each byte as one character

    written = byte_characters()
    bytes_of = {c: b for b, c in written.items()}
    opening = {next((c for c in t if c in MARKS), "") for t in special}  # a word without these holds no special token
    marks = "".join(c for c in MARKS if c not in opening)
    simple, quick = f"\\A[{LETTERS}{DIGITS}{re.escape(marks)}]+(\n[{LETTERS}{DIGITS}{re.escape(marks)}]+)*\\z", None
    usual = str(tokenizer.pre_tokenizer).startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in str(tokenizer.pre_tokenizer)
    if usual and tokenizer.normalizer is None and "" not in opening and not getattr(tokenizer.model, "ignore_merges", True):
        if not any(crosses(bytes(map(bytes_of.get, t)), marks) for t in vocabulary if bytes_of.keys() >= set(t)):
            quick = Tokenizer.from_file(tokenizer_path)
            quick.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
    characters = np.array([ord(written[b]) for b in range(256)], "<u2")
    characters[0] = ord(" ")  # no simple word has the character 0, which parts groups

    def cut(text: str, by, lengths: np.ndarray) -> pa.Array:
        """The packed ids of the parts of a text that have so many bytes, which are ends of tokens."""
        ids = np.array(by.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        reached, ends = np.cumsum(sizes[ids]), np.cumsum(lengths)
        last = np.searchsorted(reached, ends)
        if len(ids) and reached[-1] != ends[-1] or not np.array_equal(reached[last], ends):
            raise ValueError("this tokenizer isn't byte-level")
        return packed_parts(ids.astype(kind), np.diff(last, prepend=-1))

    def together(parts: pa.Array, between: str, most: int) -> pa.Array:
        """Words joined, up to so many in one."""
        offsets = np.append(np.arange(0, len(parts), most), len(parts)).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), parts), between)

    def groups(parts: pa.Array) -> pa.Array:
        """Simple words, each with a space before it."""
        text = " " + together(together(parts, " ", GROUP_WORDS), "\0 ", len(parts))[0].as_py()
        own = characters[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-16-le")
        return cut(own, quick, pc.binary_length(parts).to_numpy() + 1)

    def joined(parts: pa.Array) -> pa.Array:
        return cut(" " + together(parts, " ", len(parts))[0].as_py(), tokenizer, pc.binary_length(parts).to_numpy() + 1)

    def bulk(words: pa.Array) -> pa.Array:
        mask = pc.match_substring_regex(words, simple) if quick else pa.array(np.zeros(len(words), bool))
        out = [pa.array([], pa.binary())]
        for some, by in ((words.filter(mask), groups), (words.filter(pc.invert(mask)), joined)):
            part = np.cumsum(pc.binary_length(some).to_numpy() + 1) // PART_BYTES
            ends = [0, *np.flatnonzero(np.diff(part)) + 1, len(some)]
            out += [by(some.slice(a, b - a)) for a, b in zip(ends, ends[1:]) if b > a]
        place = np.argsort(np.argsort(~mask.to_numpy(zero_copy_only=False), kind="stable"))
        return pa.concat_arrays(out).take(pa.array(place))

    def encode(parts: list[str], before: str) -> list[bytes]:
        if before:
            return joined(pa.array(parts)).to_pylist()
        return [np.array(x.ids, kind).tobytes() for x in tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    return TextEncoder(encode, kind, CACHE_SEGMENTS, bulk, CHUNKS)


def write_token_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_text_bytes: int = SHARD_TEXT_BYTES, special_as_text: bool = False) -> DataFrame:
    """Encode every text, write records in ascending ``id_col`` order and the index; return the index.

    A null text counts as empty; every document ends in ``end_id``, so an empty one has that id alone.
    Null ids come first; repeated rows are written as often as they occur; the text breaks ties, so copies
    of one id spread over shards.  Other columns are not read.  An empty table gives no records.  What a text
    holds of the tokenizer's special tokens becomes their ids, as the library does by itself, or with
    ``special_as_text`` ordinary text.
    The number of shards follows the bytes of text, so a shard and the memory to read it are bounded (by
    one document, if that is longer).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = 1 + total_bytes(docs, "text") // shard_text_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_value("tokenizer", (tokenizer_path, end_id, special_as_text), lambda: tokenizer_encoder(tokenizer_path, end_id, special_as_text))
        width, last = encoder.kind.itemsize, np.array([end_id], encoder.kind).tobytes()
        for whole in batches:
            texts = encoder.encoded(whole.column(1))
            for at in range(0, whole.num_rows, WRITE_ROWS):
                out = []
                for doc_id in whole.column(0).slice(at, WRITE_ROWS).to_pylist():
                    out.append(frame(b"".join((struct.pack(ID_FORMAT, doc_id or 0, doc_id is None, width), next(texts).tobytes(), last))))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    records = docs.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).mapInArrow(run, "value binary")
    records.select(F.col("value").cast("string").alias("value")).write.mode("overwrite").text(f"{path}/records")
    index = scan_records(spark, path)
    index.write.mode("overwrite").parquet(f"{path}/index")
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")


def record_files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
    return files.select(F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("int").alias("shard"), "content")


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """Read all record files back, check every frame, and return a row of the index for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, start = [], 0
                for k, (offset, payload) in enumerate(frames(content.as_py())):
                    doc_id, ids = parse_payload(payload)
                    rows.append((shard, k, offset, HEAD_BYTES + len(payload) + 5, doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), start))
                    start += len(ids)
                if rows:
                    kinds = [pa.int32()] + [pa.int64()] * 7
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in INDEX_SCHEMA.split(", ")])

    return record_files(spark, path).mapInArrow(run, INDEX_SCHEMA)


def with_starts(index: DataFrame) -> DataFrame:
    """Add ``start``: ids of all documents before it.  Only a row for each shard is brought together."""
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0))).drop("n")
    return index.join(shards, "shard").withColumn("start", F.col("base") + F.col("local_start")).drop("base")


def read_shuffled(spark: SparkSession, path: str, seed: int = 0) -> DataFrame:
    """Documents in a random order that ``seed`` fixes: ``rank_key, doc_id, ids``, cut out by the index's offsets."""
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")
    wanted = index.groupBy("shard").agg(F.collect_list(F.struct(F.xxhash64(F.lit(seed), "shard", "ordinal").alias("key"), "offset", "length")).alias("spans"))
    rows = record_files(spark, path).join(wanted, "shard").select("content", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, spans in zip(batch.column(0), batch.column(1)):
                data = content.as_py()
                found = [(s["key"], *parse_payload(next(frames(data[s["offset"] : s["offset"] + s["length"]]))[1])) for s in spans.as_py()]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2].tolist() for x in found], pa.list_(pa.int32()))], names=["rank_key", "doc_id", "ids"])

    return rows.mapInArrow(run, "rank_key long, doc_id long, ids array<int>").orderBy("rank_key")


def token_table(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write records (into a workspace, unless a path is given), read them back and list the documents."""
    path = path or Workspace(docs.sparkSession, "records").path
    return with_starts(write_token_records(docs, path, tokenizer_path, end_id))
