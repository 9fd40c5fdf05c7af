"""What the operators share: a workspace in the cluster's shared folder, labels, chunked encoding."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Arrow batches handed to Python hold about this many bytes at most, so that long texts don't pile up.
BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine gets a temporary folder; on a cluster that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="tradelake-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system layer, so that any store works."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(conf).delete(there, True)


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session has a bound of its own; a Spark without that setting bounds them by rows."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        if spark.conf.get(name) in ("67108864b", "-1"):  # Spark's own
            spark.conf.set(name, str(BATCH_BYTES))
    except Exception as error:
        if "SQL_CONF_NOT_FOUND" not in str(error) and "NoSuchElement" not in str(error):
            raise


class Workspace:
    """A folder of intermediate tables under ``shared_dir``.

    ``table`` writes a DataFrame as Parquet and returns a reader of it: lineage is cut, and a lost
    executor costs at most the running tasks.  ``drop`` removes tables that are no longer needed; what is
    left is removed when the Python process ends, because a returned DataFrame may still read it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        bound_batches(spark)
        atexit.register(self.close)

    def table(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, f"{self.path}/{name}")

    def close(self) -> None:
        try:
            delete_path(self.spark, self.path)
        except Exception:  # the JVM has ended; the cluster's own clean-up of the checkpoint folder remains
            pass
        atexit.unregister(self.close)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text (remainder 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text column; one narrow scan."""
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).alias("n")).first()["n"]


#: Characters that any of the libraries takes for white space.
SPACES = "\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space beside white space or at the end: a text without it may be cut at every space.
UNSAFE = f"[{SPACES}][{SPACES}]|[{SPACES}]\\z"
#: Bytes of text that are encoded at once, and the longest word that is kept for later texts.
CHUNK_BYTES, KEPT_LENGTH = 3 << 20, 100


def safe_segments(text: str) -> list[str]:
    """Cut a text at single spaces between two other characters that aren't white space.

    Every cut is a boundary of the pre-tokenizer pattern ``... | ?\\p{L}+|...|\\s+(?!\\S)|\\s+``: what
    stands before such a space can neither take it in nor look beyond it.  The segments (each but the
    first begins with its space) joined give the text again.
    """
    out: list[list[str]] = [[]]
    last = ""
    for i, part in enumerate(text.split(" ")):
        if i and part and not part[0].isspace() and last and not last.isspace():
            out.append([])
        out[-1].append(part if not i else " " + part)
        last = part[-1] if part else " " if i else ""
    return [x for x in map("".join, out) if x]


class Kept:
    """Results for words, in two generations: when the young one is full it becomes the old one, and what is
    still used comes back from there.  Words over ``KEPT_LENGTH`` aren't kept, so entries bound the bytes."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def all(self, words: list, make) -> list:
        """The results of all ``words``; ``make`` gives those of a list of new ones."""
        out = list(map(self.young.get, words))
        missing = [i for i, x in enumerate(out) if x is None]
        if missing:
            asked = [words[i] for i in missing]
            found = list(map(self.old.get, asked))
            new = [w for w, x in zip(asked, found) if x is None]
            if new:
                made = iter(make(new))
                found = [next(made) if x is None else x for x in found]
            for i, x in zip(missing, found):
                out[i] = x
            self.young.update(zip(asked, found))
            if max(map(len, asked)) > KEPT_LENGTH:
                for w in asked:
                    if len(w) > KEPT_LENGTH:
                        self.young.pop(w, None)
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        return out

    def one(self, word, make):
        """The result of one word."""
        out = self.young.get(word)
        if out is None:
            out = self.old.get(word)
            if out is None:
                out = make(word)
            if len(word) <= KEPT_LENGTH:
                if len(self.young) >= self.limit:
                    self.old, self.young = self.young, {}
                self.young[word] = out
        return out


def packed_parts(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of so many ids each, as binary values."""
    offsets = np.concatenate(([0], np.cumsum(counts) * ids.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))])


class TextEncoder:
    """Encode texts by segments that a space begins: a chunk's distinct segments are looked up or encoded once.

    ``encode(parts, before)`` gives the packed ids (numbers of type ``kind``) of the segments ``before + part``;
    where ``before`` is a space they may be joined to one text, in which their starts are boundaries.  What is
    kept from chunk to chunk is bounded, however many distinct words the data have.

    ``bulk(words)``, if given, has the segments ``" " + word`` of an Arrow array of distinct words, as another one
    of packed ids; nothing of these is kept then but by itself.  A chunk is ``chunks`` times ``CHUNK_BYTES``.
    """

    def __init__(self, encode, kind: str, limit: int, bulk=None, chunks: int = 1):
        self.encode, self.kind, self.chunks = encode, np.dtype(kind), chunks
        self.plain, self.other = Kept(limit), Kept(limit // 8)
        self.bulk = bulk or (lambda words: pa.array(self.plain.all(words.to_numpy(zero_copy_only=False).tolist(), lambda new: self.encode(new, " ")), pa.binary()))

    def encoded(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text in order; a null one is empty."""
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at, most = 0, CHUNK_BYTES * self.chunks
        while at < len(texts):
            if lengths[at] > most:
                yield np.concatenate(list(self._long(texts[at].as_py())))
                at += 1
                continue
            end = at + int(np.searchsorted(np.cumsum(lengths[at : at + 10_000]), most, "right"))
            yield from self._chunk(texts.slice(at, end - at))
            at = end

    def _long(self, text: str) -> Iterator[np.ndarray]:
        if pc.match_substring_regex(pa.array([text]), UNSAFE)[0].as_py():
            for segment in safe_segments(text):
                yield np.frombuffer(self.encode([segment], "")[0], self.kind)
            return
        start = 0
        while start < len(text):
            cut = text.find(" ", start + CHUNK_BYTES * self.chunks)
            cut = len(text) if cut < 0 else cut
            yield from self._chunk(pa.array([text[start:cut]]), " " if start else "")
            start = cut + 1

    def _chunk(self, texts: pa.Array, before: str = "") -> list[np.ndarray]:
        """Ids of texts; ``before`` stands before their first words."""
        texts = pc.fill_null(texts, "")
        unsafe = pc.match_substring_regex(texts, UNSAFE).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(texts, " ")
        words = split.flatten().dictionary_encode()
        codes = words.indices.to_numpy()
        sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        plain = np.repeat(~unsafe, sizes)
        plain[starts] = False
        here = np.zeros(len(words.dictionary), bool)
        here[codes[plain]] = True
        used = np.flatnonzero(here)
        found = self.bulk(words.dictionary.take(pa.array(used)))
        apart = lambda new: self.encode(new, before)
        heads = words.dictionary.take(pa.array(codes[starts])).to_pylist()
        if before:  # the middle of a long text
            first = apart(heads)
        else:
            known = iter(self.other.all([head for head, odd in zip(heads, unsafe) if head and not odd], apart))
            first = []
            for head, whole, odd in zip(heads, texts, unsafe):
                segments = safe_segments(whole.as_py()) if odd else []
                first.append(b"".join(self.other.all(segments, apart)) if segments else next(known) if head and not odd else b"")
        place = np.zeros(len(words.dictionary), np.int32)
        place[used] = np.arange(len(used))
        order = place[codes]
        order[starts] = len(used) + np.arange(len(starts))
        plain[starts] = True
        row = pa.concat_arrays([found, pa.array(first, pa.binary())]).take(pa.array(order[plain]))
        _, offsets, data = row.buffers()
        ids = np.frombuffer(data or b"", self.kind)
        last = np.cumsum(np.where(unsafe, 1, sizes))
        ends = np.frombuffer(offsets, np.int32)[last] // self.kind.itemsize
        return np.split(ids[: ends[-1]], ends[:-1]) if len(last) else []


def give_back() -> None:
    """Hand memory that a worker has freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the usual C library
    if trim is not None:
        trim(0)


def worker_clear() -> None:
    """Before work that keeps nothing: what another operator kept in this worker goes."""
    kept = sys.modules.setdefault("_tradelake_worker", types.ModuleType("_tradelake_worker")).__dict__
    kept["value"] = (None, None)
    give_back()


def worker_value(kind: str, key, make):
    """A value that a Python worker keeps from task to task: one in all, so another operator's goes first."""
    kept = sys.modules.setdefault("_tradelake_worker", types.ModuleType("_tradelake_worker")).__dict__
    if kept.get("value", (None,))[0] != (kind, key):
        worker_clear()
        kept["value"] = ((kind, key), make())
    give_back()
    return kept["value"][1]
