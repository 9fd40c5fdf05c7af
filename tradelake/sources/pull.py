"""A pull parser for gzipped XML responses: items as they come, whatever their name spaces, and what is wrong with a file.

Spark's own XML reader needs the row's tag as it is written, prefix included, and a damaged file fails its job.  Here
each file is one task's work: its bytes are unpacked and parsed piece by piece, without a tree, so memory is bounded
by the packed file.  Of an item only the asked fields are kept.  Items count from 0 in each file.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ITEM

FIELDS = [x.split()[0] for x in ITEM.split(", ")]
#: Where a response says what became of the request, the service's header before the gateway's envelope.
STATUS = ["resultCode", "resultMsg", "returnReasonCode", "returnAuthMsg", "errMsg"]
#: What reading a damaged file raises.
DAMAGE = (ElementTree.ParseError, EOFError, OSError, zlib.error)
#: Bytes that are unpacked at once, and items of a batch at least.
PIECE, BATCH = 1 << 16, 4_000
SCHEMA = "source string, kind string, ordinal bigint, " + ", ".join(f"{c} string" for c in FIELDS) + ", code string, message string, parse_error string"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def local_name(tag: str) -> str:
    return tag.rpartition("}")[2]


def unpacked(content: bytes) -> Iterator[bytes]:
    """A file's bytes in pieces; gzip is known by its first bytes."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while piece := stream.read(PIECE):
        yield piece


class Wellformed:
    """A parser's target that keeps nothing."""

    def close(self) -> None:
        pass


class Status(Wellformed):
    """A parser's target that counts items and keeps the first text of each status tag, without a tree."""

    #: Fields of items that are kept; what else a tag may stand for.
    fields: list[str] = []
    OTHER, STATE, ITEM = -1, -2, -3

    def __init__(self):
        self.first: dict[str, str] = {}
        self.items, self.kinds, self.texts, self.fresh = 0, {}, [], False

    def kind(self, tag: str) -> int:
        name = local_name(tag)
        found = self.fields.index(name) if name in self.fields else self.ITEM if name == "item" else self.STATE if name in STATUS else self.OTHER
        self.kinds[tag] = found
        return found

    def start(self, tag: str, attributes: dict) -> None:
        self.texts.append("")
        self.fresh = True
        if tag not in self.kinds:
            self.kind(tag)

    def data(self, text: str) -> None:
        if self.fresh:  # what follows a child isn't its parent's first text
            self.texts[-1] += text

    def end(self, tag: str) -> None:
        text, kind, self.fresh = self.texts.pop(), self.kinds[tag], False
        if kind == self.ITEM:
            self.items += 1
        elif kind == self.STATE:
            self.first.setdefault(local_name(tag), text.strip())


class Items(Status):
    """A parser's target that also keeps the asked fields of each item: of its own children, the first of a name."""

    def __init__(self, fields: list[str]):
        super().__init__()
        self.fields, self.rows = fields, []
        self.row, self.depth, self.outer = None, 0, []

    def start(self, tag: str, attributes: dict) -> None:
        self.texts.append("")
        self.fresh = True
        kind = self.kinds.get(tag)
        if kind is None:
            kind = self.kind(tag)
        if kind == -3:  # an item, whose children are one deeper
            self.outer.append((self.row, self.depth))
            self.row, self.depth = [None] * len(self.fields), len(self.texts)

    def end(self, tag: str) -> None:
        text, kind, self.fresh = self.texts.pop(), self.kinds[tag], False
        if kind >= 0:
            if len(self.texts) == self.depth and self.row is not None and self.row[kind] is None:
                self.row[kind] = text.strip()
        elif kind == self.ITEM:
            self.rows.append(self.row)
            self.row, self.depth = self.outer.pop()
        elif kind == self.STATE:
            self.first.setdefault(local_name(tag), text.strip())


def fed(content: bytes, target: Wellformed) -> str | None:
    """Feed a file to a target; returns what is wrong with the file."""
    try:
        parser = ElementTree.XMLParser(target=target)
        for piece in unpacked(content):
            parser.feed(piece)
        parser.close()
    except DAMAGE as damage:
        return f"{type(damage).__name__}: {damage}"
    return None


#: What parsing a file gives, as (kind, ordinal, fields, code, message, error): ``item``, the first one's number and a block's fields; then one ``file``, whose number is that of the items.
Block = tuple[str, int, list[list[str | None]] | None, str | None, str | None, str | None]


def file_row(content: bytes, fields: list[str] = FIELDS) -> Iterator[Block]:
    """The ``file`` row of ``parsed_file`` alone."""
    target = Status()
    error = fed(content, target)
    yield "file", target.items, None, *(said(target.first) if error is None else (None, None)), error


def whole_file(content: bytes, fields: list[str] = FIELDS) -> Iterator[Block]:
    """``parsed_file`` of an undamaged file, ``file_row`` of another: a pass that keeps nothing tells which one it is."""
    return file_row(content, fields) if fed(content, Wellformed()) else parsed_file(content, fields)


def said(first: dict[str, str]) -> tuple[str | None, str | None]:
    """Code and message of a response."""
    code = first["resultCode"] if "resultCode" in first else first.get("returnReasonCode") or None
    return code, first["resultMsg"] if "resultMsg" in first else first.get("returnAuthMsg") or first.get("errMsg") or None


def parsed_file(content: bytes, fields: list[str] = FIELDS) -> Iterator[Block]:
    """Items in document order, in blocks, and then the file's own row.  No tree is built, so memory is bounded by the packed file and a block."""
    target, n, error = Items(fields), 0, None
    parser = ElementTree.XMLParser(target=target)
    pieces = unpacked(content)
    while error is None:
        try:
            if piece := next(pieces, None):
                parser.feed(piece)
            else:
                parser.close()
                break
        except DAMAGE as damage:
            error = f"{type(damage).__name__}: {damage}"
        if len(target.rows) >= BATCH or error is not None and target.rows:
            yield "item", n, target.rows, None, None, None
            n += len(target.rows)
            target.rows = []
    if target.rows:
        yield "item", n, target.rows, None, None, None
    yield "file", n + len(target.rows), None, *(said(target.first) if error is None else (None, None)), error


def read_responses(spark: SparkSession, path: str | list[str], parse=parsed_file, fields: list[str] = FIELDS) -> DataFrame:
    """Rows of all files below a path: ``kind`` is ``item`` or, once for each file, ``file`` (see ``parsed_file``).

    A damaged file's row has ``parse_error``, and items that came before the damage are there: ``whole_items`` leaves
    them out.  With ``parse`` as ``file_row`` there are no items, with ``whole_file`` none of damaged files.  Only
    ``fields`` of the items are read.  Spark's readers pass over files of no bytes, so these have no row, as if they weren't there.
    """
    names = [c for c in NAMES if c not in FIELDS or c in fields]
    asked = [c for c in FIELDS if c in fields]

    def block(source: str, kind: str, first: int, rows: list | None, *end: str | None) -> pa.RecordBatch:
        n = 1 if rows is None else len(rows)
        own = zip(*rows) if rows and asked else ([None] * n for _ in asked)
        columns = [pa.repeat(source, n), pa.repeat(kind, n), pa.array(range(first, first + n), pa.int64()), *(pa.array(x, pa.string()) for x in own), *(pa.array([x] * n, pa.string()) for x in end)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for found in parse(content.as_py(), asked):
                    yield block(source, *found)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, ", ".join(x for x in SCHEMA.split(", ") if x.split()[0] in names))


def items_of(responses: DataFrame) -> DataFrame:
    return responses.select("source", "ordinal", *[c for c in FIELDS if c in responses.columns])


def damaged_files(responses: DataFrame) -> DataFrame:
    """``source, items, parse_error`` of files that can't be read to their end."""
    return responses.where("kind = 'file' and parse_error is not null").select("source", F.col("ordinal").alias("items"), "parse_error")


def whole_items(responses: DataFrame) -> DataFrame:
    """Items of undamaged files."""
    return responses.where("kind = 'item'").join(damaged_files(responses).select("source"), "source", "left_anti").transform(items_of)


def items_or_error(responses: DataFrame) -> DataFrame:
    """Items; a damaged file fails the job, named in the message."""
    fine = F.when(F.col("parse_error").isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("damaged response "), "source", F.lit(": "), "parse_error")).cast("boolean"))
    return responses.where(fine & (F.col("kind") == "item")).transform(items_of)
