"""Benchmark decontamination by the pigeonhole principle and bit-parallel edit distance.

An item that occurs in a text with at most ``k`` edits keeps one of any ``k + 1`` pieces of it unedited.
So every item is cut into its error budget plus one pieces, an automaton finds all exact piece hits in one
pass over a text, and at each hit Myers' algorithm computes the smallest distance between the item and any
part of the text around that place, one machine-number step a character.

Chance hits are told apart early: runs of j neighbouring pieces, halved again and again, form a tree in
which a run has a budget of j - 1.  If both halves of a run had more edits than their budgets, the run
would have more than its own; so a true occurrence leads from some piece up to the whole item through runs
within their budgets, and a hit is followed upwards only as far as that holds.

Both sides are compared as lower-cased words joined by single spaces, so case, punctuation and white space
cost no edits.  Words have no edges: an item of few letters is found inside a longer word.

Items travel to the executors in blocks of bounded size, one pass each, and a worker keeps a block's automaton
from task to task.  With several blocks a pass writes only the texts that it found something in, by their
hash; the rows meet these once at the end, so texts are read as often as there are blocks and never rewritten.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, bound_batches, worker_value

#: Share of an item's characters that may be edited, characters of a block of items, and items whose runs a worker keeps.
ERROR_RATE, BLOCK_CHARS, ITEMS_KEPT = 0.1, 1 << 20, 2_000
MATCHES = "array<struct<item_id: long, distance: int, start: int, end: int>>"


def normalize(text: str | None) -> str:
    return " ".join(re.findall(r"[^\W_]+", text.lower())) if text else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces (offset, text) whose lengths differ by one at most."""
    n, parts = len(item), budget + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def character_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def runs(n: int) -> list[list[tuple[int, int]]]:
    """For each of ``n`` pieces the runs [a, b) above it, from its parent to the whole."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]

    def halve(a: int, b: int) -> None:
        if b - a > 1:
            halve(a, (a + b) // 2)
            halve((a + b) // 2, b)
            for i in range(a, b):
                out[i].append((a, b))

    halve(0, n)
    return out


def myers(item: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """Smallest edit distance between ``item`` and any part of ``text``, and the end of the first such part."""
    n = len(item)
    masks = masks or character_masks(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best, at = full, 0, n, n, 0
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        across = ((((eq & up) + up) ^ up) | eq | down) & full
        more, less = (down | ~(across | up)) & full, up & across
        if more & top:
            score += 1
        elif less & top:
            score -= 1
            if score < best:
                best, at = score, j
        more, less = more << 1 & full, less << 1 & full  # row 0 stays 0: a match may start anywhere
        up, down = (less | ~((eq | down) | more)) & full, more & (eq | down)
    return best, at


class Matcher:
    """Finds items in texts.  What belongs to an item's runs is made when one of its pieces is first met, and kept for a bounded number of items."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items = [(i, t, int(len(t) * error_rate)) for i, t in items if t]
        where: dict[str, list[tuple[int, int]]] = {}
        for k, (_, item, budget) in enumerate(self.items):
            for i, (_, piece) in enumerate(pieces(item, budget)):
                where.setdefault(piece, []).append((k, i))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()
        self.known: dict[int, list[tuple[int, list]]] = {}

    def above(self, k: int) -> list[tuple[int, list]]:
        """For each piece of an item its offset and the runs above it (from, to, budget, text, masks), each run made once."""
        found = self.known.get(k)
        if found is None:
            _, item, budget = self.items[k]
            cut = pieces(item, budget)
            at, over = [offset for offset, _ in cut] + [len(item)], runs(len(cut))
            nodes = {r: (at[r[0]], at[r[1]], r[1] - r[0] - 1, part := item[at[r[0]] : at[r[1]]], character_masks(part)) for r in {r for x in over for r in x}}
            found = [(offset, [nodes[r] for r in x[:-1]]) for (offset, _), x in zip(cut, over)]
            if len(self.known) >= ITEMS_KEPT:
                self.known.clear()
            self.known[k] = found
        return found

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of each item's best place; hits on one stretch are verified once."""
        if not self.items or not text:
            return []
        seen: dict[int, tuple[int, int]] = {}
        best: dict[int, tuple[int, int, int]] = {}
        for end, (n, places) in self.automaton.iter(text):
            for k, i in places:
                if k in best and best[k][0] == 0:
                    continue
                offset, above = self.above(k)[i]
                at = end + 1 - n - offset
                for a, b, spare, part, masks in above:
                    if myers(part, text[max(0, at + a - spare) : at + b + spare], masks)[0] > spare:
                        break
                else:
                    item_id, item, budget = self.items[k]
                    start, stop = max(0, at - budget), min(len(text), at + len(item) + budget)
                    if k in seen and seen[k][0] <= start and stop <= seen[k][1]:
                        continue
                    if at >= 0 and text.startswith(item, at):
                        best[k] = (0, at, at + len(item))
                        continue
                    distance, length = myers(item, text[start:stop])
                    seen[k] = (start, stop)
                    if distance <= budget and (k not in best or distance < best[k][0]):
                        best[k] = (distance, max(0, start + length - len(item)), start + length)
        return sorted((self.items[k][0], *x) for k, x in best.items())


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Normalized items in order of id, in blocks of about ``block_chars``; tasks normalize them, the driver holds one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([normalize(x.as_py()) for x in batch.column(1)], pa.string())], names=["i", "t"])

    items = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("i is not null").mapInArrow(run, "i long, t string")
    block, size = [], 0
    for row in items.where("t <> ''").orderBy("i", "t").toLocalIterator():
        block.append((row["i"], row["t"]))
        size += len(row["t"])
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


class Block:
    """A block of items on the executors."""

    def __init__(self, spark: SparkSession, items: list[tuple[int, str]], error_rate: float):
        self.items, self.error_rate, self.name = spark.sparkContext.broadcast(items), error_rate, uuid.uuid4().hex  # a block's text, and an item, at most

    def matcher(self) -> Matcher:
        return worker_value("matcher", self.name, lambda: Matcher(self.items.value, self.error_rate))


def found_in(matcher: Matcher, text: str | None) -> list[dict]:
    return [dict(zip([x.name for x in MATCH.value_type], x)) for x in matcher.find(normalize(text))]


def text_hash(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def hits(texts: DataFrame, block: Block) -> DataFrame:
    """``h1, h2, matches`` of the texts that hold an item of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = block.matcher()
        for batch in batches:
            found = [found_in(matcher, x.as_py()) for x in batch.column(2)]
            hit = pa.array([bool(x) for x in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(hit), batch.column(1).filter(hit), pa.array([x for x in found if x], MATCH)], names=["h1", "h2", "matches"])

    return texts.select(*text_hash(F.col("text")), "text").mapInArrow(run, f"h1 long, h2 long, matches {MATCHES}").dropDuplicates(["h1", "h2"])


def all_hits(texts: DataFrame, blocks: Iterator[Block], work: Workspace) -> DataFrame:
    """``h1, h2, matches`` over all blocks, each pass's result written before the next block is sent."""
    out = None
    for i, block in enumerate(blocks):
        one = work.table(f"hits-{i}", hits(texts, block))
        block.items.unpersist()
        out = one if out is None else out.unionByName(one)
    return out.groupBy("h1", "h2").agg(F.array_sort(F.flatten(F.collect_list("matches"))).alias("matches"))  # a text's matches


def two_first(blocks: Iterator[Block]) -> tuple[list[Block], Iterator[Block]]:
    """The first two blocks, if there are so many, and all of them."""
    first = list(itertools.islice(blocks, 2))
    return first, itertools.chain(first, blocks)


def find_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, contaminated, item_ids, matches`` for every row of ``docs``.

    ``matches`` lists each item found, with its smallest distance and a place in the normalized text.  Null
    and empty texts match nothing, and neither do items without words or with a null id; repeated rows and
    null ids are kept; other columns are not read; an empty benchmark leaves all documents clean.  With one
    block of items rows are independent and there is no shuffle; with several the rows are joined once.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    first, blocks = two_first(Block(spark, x, error_rate) for x in item_blocks(benchmark, item_id, item_text, block_chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = first[0].matcher()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([found_in(matcher, x.as_py()) for x in batch.column(1)], MATCH)], names=["doc_id", "matches"])

    none = F.array().cast(MATCHES)
    if not first:
        out = rows.withColumn("matches", none)
    elif len(first) == 1:
        out = rows.mapInArrow(run, f"doc_id {kind}, matches {MATCHES}")
    else:
        found = all_hits(rows, blocks, Workspace(spark, "leaks"))
        out = rows.select("doc_id", *text_hash(F.col("text"))).join(found, ["h1", "h2"], "left").withColumn("matches", F.coalesce("matches", none))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return out.select("doc_id", (F.size("matches") > 0).alias("contaminated"), items.alias("item_ids"), "matches")


def decontaminate(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Drop the rows whose text holds an item; the others keep all their columns, whatever these are called.

    Nulls, empty texts, repeated rows and empty tables as in ``find_leaks``.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    at, schema = docs.columns.index(text_col), docs.schema
    first, blocks = two_first(Block(spark, x, error_rate) for x in item_blocks(benchmark, item_id, item_text, block_chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = first[0].matcher()
        for batch in batches:
            yield batch.filter(pa.array([not matcher.find(normalize(x.as_py())) for x in batch.column(at)], pa.bool_()))

    if not first:
        return docs
    if len(first) == 1:
        return docs.mapInArrow(run, schema)
    found = all_hits(docs.select(F.col(text_col).alias("text")), blocks, Workspace(spark, "leaks"))
    found = found.select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"))
    h1, h2 = text_hash(docs[text_col])
    return docs.join(found, (h1 == F.col("__h1")) & (h2 == F.col("__h2")), "left_anti")
