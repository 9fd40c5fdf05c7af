"""Periodic runs of words by partition refinement.

A run is a maximal stretch of words that repeats with its smallest period at least twice.  Positions of a document
are held in classes: two are in one class at level l if the l words from there on are equal.  From a level to the
next a class splits by the classes of the following positions, and only the smaller classes of the last split are
asked: when a class falls apart, all its parts but a largest one become splitters, so a position is moved at most
log n times.  Neighbours in a class at level l whose distance is l are a square with a root that is no repetition
itself, and squares of one period at consecutive positions are one run.

Each class holds its positions as a linked list in ascending order.  A neighbour's distance only changes when one of
the two is moved, so squares are read off then: a distance g that held from level a to level b is a square if
``a <= g <= b``.  Many documents are refined at once as one sequence, each with an end mark of its own and classes
of its own, in arrays; work and memory follow the number of words, and no document meets another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, worker_clear

#: Bytes of text that are refined at once; a longer text is one piece.
CHUNK_BYTES = 6 << 20


def heads(x: np.ndarray) -> np.ndarray:
    """Where a new value begins in a grouped array."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.empty(0, np.int64)


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``first[i] .. first[i] + count[i] - 1``, one range after the other."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


class Refinement:
    """Classes of the positions of a sequence; ``n`` stands for no position."""

    def __init__(self, first_class: np.ndarray):
        n = self.n = len(first_class)
        self.members = np.argsort(first_class, kind="stable")  # grouped by class
        values = first_class[self.members]
        first = heads(values)
        sizes = np.diff(np.append(first, n))
        self.start, self.size = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.start[: len(first)], self.size[: len(first)] = first, sizes
        self.classes = len(first)
        self.of = np.empty(n, np.int64)
        self.of[self.members] = np.repeat(np.arange(len(first)), sizes)
        self.place = np.empty(n, np.int64)
        self.place[self.members] = np.arange(n)
        self.next, self.before = np.full(n + 1, n), np.full(n + 1, n)
        self.link(self.members, values)
        self.since = np.ones(n, np.int64)
        self.moving = np.zeros(n + 1, bool)
        self.level, self.squares = 1, []

    def link(self, positions: np.ndarray, group: np.ndarray) -> None:
        """Lists of positions that stand in ascending order in each group."""
        self.next[positions] = self.before[positions] = self.n
        same = group[1:] == group[:-1]
        a, b = positions[:-1][same], positions[1:][same]
        self.next[a], self.before[b] = b, a

    def note(self, positions: np.ndarray) -> None:
        """Squares among these positions, whose neighbours are about to change."""
        other = self.next[positions]
        gap = other - positions
        found = (other < self.n) & (self.since[positions] <= gap) & (gap < self.level)
        if found.any():
            self.squares.append((gap[found], positions[found]))
        self.since[positions] = self.level

    def refine(self, splitters: np.ndarray) -> np.ndarray:
        """One level on; ``splitters`` are the positions of the asked classes, the result those of the next ones."""
        none = np.empty(0, np.int64)
        self.level += 1
        i = splitters - 1
        i = i[i >= 0]
        i = i[self.size[self.of[i]] > 1]
        if not len(i):
            return none
        i.sort()
        i = i[np.argsort(self.of[i], kind="stable")]  # by class and position
        own, key = self.of[i], self.of[i] * self.classes + self.of[i + 1]
        order = np.argsort(key, kind="stable")
        key, positions = key[order], i[order]  # by class, following class and position
        group = heads(key)
        many, parent = np.diff(np.append(group, len(key))), own[order][group]
        family = heads(parent)  # groups of one class
        groups = np.diff(np.append(family, len(group)))
        classes = parent[family]
        rest = self.size[classes] - np.add.reduceat(many, family)
        largest = np.maximum.reduceat(many, family)
        at = np.flatnonzero(many == np.repeat(largest, groups))
        chief = np.zeros(len(group), bool)
        chief[at[heads(np.repeat(np.arange(len(family)), groups)[at])]] = True  # the first largest group of each class
        moves = ~(chief & np.repeat(rest == 0, groups))  # where nothing else is left, the chief group stays
        if not moves.any():
            return none
        moved = positions[np.repeat(moves, many)]
        sizes = many[moves]
        self.moving[moved] = True
        by_place = i[self.moving[i]]
        chain_first, chain_last = by_place[~self.moving[self.before[by_place]]], by_place[~self.moving[self.next[by_place]]]
        left, right = self.before[chain_first], self.next[chain_last]
        self.note(np.concatenate((left[left < self.n], moved)))
        self.next[left], self.before[right] = right, left
        new = self.classes + np.arange(len(sizes))
        named = np.repeat(new, sizes)
        self.link(moved, named)

        # moved positions go to the end of their class's stretch, others there to the places that come free
        gone = np.add.reduceat(np.where(moves, many, 0), family)
        edge = self.start[classes] + self.size[classes] - gone
        place, target = self.place[moved], ranges(edge, gone)
        free = place[place < np.repeat(edge, gone)]
        there = self.members[target]
        stay = there[~self.moving[there]]
        self.members[free], self.place[stay] = stay, free
        self.members[target], self.place[moved] = moved, target
        self.start[new], self.size[new] = target[np.cumsum(sizes) - sizes], sizes
        self.size[classes] -= gone
        self.of[moved] = named
        self.classes += len(sizes)
        self.moving[moved] = False

        exceeds = (rest > 0) & (largest > rest)  # then the chief group needn't be asked, but the rest
        asked = np.repeat((~(chief & np.repeat(exceeds, groups)))[moves], sizes)
        small = classes[exceeds]
        return np.concatenate((moved[asked], self.members[ranges(self.start[small], self.size[small])])) if len(small) else moved[asked]

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """Periods and positions of all squares with primitive roots."""
        splitters = np.arange(1, self.n)
        while len(splitters):
            splitters = self.refine(splitters)
        if not self.squares:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([g for g, _ in self.squares]), np.concatenate([p for _, p in self.squares])


def periodic_runs(words: np.ndarray, sizes: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of several documents: document, start within it, length and period, by document, start and period.

    ``words`` are the documents' words as numbers, one document after the other, ``sizes`` their numbers of words.
    """
    n, total = len(sizes), len(words)
    doc = np.repeat(np.arange(n), sizes)
    kinds = int(words.max()) + 1 if total else 1
    at = np.arange(total) + doc  # an end mark stands after each document
    marked = np.empty(total + n, np.int64)
    marked[at] = doc * kinds + words
    ends = np.cumsum(sizes) + np.arange(n)
    marked[ends] = n * kinds + np.arange(n)
    gap, position = Refinement(marked).run()
    order = np.lexsort((position, gap))
    gap, position = gap[order], position[order]
    new = np.flatnonzero(np.concatenate(([True], (gap[1:] != gap[:-1]) | (position[1:] != position[:-1] + 1)))) if len(gap) else np.empty(0, np.int64)
    last = np.append(new[1:], len(gap)) - 1 if len(new) else new
    start, period = position[new], gap[new]
    length = position[last] - start + 2 * period
    long = length >= min_length
    start, period, length = start[long], period[long], length[long]
    doc_of = np.searchsorted(ends, start)
    start = start - (ends[doc_of] - sizes[doc_of])
    order = np.lexsort((period, start, doc_of))
    return doc_of[order], start[order], length[order], period[order]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts in order, and how many each text has; null is empty."""
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
    words, sizes = split.flatten(), pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(words), 0)
    keep = full.to_numpy(zero_copy_only=False)
    if not keep.all():  # an empty text
        sizes = np.add.reduceat(np.append(keep, False).astype(np.int64), np.cumsum(sizes) - sizes) * (sizes > 0)
        words = words.filter(full)
    return words, sizes


NAMES = ["n_words", "n_runs", "start", "length", "period", "runs", "collapsed"]
TYPES = [pa.int64()] * 5 + [pa.string()] * 2


def describe(texts: pa.Array, min_length: int) -> list[pa.Array]:
    """The columns ``NAMES`` for some texts."""
    words, sizes = split_words(texts)
    coded = words.dictionary_encode()
    doc, start, length, period = periodic_runs(coded.indices.to_numpy().astype(np.int64), sizes, min_length)
    n = len(sizes)
    first = np.searchsorted(doc, np.arange(n + 1))
    offset = (np.cumsum(sizes) - sizes)[doc]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, offset + start + period, 1)
    np.add.at(change, offset + start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    kept_ends = np.concatenate(([0], np.cumsum(kept)))[np.concatenate(([0], np.cumsum(sizes)))]
    kind = pa.LargeListArray if pa.types.is_large_string(words.type) else pa.ListArray
    lists = kind.from_arrays(pa.array(kept_ends, pa.int64() if kind is pa.LargeListArray else pa.int32()), words.filter(pa.array(kept)))
    lines = [f"{a},{b},{c}\n" for a, b, c in zip(start.tolist(), length.tolist(), period.tolist())]
    best = np.lexsort((period, start, -length, doc))  # longest, then first, then shortest period
    best = best[np.minimum(first[:-1], max(len(best) - 1, 0))] if len(best) else np.zeros(n, np.int64)
    none = first[1:] == first[:-1]
    longest = [pa.array(x[best] if len(x) else np.zeros(n, np.int64), pa.int64(), mask=none) for x in (start, length, period)]
    return [pa.array(sizes), pa.array(np.diff(first)), *longest, pa.array(["".join(lines[a:b]) for a, b in zip(first, first[1:])], pa.string()), pc.binary_join(lists, " ").cast(pa.string())]


def pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Cuts (from, to) of about ``CHUNK_BYTES`` of text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at, ends = 0, np.cumsum(sizes)
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_BYTES, "right")))
        yield at, to
        at = to


def find_runs(docs: DataFrame, min_length: int = 12, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """``doc_id, n_words, n_runs, start, length, period, runs, collapsed`` for every row of ``docs``.

    ``runs`` lists all runs of at least ``min_length`` words (and two periods) as lines ``start,length,period``
    by start, then period; ``start, length, period`` are those of the longest (ties: smallest start, then
    period), null without any; ``collapsed`` is the text without words that a run holds after its first period,
    words joined by one space.  With ``digests``, ``runs`` and ``collapsed`` are their SHA-256 in hex, so long
    texts don't leave the task.  A null or empty text has no words, no runs and an empty rest; a null id stays
    null; repeated rows give repeated results; other columns aren't read; an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    sha = lambda x: pa.array([hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest() for v in x.to_pylist()], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_clear()
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                out = describe(batch.column(1).slice(a, b - a), min_length)
                if digests:
                    out[-2:] = map(sha, out[-2:])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *out], names=["doc_id", *NAMES])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_runs long, start long, length long, period long, runs string, collapsed string")


def with_cycles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``: every tenth document (by the crc32 h of its id) made periodic, the others as they are.

    With g = floor(h / 10) and n words, the words from a = g % n on become those from a on in turns of
    p = 1 + floor((n - a) / (3 + g % 8)).  A null id counts as the empty text, whose h is 0.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    chosen = rows.withColumn("g", F.when(h % 10 == 0, F.floor(h / 10)))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    chosen = chosen.withColumn("w", F.when(F.col("g").isNotNull(), words)).withColumn("n", F.size("w"))
    a = F.col("g") % F.col("n")
    p = 1 + F.floor((F.col("n") - a) / (3 + F.col("g") % 8))
    turned = lambda i: F.element_at("w", (F.when(i >= a, a + (i - a) % p).otherwise(i) + 1).cast("int"))
    cycled = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), turned), " ")
    return chosen.select("doc_id", F.when(F.col("g").isNotNull() & (F.col("n") > 0), cycled).otherwise(F.col("text")).alias("text"))
