"""Language-model scoring by a weighted backoff automaton over word n-grams.

States are contexts, each n-gram seen in training is an arc, and each state has a failure arc to the
context without its first word:

    arc      h -> w   log10 (c(h w) + mu P(w | fail(h))) / (c(h) + mu)
    failure  h        log10 mu / (c(h) + mu)
    root     w        log10 (c(w) - d) / N;  an unknown word: log10 d V / N

so probabilities over the known words and one unknown word sum to 1 in every state.  Scoring is one
traversal from left to right that carries the state: follow the arc if there is one, else fail and try again.
The arc of a text's end leads to the state of a text's start, so texts are one stream.

The automaton of a large corpus fits no machine, so it is never gathered.  Documents are packed into
blocks of bounded text.  A block asks for the counts of its own distinct n-grams: fingerprints, sorted and
cut into hash buckets, go to the bucket's group, which adds up the counts of all blocks and answers each
with its totals.  With the answers a block builds the slice of the automaton that its texts can reach: states,
sorted arcs, failure arcs.  No key is hot: an n-gram comes once from a block, however frequent.

The state depends on the last ``order - 1`` words alone, so a block's stream is cut into lanes that are
traversed in step; a lane begins at the root that many words early, by which it has reached its state.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, id_remainder
from .shingles import chain, words_of

#: Longest n-grams; text of a block, n-grams of a bucket (about), words of a lane.
ORDER, BLOCK_BYTES, BUCKET_GRAMS, LANE_WORDS = 3, 8 << 20, 4_000_000, 1_024
#: Bits of an n-gram's fingerprint; of 100 million n-grams no two are expected to share one.
KEY_BITS = 56
#: Strength of the backoff distribution in a context, in occurrences.
MU = 30.0
END, START = 0, 1
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def pack(x: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes(), 1)


def unpack(data: bytes, kind: str) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def discount(n1: int, n2: int) -> float:
    """Ney's estimate of the absolute discount, kept inside (0, 1)."""
    return min(0.99, max(0.01, n1 / (n1 + 2 * n2))) if n1 else 0.01


class Block:
    """Documents with their words numbered in the block; 0 ends a document, 1 stands before its start."""

    def __init__(self):
        self.words, self.tokens, self.ids, self.held, self.size = {}, [], [], [], 0

    def add(self, doc_id: int | None, held: bool, text: str | None) -> None:
        words, known = words_of(text), self.words
        numbers = [known.setdefault(w, len(known) + 2) for w in words]
        numbers.append(END)
        self.tokens.append(np.array(numbers, np.uint32))
        self.ids.append(doc_id)
        self.held.append(held)
        self.size += len(text or "")

    def row(self, block: int) -> tuple:
        tokens = np.concatenate(self.tokens)
        return block, len(tokens), self.ids, self.held, zstandard.compress(b"\n".join(self.words), 3), pack(tokens)


def pack_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Rows ``block, n_tokens, ids, held, words, tokens`` from (doc_id, held_out, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary()]
        first, k, block = TaskContext.get().partitionId() << 24, 0, Block()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(block.row(first + k), kinds)], names=["block", "n_tokens", "ids", "held", "words", "tokens"])

        for batch in batches:
            for doc_id, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                block.add(doc_id, held, text.as_py())
                if block.size >= block_bytes:
                    yield out()
                    k, block = k + 1, Block()
        if block.ids:
            yield out()

    return docs.mapInArrow(run, "block long, n_tokens long, ids array<long>, held array<boolean>, words binary, tokens binary")


def grams(words: bytes, tokens: np.ndarray, held: np.ndarray, order: int) -> tuple[list, np.ndarray, np.ndarray]:
    """For each order (distinct fingerprints, number of each token's, training count of each, a place of each); documents' starts; each token's number in its document."""
    names = zstandard.decompress(words)
    h = np.array([0x1D0C5EED, 0x57A127, *map(xxhash.xxh3_64_intdigest, names.split(b"\n") if names else [])], np.uint64)
    ends = np.flatnonzero(tokens == END)
    starts = np.concatenate(([0], ends[:-1] + 1))
    lengths = ends - starts + 1
    place = (np.arange(len(tokens)) - np.repeat(starts, lengths)).astype(np.int32)
    train = np.repeat(~held, lengths)
    own, found = h[tokens], []
    for n in range(1, order + 1):
        columns = [own]
        for back in range(1, n):
            before = np.full(len(own), h[START])
            before[back:] = own[:-back]
            before[place < back] = h[START]
            columns.insert(0, before)
        keys, first, number = np.unique(chain(columns) >> np.uint64(64 - KEY_BITS), return_index=True, return_inverse=True)
        found.append((keys, number.astype(np.int32), np.bincount(number[train], minlength=len(keys)).astype(np.uint32), first.astype(np.int32)))
    return found, starts, place


def requests(blocks: DataFrame, order: int, bits: int) -> DataFrame:
    """``n, bucket, block, keys, counts``: a block's distinct n-grams and their training counts in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found, _, _ = grams(row["words"], unpack(row["tokens"], "u4"), np.array(row["held"], bool), order)
                for n, (keys, _, counts, _) in enumerate(found, 1):
                    cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(KEY_BITS - bits)) if bits else np.empty(0, int)
                    out = []
                    for bucket, (k, c) in enumerate(zip(np.split(keys, cuts), np.split(counts, cuts))):
                        if len(k):
                            out.append((n, bucket, row["block"], pack(np.diff(k, prepend=np.uint64(0))), pack(c)))
                    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=["n", "bucket", "block", "keys", "counts"])

    return blocks.select("block", "held", "words", "tokens").mapInArrow(run, "n int, bucket int, block long, keys binary, counts binary")


def answers(asked: DataFrame) -> DataFrame:
    """``n, bucket, block, counts`` with whole-corpus counts in the order asked, and per group a row of statistics."""

    def add_up(group: pa.Table) -> pa.Table:
        n, bucket, blocks = group["n"][0].as_py(), group["bucket"][0].as_py(), group["block"].to_pylist()
        keys = [np.cumsum(unpack(x.as_py(), "u8"), dtype=np.uint64) for x in group["keys"]]
        counts = np.concatenate([unpack(x.as_py(), "u4") for x in group["counts"]])
        _, number = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(number, weights=counts).astype(np.int64)
        mine = np.split(totals[number], np.cumsum([len(k) for k in keys])[:-1])
        stats = [int(totals.sum()), int((totals > 0).sum()), int((totals == 1).sum()), int((totals == 2).sum())]
        rows = [(n, bucket, b, pack(x), 0, 0, 0, 0) for b, x in zip(blocks, mine)] + [(n, bucket, None, None, *stats)]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["n", "bucket", "block", "counts", "tokens", "distinct", "once", "twice"])

    return asked.groupBy("n", "bucket").applyInArrow(add_up, "n int, bucket int, block long, counts binary, tokens long, distinct long, once long, twice long")


class Automaton:
    """States, sorted arcs and failure arcs of the n-grams that a block's texts can reach.

    ``number``, ``first`` and ``counts`` hold for each order the n-gram that ends at each token of the stream, a
    place of each n-gram and its count in training.  State 0 is the root; ``begin`` is a text's start.
    """

    def __init__(self, number: list[np.ndarray], first: list[np.ndarray], counts: list[np.ndarray], place: np.ndarray, ends: np.ndarray, docs: int, total: int, distinct: int, d: float, mu: float):
        self.order, self.labels, labels = len(number), len(first[0]), number[0]
        known = [np.flatnonzero(c > 0) for c in counts]
        # contexts of length n: the known n-grams that no text ends with, and n starts
        states, fail, fail_weight, start = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1)], [0]
        size = 1
        for n in range(1, self.order):
            i = n - 1
            g = known[i][~ends[first[i][known[i]]]]
            own = np.zeros(len(first[i]), np.int64)
            own[g] = size + np.arange(len(g))
            states.append(own)
            shorter = states[n - 1][number[n - 2][first[i][g]]] if n > 1 else np.zeros(len(g), np.int64)
            fail.append(np.append(shorter, start[-1]))
            fail_weight.append(np.log10(mu / (np.append(counts[i][g], docs) + mu)))
            size += len(g) + 1
            start.append(size - 1)
        self.begin, self.fail, self.fail_weight = start[-1], np.concatenate(fail), np.concatenate(fail_weight)
        keys, weights, targets = [], [], []
        p = np.zeros(len(first[0]))
        for n in range(1, self.order + 1):  # arcs from contexts of length n - 1
            g = known[n - 1]
            at = first[n - 1][g]
            if n == 1:
                source, own = np.zeros(len(g), np.int64), (counts[0][g] - d) / total
            else:
                begins = place[at] == 0
                before = np.where(begins, 0, number[n - 2][at - 1])
                source = np.where(begins, start[n - 1], states[n - 1][before])
                context = np.where(begins, docs, counts[n - 2][before])
                own = (counts[n - 1][g] + mu * p[number[n - 2][at]]) / (context + mu)
            p = np.zeros(len(first[n - 1]))
            p[g] = own
            target = states[n][g] if n < self.order else states[n - 1][number[n - 2][at]] if n > 1 else np.zeros(len(g), np.int64)
            keys.append(source * self.labels + labels[at])
            weights.append(np.log10(own))
            targets.append(np.where(ends[at], self.begin, target))
        keys = np.concatenate(keys)
        order = np.argsort(keys)
        self.keys, self.weights, self.targets = keys[order], np.concatenate(weights)[order], np.concatenate(targets).astype(np.int32)[order]
        self.unknown = math.log10(d * distinct / total)

    def step(self, state: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """From a state by a label for each lane: (state, log probability, failures)."""
        score, after, failures = np.zeros(len(state)), np.empty(len(state), np.int64), 0
        lanes = np.arange(len(state))
        while len(lanes):
            key = state * self.labels + label
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[at] == key
            hit = lanes[there]
            score[hit] += self.weights[at[there]]
            after[hit] = self.targets[at[there]]
            lanes, state, label = lanes[~there], state[~there], label[~there]
            root = state == 0
            score[lanes[root]] += self.unknown
            after[lanes[root]] = 0
            lanes, state, label = lanes[~root], state[~root], label[~root]
            score[lanes] += self.fail_weight[state]
            state = self.fail[state]
            failures += len(lanes)
        return after, score, failures

    def traverse(self, labels: np.ndarray, lane_words: int = LANE_WORDS) -> tuple[np.ndarray, int]:
        """The log probability of each label of a stream that begins at a text's start, and the failure arcs taken."""
        n = len(labels)
        begins = np.arange(0, n, lane_words)
        out, taken, state = np.empty(n), 0, np.zeros(len(begins), np.int64)
        state[0] = self.begin
        for t in range(1 - self.order, min(lane_words, n)):
            lanes = slice(int(t < 0), np.searchsorted(begins, n - t))  # the first lane needs no way to its state
            at = begins[lanes] + t
            state[lanes], score, failures = self.step(state[lanes], labels[at])
            if t >= 0:
                out[at] = score
                taken += failures
        return out, taken


def block_scores(found: list, counts: list[np.ndarray], starts: np.ndarray, place: np.ndarray, docs: int, total: int, distinct: int, d: float, mu: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document of a block: known tokens, base score and score."""
    number = [x[1] for x in found]
    c1 = counts[0][number[0]]
    base, own = np.log10((c1 + 1) / (total + distinct + 1)), np.zeros(len(c1))
    if total:
        ends = np.zeros(len(place), bool)
        ends[starts[1:] - 1] = ends[-1] = True
        own, _ = Automaton(number, [x[3] for x in found], counts, place, ends, docs, total, distinct, d, mu).traverse(number[0].astype(np.int64))
    add = lambda x: np.add.reduceat(x, starts)
    return add((c1 > 0).astype(np.int64)), add(base), add(own)


def score_documents(docs: DataFrame, held_out=None, order: int = ORDER, mu: float = MU, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    ``held_out`` is a condition on the rows that aren't learned from (by default crc32 of the id modulo 7
    is 2).  A null text counts as empty; an empty text is its end token alone.  Repeated rows count and are
    scored as often as they occur; a null id has remainder 0.  Other columns, whatever their names, are not read.
    Without training rows every probability is 1 (base and score 0).
    """
    spark = docs.sparkSession
    work = Workspace(spark, "ngram-lm")
    held = id_remainder(F.col(id_col), 7) == 2 if held_out is None else held_out
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    blocks = work.table("blocks", pack_blocks(rows, block_bytes))
    size = blocks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first()["n"]
    bits = max(4, math.ceil(math.log2(max(1, size / BUCKET_GRAMS))) + 1)
    replies = work.table("answers", answers(requests(blocks, order, bits)))
    s = replies.where("block is null and n = 1").agg(*(F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("tokens", "distinct", "once", "twice"))).first()
    total, distinct, d = s["tokens"], s["distinct"], discount(s["once"], s["twice"])
    documents = blocks.select(F.explode("held").alias("h")).where("not h").count()

    def score(key: tuple, block: pa.Table, got: pa.Table) -> pa.Table:
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        names = [x.split()[0] for x in RESULT.split(", ")]
        columns = [[] for _ in kinds]
        for row in block.to_pylist():
            held = np.array(row["held"], bool)
            tokens = unpack(row["tokens"], "u4")
            found, starts, place = grams(row["words"], tokens, held, order)
            parts = {(n, b): x for n, b, x in zip(got["n"].to_pylist(), got["bucket"].to_pylist(), got["counts"])}
            counts = [np.concatenate([unpack(parts[k].as_py(), "i8") for k in sorted(parts) if k[0] == n]) for n in range(1, order + 1)]
            known, base, own = block_scores(found, counts, starts, place, documents, total, distinct, d, mu)
            lengths = np.diff(starts, append=len(tokens))
            for c, x in zip(columns, (row["ids"], row["held"], lengths, known, [total] * len(starts), base, own)):
                c.extend(x)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    left = blocks.select("block", "ids", "held", "words", "tokens").groupBy("block")
    right = replies.where("block is not null").select("block", "n", "bucket", "counts").groupBy("block")
    return left.cogroup(right).applyInArrow(score, RESULT)
