"""Quality by Bradley-Terry ranking: document scores from preference pairs, cut at a quantile.

Each labelled good document is preferred to some labelled poor ones.  The score is
linear in features of the text: numbers that describe its form, and how often it has the words of each of
``WORD_BINS`` hashed classes.  The weights minimise the logistic loss of the difference between the two
documents of each pair.  All labelled rows teach: tasks fit blocks of them, which hashes of the ids deal out, and the
weights are averaged.  The cut is the exact quantile of their scores at the share of poor documents, and scores are
mapped so that the cut becomes 0.3.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Kept, Workspace, bound_batches, id_remainder, worker_value
from .labelled import labelled_rows

THRESHOLD = 0.3
#: Rows of a block, which one task fits; their number grows with the rows.
BLOCK_ROWS = 12_000
#: Bins of a search for a quantile, and scores that end it.
RANK_BINS, RANK_ROWS = 1_024, 4_096
#: Preference pairs for each document of a block.
PAIRS_EACH = 8
#: Hashed classes of words, the weight of their differences against the other features', words that a worker keeps.
WORD_BINS, WORD_SCALE, WORDS_KEPT = 256, 0.25, 150_000
#: Pull of the weights towards 0.
DECAY = 1e-4
SIGNS = "%&$#*|!_^~<>{}[]\\/=+@"
FEATURES = [
    "length", "word_length", "word_spread", "sign_words", "signs", "upper", "shouted", "digits", "stops", "distinct", "distinct_long",
    "lines_distinct", "line_words", "sentences_distinct", "bars", "short", "long_words", "repeat_next", "top_word", "lines_short", "ends_ok",
]
EDGES = " .,;:!?\"'()" + SIGNS
SENTENCE = re.compile(r"[.!?]+\s+|\n+")


def word_bins(words: list[str]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(w.strip(EDGES).lower()) % WORD_BINS for w in words]


class Features:
    """The features of texts; keeps the classes of words."""

    def __init__(self):
        self.kept = Kept(WORDS_KEPT)

    def of(self, text: str | None) -> np.ndarray:
        """Form, then the root of each word class's share; a text without words has none but ``short``."""
        kinds: dict[str, int] = {}
        for w in (text or "").split():
            kinds[w] = kinds.get(w, 0) + 1
        shares = np.bincount(self.kept.all(list(kinds), word_bins), list(kinds.values()), WORD_BINS) if kinds else np.zeros(WORD_BINS)
        return np.concatenate([form(text, kinds), np.sqrt(shares / max(1, sum(kinds.values())))])

    def table(self, texts: pa.Array) -> np.ndarray:
        return np.array([self.of(t.as_py()) for t in texts]).reshape(len(texts), len(FEATURES) + WORD_BINS)

    @staticmethod
    def of_worker() -> "Features":
        return worker_value("quality", 0, Features)


def form(text: str | None, kinds: dict[str, int]) -> list[float]:
    """Numbers that describe a whole text of words with these counts; an empty one is all zeros but for ``short``."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * FEATURES.index("short") + [1.0] + [0.0] * (len(FEATURES) - FEATURES.index("short") - 1)
    size = len(text)
    lengths = np.fromiter(map(len, words), np.int32, n)
    signs = sum(map(text.count, SIGNS))
    signed = shouted = digits = 0
    for w, k in kinds.items():
        if w[-1] in SIGNS or w[0] in SIGNS:
            signed += k
        if w.isupper() and len(w) > 1:
            shouted += k
        if not w.isalpha() and any(map(str.isdigit, w)):
            digits += k
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    sentences = [x for x in SENTENCE.split(text) if x]
    upper = sum(k * len(w) for w, k in kinds.items() if w.isupper())
    repeated = sum(a == b for a, b in zip(words, words[1:]))
    long_ = [w for w in kinds if len(w) > 3]
    return [
        math.log1p(n), float(lengths.mean()) / 10, float(lengths.std()) / 10, signed / n, signs / size, upper / size, shouted / n, digits / n,
        (text.count(".") + text.count(",")) / n, len(kinds) / n, len(long_) / (1 + sum(kinds[w] for w in long_)),
        len(set(lines)) / len(lines), math.log1p(n / len(lines)), len(set(sentences)) / max(1, len(sentences)), text.count("|") / n, 1 / (1 + n),
        float((lengths > 20).mean()), repeated / n, max(kinds.values()) / n, sum(len(x) < 20 for x in lines) / len(lines), sum(x[-1] in ".!?" for x in lines) / len(lines),
    ]


class Ranker:
    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, cut: float):
        self.mean, self.scale, self.weights, self.cut = mean, scale, weights, cut

    def plain(self) -> tuple:
        return tuple(x.tolist() for x in (self.mean, self.scale, self.weights)) + (self.cut,)

    @staticmethod
    def of(plain: tuple) -> "Ranker":
        return Ranker(*map(np.array, plain[:3]), plain[3])

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        z, words = z[..., : len(FEATURES)], z[..., len(FEATURES) :] * WORD_SCALE
        return np.concatenate([z, np.abs(z), z * z / 8, words], axis=-1)

    def rank(self, x: np.ndarray) -> np.ndarray:
        """The Bradley-Terry score: the log odds of being preferred."""
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.rank(x) - self.cut + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def loss(weights: np.ndarray, z: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean logistic loss of the pairs (row a preferred to row b) with its pull to 0, and the gradient."""
    s = z @ weights
    gap = np.clip(s[a] - s[b], -30, 30)
    error = 1 / (1 + np.exp(gap))  # probability given to the wrong order
    pull = np.bincount(b, error, len(z)) - np.bincount(a, error, len(z))
    return float(np.log1p(np.exp(-gap)).mean() + DECAY / 2 * weights @ weights), pull @ z / len(a) + DECAY * weights


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 400) -> Ranker:
    """From features and labels (0 poor, 1 good); with one kind only, every document gets the same score."""
    width = x.shape[1]
    ranker = Ranker(x.mean(0) if len(x) else np.zeros(width), (x.std(0) if len(x) else np.zeros(width)) + 1e-6, np.zeros(2 * len(FEATURES) + width), 0.0)
    good, poor = int((y == 1).sum()), int((y == 0).sum())
    if not good or not poor:
        ranker.cut = one_kind_cut(good, len(x))
        return ranker
    ranker.weights = fit_weights(ranker, x, y, rounds)
    ranker.cut = quantile_cut(ranker.rank(x), poor)
    return ranker


def one_kind_cut(good: int, rows: int) -> float:
    return -30.0 if good or not rows else 30.0


def fit_weights(ranker: Ranker, x: np.ndarray, y: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Weights from rows of both kinds."""
    good, poor = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    z, draw = ranker.expand(x), np.random.default_rng(7)
    a = np.concatenate([np.repeat(good, PAIRS_EACH), draw.choice(good, len(poor) * PAIRS_EACH)])
    b = np.concatenate([draw.choice(poor, len(good) * PAIRS_EACH), np.repeat(poor, PAIRS_EACH)])
    w, speed, square = np.zeros(z.shape[1]), 0.0, 0.0
    for k in range(1, rounds + 1):
        _, gradient = loss(w, z, a, b)
        speed, square = 0.9 * speed + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        w = w - 0.05 * (speed / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    return w


def quantile_cut(scores: np.ndarray, poor: int) -> float:
    """Between the ``poor`` lowest scores and the next."""
    s = np.sort(scores)
    return float((s[poor - 1] + s[min(poor, len(s) - 1)]) / 2)


def features_in(x: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in x), "<f4").astype(float).reshape(len(x), len(FEATURES) + WORD_BINS)


def by_block(rows: DataFrame, make, columns: str) -> DataFrame:
    """A row of ``columns`` for each block, from its features and labels in the order of the ids."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(block: pa.Table) -> pa.Table:
        block = block.combine_chunks().sort_by("doc_id")
        made = make(features_in(block["x"]), block["label"].to_numpy())
        return pa.table({"block": block["block"][:1]} | {n: pa.array([v]) for n, v in zip(names, made)})

    return rows.groupBy("block").applyInArrow(run, f"block long, {columns}").orderBy("block")


def moments(x: np.ndarray, y: np.ndarray) -> tuple:
    mean = x.mean(0)
    return len(x), mean.tolist(), ((x - mean) ** 2).sum(0).tolist()


def spread_of(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each feature over all rows: the blocks' own, put together one by one."""
    n, mean, square = 0, 0.0, 0.0
    for r in by_block(rows, moments, "n long, mean array<double>, square array<double>").toLocalIterator():
        gap = np.array(r["mean"]) - mean
        mean = mean + gap * (r["n"] / (n + r["n"]))
        square = square + np.array(r["square"]) + gap * gap * (n * r["n"] / (n + r["n"]))
        n += r["n"]
    return mean, np.sqrt(square / n)


def smallest(scores: DataFrame, k: int) -> float:
    """The ``k``-th smallest ``r`` (from 1): ranges are counted and narrowed until few scores are left, which are then sorted."""
    low, high = scores.agg(F.min("r"), F.max("r")).first()
    while True:
        inside = scores.where(F.col("r").between(low, high))
        width = (high - low) / RANK_BINS
        if inside.count() <= RANK_ROWS or not low < low + width < high:
            # a range that doubles can't divide holds a value or two, however many rows have them
            for r in inside.groupBy("r").count().orderBy("r").collect():
                if k <= r["count"]:
                    return r["r"]
                k -= r["count"]
        at = F.least(F.floor((F.col("r") - low) / width), F.lit(RANK_BINS - 1))
        for r in inside.groupBy(at.alias("at")).agg(F.count("*").alias("n"), F.min("r").alias("low"), F.max("r").alias("high")).orderBy("at").collect():
            if k <= r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]


def exact_cut(scores: DataFrame, poor: int) -> float:
    """``quantile_cut`` of a table of scores ``r``."""
    last = smallest(scores, poor)
    more = scores.agg(F.count_if(F.col("r") <= last).alias("n"), F.min(F.when(F.col("r") > last, F.col("r"))).alias("next")).first()
    return (last + (last if more["n"] > poor or more["next"] is None else more["next"])) / 2


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", train=None, rows: int = BLOCK_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Ranker:
    """Learn a ranking from all labelled documents that satisfy ``train``, in blocks of about ``rows``.

    Rows with a null id or label teach nothing; null texts count as empty; of repeated rows of an id one counts.
    Without labels, or with one kind only, every text gets the same score (0 if all are poor, else 1).
    """
    bound_batches(docs.sparkSession)
    work = Workspace(docs.sparkSession, "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Features.of_worker()
        for batch in batches:
            x = [row.astype("<f4").tobytes() for row in own.table(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.binary())], names=["doc_id", "label", "x"])

    found = work.table("rows", labelled_rows(docs, labels, label, train, id_col, text_col).mapInArrow(run, "doc_id long, label int, x binary"))
    kinds = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    n, good, poor = sum(kinds.values()), kinds.get(1, 0), kinds.get(0, 0)
    width = len(FEATURES) + WORD_BINS
    ranker = Ranker(np.zeros(width), np.zeros(width) + 1e-6, np.zeros(2 * len(FEATURES) + width), one_kind_cut(good, n))
    if good and poor:
        blocks = found.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(-(-n // rows))).cast("long"))
        mean, scale = spread_of(blocks)
        ranker = Ranker(mean, scale + 1e-6, ranker.weights, 0.0)
        plain = ranker.plain()

        def weights(x: np.ndarray, y: np.ndarray) -> tuple:
            both = (y == 1).any() and (y == 0).any()
            return (len(x), fit_weights(Ranker.of(plain), x, y).tolist()) if both else (0, [])

        taught = 0
        for r in by_block(blocks, weights, "n long, w array<double>").where("n > 0").toLocalIterator():
            ranker.weights = ranker.weights + np.array(r["w"]) * r["n"]
            taught += r["n"]
        ranker.weights = ranker.weights / max(1, taught)
        plain = ranker.plain()

        def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Ranker.of(plain)
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(own.rank(features_in(batch.column(0))), pa.float64())], names=["r"])

        ranker.cut = exact_cut(work.table("ranks", found.select("x").mapInArrow(ranks, "r double")), poor)
    work.close()
    return ranker


def score_texts(docs: DataFrame, ranker: Ranker, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every row, each by itself.

    A null text scores as an empty one, a text of any length whole; null ids and repeated rows are kept; other
    columns, whatever their names, are not read; an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    plain, kind = ranker.plain(), docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, features = Ranker.of(plain), Features.of_worker()
        for batch in batches:
            s = own.score(features.table(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], names=["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def drop_poor(docs: DataFrame, ranker: Ranker, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows that score at least the threshold, with all their columns, whatever their names; nulls as in ``score_texts``."""
    bound_batches(docs.sparkSession)
    plain, at = ranker.plain(), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, features = Ranker.of(plain), Features.of_worker()
        for batch in batches:
            s = own.score(features.table(batch.column(at)))
            yield batch.filter(pa.array(s >= threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def quality(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0) -> DataFrame:
    """Learn from the rows whose remainder differs, and score all: ``doc_id, held_out, score, predicted``.

    Odd rows as in ``learn`` and ``score_texts``; a null id has remainder 0.
    """
    ranker = learn(docs, labels, train=lambda i: id_remainder(i, modulus) != remainder)
    return score_texts(docs, ranker).select("doc_id", (id_remainder(F.col("doc_id"), modulus) == remainder).alias("held_out"), "score", "predicted")
