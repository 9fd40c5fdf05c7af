"""Toxicity by noisy-channel deobfuscation and a lexical score.

Every word but one of single letters only has more than one reading and becomes a lattice, as do characters
spaced out one by one: each sign may stand for some letters or for nothing at an end, a run for one or two of
its letter, a separator joins or splits.  A Viterbi search over the lattice finds the letters most likely
under the channel and a character trigram model.  A word counts as that, as written and joined over its
separators.  The restored text is scored by a logistic model over words and word beginnings.

The character model counts the words of all documents, in a table of ``BINS`` hashed counts whatever their
scripts.  Features and weights are learned from a bounded sample of labelled rows; every text is scored whole.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Kept, Workspace, bound_batches, id_remainder, worker_clear, worker_value
from .labelled import SAMPLE_ROWS, labelled_sample
from .shingles import chain

#: The letters that a sign is commonly written for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "§": "s", "*": "aeiou", "#": "h",
}
#: Log probabilities of the channel: a sign for a letter, a run of a letter shortened.
SIGN_COST, RUN_COST = math.log(0.2), math.log(0.2)
#: The same for a separator that joins, a sign at an end that stands for nothing, and one that mostly does so as a letter.
JOIN_COST, DROP_COST, MARK_COST = math.log(0.2), math.log(0.05), math.log(1e-4)
#: Signs that at a word's end are mostly punctuation, and those that also separate letters.
MARKS, ALSO_SEPARATORS = frozenset("!*#(¡"), frozenset("*+|#")
#: Rows of the sample that a feature needs, and its lift for label 1.
MIN_ROWS, MIN_LIFT = 6, 8.0
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
#: Counts of the character model; words that a worker keeps in each of two generations.
BINS, WORDS_KEPT = 1 << 20, 150_000
#: Paths of a lattice that are looked through for features before it is searched.
ENUMERATED = 32
EDGES = " \t\n\r\v\f.,;:!?\"'()[]{}<>%&$#*|+=-_~^/\\`«»„“”…¡¿@"
OPEN = "".join(c for c in EDGES if c not in SIGNS)
SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+(€£¡§*#])(?:[\s.,\-_~/:;·•]+(?:[^\W_]|[@$!|+(€£¡§*#])){2,}(?![^\s.,;:!?])")
SEVERAL = re.compile(r"[\W\d_]|([^\W\d_])\1")
LETTER = re.compile(r"[^\W\d_]")
#: What a separator that splits stands for.
SPLIT = " "


#: Kinds of counts: a trigram, its last two characters, its last one, the contexts of these, and all.
THREE, TWO, ONE, CONTEXT, MIDDLE, ALL = range(6)
WORD = (1 << 64) - 1


def bins_of(kind: int, *characters: np.ndarray) -> np.ndarray:
    """The bins of counts of a kind, for arrays of code points."""
    n = len(characters[0]) if characters else 1
    return (chain([np.full(n, kind, np.uint64), *(c.astype(np.uint64) for c in characters)]) & np.uint64(BINS - 1)).astype(np.int64)


def bin_of(kind: int, characters: str = "") -> int:
    """The same for one count, in plain numbers."""

    def mixed(x: int) -> int:
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & WORD
        x = (x ^ x >> 27) * 0x94D049BB133111EB & WORD
        return x ^ x >> 31

    out = mixed(kind + len(characters) + 1)
    for c in characters:
        out = mixed(out * 0x9E3779B97F4A7C15 + ord(c) & WORD)
    return out & BINS - 1


def hashed(words: list[str], times: np.ndarray) -> np.ndarray:
    """Counts of the trigrams of ``^^word$``, of their parts and contexts, in hashed bins."""
    bins = np.zeros(BINS)
    if words:
        text = np.frombuffer("".join([f"^^{w}$" for w in words]).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 3
        own = np.ones(len(text), bool)
        ends = np.cumsum(lengths)
        own[ends - 1] = own[ends - 2] = False  # a trigram doesn't reach into the next word
        at = np.flatnonzero(own)
        n = np.repeat(times, lengths - 2).astype(float)
        x, y, z = text[at], text[at + 1], text[at + 2]
        for where in (bins_of(THREE, x, y, z), bins_of(TWO, y, z), bins_of(ONE, z), bins_of(CONTEXT, x, y), bins_of(MIDDLE, y)):
            bins += np.bincount(where, n, BINS)
        bins[bin_of(ALL)] += n.sum()
    return bins.astype(np.int64)


class CharModel:
    """Character trigrams with counts of shorter contexts mixed in, from hashed counts (or a dict of words)."""

    def __init__(self, counts: np.ndarray | dict[str, int]):
        self.bins = hashed(list(counts), np.array(list(counts.values()))) if isinstance(counts, dict) else counts
        self.total = self.count(ALL)
        self.memo: dict[str, float] = {}

    def count(self, kind: int, characters: str = "") -> int:
        return int(self.bins[bin_of(kind, characters)])

    def log(self, gram: str) -> float:
        out = self.memo.get(gram)
        if out is None:
            n = self.count
            p = (n(ONE, gram[2]) + 0.5) / (self.total + 200)
            p = (n(TWO, gram[1:]) + 5 * p) / (n(MIDDLE, gram[1]) + 5)
            p = (n(THREE, gram) + 5 * p) / (n(CONTEXT, gram[:2]) + 5)
            if len(self.memo) >= WORDS_KEPT:
                self.memo.clear()
            out = self.memo[gram] = math.log(p)
        return out


def is_letter(c: str) -> bool:
    return c.isalpha() or unicodedata.category(c)[0] == "M"


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each stretch of a token the strings it may stand for, with the channel's log probability."""
    out, i = [], 0
    first = next((k for k, c in enumerate(token) if is_letter(c)), 0)
    last = next((k for k in range(len(token) - 1, -1, -1) if is_letter(token[k])), len(token) - 1)
    while i < len(token):
        c, j = token[i], i
        while j < len(token) and token[j] == c:
            j += 1
        if c in SIGNS:
            end, mark = (j <= first or i > last) and not c.isdigit(), c in MARKS
            step = [(x, MARK_COST if end and mark else SIGN_COST) for x in SIGNS[c]]
            if end:
                step.append(("", 0.0 if mark else DROP_COST))
            elif c in ALSO_SEPARATORS:
                step.append(("", JOIN_COST))
            for _ in range(j - i if j - i < 3 else 1):
                out.append(step)
        elif is_letter(c):
            if j - i == 1:
                out.append([(c, 0.0)])
            else:
                out.append([(c, RUN_COST * (j - i > 1)), (c * 2, 0.0 if j - i == 2 else RUN_COST)])
        elif not (out and (SPLIT, 0.0) in out[-1]):
            out.append([("", JOIN_COST), (SPLIT, 0.0)])
        i = j
    return out


def decode(token: str, model: CharModel) -> str:
    """The most likely letters behind a token (Viterbi over the last two letters); parts are apart by a space."""
    best: dict[str, tuple[float, tuple]] = {"^^": (0.0, ())}
    log = model.log
    for step in lattice(token):
        new: dict[str, tuple[float, tuple]] = {}
        for state, (score, text) in best.items():
            for letters, cost in step:
                s, total = state, score + cost
                if letters == SPLIT:
                    if s != "^^":
                        total += log(s + "$")
                        s = "^^"
                else:
                    for c in letters:
                        total += log(s + c)
                        s = s[1] + c
                if s not in new or total > new[s][0]:
                    new[s] = (total, (text, letters))
        best = new
    text = max(best.items(), key=lambda x: x[1][0] + log(x[0] + "$"))[1][1]
    parts = []
    while text:
        text, letters = text
        parts.append(letters)
    return "".join(reversed(parts))


def unseparated(token: str) -> str:
    return "".join([c for c in token if c in SIGNS or is_letter(c)])


class Restorer:
    """Words of a text as they were meant, each distinct word worked out once."""

    def __init__(self, model: CharModel):
        self.model, self.known = model, Kept(WORDS_KEPT // 4)

    def readings(self, token: str) -> set[str]:
        """The words of the most likely path, and the one word that the token is without its separators."""
        out = set(decode(token, self.model).split())
        joined = unseparated(token)
        if len(joined) < len(token):
            out.add(decode(joined, self.model))
        return out

    def word(self, raw: str) -> tuple[str, ...]:
        plain, bare = raw.strip(EDGES), raw.strip(OPEN)
        if not LETTER.search(bare) or not SEVERAL.search(bare):
            return (plain,)
        return tuple({plain} | self.readings(bare))

    def spaced(self, text: str) -> Iterator[set[str]]:
        """Readings of what is written with its characters apart."""
        for m in SPACED.finditer(text):
            if LETTER.search(m.group()):
                yield self.readings(m.group())

    def words(self, text: str) -> set[str]:
        text = text.lower()
        out: set[str] = set()
        for words in self.known.all(list(set(text.split())), lambda new: [self.word(raw) for raw in new]):
            out.update(words)
        return out.union(*self.spaced(text))


def features_of(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def count_grams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The character model's counts over the words of all texts: one pass, a row for each bin and task at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_clear()
        bins = np.zeros(BINS, np.int64)
        for batch in batches:
            words = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(batch.column(0), ""))).flatten().dictionary_encode()
            times = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
            kept = [(w, n) for w, n in zip([w.strip(EDGES) for w in words.dictionary.to_pylist()], times.tolist()) if w.isalpha()]
            bins += hashed([w for w, _ in kept], np.array([n for _, n in kept]))
        at = np.flatnonzero(bins)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(bins[at], pa.int64())], names=["bin", "n"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()  # BINS rows at most
    bins = np.zeros(BINS, np.int64)
    bins[found["bin"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return bins


class Model:
    """Weights of features and the character model; a feature counts once in a text."""

    def __init__(self, chars: CharModel, weights: dict[str, float], bias: float):
        self.chars, self.weights, self.bias = chars, weights, bias

    def plain(self) -> tuple:
        return self.chars.bins, self.weights, self.bias, uuid.uuid4().hex

    @staticmethod
    def kept_scorer(plain: tuple):
        """The scorer of a broadcast model, which a worker keeps from task to task."""
        return worker_value("toxicity", plain[3], lambda: Model(CharModel(plain[0]), *plain[1:3]).scorer())

    def scorer(self):
        restorer, weights, bias, kept = Restorer(self.chars), self.weights, self.bias, Kept(WORDS_KEPT)

        def known(words) -> tuple[str, ...]:
            return tuple({f for w in words for f in features_of(w) if f in weights})

        def hopeless(token: str) -> bool:
            """Whether no reading of a token holds a feature: then it needs no search."""
            steps = lattice(token)
            return math.prod(map(len, steps)) <= ENUMERATED and not any(known("".join([x for x, _ in path]).split(SPLIT)) for path in itertools.product(*steps))

        def of_word(raw: str) -> tuple[str, ...]:
            plain, bare = raw.strip(EDGES), raw.strip(OPEN)
            if not LETTER.search(bare) or not SEVERAL.search(bare) or all(map(hopeless, {bare, unseparated(bare)})):
                return known((plain,))
            return known(restorer.word(raw))

        def score(text: str | None) -> float:
            text = (text or "").lower()
            found = set().union(*kept.all(list(set(text.split())), lambda new: list(map(of_word, new))))
            found.update(*map(known, restorer.spaced(text)))
            z = bias + math.fsum(weights[f] for f in found)
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def fit(sample: DataFrame, work: Workspace, bins: np.ndarray) -> Model:
    """Learn from (doc_id, label, text): features by their lift for label 1, then weights by logistic loss."""
    sample, chars = work.table("sample", sample), CharModel(bins)
    shared = sample.sparkSession.sparkContext.broadcast(bins)  # BINS numbers

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(CharModel(shared.value))
        for batch in batches:
            lists = [sorted({f for w in restorer.words(t.as_py()) if w for f in features_of(w)}) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.string()))], names=["doc_id", "label", "found"])

    rows = work.table("features", sample.mapInArrow(features, "doc_id long, label int, found array<string>"))
    sizes = rows.agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n")).first()
    positive, negative = sizes["p"], sizes["n"]
    if not positive or not negative:
        return Model(chars, {}, 30.0 if positive else -30.0)
    lift = ((F.col("p") + 0.5) / (positive + 1)) / ((F.col("n") + 0.5) / (negative + 1))
    counts = rows.select("label", F.explode("found").alias("f")).groupBy("f").agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"))
    chosen = counts.where((F.col("p") >= MIN_ROWS) & (lift >= MIN_LIFT))
    chosen = work.table("chosen", chosen.select("f"))  # as many as the bounded sample's texts repeat
    names = {r["f"]: i for i, r in enumerate(chosen.orderBy("f").collect())}
    bags: dict[int, set[str]] = {}
    for r in rows.select("doc_id", F.explode("found").alias("f")).join(chosen, "f").select("doc_id", "f").toLocalIterator():
        bags.setdefault(r["doc_id"], set()).add(r["f"])
    data = [(r["doc_id"], r["label"], sorted(bags.get(r["doc_id"], ()))) for r in rows.select("doc_id", "label").orderBy("doc_id").collect()]
    y = np.array([r[1] for r in data], float)
    row = np.concatenate([np.full(len(r[2]), i) for i, r in enumerate(data)] or [[]]).astype(int)
    column = np.array([names[f] for r in data for f in r[2]], int)
    w, b = np.zeros(len(names)), math.log((positive + 1) / (negative + 1))
    for _ in range(400):
        z = b + np.bincount(row, w[column], minlength=len(y))
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        b -= 4 * error.mean()
        w -= 4 * (np.bincount(column, error[row], minlength=len(w)) / len(y) * 4 + 1e-4 * w)
    return Model(chars, {f: float(w[i]) for f, i in names.items()}, float(b))


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", train=None, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Count characters over all documents and learn weights from at most ``rows`` labelled ones that satisfy ``train``.

    Rows with a null id or label teach nothing; null texts count as empty; of repeated rows of an id one counts.
    Without labels, or with one kind only, every text gets the same score (0 without label 1, else 1).
    """
    work = Workspace(docs.sparkSession, "toxicity")
    model = fit(labelled_sample(docs, labels, label, train, rows, id_col, text_col), work, count_grams(docs, text_col))
    work.close()
    return model


def score_texts(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every row, each by itself.

    A null text scores as an empty one, a text of any length whole; null ids and repeated rows are kept; other
    columns, whatever their names, are not read; an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())  # weights of a bounded sample, BINS numbers
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Model.kept_scorer(shared.value)
        for batch in batches:
            s = [score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())], names=["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows that score below the threshold, with all their columns, whatever their names; nulls as in ``score_texts``."""
    bound_batches(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model.plain()), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Model.kept_scorer(shared.value)
        for batch in batches:
            yield batch.filter(pa.array([score(t.as_py()) < threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """Learn from the rows whose remainder differs, and score all: ``doc_id, held_out, score, predicted``.

    Odd rows as in ``learn`` and ``score_texts``; a null id has remainder 0.
    """
    model = learn(docs, labels, train=lambda i: id_remainder(i, modulus) != remainder)
    return score_texts(docs, model).select("doc_id", (id_remainder(F.col("doc_id"), modulus) == remainder).alias("held_out"), "score", "predicted")
