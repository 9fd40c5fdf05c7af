"""Gradient boosted trees with Huber loss, each level of a tree by one pass over all tasks.

Rows are held as bin numbers of their features (edges are quantiles of the whole table), label and score.  A pass
returns, from each task, sums by node, feature and bin; the driver adds them up and splits every node of the level.
The last pass of a tree summarizes each leaf's residuals.  From these the driver takes the leaf's value (the median
residual plus the mean of what the clipped distances from it leave) and the next tree's clip: the quantile
``ALPHA`` of the absolute residuals after this tree.  What a task returns is bounded by nodes, features, bins and
``CENTROIDS``, and tasks by ``MAX_TASKS``, so the driver holds the same however many rows there are.

Scores are rewritten to the shared folder every ``CUT`` trees, so lineage is short and a lost executor costs the
passes' running tasks only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import delete, scratch

#: Trees, their weight and depth, the quantile of residuals that are clipped, and bins of a feature.
TREES, STEP, DEPTH, ALPHA, BINS = 300, 0.03, 3, 0.9, 128
#: Residuals of a leaf that a task returns one by one (more are grouped to as many means), rows of a task, tasks, and trees between rewrites.
CENTROIDS, TASK_ROWS, MAX_TASKS, CUT = 512, 1_000_000, 256, 30
#: Gains below this are none.
LEAST_GAIN = 1e-12


@dataclass
class Tree:
    """Nodes in an array, children of i at 2i+1 (``bin <= at``) and 2i+2; a feature of -1 is a leaf."""

    feature: np.ndarray
    at: np.ndarray
    value: np.ndarray

    @classmethod
    def of_depth(cls, depth: int) -> Tree:
        n = (2 << depth) - 1
        return cls(np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row of bin numbers ends in."""
        node, every = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range((len(self.feature) + 1).bit_length() - 2):
            f = self.feature[node]
            node = np.where(f < 0, node, 2 * node + 1 + (bins[every, f] > self.at[node]))
        return node


@dataclass
class Boosted:
    """A fitted model: ``start`` plus ``step`` times the trees' values."""

    edges: list[np.ndarray]
    start: float
    step: float
    trees: list[Tree] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def added(self, bins: np.ndarray, trees: list[Tree]) -> np.ndarray:
        out = np.zeros(len(bins))
        for t in trees:
            out += self.step * t.value[t.leaves(bins)]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.start + self.added(self.bins(x), self.trees)

    def column(self, features: Column) -> Column:
        """The prediction for an array of features (in the order of the fit), a column that tasks compute in batches."""

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            return pd.Series(self.predict(np.stack(x.to_list())) if len(x) else np.empty(0))

        return score(features)


def weighted_quantile(values: np.ndarray, weights: np.ndarray, q: float) -> float:
    """The smallest value that a share ``q`` of the weight doesn't exceed."""
    order = np.argsort(values, kind="stable")
    total = np.cumsum(weights[order])
    return float(values[order][min(np.searchsorted(total, q * total[-1], "left"), len(values) - 1)])


def centroids(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and sizes of ``most`` equal parts of sorted values; each value by itself if there are no more."""
    r = np.sort(r)
    if len(r) <= most:
        return r, np.ones(len(r))
    cuts = np.linspace(0, len(r), most + 1).astype(np.int64)[:-1]
    sizes = np.diff(np.append(cuts, len(r)))
    return np.add.reduceat(r, cuts) / sizes, sizes.astype(float)


def leaf_value(r: np.ndarray, w: np.ndarray, clip: float) -> float:
    middle = weighted_quantile(r, w, 0.5)
    off = r - middle
    return middle + float(np.average(np.sign(off) * np.minimum(np.abs(off), clip), weights=w))


def best_split(sums: np.ndarray, counts: np.ndarray) -> tuple[int, int] | None:
    """The feature and bin that part a node's gradients best: (feature, bin) sums and counts; ties go to the first."""
    left, n = np.cumsum(sums, axis=1)[:, :-1], np.cumsum(counts, axis=1)[:, :-1]
    total, size = sums[0].sum(), counts[0].sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where((n > 0) & (n < size), n * (size - n) / size * (left / n - (total - left) / (size - n)) ** 2, -1.0)
    at = int(gain.argmax())
    return divmod(at, gain.shape[1]) if gain.size and gain.flat[at] > LEAST_GAIN * max(1.0, size) else None


class State:
    """Rows of a fit: bins, label, score; passes over them."""

    def __init__(self, rows: DataFrame, model: Boosted, tasks: int):
        self.spark, self.model, self.path = rows.sparkSession, model, scratch(rows.sparkSession, "boosting")
        self.done, self.version = 0, 0
        start = model.start

        def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(model.edges))
                yield pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in model.bins(x)], pa.binary()), batch.column(1), pa.array(np.full(len(x), start))], names=["bins", "y", "score"])

        self._keep(rows.repartition(tasks).mapInArrow(binned, "bins binary, y double, score double"))

    def _keep(self, df: DataFrame) -> None:
        path = f"{self.path}/{self.version}"
        df.write.parquet(path)
        old, self.version = getattr(self, "rows", None), self.version + 1
        self.rows = self.spark.read.schema("bins binary, y double, score double").parquet(path).persist()
        if old is not None:
            old.unpersist()
            delete(self.spark, f"{self.path}/{self.version - 2}")

    def close(self) -> None:
        self.rows.unpersist()
        delete(self.spark, self.path)

    def each(self, make) -> list[bytes]:
        """What ``make(bins, residuals)`` gives for each task's rows."""
        trees, model = self.model.trees[self.done :], self.model

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bins, rest = [], []
            for batch in batches:
                b = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(len(batch), -1)
                bins.append(b)
                rest.append(batch.column(1).to_numpy() - (batch.column(2).to_numpy() + model.added(b, trees)))
            if bins:
                yield pa.RecordBatch.from_arrays([pa.array([make(np.concatenate(bins), np.concatenate(rest))], pa.binary())], names=["x"])

        return [r["x"] for r in self.rows.mapInArrow(run, "x binary").collect()]  # of bounded size and number

    def histogram(self, tree: Tree, level: int, clip: float) -> np.ndarray:
        """Sums and counts of clipped residuals by node of a level, feature and bin."""
        first, nodes, features, most = (1 << level) - 1, 1 << level, len(self.model.edges), max(len(e) for e in self.model.edges) + 1

        def make(bins: np.ndarray, r: np.ndarray) -> bytes:
            out = np.zeros((2, nodes, features, most))
            node, g = tree.leaves(bins) - first, np.clip(r, -clip, clip)
            there = node >= 0
            node, g, bins = node[there], g[there], bins[there]
            for j in range(features):
                cell = node * most + bins[:, j]
                out[0, :, j] = np.bincount(cell, g, nodes * most).reshape(nodes, most)
                out[1, :, j] = np.bincount(cell, minlength=nodes * most).reshape(nodes, most)
            return out.tobytes()

        shape = (2, nodes, features, most)
        return sum((np.frombuffer(x).reshape(shape) for x in self.each(make)), np.zeros(shape))

    def residuals(self, tree: Tree) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each node's residuals as values and weights."""
        nodes = len(tree.feature)

        def make(bins: np.ndarray, r: np.ndarray) -> bytes:
            node = tree.leaves(bins)
            parts = [np.stack((np.full(len(v), float(i)), v, w)) for i in np.unique(node) for v, w in [centroids(r[node == i], CENTROIDS)]]
            return np.concatenate(parts, axis=1).tobytes()

        found = np.concatenate([np.frombuffer(x).reshape(3, -1) for x in self.each(make)], axis=1)
        return [(found[1, found[0] == i], found[2, found[0] == i]) for i in range(nodes)]

    def rewrite(self) -> None:
        """Scores with all trees so far."""
        trees, model = self.model.trees[self.done :], self.model

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                b = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(len(batch), -1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(batch.column(2).to_numpy() + model.added(b, trees))], names=["bins", "y", "score"])

        self._keep(self.rows.mapInArrow(run, "bins binary, y double, score double"))
        self.done = len(self.model.trees)


def fit(rows: DataFrame, features: list[str], label: str, trees: int = TREES, step: float = STEP, depth: int = DEPTH, alpha: float = ALPHA, bins: int = BINS) -> Boosted:
    """Boost ``trees`` trees on the rows whose features and label are neither null nor NaN; no such row is an error."""
    rows = rows.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"), F.col(label).cast("double").alias("y")).where(~F.exists("x", lambda v: v.isNull() | F.isnan(v)) & F.col("y").isNotNull() & ~F.isnan("y"))
    cuts = [i / bins for i in range(1, bins)]
    found = rows.agg(F.count("*").alias("n"), F.percentile_approx("y", 0.5, 10_000).alias("middle"), *[F.percentile_approx(F.col("x")[j], cuts, 10_000).alias(f"e{j}") for j in range(len(features))]).first()
    if not found["n"]:
        raise ValueError("no row to learn from")
    model = Boosted([np.unique(found[f"e{j}"]) for j in range(len(features))], float(found["middle"]), step)
    context = rows.sparkSession.sparkContext
    state = State(rows, model, max(min(context.defaultParallelism, MAX_TASKS), min(MAX_TASKS, -(-found["n"] // TASK_ROWS))))
    try:
        left = state.residuals(Tree.of_depth(0))
        clip = weighted_quantile(np.abs(left[0][0]), left[0][1], alpha)
        for _ in range(trees):
            tree = Tree.of_depth(depth)
            for level in range(depth):
                open_ = [(1 << level) - 1 + i for i in range(1 << level) if level == 0 or tree.feature[((1 << level) - 2 + i) // 2] >= 0]
                if not open_:
                    break
                cells = state.histogram(tree, level, clip)
                for node in open_:
                    split = best_split(cells[0, node - (1 << level) + 1], cells[1, node - (1 << level) + 1])
                    if split:
                        tree.feature[node], tree.at[node] = split
            left = state.residuals(tree)
            after = []
            for i, (r, w) in enumerate(left):
                if len(r):
                    tree.value[i] = leaf_value(r, w, clip)
                    after.append((np.abs(r - step * tree.value[i]), w))
            clip = weighted_quantile(np.concatenate([r for r, _ in after]), np.concatenate([w for _, w in after]), alpha)
            model.trees.append(tree)
            if len(model.trees) - state.done >= CUT and len(model.trees) < trees:
                state.rewrite()
    finally:
        state.close()
    return model
