"""One-step forecasts by boosted trees on the log scale, and what their features are worth."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import scratch
from .analytics import LAGS, ROLLS, calendar_features, lag_features, next_month_features, rolling_features
from .boosting import DEPTH, STEP, TREES, Boosted, fit

FEATURES = [*(f"lag_{n}" for n in LAGS), *(f"mean_{n}" for n in ROLLS), "month_sin", "month_cos"]
LOGGED = [c for c in FEATURES if not c.startswith("month")]
#: How often a feature is dealt anew.
REPEATS = 8


def logged(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0))) for c in LOGGED})


def design(panel: DataFrame, code: str) -> DataFrame:
    return logged(calendar_features(rolling_features(lag_features(panel, code), code)).dropna(subset=FEATURES))


def learned(rows: DataFrame, trees: int = TREES, step: float = STEP, depth: int = DEPTH) -> Boosted:
    return fit(rows, FEATURES, "log_value", trees, step, depth)


def predicted(model: Boosted, rows: DataFrame) -> DataFrame:
    return rows.withColumn("forecast", F.greatest(F.expm1(model.column(F.array(*FEATURES))), F.lit(0.0)))


def forecast(panel: DataFrame, code: str, cutoff: str, **sizes) -> DataFrame:
    """Forecasts of the months after ``cutoff`` by a model that has seen none of them."""
    rows = design(panel, code)
    model = learned(rows.where(F.col("month") <= cutoff), **sizes)
    return predicted(model, rows.where(F.col("month") > cutoff)).select(code, "month", "import_usd", F.round("forecast", 2).alias("forecast"))


def forecast_next(panel: DataFrame, code: str, **sizes) -> DataFrame:
    """The month after the panel, by a model of all its months."""
    model = learned(design(panel, code), **sizes)
    nxt = calendar_features(next_month_features(panel, code).withColumn("import_usd", F.lit(0).cast("bigint"))).dropna(subset=FEATURES)
    return predicted(model, logged(nxt)).select(code, "month", F.round("forecast", 2).alias("forecast"))


def dealt(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudo-random permutation of 0 .. n - 1 at some places: a keyed four-round network on as many bits, walked until it is below n.

    So each row finds its partner by itself, without a sort of the whole table.
    """
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    mask, x = (np.uint64(1) << half) - np.uint64(1), np.array(i, np.uint64)
    todo = np.ones(len(x), bool)
    while todo.any():
        left, right = x[todo] >> half, x[todo] & mask
        for r in range(4):
            h = (right + np.uint64((key * 4 + r + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((h >> np.uint64(32)) & mask)
        x[todo] = (left << half) | right
        todo[todo] = x[todo] >= n
    return x.astype(np.int64)


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Rows with ``n`` from 0 in an order, and how many there are: sorted by ranges, then counted from each range's first number."""
    path = scratch(rows.sparkSession, "numbered")
    rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}).write.parquet(path)
    rows = rows.sparkSession.read.parquet(path)
    sizes = rows.groupBy("__part").agg(F.count("*").alias("size"), F.min("__at").alias("low")).orderBy("__part").collect()  # as many as there are partitions
    starts, total = [], 0
    for r in sizes:
        starts.append((r["__part"], total - r["low"]))
        total += r["size"]
    offsets = F.broadcast(rows.sparkSession.createDataFrame(starts, "__part int, __first bigint"))
    return rows.join(offsets, "__part").withColumn("n", F.col("__at") + F.col("__first")).drop("__part", "__at", "__first"), total


def importance(panel: DataFrame, code: str, cutoff: str, repeats: int = REPEATS, **sizes) -> DataFrame:
    """How much the log-scale error grows when a feature's values are dealt anew among the test rows.

    Test rows are numbered; for each feature and repeat a permutation of the numbers names the row whose value
    replaces a row's own.  Values come by a join on (number, feature), so no task holds a whole column.
    """
    rows = design(panel, code)
    model = learned(rows.where(F.col("month") <= cutoff), **sizes)
    return permuted(model, rows.where(F.col("month") > cutoff).select(code, "month", "log_value", *FEATURES), [code, "month"], repeats)


def permuted(model: Boosted, test: DataFrame, order: list[str], repeats: int) -> DataFrame:
    test, total = numbered(test, order)
    if not total:
        return test.sparkSession.createDataFrame([], "feature string, importance double")
    test = test.select("n", "log_value", F.array(*FEATURES).alias("x"))
    error = lambda x: F.abs(model.column(x) - F.col("log_value"))
    kinds = len(FEATURES)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(0).to_numpy()
            for j in range(kinds):
                for r in range(repeats):
                    columns = [batch.column(1), batch.column(2), pa.array(np.full(len(n), j, np.int32)), pa.array(np.full(len(n), r, np.int32)), pa.array(dealt(n, total, j * repeats + r))]
                    yield pa.RecordBatch.from_arrays(columns, names=["log_value", "x", "j", "repeat", "from"])

    trials = test.mapInArrow(pair, "log_value double, x array<double>, j int, repeat int, from bigint")
    values = test.select(F.col("n").alias("from"), F.posexplode("x").alias("j", "value"))
    mixed = trials.join(values, ["from", "j"]).withColumn("x", F.transform("x", lambda v, i: F.when(i == F.col("j"), F.col("value")).otherwise(v)))
    scored = mixed.groupBy("j").agg(F.avg(error(F.col("x"))).alias("mae"))
    base = test.agg(F.avg(error(F.col("x"))).alias("base"))
    named: Column = F.element_at(F.array(*map(F.lit, FEATURES)), F.col("j") + 1)
    return scored.crossJoin(F.broadcast(base)).select(named.alias("feature"), F.round(F.col("mae") - F.col("base"), 9).alias("importance"))
