"""Whitening of vectors by principal components, without a covariance matrix of all columns being asked for.

Components are eigenvectors of the covariance V of the fit list.  V itself is never formed: a pass over the data
computes ``Y = X'(XQ) / n`` on centred rows for a block Q of orthonormal columns (block subspace iteration).  On the
driver ``Q'Y`` gives Ritz values and vectors, and the block's next Q is the QR factor of Y.  A pass's residuals
``|VU - U e|`` certify components; it goes on until they certify all that are asked for.  Where they shrink so
slowly that many passes would follow (a flat spectrum), the block is widened by random directions, at most to the
number of columns; then one pass is exact.  Per pass a task returns as many numbers as Q has, added up by Spark.

Rows are whole numbers, so sums are exact and a row is centred without rounding, as ``n * x - S``.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace

#: Columns of the block beyond the components asked for, residuals that certify (relative to the largest
#: eigenvalue), passes that may follow before the block is widened, and passes at most.
EXTRA, TOLERANCE, PATIENCE, PASSES = 16, 1e-13, 12, 400
#: x = floor(SCALE * c) + SHIFT must be a long, so components are smaller than this.
SCALE, SHIFT, LIMIT = 64, 1_000_000, float(1 << 56)


def integer_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, x``: vectors as whole numbers; none for null vectors, null, non-finite or huge (from ``LIMIT`` on) entries."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LIMIT)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & ~F.exists("v", bad))
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def integers(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(-1, dimensions)


def times_n(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exact: in 64 bits where they suffice, else in Python's integers."""
    most = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, sums), default=0)
    return n * (x if most < 1 << 62 else x.astype(object)) - np.array(sums, None if most < 1 << 62 else object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - S/n`` in doubles."""
    return (times_n(x, n, sums) / n).astype(np.float64)


def square_sums(y: np.ndarray) -> list[int | None]:
    """Sums of squares of whole numbers, exact; null where a sum exceeds a long."""
    most = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
    if most * most * max(1, y.shape[1]) < 1 << 62:
        return (y * y).sum(1).tolist()
    sums = [sum(int(v) * int(v) for v in row) for row in y]
    return [s if s < 1 << 63 else None for s in sums]


def added_up(parts: DataFrame, rows: int, columns: int) -> np.ndarray:
    """The sum of matrices that tasks return row by row (i, values); rows * columns numbers in all."""
    each = parts.select("i", F.posexplode("values").alias("j", "value")).groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()
    out = np.zeros((rows, columns))
    out[each["i"].to_numpy(), each["j"].to_numpy()] = each["value"].to_numpy()
    return out


def product(fit: DataFrame, n: int, sums: list[int], q: np.ndarray) -> tuple[np.ndarray, float]:
    """One pass: ``X'(XQ) / n`` and the trace of the covariance."""
    d, b = q.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, b))
        for batch in batches:
            y = centred(integers(batch.column(0), d), n, sums)
            total[:d] += y.T @ (y @ q)
            total[d, 0] += (y * y).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "values"])

    out = added_up(fit.select("x").mapInArrow(run, "i int, values array<double>"), d + 1, b) / n
    return out[:d], float(out[d, 0])


def components_of(fit: DataFrame, n: int, sums: list[int], k: int, tolerance: float = TOLERANCE, seed: int = 7, multiply=product) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling), unit eigenvectors (columns) and the trace: at most ``k``, and none of rounding size.

    Signs are fixed: the largest entry of each vector is positive.
    """
    d = len(sums)
    draw = np.random.default_rng(seed)
    width = min(d, k + EXTRA)
    q = np.linalg.qr(draw.standard_normal((d, width)))[0]
    past = None
    for _ in range(PASSES):
        y, trace = multiply(fit, n, sums, q)
        t = q.T @ y
        values, turn = np.linalg.eigh((t + t.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        u, top = q @ turn, values[: min(k, d)]
        if not trace > 0:
            return np.empty(0), np.empty((d, 0)), trace
        real = top > max(trace, 0) * d * 1e-15  # an eigenvalue of rounding size stands for none
        residual = np.linalg.norm(y @ turn[:, : len(top)] - u[:, : len(top)] * top, axis=0)
        worst = float(residual[real].max(initial=0)) / float(values[0])
        if worst <= max(tolerance, d * 1e-15):
            u = u[:, : len(top)][:, real]
            return top[real], u * np.sign(u[np.abs(u).argmax(0), np.arange(u.shape[1])]), trace
        q = np.linalg.qr(y)[0]
        pace = worst / past if past else None
        if pace is not None and (pace >= 1 or np.log(tolerance / worst) / np.log(pace) > PATIENCE) and width < d:
            width, past = min(d, 2 * width), None
            q = np.linalg.qr(np.concatenate((q, draw.standard_normal((d, width - q.shape[1]))), axis=1))[0]
        else:
            past = worst
    raise RuntimeError(f"components aren't certified after {PASSES} passes: residual {worst:.2g} of the largest eigenvalue")


def second_moments(fit: DataFrame, n: int, sums: list[int], turn: np.ndarray) -> np.ndarray:
    """Covariance of the projections of centred rows on the columns of ``turn``; one pass."""
    d, k = turn.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            w = centred(integers(batch.column(0), d), n, sums) @ turn
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "values"])

    return added_up(fit.select("x").mapInArrow(run, "i int, values array<double>"), k, k) / n


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, k: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each usable row and component.

    Rows whose vector is null or holds a null or non-finite entry take no part, nor do those with entries of
    2^56 or more, which have no whole number of 64 bits.  The fit list holds each distinct vector of whole numbers
    once, however many copies there are; copies are combined before they are shuffled.  ``deviation`` is null
    where it exceeds a long.  Components are numbered from 1 by falling eigenvalue, at most ``k`` and the number
    of columns; those whose eigenvalue is zero up to rounding (fewer distinct vectors than components, constant
    columns) don't exist, so a table of one vector only gives no rows.  Vectors of each length are whitened
    on their own.  A null id stays, repeated rows stay, other columns aren't read, an empty table gives no rows.
    """
    spark = vectors.sparkSession
    work = Workspace(spark, "whitening")
    rows = integer_rows(vectors, id_col, vector_col)
    fit = work.table("fit", rows.select("x").distinct().withColumn("d", F.size("x")))
    lengths = fit.groupBy("d").count().where("d > 0").orderBy("d").collect()  # as many as there are lengths
    out = None
    for r in lengths:
        part = of_length(spark, rows.where(F.size("x") == r["d"]), fit.where(F.col("d") == r["d"]), r["d"], r["count"], k)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], RESULT) if out is None else out


def column_sums(fit: DataFrame, d: int) -> list[int]:
    """Exact sums of the columns; wider than a long where needed.  A task returns one row for each column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, object)
        for batch in batches:
            x = integers(batch.column(0), d)
            most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * max(1, len(x))
            total += (x if most < 1 << 62 else x.astype(object)).sum(0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(map(Decimal, map(int, total)), pa.decimal128(38, 0))], names=["j", "value"])

    sums = {r["j"]: int(r["value"]) for r in fit.select("x").mapInArrow(run, "j int, value decimal(38,0)").groupBy("j").agg(F.sum("value").alias("value")).collect()}
    return [sums[j] for j in range(d)]


def of_length(spark: SparkSession, rows: DataFrame, fit: DataFrame, d: int, n: int, k: int) -> DataFrame:
    sums = column_sums(fit, d)
    values, vectors, trace = components_of(fit, n, sums, k)
    m = len(values)
    if not m:
        return spark.createDataFrame([], RESULT)
    turn = vectors / np.sqrt(values)
    error = float(np.abs(second_moments(fit, n, sums, turn) - np.eye(m)).max())
    explained = values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = len(batch)
            exact = times_n(integers(batch.column(1), d), n, sums)
            each = np.repeat(np.arange(size), m)
            columns = [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), size)),
                pa.array(np.full(size * m, n)),
                pc.take(pa.array(square_sums(exact), pa.int64()), pa.array(each)),
                pa.array(((exact / n).astype(np.float64) @ turn).ravel()),
                pa.array(np.tile(explained, size)),
                pa.array(np.full(size * m, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, RESULT)
