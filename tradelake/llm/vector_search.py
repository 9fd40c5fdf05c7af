"""Approximate nearest neighbours by an adaptive scan over dimensions of rotated vectors.

Index: vectors are scaled to length one, turned by a random rotation (so that any few coordinates are a
random projection) and dealt to the list of the nearest centroid.  A list's vectors are held by columns,
in blocks of dimensions.

Search: a query looks into its nearest list first, and then, with the k-th distance found there as its limit,
into its other nearest lists.  Within a list its candidates are scanned block by block; after d of D dimensions
the partial squared distance, scaled by D / d, estimates the whole one, and a candidate is given up when a
hypothesis test says that it is beyond the limit: ``partial * D / d > (1 + eps / sqrt(d))^2 * limit``.  The
survivors are measured exactly, in double precision on the original vectors.  A query that finds fewer than k
candidates in its lists looks into all others as well.

Centroids are fitted on a bounded sample, and the number of lists to look into is set on it so that they
hold ``COVER`` of its true neighbours; every row is indexed.  Lists are cut into blocks of rows and the
queries of a list into groups, by how many rows and queries each list has, so a crowded list is many tasks and
a list's rows are sent as often as its own queries need.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace

#: Rows that centroids are fitted on, rows of a block and queries of a group (about), dimensions of a column block.
SAMPLE_ROWS, BLOCK_ROWS, GROUP_QUERIES, STEP = 20_000, 4_096, 8_192, 16
#: Share of the sample's true neighbours that the probed lists must hold, and the test's strictness.
COVER, EPSILON = 0.97, 2.1
#: As many lists as the bounded sample can tell apart; beyond ``(2 * MAX_LISTS) ** 2`` rows lists grow longer.
MAX_LISTS = SAMPLE_ROWS // 4


def rotation(dimensions: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    draw = np.random.default_rng(seed)
    centres = x[draw.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.argmax(x @ centres.T - 0.5 * (centres**2).sum(1), axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def probes_needed(x: np.ndarray, centres: np.ndarray, k: int, cover: float, queries: int = 256) -> int:
    """How many lists a query must look into so that they hold ``cover`` of true neighbours within the sample."""
    if len(x) <= k + 1:
        return len(centres)
    near = x @ centres.T - 0.5 * (centres**2).sum(1)
    home, queries = near.argmax(1), min(queries, len(x))
    likeness = x[:queries] @ x.T
    likeness[np.arange(queries), np.arange(queries)] = -np.inf
    best = np.argpartition(-likeness, k, axis=1)[:, :k]
    rank = np.argsort(np.argsort(-near[:queries], axis=1, kind="stable"), axis=1)
    return min(len(centres), 1 + int(np.quantile(rank[np.arange(queries)[:, None], home[best]], cover, method="higher")))


def scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component near 1: exact, and no square overflows."""
    _, power = np.frexp(np.abs(x).max(1))
    return np.ldexp(x, -power[:, None])


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(1))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = scaled(a), scaled(b)
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dimensions)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v``: vectors that are neither null nor zero nor hold a null or non-finite component, of any length."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = F.col("v")
    return vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(v.isNotNull() & F.col("vec_id").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0))


def scan(q: np.ndarray, x: np.ndarray, columns: list[np.ndarray], limit: np.ndarray, k: int, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, candidate) that outlive the scan of one block of a list.

    ``limit``: each query's squared distance within which k candidates are known already.  The first step
    measures all pairs over one column block, each later step only the pairs left.
    """
    dimensions, done = x.shape[1], 0
    qi = xi = partial = None
    for columns_ in columns:
        low, done = done, done + columns_.shape[1]
        if partial is None:
            a = q[:, low:done]
            d = (a * a).sum(1)[:, None] + (columns_ * columns_).sum(1)[None, :] - 2 * a @ columns_.T
            keep = d * (dimensions / done) <= ((1 + epsilon / math.sqrt(done)) ** 2 * limit)[:, None] + 1e-9
            qi, xi = np.nonzero(keep)
            partial = d[qi, xi]
        else:
            diff = q[qi, low:done] - columns_[xi]
            partial = partial + (diff * diff).sum(1)
            bound = limit[qi] * (1 if done == dimensions else (1 + epsilon / math.sqrt(done)) ** 2) + 1e-9
            keep = partial * (dimensions / done) <= bound
            qi, xi, partial = qi[keep], xi[keep], partial[keep]
    return qi, xi


RESULT = "query_id long, rank int, vec_id long, score double"


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", cover: float = COVER, epsilon: float = EPSILON, block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query row by cosine.

    ``is_query`` is a condition on the id.  A query's own rows aren't candidates.  Ties go to the smaller id.
    Vectors that are null, zero or hold a null or non-finite component take no part, nor do rows with a
    null id.  Vectors are compared with those of their own length: each length has an index of its own.
    Repeated rows are candidates as often as they occur, and a repeated query is answered once.  Other columns
    are not read.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    work = Workspace(spark, "vectors")
    rows = usable(vectors, id_col, vector_col)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy("d").collect()  # as many as there are lengths
    found = [of_length(rows.where(F.size("v") == r["d"]), r["d"], r["count"], is_query, k, cover, epsilon, block_rows, group_queries, work) for r in lengths]
    if not found:
        return spark.createDataFrame([], RESULT)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def best_of(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def of_length(rows: DataFrame, dimensions: int, total: int, is_query, k: int, cover: float, epsilon: float, block_rows: int, group_queries: int, work: Workspace) -> DataFrame:
    """The search over vectors of one length."""
    name = lambda x: f"{x}-{dimensions}"
    turn = rotation(dimensions)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("v").toPandas()["v"]
    lists = int(min(MAX_LISTS, max(1, math.sqrt(total) / 2)))
    x = units(np.stack(sample.to_list())) @ turn
    centres = kmeans(x, lists)
    lists = len(centres)
    probes = probes_needed(x, centres, k, cover)
    steps = [min(dimensions, s + STEP) - s for s in range(0, dimensions, STEP)]

    def near(batch: pa.RecordBatch) -> np.ndarray:
        y = units(matrix(batch.column(1), dimensions)) @ turn
        return y @ centres.T - 0.5 * (centres**2).sum(1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near(batch).argmax(1), pa.int32())], names=["vec_id", "v", "list"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = np.argsort(-near(batch), axis=1, kind="stable")[:, :probes]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best.tolist(), pa.list_(pa.int32()))], names=["query_id", "q", "lists"])

    index = work.table(name("index"), rows.withColumn("vec_id", F.col("vec_id").cast("long")).mapInArrow(deal, "vec_id long, v array<double>, list int"))
    blocks_of = work.table(name("cuts"), index.groupBy("list").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")))  # MAX_LISTS rows at most
    queries = rows.where(is_query).withColumn("vec_id", F.col("vec_id").cast("long")).dropDuplicates(["vec_id"])
    queries = work.table(name("queries"), queries.mapInArrow(ask, "query_id long, q array<double>, lists array<int>"))

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        names, kinds = ["query_id", "vec_id", "score"], [pa.int64(), pa.int64(), pa.float64()]
        if len(left) and len(right):
            order = np.argsort(left["vec_id"].to_numpy(), kind="stable")
            ids = left["vec_id"].to_numpy()[order]
            original = matrix(left["v"].combine_chunks(), dimensions)[order]
            y = units(original) @ turn
            columns = [np.ascontiguousarray(part) for part in np.split(y, np.cumsum(steps)[:-1], axis=1)]
            first = slice(0, 64 + 4 * k)
            for at in range(0, len(right), 256):
                part = right.slice(at, 256)
                q_ids = part["query_id"].to_numpy()
                q_own = matrix(part["q"].combine_chunks(), dimensions)
                q = units(q_own) @ turn
                d = ((q[:, None, :] - y[None, first, :]) ** 2).sum(2)
                d[q_ids[:, None] == ids[None, first]] = np.inf
                limit = np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] >= k else np.full(len(q), np.inf)
                limit = np.minimum(np.where(np.isfinite(limit), limit, 1e9), part["known"].to_numpy())
                qi, xi = scan(q, y, columns, limit, k, epsilon)
                other = q_ids[qi] != ids[xi]
                qi, xi = qi[other], xi[other]
                score = cosines(q_own[qi], original[xi])
                best = np.lexsort((ids[xi], -score, qi))
                qi, xi, score = qi[best], xi[best], score[best]
                start = np.searchsorted(qi, np.arange(len(q)))
                top = np.arange(len(qi)) - start[qi] < k
                out += zip(q_ids[qi[top]].tolist(), ids[xi[top]].tolist(), score[top].tolist())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else ([], [], []), kinds)], names=names)

    def look(asked: DataFrame, table: str) -> DataFrame:
        """Search (query_id, q, list, known), ``known`` being a squared distance within which k candidates are known."""
        asked = work.table(name(f"asked-{table}"), asked)
        cuts = asked.groupBy("list").agg(F.ceil(F.count("*") / group_queries).cast("int").alias("parts")).join(blocks_of, "list")
        cuts = work.table(name(f"cuts-{table}"), cuts)  # MAX_LISTS rows at most
        part = lambda column: F.pmod(F.xxhash64(column), F.col("parts")).cast("int").alias("part")
        block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block")
        left = index.join(F.broadcast(cuts), "list").select("list", block, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "vec_id", "v")
        right = asked.join(F.broadcast(cuts), "list").select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), part("query_id"), "query_id", "q", "known")
        keys = ["list", "block", "part"]
        return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(search, "query_id long, vec_id long, score double")

    unlimited = F.lit(1e9).alias("known")
    home = work.table(name("home"), best_of(look(queries.select("query_id", "q", F.element_at("lists", 1).alias("list"), unlimited), "home"), k))
    limits = home.groupBy("query_id").agg((2 - 2 * F.min("score") + 1e-9).alias("limit"), F.count("*").alias("n")).where(F.col("n") == k).select("query_id", "limit")
    known = F.coalesce("limit", F.lit(1e9)).alias("known")
    asked = queries.join(limits, "query_id", "left").select("query_id", "q", known, F.explode(F.slice("lists", 2, max(1, probes))).alias("list"))
    columns = ["query_id", "vec_id", "score"]
    found = work.table(name("found"), best_of(home.select(columns).unionByName(look(asked, "others")), k))
    enough = found.groupBy("query_id").count().where(F.col("count") == k).select("query_id")
    short = queries.join(enough, "query_id", "left_anti") if probes < lists else queries.limit(0)
    short = work.table(name("short"), short)
    if not short.isEmpty():
        everywhere = F.array_except(F.sequence(F.lit(0), F.lit(lists - 1)), "lists")
        more = look(short.select("query_id", "q", unlimited, F.explode(everywhere).alias("list")), "more")
        found = work.table(name("widened"), best_of(found.select(columns).unionByName(more), k))
    return found
