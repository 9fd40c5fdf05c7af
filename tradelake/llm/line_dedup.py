"""Lines that documents share, dropped from all but the first of them, by levelled sorted runs of line hashes.

A store holds the hashes of all lines seen so far, each once with the smallest document that holds it, in runs:
tables bucketed and sorted by hash.  A new batch of documents is merged with the runs in an anti-join (neither side of
a bucket is dealt anew but the batch's): hashes that a run holds are known, the others become a run of their own on
level 0.  Whenever a level has ``FAN_IN`` runs they are merged to one run of the next level, so a batch meets a number
of runs that grows with the logarithm of the batches.  Batches come in ascending order of documents, so the first
holder is in the run.

The first step writes the distinct hashes of each document's lines, by batch, so texts are read twice: for
their hashes, and when the lines to keep are put together.  A line that a third of all documents hold is one row for
each document, spread by document; per batch it is combined before any shuffle.

Everything is DataFrame expressions: no Python runs on the executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, ascii_lower

#: Batches that a table is dealt to, runs of a level that are merged, code points from which a line counts.
BATCHES, FAN_IN, MIN_LENGTH = 6, 3, 10
SPACES = " \t\n\x0b\x0c\r"
#: Hashes of a bucket, about; small tables have as many buckets as shuffles have partitions.
BUCKET_ROWS = 4_000_000
HASH = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty one has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_hash(key: Column, min_length: int) -> Column:
    """A 128-bit hash of a key as a struct; null for keys of fewer than ``min_length`` code points."""
    return F.when(F.length(key) >= min_length, F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")))


class LineStore:
    """Levelled runs of (h1, h2, owner) as bucketed, sorted tables in the session's catalog, files in the shared folder."""

    def __init__(self, spark: SparkSession, work: Workspace, buckets: int, fan_in: int = FAN_IN):
        self.spark, self.work, self.buckets, self.fan_in = spark, work, buckets, fan_in
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        rows = rows.select(*HASH, "owner").repartition(self.buckets, *HASH)
        rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", f"{self.work.path}/{name}").option("compression", "zstd").format("parquet").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.work.drop(name)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def unseen(self, hashes: DataFrame) -> DataFrame:
        """Rows of ``hashes`` (a row for each hash) that no run holds."""
        for run in self.runs():
            hashes = hashes.join(run.select(*HASH), HASH, "left_anti")
        return hashes

    def add(self, lines: DataFrame) -> None:
        """Take in a batch of (doc_id, h1, h2), whose documents follow those of all batches before."""
        first = lines.groupBy(*HASH).agg(F.min("doc_id").alias("owner"))
        self._push(0, self._write(self.unseen(first)))

    def _push(self, level: int, run: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_in:
            full, self.levels[level] = self.levels[level], []
            merged = self.spark.table(full[0])
            for name in full[1:]:
                merged = merged.unionByName(self.spark.table(name))  # no hash is in two runs
            self._push(level + 1, self._write(merged))
            for name in full:
                self._drop(name)

    def not_first(self, lines: DataFrame) -> DataFrame:
        """Rows (doc_id, h1, h2 and more) whose hash belongs to a smaller document."""
        for run in self.runs():
            lines = lines.join(run.select(*HASH, F.col("owner").alias("doc_id")), [*HASH, "doc_id"], "left_anti")
        return lines

    def close(self) -> None:
        for level in self.levels:
            for name in level:
                self._drop(name)
        self.levels = []


def repeated_lines(docs: DataFrame, min_length: int, batches: int, fan_in: int, work: Workspace) -> DataFrame:
    """``doc_id, mark, gone``: for each text with lines that a smaller document holds, the numbers of these lines."""
    spark = docs.sparkSession
    known = docs.where("doc_id is not null")
    cuts = known.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10_000).alias("cuts")).first()["cuts"] if batches > 1 else []
    cuts = sorted(set(cuts or []))
    batch = sum([F.when(F.col("doc_id") > cut, 1).otherwise(0) for cut in cuts], F.lit(0))
    each = known.select("doc_id", "mark", batch.alias("batch"), F.posexplode(F.transform(lines_of(F.col("text")), lambda x: line_hash(line_key(x), min_length))).alias("line", "h"))
    path = f"{work.path}/hashes"
    each.where("h is not null").select("doc_id", "mark", "line", "h.h1", "h.h2", "batch").write.partitionBy("batch").option("compression", "zstd").parquet(path)
    hashes = spark.read.schema("doc_id long, mark long, line int, h1 long, h2 long, batch int").parquet(path)
    counts = {r["batch"]: r["count"] for r in hashes.groupBy("batch").count().collect()}  # as many as there are batches
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(counts.values()) // BUCKET_ROWS))
    store = LineStore(spark, work, buckets, fan_in)
    for b in sorted(counts):
        store.add(hashes.where(F.col("batch") == b).select("doc_id", *HASH))
    gone = store.not_first(hashes.select("doc_id", "mark", "line", *HASH)).groupBy("doc_id", "mark").agg(F.collect_set("line").alias("gone"))  # a text's own lines at most
    gone = work.table("gone", gone)
    store.close()
    work.drop("hashes")
    return gone


def dedup_lines(docs: DataFrame, min_length: int = MIN_LENGTH, batches: int = BATCHES, fan_in: int = FAN_IN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` for every row of ``docs``; ``kept`` is the text that is left.

    Texts are split at line feeds; a null or empty text is one empty line.  A line's key is the line without ASCII
    white space at its ends, A-Z lower-cased.  A key of at least ``min_length`` code points found in several
    documents loses its lines in all but the smallest ``doc_id``; there they all stay, as do all shorter lines.
    Lines are joined by line feeds; a document that loses all is empty.  Rows of one id are one document and
    stay or go alike; rows with a null id belong to no document and stay whole.  Other columns aren't read, and an
    empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "lines")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text"))  # texts of one id are told apart by it
    gone = repeated_lines(rows, min_length, batches, fan_in, work)
    split = rows.join(gone, ["doc_id", "mark"], "left").select("doc_id", lines_of(F.col("text")).alias("lines"), "gone")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(left, lambda i: F.get("lines", i)))
    sizes = split.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))
    return sizes.select("doc_id", "n_lines", F.when(F.col("n_dropped") > 0, F.col("n_dropped")).otherwise(F.lit(0).cast("long")).alias("n_dropped"), F.array_join("kept", "\n").alias("kept"))
