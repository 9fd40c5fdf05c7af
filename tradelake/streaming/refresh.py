"""Revision refresh as a stream: new manifests arrive as files, touched country months are chosen anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import storage
from ..operators.selection import expand_windows, priority
from ..schemas import MANIFEST


def best_of(candidates: DataFrame) -> DataFrame:
    kept = ["finished_at", "span", "path"]
    return candidates.groupBy("country", "month").agg(F.max_by(F.struct(*kept), priority()).alias("x")).select("country", "month", "x.*")


def merge(state: DataFrame | None, new: DataFrame) -> DataFrame:
    """The best source of each country month among the state and new candidates: ``max_by`` merges in any order."""
    candidates = expand_windows(new).select("country", "month", "finished_at", "span", "path")
    return best_of(candidates if state is None else state.select(candidates.columns).unionByName(candidates))


def refresh(spark: SparkSession, manifests: str, state: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Follow a folder of JSON manifests; ``state`` always holds a whole table of choices."""
    files = spark.readStream.schema(MANIFEST).json(manifests).where("success and status = 'success'")
    rows = files.select("country", "window_start", "window_end", F.coalesce("finished_at", "requested_at").alias("finished_at"), F.col("_metadata.file_path").alias("path"))

    def step(batch: DataFrame, number: int) -> None:
        old = spark.read.parquet(state) if storage.exists(spark, state) else None
        merge(old, batch).write.mode("overwrite").parquet(f"{state}.next")
        storage.swap(spark, f"{state}.next", state)

    writer = rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
