"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def connected_components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``id, component`` (the smallest id reached) for every id in the edges (a, b).

    Each round takes the smallest label among the neighbours and then the label's own label, so long paths
    shorten at twice the pace.  Labels are written to the shared folder after each round; a hub's edges are
    combined before they are shuffled.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = work.table(f"{name}-0", both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    k = 0
    while True:
        seen = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("component").alias("lowest"))
        lower = labels.join(seen, labels["id"] == seen["a"], "left").select("id", F.least("component", F.coalesce("lowest", "component")).alias("component"), F.col("component").alias("before"))
        lower = work.table(f"{name}-{k}-lower", lower)
        jump = lower.select(F.col("id").alias("component"), F.col("component").alias("next"))
        labels = work.table(f"{name}-{k + 1}", lower.join(jump, "component", "left").select("id", F.least("component", F.coalesce("next", "component")).alias("component"), "before"))
        work.drop(f"{name}-{k}", f"{name}-{k}-lower")
        k += 1
        if labels.where("component <> before").isEmpty():
            return labels.select("id", "component")
        labels = labels.drop("before")
