"""CSV dimensions with declared text columns, so codes keep their zeros and NA stays a code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PARTNER


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", "true").option("enforceSchema", "false").schema(schema).csv(path)


def read_partners(spark: SparkSession, path: str, schema: str = PARTNER, requested: list[str] | None = None) -> DataFrame:
    """Partners by upper-case code; an empty table, a repeated code or an unknown requested one is an error."""
    rows = read_csv(spark, path, schema).withColumn("country_code", F.upper(F.trim("country_code"))).where("country_code <> ''")
    if rows.isEmpty():
        raise ValueError("the partner table is empty")
    twice = rows.groupBy("country_code").count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"repeated codes: {[r[0] for r in twice]}")
    if requested is None:
        return rows
    wanted = spark.createDataFrame([(x.strip().upper(),) for x in requested], "country_code string").distinct()
    unknown = wanted.join(rows, "country_code", "left_anti").collect()
    if unknown:
        raise ValueError(f"unknown codes: {[r[0] for r in unknown]}")
    return rows.join(F.broadcast(wanted), "country_code", "left_semi")  # the caller's own list
