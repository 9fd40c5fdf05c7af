"""Gzipped XML responses and their manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import months_between, parse_year_month
from ..functions.text import as_int, strip
from ..schemas import MANIFEST
from . import pull

#: A response's path: raw/year=YYYY/country=CC/response_<start>-<end>.xml.gz
PATH = r"country=([^/]+)/response_([0-9]{6})-([0-9]{6})"


def read_items(spark: SparkSession, path: str | list[str], fields: list[str] = pull.FIELDS) -> DataFrame:
    """Items (the asked fields) with their file and their order in it, whatever their name spaces; a damaged file fails the job."""
    return pull.items_or_error(pull.read_responses(spark, path, fields=fields))


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """Result code and message of each response, from its header or else from the gateway's envelope; null for a damaged one."""
    return pull.read_responses(spark, path, pull.file_row).where("kind = 'file'").select("source", "code", "message")


def raw_columns(items: DataFrame) -> DataFrame:
    """Items under the names that normalization reads, as far as their fields were asked for."""
    text = lambda c: F.coalesce(strip(F.col(c)), F.lit(""))
    texts = {"statCd": "country_code_raw", "hsCd": "hs_code_raw", "statKor": "name_ko"}
    plain = {"expDlr": "exp_dlr", "expWgt": "exp_wgt", "impDlr": "imp_dlr", "impWgt": "imp_wgt", "balPayments": "bal_payments"}
    month = [parse_year_month(text("year")).alias("month")] if "year" in items.columns else []
    return items.select(
        "source", "ordinal", *month, F.regexp_extract("source", PATH, 1).alias("requested_country"), *[text(c).alias(x) for c, x in texts.items() if c in items.columns],
        *[F.col(c).alias(x) for c, x in plain.items() if c in items.columns],
    )


#: Fields that the queries of items need.
SUM_FIELDS, NAME_FIELDS, COUNTRY_FIELDS = ["year", "hsCd", "expDlr", "impWgt"], ["year", "hsCd", "statKor"], ["statCd"]


def normalized_items(items: DataFrame) -> DataFrame:
    """Rows and sums of a folder of responses by month."""
    from ..operators.normalize import is_summary

    kept = raw_columns(items).where(~is_summary())
    return kept.groupBy("month").agg(F.count("*").alias("rows"), F.sum(as_int(F.col("exp_dlr"))).alias("export_usd"), F.sum(as_int(F.col("imp_wgt"))).alias("import_weight_kg"))


def name_observations(items: DataFrame) -> DataFrame:
    return raw_columns(items).where("month is not null and hs_code_raw rlike '^[0-9]{10}$'").select("month", F.col("hs_code_raw").alias("hs10"), "name_ko")


def inspect_responses(items: DataFrame) -> DataFrame:
    """Per file: items, and the countries that they name."""
    return raw_columns(items).groupBy("source").agg(F.count("*").alias("items"), F.array_sort(F.collect_set(F.when(~F.col("country_code_raw").isin("", "-"), F.col("country_code_raw")))).alias("countries"))


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Successful requests of a folder of manifests, with the time that orders them; broken files are left out.

    ``finished_at`` is that time: of the answer, else of the request, else the file's.  ``stated_at`` is the text
    that the manifest has.  A window that isn't two months is an error.
    """
    rows = spark.read.option("multiLine", "true").option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").schema(MANIFEST).json(path)
    fallback = F.col("_metadata.file_modification_time")
    said = F.coalesce(F.nullif("finished_at", F.lit("")), F.nullif("requested_at", F.lit("")))
    good = rows.select("*", F.coalesce(F.try_to_timestamp(said), fallback).alias("__at"), F.col("_metadata.file_path").alias("path")).where("success and status = 'success'")
    month = lambda c: F.when(F.coalesce(F.length(c), F.lit(0)) == 6, F.col(c)).otherwise(F.raise_error(F.concat(F.lit("invalid manifest window: "), F.col("path"))).cast("string"))
    return good.withColumns({"stated_at": F.col("finished_at"), "country": F.upper("country"), "window_start": month("window_start"), "window_end": month("window_end")}).withColumn("finished_at", F.col("__at")).drop("__at")


def require_known_countries(sources: DataFrame, partners: DataFrame) -> None:
    unknown = sources.join(partners, sources["country"] == partners["country_code"], "left_anti").select("country").distinct().limit(5).collect()
    if unknown:
        raise ValueError(f"unknown countries: {[r[0] for r in unknown]}")


def without_raw_file(spark: SparkSession, sources: DataFrame, raw: str) -> DataFrame:
    """Manifests whose response is missing; only file names are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw).select(F.regexp_extract("path", PATH, 1).alias("country"), F.regexp_extract("path", PATH, 2).alias("window_start"), F.regexp_extract("path", PATH, 3).alias("window_end"))
    return sources.join(files, ["country", "window_start", "window_end"], "left_anti")
