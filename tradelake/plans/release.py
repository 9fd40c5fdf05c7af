"""Writing, consolidating, describing and swapping release tables."""

from __future__ import annotations

import hashlib
import json
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..functions.text import MEASURES, bad_unicode_reason
from ..operators import quality
from ..schemas import EDITION, PARTNER
from ..sources import dimensions, footers

#: An anomaly's released columns, by the name inside.
RELEASED = {
    "reason": "reason", "month": "month", "requested_country": "country_code", "country_code_raw": "country_code_raw", "hs_code_raw": "raw_hs_code", "hs_length": "raw_hs_length", "name_ko": "name_ko",
    **{m: m for m in MEASURES}, "source_finished_at": "source_finished_at",
}
#: Rows of one file at most.
FILE_ROWS = 5_000_000


def write_monthly(facts: DataFrame, path: str, order: list[str]) -> None:
    """Facts in folders year=/mm=, sorted inside.

    Months are dealt out by size: adaptive execution splits a large month among tasks and joins small ones, so
    one month is no bottleneck however much of the table it holds.
    """
    rows = facts.withColumns({"year": F.substring("month", 1, 4), "mm": F.substring("month", 5, 2)})
    rows = rows.hint("rebalance", F.col("year"), F.col("mm")).sortWithinPartitions("year", "mm", *order)
    rows.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).partitionBy("year", "mm").parquet(path)



def fingerprint(df: DataFrame) -> list:
    """Aggregates of a table's rows that no order changes: how many there are, and the sum of their hashes."""
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("hashes")]


class Unequal(ValueError):
    """A written table isn't what was read."""


def require_written(seen: dict, written: DataFrame, was: footers.TableFigures, now: footers.TableFigures) -> None:
    """Raise unless a table's rows are those that its writer got, and its footers state what the source's do."""
    if not was.rows == now.rows == seen["rows"]:
        raise Unequal(f"{was.rows} rows were read, {seen['rows']} handed to the writer, {now.rows} written")
    if (was.low, was.high) != (now.low, now.high) and None not in (was.low, now.low):
        raise Unequal(f"months {was.low}-{was.high} became {now.low}-{now.high}")
    if written.agg(*fingerprint(written)).first().asDict() != seen:
        raise Unequal("written rows differ from those handed to the writer")


def consolidate(spark: SparkSession, source: str, target: str, order: list[str], files: int | None = None) -> dict:
    """One sorted table from monthly folders, proven to hold the same rows; returns its figures.

    Row counts, columns and months come from the footers of both sides; a fingerprint is taken of the rows as they go
    to the writer and again of the written files.  ``files=1`` gives the single file of a release; None lets
    the sort's range partitions be files, which is what a table of many terabytes needs.
    """
    was = footers.table_figures(spark, source)
    rows = spark.read.parquet(source).drop("year", "mm")
    seen = Observation()
    out = (rows.repartition(1).sortWithinPartitions(*order) if files == 1 else rows.orderBy(*order)).observe(seen, *fingerprint(rows))
    out.write.mode("overwrite").option("compression", "zstd").parquet(target)
    now = footers.table_figures(spark, target)
    require_written(seen.get, spark.read.schema(rows.schema).parquet(target), was, now)
    return {"rows": now.rows, "source_files": was.files, "source_bytes": was.bytes, "columns": rows.columns} | folder_figures(spark, target)


def roundtrip(spark: SparkSession, facts: DataFrame, order: list[str]) -> DataFrame:
    """Facts written by month, consolidated and read again."""
    path = storage.scratch(spark, "consolidate")
    write_monthly(facts, f"{path}/monthly", order[1:])
    consolidate(spark, f"{path}/monthly", f"{path}/one", order)
    return spark.read.parquet(f"{path}/one")


def release_anomalies(anomalies: DataFrame, reason: str) -> DataFrame:
    """Anomalies of one reason without internal paths, under their released names."""
    return anomalies.where(F.col("reason") == reason).select(*[F.col(c).alias(name) for c, name in RELEASED.items()])


def write_csv(df: DataFrame, path: str, order: list[str]) -> int:
    """An audit as one sorted CSV file in a folder, nested columns as JSON text; returns its rows.

    The sort's range partitions are written by as many tasks, and the file system joins the parts.
    """
    spark, nested = df.sparkSession, (T.ArrayType, T.MapType, T.StructType)
    flat = df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema])
    parts, seen = storage.scratch(spark, "csv"), Observation()
    flat.orderBy(*order).observe(seen, F.count(F.lit(1)).alias("rows")).write.csv(parts)
    storage.delete(spark, path)
    storage.write_bytes(spark, f"{path}/head", (",".join(df.columns) + "\n").encode())
    found = [p for p, n in storage.files(spark, parts) if n and "/part-" in p]
    storage.join_files(spark, [f"{path}/head", *found], f"{path}/part-00000.csv")
    storage.delete(spark, parts)
    return seen.get["rows"]


def latest_sample(facts: DataFrame, path: str, month: str | None = None) -> int:
    """A month's rows (the latest, unless one is given) as CSV; returns how many.  No rows, or others than the table has, are an error."""
    if month is None:
        month = facts.agg(F.max("month")).first()[0]
    rows = facts.where(F.col("month") == month)
    write_csv(rows, path, ["month", *[c for c in facts.columns if c.startswith(("country", "hs"))]])
    known, written = rows.count(), facts.sparkSession.read.option("header", "true").csv(path).count()
    if not written or written != known:
        raise Unequal(f"sample of {month}: {written} of {known} rows written")
    return written


def file_figures(spark: SparkSession, path: str) -> DataFrame:
    """Bytes and SHA-256 of each file below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


#: A file over this size gets a digest of its parts' digests, so no task holds it whole.
WHOLE_FILE = 256 << 20


def folder_figures(spark: SparkSession, path: str) -> dict:
    """Bytes of a table's files and, while they are small enough to be read whole, a SHA-256 over theirs in order of name."""
    files = [(p, n) for p, n in storage.files(spark, path) if "/_" not in p and not p.endswith(".crc")]
    out = {"bytes": sum(n for _, n in files), "files": len(files)}
    if all(n <= WHOLE_FILE for _, n in files):
        digests = [r["sha256"] for r in file_figures(spark, path).where(~F.col("path").contains("/_")).orderBy("path").collect()]  # a row a file
        out["sha256"] = digests[0] if len(digests) == 1 else hashlib.sha256("".join(digests).encode()).hexdigest()
    return out


def copy_with_figures(spark: SparkSession, source: str, target: str) -> dict:
    """Copy a table or a document into a release; rows and columns of Parquet and CSV are stated too."""
    if not storage.exists(spark, source):
        raise FileNotFoundError(f"required release source missing: {source}")
    storage.copy(spark, source, target)
    kind = source.rpartition(".")[2].lower()
    rows = spark.read.parquet(target) if kind == "parquet" else spark.read.option("header", "true").csv(target) if kind == "csv" else None
    known = {} if rows is None else {"rows": rows.count(), "columns": rows.columns}
    one = file_figures(spark, target).agg(F.sum("bytes").alias("b"), F.array_join(F.array_sort(F.collect_list("sha256")), "").alias("s")).first()  # a file or a few
    return known | {"bytes": one["b"], "sha256": one["s"] if len(one["s"]) == 64 else hashlib.sha256(one["s"].encode()).hexdigest()}


def damaged_text_files(spark: SparkSession, path: str, kind: str = "*") -> DataFrame:
    """Text files that aren't UTF-8 or hold replacement or control characters."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", kind).load(path)
    text = F.col("content").cast("string")
    reason = F.when(~F.is_valid_utf8(text), "not_utf8").otherwise(bad_unicode_reason(text))
    return files.select("path", reason.alias("reason")).where("reason is not null")


def field_type(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, T.IntegralType):
        return "integer"
    if isinstance(kind, (T.FractionalType,)):
        return "numeric"
    return "datetime" if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "string"


#: Fields that stay text even where a CSV's values look like numbers.
CODE_FIELDS = frozenset({"month", "hs2", "hs4", "hs6", "hs8", "hs10"})


def fields(df: DataFrame, descriptions: dict[str, str] | None = None) -> list[dict]:
    kind = lambda f: "string" if f.name in CODE_FIELDS else field_type(f.dataType)
    return [{"name": f.name, "description": (descriptions or {}).get(f.name, f.name), "type": kind(f)} for f in df.schema]


def metadata(title: str, description: str, tables: dict[str, DataFrame], notes: dict[str, str] | None = None, about: dict[str, str] | None = None, **more) -> dict:
    """Description of a release: tables with their fields' types and meanings, and what else is to be said."""
    resources = [{"path": name, "description": (notes or {}).get(name, f"Release file: {name}")} | ({"schema": {"fields": fields(df, about)}} if df is not None else {}) for name, df in sorted(tables.items())]
    return {"title": title, "description": description, "resources": resources} | more


def require_passed(report: dict) -> None:
    """A release is only made of tables that passed their checks; a report that doesn't say so hasn't."""
    if report.get("release_gate_pass") is not True:
        raise ValueError(f"release QA has not passed: {report.get('fatal_sections', 'no report')}")


def edition_check(spark: SparkSession, path: str) -> dict:
    """Metrics of the code reference's rows, its bytes and whether its columns and types are the declared ones."""
    table = spark.read.parquet(path)
    kinds = [(f.name, f.dataType.simpleString()) for f in table.schema]
    told = {"schema_ok": kinds == [tuple(x.split()) for x in EDITION.split(", ")], "bytes": sum(n for _, n in footers.parquet_files(spark, path))}
    found = quality.dimension_metrics(table).first().asDict()
    return found | told | {"ok": found["ok"] and told["schema_ok"]}


def qa_report(spark: SparkSession, data_dir: str, documents: list[str] = ()) -> dict:
    """Check dimensions, manifests, the quarantine's text and documents; write the report and its long form.

    Every section must say that it is well; a file that isn't there is a failure.
    """
    missing = {"ok": False, "missing": True}
    there = lambda path: storage.exists(spark, f"{data_dir}/{path}")
    read = lambda path: json.loads(storage.read_bytes(spark, f"{data_dir}/{path}"))
    one = lambda df: df.first().asDict()
    partners, editions, bad = "reference/country_reference.csv", "reference/hsk_code_reference.parquet", "audits/normalization/normalization_anomalies.parquet"
    checks = {
        "country_reference": one(quality.partner_metrics(dimensions.read_csv(spark, f"{data_dir}/{partners}", PARTNER))) if there(partners) else missing,
        "hsk_reference": edition_check(spark, f"{data_dir}/{editions}") if there(editions) else missing,
        "normalization": quality.normalization_gate(read(NORMALIZATION)) if there(NORMALIZATION) else missing,
        "derivation": quality.derivation_gate(read(DERIVATION)) if there(DERIVATION) else missing,
        "anomaly_text": one(quality.anomaly_text_metrics(spark.read.parquet(f"{data_dir}/{bad}"))) if there(bad) else missing,
    }
    for path in documents:
        if storage.exists(spark, path):
            found = damaged_text_files(spark, path).first()
            checks[f"text:{path.rpartition('/')[2]}"] = {"ok": found is None, "error": found and found["reason"]}
        else:
            checks[f"text:{path.rpartition('/')[2]}"] = missing
    fatal = [name for name, check in checks.items() if not check.get("ok")]
    warned = {"anomaly_text": ("korean_name_without_hangul", "negative_weight_rows"), "normalization": ("hsk_reference_unknown_unique",)}
    warnings = [f"{name}: {k} {checks[name][k]}" for name, keys in warned.items() for k in keys if checks[name].get(k)]
    report = {"checks": checks, "fatal_sections": fatal, "warnings": warnings, "release_gate_pass": not fatal}
    storage.write_text(spark, f"{data_dir}/{QA}", json.dumps(report, ensure_ascii=False, indent=2, default=str))
    long = [(name, k, None if v is None else str(v)) for name, check in checks.items() for k, v in check.items() if v is None or isinstance(v, (str, int, float, bool))]
    write_csv(spark.createDataFrame(long, "section string, metric string, value string"), f"{data_dir}/audits/release_qa/coverage_report.csv", ["section", "metric"])
    return report


#: The job's reports below the data folder, and what a release is made of.
NORMALIZATION, DERIVATION, QA = "audits/normalization/normalization_manifest.json", "audits/derivation/derivation_manifest.json", "audits/release_qa/release_qa.json"
FACT_TABLES = {"trade_hs10_monthly.parquet": ("normalized/hs10", "hs10"), **{f"trade_hs{n}_monthly.parquet": (f"derived/hs{n}", f"hs{n}") for n in (8, 6, 4, 2)}}
REFERENCES = {
    "hsk_code_reference.parquet": "reference/hsk_code_reference.parquet", "country_reference.csv": "reference/country_reference.csv",
    "hsk_reference_gaps.csv": "audits/normalization/hsk_reference_unknown_codes.csv", "coverage_report.csv": "audits/release_qa/coverage_report.csv",
}
EXCEPTIONS = {"source_code_exceptions.parquet": "non_hs10_code", "source_weight_warnings.parquet": "negative_weight"}


def build(spark: SparkSession, data_dir: str, output: str, title: str, documents: list[str] = (), description: str = "", month: str | None = None, files: int | None = None, overwrite: bool = True, **more) -> dict:
    """Package a passed job: fact tables, a sample month, references, exceptions, documents, manifest, metadata.

    Everything is made in a staging folder; damaged text stops it, and only a whole release replaces the old one.
    """
    began, staging = time.monotonic(), f"{output}.staging"
    qa = json.loads(storage.read_bytes(spark, f"{data_dir}/{QA}")) if storage.exists(spark, f"{data_dir}/{QA}") else {}
    require_passed(qa)
    if not overwrite and storage.exists(spark, output):
        raise FileExistsError(output)
    storage.delete(spark, staging)
    figures = {name: consolidate(spark, f"{data_dir}/{source}", f"{staging}/{name}", ["month", "country_code", code], files) for name, (source, code) in FACT_TABLES.items()}
    sample = "trade_hs6_sample.csv"
    figures[sample] = {"rows": latest_sample(spark.read.parquet(f"{staging}/trade_hs6_monthly.parquet"), f"{staging}/{sample}", month)} | folder_figures(spark, f"{staging}/{sample}")
    figures |= {name: copy_with_figures(spark, f"{data_dir}/{source}", f"{staging}/{name}") for name, source in REFERENCES.items()}
    bad = spark.read.parquet(f"{data_dir}/audits/normalization/normalization_anomalies.parquet")
    for name, reason in EXCEPTIONS.items():
        rows = release_anomalies(bad, reason)
        (rows.coalesce(1) if files == 1 else rows).write.option("compression", "zstd").parquet(f"{staging}/{name}")
        figures[name] = {"rows": spark.read.parquet(f"{staging}/{name}").count(), "columns": rows.columns} | folder_figures(spark, f"{staging}/{name}")
    figures |= {path.rpartition("/")[2]: copy_with_figures(spark, path, f"{staging}/{path.rpartition('/')[2]}") for path in documents}
    job = json.loads(storage.read_bytes(spark, f"{data_dir}/{NORMALIZATION}"))
    stats, derived = job["normalization_stats"], json.loads(storage.read_bytes(spark, f"{data_dir}/{DERIVATION}"))
    months = spark.read.parquet(f"{staging}/trade_hs10_monthly.parquet").agg(F.min("month"), F.max("month"), F.countDistinct("country_code")).first()
    coverage = {
        "start_month": months[0], "end_month": months[1], "partner_codes": months[2], "country_month_assignments": job["selected_country_months"], "source_fact_rows": stats["assigned_fact_rows"], "canonical_hsk10_rows": stats["canonical_rows"],
        "non_hsk10_source_rows": stats["non_hs10_rows"], "negative_weight_warning_rows": stats.get("negative_weight_rows", 0), "hsk_reference_unknown_fact_rows": job["hsk_reference_unknown_rows"],
        "hsk_reference_unknown_unique_year_codes": job["hsk_reference_unknown_unique"], "annual_hsk_reference_rows": figures["hsk_code_reference.parquet"]["rows"],
    }
    checked = {k: job[k] for k in ("source_summary_checked", "source_summary_matches", "source_summary_mismatches", "stored_row_reconciliation")}
    passed = {k: qa[k] for k in ("release_gate_pass", "fatal_sections", "warnings")} | {"duplicate_hsk10_keys": job["verification"]["duplicate_keys"], "partition_month_mismatches": job["verification"]["partition_month_mismatches"]}
    manifest = {"dataset_title": title, "coverage": coverage, "quality": passed | checked, "derived_levels": derived["levels"], "files": figures, "build_elapsed_seconds": round(time.monotonic() - began, 3)}
    storage.write_text(spark, f"{staging}/release_manifest.json", json.dumps(manifest, ensure_ascii=False, indent=2))
    read = lambda name: spark.read.parquet(f"{staging}/{name}") if name.endswith(".parquet") else spark.read.option("header", "true").option("inferSchema", "true").csv(f"{staging}/{name}") if name.endswith(".csv") else None
    described = metadata(title, description, {name: read(name) for name in [*figures, "release_manifest.json"]}, **more)
    storage.write_text(spark, f"{staging}/dataset-metadata.json", json.dumps(described, ensure_ascii=False, indent=2))
    for kind in ("*.csv", "*.json", "*.md"):
        damaged = damaged_text_files(spark, staging, kind).first()
        if damaged is not None:
            raise ValueError(f"{damaged['reason']} in {damaged['path']}")
    storage.swap(spark, staging, output, overwrite)
    return manifest
