"""The whole job: responses to canonical facts, quarantine, roll-ups, audits and manifests.

Below a data folder it reads ``raw`` and ``audits/manifests`` and writes ``normalized/hs10``, ``derived/hsN``,
``audits/normalization`` and ``audits/derivation``.  Tables are made in staging folders; a failed check leaves
the old ones, and the manifest says which check it was.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas, storage
from ..functions.months import months_between, window_size
from ..functions.text import LEVELS, MEASURES
from ..operators import normalize, reference, rollup, selection
from ..sources import footers, responses
from . import release

NAME = r"(country=[^/]+/response_[0-9]{6}-[0-9]{6})"


class CheckFailed(ValueError):
    """A job's check failed; ``manifest`` says which."""

    def __init__(self, manifest: dict):
        super().__init__(f"checks failed: {manifest['failed_checks']}")
        self.manifest = manifest


def chosen_sources(spark: SparkSession, data_dir: str, partners: DataFrame, start: str | None, end: str | None, full_coverage: bool) -> tuple[DataFrame, DataFrame]:
    """Successful sources, and the one that counts for each country and month.

    A country outside the reference, an answer that is gone and, if asked for, an uncovered country month are errors.
    """
    sources = responses.read_manifests(spark, f"{data_dir}/audits/manifests")
    responses.require_known_countries(sources, partners)
    gone = responses.without_raw_file(spark, sources, f"{data_dir}/raw")
    if not gone.isEmpty():
        raise ValueError(f"successful manifests with missing raw files: {gone.count()}")
    selected = selection.select_sources(selection.expand_windows(sources, start, end))
    bounds = selected.agg(F.min("month").alias("a"), F.max("month").alias("b")).first()
    if bounds["a"] is None:
        raise ValueError("no source for any country and month")
    if full_coverage:
        months = spark.range(1).select(F.explode(months_between(F.lit(start or bounds["a"]), F.lit(end or bounds["b"]))).alias("month"))
        missing = selection.missing_months(partners.select(F.col("country_code").alias("country")), months, selected)
        first = missing.orderBy("country", "month").limit(10).collect()
        if first:
            raise ValueError(f"full coverage misses {missing.count()} country months, among them {[tuple(r) for r in first]}")
    return sources, selected


def raw_name() -> Column:
    """Where a source's answer is kept, below the data folder."""
    return F.concat(F.lit("raw/year="), F.substring("window_start", 1, 4), F.lit("/country="), "country", F.lit("/response_"), "window_start", F.lit("-"), "window_end", F.lit(".xml.gz"))


def assigned_rows(items: DataFrame, sources: DataFrame, selected: DataFrame) -> DataFrame:
    """Raw rows, totals among them, with where they come from and whether their source counts for their month."""
    own = sources.select(F.concat(F.lit("country="), "country", F.lit("/response_"), "window_start", F.lit("-"), "window_end").alias("name"), F.col("path").alias("source_manifest"), F.col("stated_at").alias("source_finished_at"))
    rows = items.withColumn("name", F.regexp_extract("source", NAME, 1)).join(own, "name")
    taken = selected.select(F.col("path").alias("source_manifest"), "month", F.lit(True).alias("assigned"))
    return rows.join(taken, ["source_manifest", "month"], "left").withColumn("assigned", F.coalesce("assigned", F.lit(False))).drop("name")


def whole_sources(sources: DataFrame, selected: DataFrame) -> DataFrame:
    """(source_manifest, whole): whether a source counts for all months of its window within a calendar year.

    A window of several years is cut at years, so it never is whole.
    """
    per_year = selected.groupBy(F.col("path").alias("source_manifest"), F.substring("month", 1, 4).alias("year")).agg(F.count("*").alias("n"))
    most = per_year.groupBy("source_manifest").agg(F.max("n").alias("n"))
    asked = sources.select(F.col("path").alias("source_manifest"), window_size(F.col("window_start"), F.col("window_end")).alias("asked"))
    return most.join(asked, "source_manifest").select("source_manifest", (F.col("n") == F.col("asked")).alias("whole"))


def normalize_job(spark: SparkSession, data_dir: str, editions: DataFrame, partners: DataFrame, start: str | None = None, end: str | None = None, full_coverage: bool = False, overwrite: bool = True, dry_run: bool = False) -> dict:
    """Write ``normalized/hs10`` and its audits; returns the manifest, or raises CheckFailed with it."""
    audits, target = f"{data_dir}/audits/normalization", f"{data_dir}/normalized/hs10"
    if not dry_run and not overwrite and storage.exists(spark, target):
        raise FileExistsError(target)
    reference.require_one_revision(editions)
    sources, selected = chosen_sources(spark, data_dir, partners, start, end, full_coverage)
    selected.write.mode("overwrite").parquet(f"{audits}/selected.staging")
    selected = spark.read.parquet(f"{audits}/selected.staging")
    audit = selected.join(sources.select("path", "window_start", "window_end", "requested_at", F.col("stated_at").alias("finished_at"), raw_name().alias("raw_path")), "path")
    audit = audit.select(F.col("country").alias("country_code"), "month", F.col("candidates").alias("candidate_count"), F.col("window_start").alias("selected_window_start"), F.col("window_end").alias("selected_window_end"), "requested_at", "finished_at", F.col("path").alias("manifest_path"), "raw_path")
    release.write_csv(audit, f"{audits}/source_selection.csv", ["country_code", "month"])
    overlap = selection.overlap_counts(selected).first()
    manifest = {"start_month": start, "end_month": end, "successful_source_manifests": sources.count(), "selected_country_months": overlap["country_months"], "overlap_country_months": overlap["overlapping"], "selected_unique_raw_sources": selected.select("path").distinct().count()}
    if dry_run:
        storage.delete(spark, f"{audits}/selected.staging")
        return manifest

    staging = f"{target}.staging"
    items = responses.raw_columns(responses.read_items(spark, f"{data_dir}/raw"))
    assigned_rows(items, sources, selected).write.mode("overwrite").parquet(f"{audits}/rows.staging")  # one parse of the XML
    rows = spark.read.parquet(f"{audits}/rows.staging")
    normalize.classify(rows.where(~normalize.is_summary() & F.col("assigned"))).write.mode("overwrite").parquet(f"{audits}/classified.staging")
    classified = spark.read.parquet(f"{audits}/classified.staging")
    facts = reference.revision_lookup(normalize.canonical(classified), editions)
    release.write_monthly(facts, staging, ["country_code", "hs10"])
    written = spark.read.parquet(staging)

    normalize.anomalies(classified).write.mode("overwrite").option("compression", "zstd").parquet(f"{audits}/normalization_anomalies.parquet")
    bad = spark.read.parquet(f"{audits}/normalization_anomalies.parquet")
    release.write_csv(bad, f"{audits}/normalization_anomalies.csv", ["month", "requested_country", "hs_code_raw"])
    looked = classified.where("coalesce(reason, '') not in ('country_mismatch', 'non_hs10_code', 'duplicate_key')").withColumnRenamed("hs_code_raw", "hs10")
    gaps = reference.reference_gaps(looked.drop("hs_revision"), editions).select(F.col("year").alias("reference_year"), "hs10", F.col("rows").alias("fact_rows"), "months", F.col("names").alias("name_ko_variants"))
    gaps.write.mode("overwrite").parquet(f"{audits}/gaps.staging")
    gaps = spark.read.parquet(f"{audits}/gaps.staging")
    release.write_csv(gaps, f"{audits}/hsk_reference_unknown_codes.csv", ["reference_year", "hs10"])

    checks = summary_checks(rows, sources, selected)
    summary = normalize.summary_figures(checks).first().asDict()
    counted = rows.agg(F.count("*").alias("items_seen"), F.count_if(normalize.is_summary()).alias("summary_or_nonfact_rows"), F.count_if(~normalize.is_summary() & ~F.col("assigned")).alias("superseded_month_rows_skipped")).first().asDict()
    figures = normalize.row_reconciliation(classified).first()
    verified = verification(spark, staging, written)
    unknown = gaps.agg(F.coalesce(F.sum("fact_rows"), F.lit(0)), F.count("*")).first()
    by_reason = {r["reason"]: r["count"] for r in bad.groupBy("reason").count().collect()}  # a row a reason
    reconciled = {"assigned_fact_rows": figures["assigned"], "canonical_rows": figures["canonical"], "non_hs10_rows": figures["quarantine"], "fatal_anomalies": figures["fatal"], "reconciles": figures["reconciles"]}
    stats = counted | reconciled | {"negative_weight_rows": by_reason.get("negative_weight", 0), "partition_count": verified["partition_count"]}
    manifest |= {"normalization_stats": stats, "verification": verified, "fatal_anomalies": figures["fatal"], "anomaly_rows": sum(by_reason.values()), "non_hs10_anomaly_rows": by_reason.get("non_hs10_code", 0), "hsk_reference_unknown_rows": unknown[0], "hsk_reference_unknown_unique": unknown[1], "stored_row_reconciliation": reconciled, **summary}
    failed = {
        "fatal_anomalies": figures["fatal"] > 0, "parquet_rows": verified["parquet_rows"] != figures["canonical"], "schema": not verified["schema_ok"], "partition_months": verified["partition_month_mismatches"] > 0,
        "duplicate_keys": verified["duplicate_keys"] > 0, "source_summaries": summary["source_summary_mismatches"] > 0, "row_reconciliation": not figures["reconciles"],
    }
    manifest["failed_checks"] = [k for k, v in failed.items() if v]
    storage.write_text(spark, f"{audits}/normalization_manifest.json", json.dumps(manifest, ensure_ascii=False, indent=2))
    for name in ("selected", "rows", "classified", "gaps"):
        storage.delete(spark, f"{audits}/{name}.staging")
    if manifest["failed_checks"]:
        raise CheckFailed(manifest)
    storage.swap(spark, staging, target)
    return manifest


def summary_checks(rows: DataFrame, sources: DataFrame, selected: DataFrame) -> DataFrame:
    """Totals of each whole source's assigned rows against the last total row of its response.

    Sources come from their manifests, so one whose response has no item at all is there, with totals of zero and none stated.
    """
    facts = rows.where(~normalize.is_summary() & F.col("assigned")).withColumn("source", F.col("source_manifest"))
    totals = normalize.source_totals(facts)
    known = sources.select(F.col("path").alias("source_manifest")).distinct()
    whole = known.join(whole_sources(sources, selected), "source_manifest").select(F.col("source_manifest").alias("source"), "whole")
    totals = whole.join(totals, "source", "left").select("source", "whole", F.coalesce("fact_rows", F.lit(0)).alias("fact_rows"), F.coalesce("numeric_ok", F.lit(True)).alias("numeric_ok"), *[F.coalesce(m, F.lit(0)).alias(m) for m in MEASURES])
    return normalize.summary_reconciliation(totals, normalize.last_summaries(rows.withColumn("source", F.col("source_manifest"))))


def verification(spark: SparkSession, path: str, written: DataFrame) -> dict:
    """What was written, read again: by footers rows, bytes, columns and months of each folder, by keys repeated ones and nulls."""
    told = footers.footers(spark, path)
    folder = lambda p: "".join(re.search(r"/year=([0-9]{4})/mm=([0-9]{2})/", p).groups())
    misplaced = [f for f in told if f.rows and {f.low, f.high} != {folder(f.path)}]
    keys = written.groupBy("month", "country_code", "hs10").agg(F.count("*").alias("n"))
    null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("month", "country_code", "hs10")])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = keys.agg(total("n").alias("parquet_rows"), total(F.col("n") - 1).alias("duplicate_keys"), F.countDistinct("month").alias("partition_count"), F.count_if(null).alias("nulls")).first()
    kinds = [(f.name, f.dataType.simpleString()) for f in written.schema if f.name not in ("year", "mm")]
    same = len({f.columns for f in told}) <= 1
    schema_ok = sorted(kinds) == sorted(tuple(x.split()) for x in schemas.FACT.split(", ")) and out["nulls"] == 0 and same
    wrong = written.where(F.col("month") != F.concat("year", "mm")).count() if misplaced else 0  # rows are only looked at where a footer says so
    rows = sum(f.rows for f in told)
    if rows != out["parquet_rows"]:
        raise release.Unequal(f"footers state {rows} rows, {out['parquet_rows']} are read")
    return {"parquet_rows": rows, "partition_month_mismatches": wrong, **{k: out[k] for k in ("duplicate_keys", "partition_count")}, "parquet_files": len(told), "parquet_bytes": sum(f.bytes for f in told), "schema_ok": schema_ok}


def derive_job(spark: SparkSession, data_dir: str, levels: tuple[int, ...] = LEVELS, overwrite: bool = True) -> dict:
    """Write ``derived/hsN`` from the canonical facts and the quarantine; returns the manifest.

    Each level is written once and the next coarser one made from it.  Totals must agree for every month and level.
    """
    if any(n not in LEVELS for n in levels):
        raise ValueError(f"levels are {LEVELS}")
    target = f"{data_dir}/derived"
    if not overwrite and storage.exists(spark, target):
        raise FileExistsError(target)
    staging, scratch = f"{target}.staging", storage.scratch(spark, "levels")
    facts = spark.read.parquet(f"{data_dir}/normalized/hs10")
    if not facts.where(F.col("month") != F.concat("year", "mm")).isEmpty():
        raise ValueError("a fact is in another month's folder")
    bad = spark.read.parquet(f"{data_dir}/audits/normalization/normalization_anomalies.parquet").where("reason = 'non_hs10_code'")

    def written(level: int, groups: DataFrame) -> DataFrame:
        groups.write.mode("overwrite").parquet(f"{scratch}/hs{level}")
        return spark.read.parquet(f"{scratch}/hs{level}")

    found = rollup.cascade(facts, bad, written)
    want = rollup.expected(facts, bad, ["month"])
    sums = [F.sum(m).alias(m) for m in MEASURES]
    have = reduce(DataFrame.unionByName, [g.groupBy("month").agg(*sums, F.sum("exception_row_count").alias("exceptions"), F.count("*").alias("rows")).withColumn("level", F.lit(n)) for n, g in found.items()])
    both = have.join(want, ["level", "month"], "full")
    same = reduce(lambda a, b: a & b, [F.col(m).eqNullSafe(F.col(f"e_{m}")) for m in MEASURES]) & F.col("exceptions").eqNullSafe(F.col("mapped"))
    wrong = both.where(~same).orderBy("level", "month").limit(5).collect()
    if wrong:
        raise ValueError(f"totals differ: {[(r['level'], r['month']) for r in wrong]}")
    for level in levels:
        release.write_monthly(rollup.level_table(found[level], level), f"{staging}/hs{level}", ["country_code", f"hs{level}"])
    per_level = {r["level"]: r for r in have.groupBy("level").agg(*sums, F.sum("rows").alias("rows"), F.sum("exceptions").alias("mapped"), F.count("*").alias("files")).collect()}
    base = rollup.totals(facts).first().asDict()
    of = lambda r: {m: r[m] for m in MEASURES}
    stats = {
        "input_rows": facts.count(), "residual_input_rows": bad.count(), "levels": {str(n): {"rows": per_level[n]["rows"], "months": per_level[n]["files"], "mapped_residual_rows": per_level[n]["mapped"]} for n in levels},
        "totals": {"hs10": base} | {f"hs{n}": of(per_level[n]) for n in levels}, "residual_totals": {str(n): {m: r[f"residual_{m}"] for m in MEASURES} for n in levels for r in [found[n].agg(*[F.coalesce(F.sum(f"residual_{m}"), F.lit(0)).alias(f"residual_{m}") for m in MEASURES]).first()]},
    }
    manifest = {"levels": list(levels), "stats": stats}
    storage.write_text(spark, f"{data_dir}/audits/derivation/derivation_manifest.json", json.dumps(manifest, ensure_ascii=False, indent=2))
    storage.swap(spark, staging, target)
    return manifest
