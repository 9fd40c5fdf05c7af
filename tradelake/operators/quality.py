"""Quality metrics and gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import MEASURES, bad_unicode_reason, has_hangul, level_of, strip


def text_flags(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    return rows.select(*keys, bad_unicode_reason(F.col(text)).alias("reason"), F.coalesce(has_hangul(F.col(text)), F.lit(False)).alias("hangul"))


def prefix_integrity(codes: DataFrame) -> DataFrame:
    """Rows whose coarser codes aren't prefixes of the full one."""
    bad = reduce(lambda a, b: a | b, [F.col(f"hs{n}") != level_of(F.col("hs10"), n) for n in (8, 6, 4, 2)])
    return codes.agg(F.count("*").alias("rows"), F.count_if(bad).alias("prefix_mismatches"), F.count_if(~F.col("hs10").rlike("^[0-9]{10}$")).alias("invalid_codes"))


def blank(c: str):
    return F.coalesce(strip(F.col(c)), F.lit("")) == ""


def dimension_metrics(editions: DataFrame, names: tuple[str, ...] = ("name_ko", "name_en")) -> DataFrame:
    """Of a code reference, one row: size, years, repeated and invalid codes, wrong prefixes, missing and damaged names.

    Keys are counted once each, so one aggregation by key serves; ``ok`` tells whether all is well.
    """
    one = editions.withColumns({f"hs{n}": F.col(f"hs{n}") if f"hs{n}" in editions.columns else level_of(F.col("hs10"), n) for n in (8, 6, 4, 2)})
    wrong = reduce(lambda a, b: a | b, [F.col(f"hs{n}") != level_of(F.col("hs10"), n) for n in (8, 6, 4, 2)])
    names = [c for c in names if c in editions.columns]
    tests = {"invalid_hs10": ~F.col("hs10").rlike("^[0-9]{10}$"), "prefix_mismatch": wrong}
    tests |= {f"missing_{c}": blank(c) for c in names} | {f"bad_unicode_{c}": bad_unicode_reason(F.col(c)).isNotNull() for c in names}
    tests["korean_name_without_hangul"] = ~blank("name_ko") & ~F.coalesce(has_hangul(F.col("name_ko")), F.lit(False))
    keys = one.groupBy("reference_year", "hs10").agg(F.count("*").alias("n"), *[F.count_if(t).alias(x) for x, t in tests.items()])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = keys.agg(total("n").alias("rows"), F.min("reference_year").alias("year_min"), F.max("reference_year").alias("year_max"), F.countDistinct("reference_year").alias("year_count"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_year_hs10"), *[total(x).alias(x) for x in tests])
    return out.withColumn("ok", (F.col("rows") > 0) & (F.col("duplicate_year_hs10") + sum(F.col(x) for x in tests) == 0))


def partner_metrics(partners: DataFrame) -> DataFrame:
    """Of the partner table, one row: size, repeated codes, names missing, damaged or not Korean."""
    name = F.col("country_name_ko")
    tests = {"missing_country_name_ko": blank("country_name_ko"), "bad_unicode_rows": bad_unicode_reason(name).isNotNull(), "korean_name_without_hangul": ~blank("country_name_ko") & ~F.coalesce(has_hangul(name), F.lit(False))}
    out = partners.agg(F.count("*").alias("rows"), F.countDistinct("country_code").alias("unique_country_codes"), *[F.count_if(t).alias(x) for x, t in tests.items()])
    out = out.withColumn("duplicate_country_codes", F.col("rows") - F.col("unique_country_codes"))
    return out.withColumn("ok", (F.col("rows") > 0) & (F.col("duplicate_country_codes") + sum(F.col(x) for x in tests) == 0))


def anomaly_text_metrics(anomalies: DataFrame) -> DataFrame:
    """Of the quarantine: rows by reason, damaged names; only damage fails it."""
    name = F.col("name_ko")
    tests = {"non_hs10_rows": F.col("reason") == "non_hs10_code", "negative_weight_rows": F.col("reason") == "negative_weight", "bad_unicode_name_ko": bad_unicode_reason(name).isNotNull(), "korean_name_without_hangul": (F.coalesce(name, F.lit("")) != "") & ~F.coalesce(has_hangul(name), F.lit(False))}
    return anomalies.agg(F.count("*").alias("rows"), *[F.count_if(t).alias(x) for x, t in tests.items()]).withColumn("ok", F.col("bad_unicode_name_ko") == 0)


def long_report(sections: dict[str, DataFrame]) -> DataFrame:
    """One-row metric tables as rows (section, metric, value)."""
    parts = []
    for section, df in sections.items():
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in df.columns]))
        parts.append(df.select(F.lit(section).alias("section"), pairs.alias("x")).select("section", "x.metric", "x.value"))
    return reduce(DataFrame.unionByName, parts)


def partition_metrics(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Of a written table: rows, months, rows in a wrong folder, duplicate keys."""
    by_key = facts.groupBy("month", *keys).agg(F.count("*").alias("n"), F.count_if(F.col("month") != F.concat("year", "mm")).alias("wrong"))
    return by_key.groupBy("month").agg(F.sum("n").alias("rows"), F.sum("wrong").alias("misplaced"), F.sum(F.col("n") - 1).alias("duplicates"))


def whole(value) -> int:
    return int(value or 0)


def normalization_gate(manifest: dict) -> dict:
    """Figures of a normalization manifest and ``ok``.  What isn't stated fails: a gate that can't see is closed."""
    stats, verify = manifest.get("normalization_stats") or {}, manifest.get("verification") or {}
    either = lambda k: manifest.get(k) or stats.get(k)
    report = {k: whole(manifest.get(k)) for k in ("selected_country_months", "fatal_anomalies", "hsk_reference_unknown_rows", "hsk_reference_unknown_unique")}
    report |= {k: whole(stats.get(k)) for k in ("partition_count", "canonical_rows", "non_hs10_rows")}
    report |= {k: whole(verify.get(k)) for k in ("duplicate_keys", "partition_month_mismatches", "parquet_rows", "parquet_bytes")}
    report |= {f"source_summary_{k}": whole(either(f"source_summary_{k}")) for k in ("checked", "matches", "mismatches", "missing", "weight_rounding_sources", "weight_rounding_abs_kg")}
    report |= {"schema_ok": bool(verify.get("schema_ok")), "stored_row_reconciliation_ok": bool((either("stored_row_reconciliation") or {}).get("reconciles"))}
    positive, zero = ("selected_country_months", "partition_count"), ("duplicate_keys", "partition_month_mismatches", "fatal_anomalies", "source_summary_mismatches")
    told = report["schema_ok"] and report["stored_row_reconciliation_ok"] and report["parquet_rows"] == report["canonical_rows"]
    report["ok"] = told and all(report[k] > 0 for k in positive) and not any(report[k] for k in zero)
    return report


def derivation_gate(manifest: dict, required: tuple[int, ...] = (2, 4, 6, 8)) -> dict:
    """Figures of a derivation manifest and ``ok``.  Totals are added up here again, whatever the manifest claims."""
    levels, stats = [int(x) for x in manifest.get("levels") or []], manifest.get("stats") or {}
    totals, residual, known = stats.get("totals") or {}, stats.get("residual_totals") or {}, stats.get("levels") or {}
    of = lambda table: {m: whole((table or {}).get(m)) for m in MEASURES}
    failures = 0
    for level in levels:
        base, extra = of(totals.get("hs10")), of(residual.get(str(level)))
        there = str(level) in known and f"hs{level}" in totals
        failures += not there or of(totals[f"hs{level}"]) != {m: base[m] + extra[m] for m in MEASURES}
    report = {"levels": levels, "input_rows": whole(stats.get("input_rows")), "residual_input_rows": whole(stats.get("residual_input_rows")), "reconciliation_failures": failures, "required_levels_present": set(required) <= set(levels)}
    return report | {"ok": report["input_rows"] > 0 and report["required_levels_present"] and not failures}
