"""Collection: requests in waves, failed ones in smaller windows, until a limit or the plan ends."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.months import latest_stable_month, shift_month, window_level, window_size
from ..functions.outcomes import AUTH, INTERRUPTED, QUOTA, RATE, outcome_status, should_split
from ..operators import normalize, outcomes
from ..sources import http_api, responses

#: Roots that a wave asks for.
WAVE = 64
METRICS = [
    "row_count", "fact_row_count", "total_row_count", "month_count", "months_found", "missing_months", "hs_length_counts", "non_hs10_fact_rows", "duplicate_key_rows", "duplicate_key_groups", "zero_trade_rows",
    "negative_amount_or_weight_rows", "balance_mismatch_rows", "country_mismatch_rows", "hs_name_variant_codes", "hs_name_variant_examples",
]


def root_plan(spark: SparkSession, partners: DataFrame, start: str, end: str, by_country: bool = False, most: int | None = None) -> DataFrame:
    """Every partner with every calendar year of a range."""
    years = outcomes.annual_windows(spark.createDataFrame([(start, end)], "window_start string, window_end string")).select(F.col("start").alias("window_start"), F.col("end").alias("window_end"))
    return outcomes.plan_roots(partners.select(F.col("country_code").alias("country")), years, by_country, most)


def refresh_range(spark: SparkSession, day: str, lookback: int = 12, end: str | None = None) -> tuple[str, str]:
    """The months that a refresh on a day asks for again: the latest stable one (or ``end``) and ``lookback`` before it."""
    last = F.lit(end) if end else latest_stable_month(F.lit(day).cast("date"))
    row = spark.range(1).select(shift_month(last, -lookback).alias("start"), last.alias("end")).first()
    return row["start"], row["end"]


def judged(spark: SparkSession, answers: DataFrame) -> DataFrame:
    """Answers with their status and, of those that are whole XML, the metrics of their rows."""
    rows = answers.withColumn("status", outcome_status(*map(F.col, ("http_status", "api_result_code", "api_result_msg", "parsed", "raised"))))
    rows = rows.withColumns({"success": F.col("status") == "success", "split_level": window_level(F.col("window_start"), F.col("window_end")), "name": F.regexp_extract("raw_path", r"(country=.*)$", 1)})
    paths = [r["raw_path"] for r in rows.where("parsed").select("raw_path").collect()]  # a wave's
    if not paths:
        kinds = {"months_found": "array<string>", "missing_months": "array<string>", "hs_length_counts": "map<string,bigint>", "hs_name_variant_examples": "array<struct<hs10:string,names:array<string>>>"}
        return rows.drop("name").withColumns({m: F.lit(None).cast(kinds[m]) if m in kinds else F.lit(0).cast("bigint") for m in METRICS})
    items = responses.raw_columns(responses.read_items(spark, paths)).withColumn("source", F.regexp_extract("source", r"(country=.*)$", 1))
    metrics = normalize.response_metrics(storage.written(items, "items"))  # parsed once, read several times
    out = rows.join(metrics.withColumnRenamed("source", "name"), "name", "left")
    asked = F.array_except(responses.months_between(F.col("window_start"), F.col("window_end")), F.coalesce("months_found", F.array().cast("array<string>")))
    out = out.withColumn("missing_months", F.when(F.col("parsed"), asked))
    counts = [m for m in METRICS if m not in ("months_found", "missing_months", "hs_length_counts", "hs_name_variant_examples")]
    return out.withColumns({m: F.coalesce(m, F.lit(0)).cast("bigint") for m in counts}).drop("name")


def kept_outcomes(spark: SparkSession, data_dir: str, roots: DataFrame, like: DataFrame) -> DataFrame:
    """Outcomes of roots that succeeded earlier and whose answer is still there, from their manifests."""
    if not storage.exists(spark, f"{data_dir}/audits/manifests") or not storage.exists(spark, f"{data_dir}/raw"):
        return like.limit(0)
    known = spark.read.option("multiLine", "true").option("recursiveFileLookup", "true").schema(like.schema).json(f"{data_dir}/audits/manifests")
    known = known.where("success and status = 'success'").join(roots, ["country", "window_start", "window_end"], "left_semi")
    missing = responses.without_raw_file(spark, known, f"{data_dir}/raw").select("country", "window_start", "window_end")
    return known.join(missing, ["country", "window_start", "window_end"], "left_anti").select(like.columns)


def collect_with_split(spark: SparkSession, roots: DataFrame, options: dict[str, str], at_once: int = 4, force: bool = True) -> DataFrame:
    """Outcomes of roots and, where transport failed, of their parts: years into quarters, quarters into months.

    Each round is one DataFrame of requests, so a round's parts are fetched together; there are three at most.
    Unless ``force`` is set, a request that succeeded earlier and whose answer is kept isn't sent again.
    A limit that a task meets ends the round where it is, and no further one follows.
    """
    path, key, done = storage.scratch(spark, "collect"), ["country", "window_start", "window_end"], []
    todo = roots.select(*key, F.lit(None).cast("string").alias("parent_request"))
    while True:
        found = []
        if not force:
            like = judged(spark, spark.createDataFrame([], http_api.SCHEMA))
            found.append(spark.createDataFrame(kept_outcomes(spark, options["data_dir"], todo, like).collect(), like.schema))  # a round's
            todo = todo.join(found[0], key, "left_anti")
        http_api.fetch(todo, options, at_once).write.parquet(f"{path}/answers-{len(done)}")
        found.append(judged(spark, spark.read.schema(http_api.SCHEMA).parquet(f"{path}/answers-{len(done)}")))
        reduce(DataFrame.unionByName, found).write.parquet(f"{path}/outcomes-{len(done)}")
        done.append(spark.read.schema(found[-1].schema).parquet(f"{path}/outcomes-{len(done)}"))
        failed = done[-1].where(should_split(F.col("status"), F.col("http_status"), window_size(F.col("window_start"), F.col("window_end"))))
        parts = outcomes.split_parts(failed.select(*key)).select("country", F.col("part_start").alias("start"), F.col("part_end").alias("end"), outcomes.request_key().alias("parent_request"))
        if parts.isEmpty() or options.get("run") and storage.exists(spark, f"{options['data_dir']}/{options['run']}/stop"):
            return reduce(DataFrame.unionByName, done)
        todo = parts.select("country", F.col("start").alias("window_start"), F.col("end").alias("window_end"), "parent_request")


def plain(value):
    if hasattr(value, "asDict"):
        return value.asDict(recursive=True)
    return [plain(x) for x in value] if isinstance(value, list) else value


def save_manifests(spark: SparkSession, done: DataFrame, data_dir: str, url: str) -> None:
    """One JSON file for each outcome of a wave; the key isn't among an outcome's columns."""
    for row in done.toLocalIterator():
        own = {k: plain(v) for k, v in row.asDict().items()}
        path = http_api.manifest_path(own["country"], own["window_start"], own["window_end"])
        request = {"strtYymm": own["window_start"], "endYymm": own["window_end"], "cntyCd": own["country"]}
        storage.write_text(spark, f"{data_dir}/{path}", json.dumps(own | {"manifest_path": path, "endpoint": url, "request_params": request, "hsSgn_omitted": True}, ensure_ascii=False, indent=2))


def within(row: dict, root: dict) -> bool:
    return row["country"] == root["country"] and root["window_start"] <= row["window_start"] and row["window_end"] <= root["window_end"]


def collect(spark: SparkSession, roots: DataFrame, options: dict[str, str], wave: int = WAVE, at_once: int = 4, rate_limit_retries: int = 4, force: bool = False, pause: float = 1.0, progress: Callable[[str], None] = lambda line: None) -> dict:
    """Collect a plan of roots, in order, and write its run manifest; returns that.

    A request that the service finds too fast is sent again by itself, and all tasks slow down.  A daily quota, a
    refused key or a rate that no retry mends ends the run: tasks see it before their next request, what came
    in is kept, and the next run asks for the rest only.  So does an interrupt.
    """
    data_dir, began, run_id = options["data_dir"], http_api.now(), uuid.uuid4().hex
    options = options | {"run": f"audits/runs/running-{run_id}", "rate_limit_retries": str(rate_limit_retries), "rate_pause": str(pause)}
    plan = [tuple(r) for r in roots.select("country", "window_start", "window_end").collect()]  # partners by years
    schema, found, stopped, reused = "country string, window_start string, window_end string", [], None, 0
    try:
        for at in range(0, len(plan), wave):
            asked = spark.createDataFrame(plan[at : at + wave], schema)
            if not force:
                reused += kept_outcomes(spark, data_dir, asked, judged(spark, spark.createDataFrame([], http_api.SCHEMA))).count()
            done = collect_with_split(spark, asked, options, at_once, force)
            totals = outcomes.run_totals(done).first()
            save_manifests(spark, done, data_dir, options["url"])
            retries = [r.asDict() for r in done.where("rate_limit_retries > 0").select("country", "window_start", "window_end", "rate_limit_retries").collect()]  # a wave's
            summaries = [{k: plain(v) for k, v in r.asDict().items()} for r in outcomes.collection_summary(asked, done).where("leaf_requests > 0").collect()]
            found += [r | {"rate_limit_retries": sum(x["rate_limit_retries"] for x in retries if within(x, r))} for r in summaries]
            stopped = QUOTA if totals["quota_exceeded"] else AUTH if totals["auth_failed"] else RATE if totals["rate_limited"] else None
            progress(f"progress={min(at + wave, len(plan))}/{len(plan)} success={sum(r['collection_success'] for r in found)} rows={sum(r['fact_row_count'] for r in found)} checkpoint={reused} stopping_reason={stopped or '-'}")
            if stopped:
                break
    except KeyboardInterrupt:
        stopped = INTERRUPTED
    finally:
        storage.delete(spark, f"{data_dir}/{options['run']}")
    good = [r for r in found if r["collection_success"]]
    add = lambda k: sum(r[k] for r in good)
    run = {
        "started_at": began, "finished_at": http_api.now(), "planned_roots": len(plan), "attempted_roots": len(found), "successful_roots": len(good), "failed_roots": len(found) - len(good), "checkpoint_reused_roots": reused,
        "no_trade_roots": sum(r["fact_row_count"] == 0 for r in good), **{k: add(k) for k in ("fact_row_count", "non_hs10_fact_rows", "response_bytes", "gzip_bytes")}, "stopped_reason": stopped, "roots": found,
    }
    stamp = began.replace(":", "").replace("-", "").replace("+", "p")
    storage.write_text(spark, f"{data_dir}/audits/runs/collection_{stamp}.json", json.dumps(run, ensure_ascii=False, indent=2))
    return run


def exit_code(run: dict) -> int:
    """0: all came in; 2: some roots failed; 3: a limit ended the run; 130: it was interrupted."""
    return 130 if run["stopped_reason"] == INTERRUPTED else 3 if run["stopped_reason"] else 2 if run["failed_roots"] else 0
