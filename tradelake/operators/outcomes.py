"""Requests, their leaves after splitting, and what they say about a window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.months import months_between, split_window
from ..functions.outcomes import AUTH_CODES

#: Counts that a response's metrics add up over leaves.
COUNTS = ["fact_row_count", "response_bytes", "non_hs10_fact_rows", "duplicate_key_rows", "zero_trade_rows", "negative_amount_or_weight_rows", "balance_mismatch_rows", "country_mismatch_rows"]


def request_key():
    return F.concat_ws(":", "country", F.concat_ws("-", "window_start", "window_end"))


def plan_roots(countries: DataFrame, windows: DataFrame, by_country: bool = True, most: int | None = None) -> DataFrame:
    """Every country with every window, both small, in one of two orders; the first ``most`` of them for a trial."""
    grid = F.broadcast(windows).crossJoin(countries)
    ordered = grid.orderBy("country", "window_start") if by_country else grid.orderBy("window_start", "country")
    return ordered if most is None else ordered.limit(most)


def annual_windows(ranges: DataFrame) -> DataFrame:
    """Windows cut at calendar years."""
    months = ranges.select("*", F.explode(months_between(F.col("window_start"), F.col("window_end"))).alias("m"))
    return months.groupBy(*ranges.columns, F.substring("m", 1, 4).alias("year")).agg(F.min("m").alias("start"), F.max("m").alias("end"))


def split_parts(requests: DataFrame) -> DataFrame:
    part = requests.select("*", F.explode(split_window(F.col("window_start"), F.col("window_end"))).alias("part"))
    return part.select(*requests.columns, F.col("part.start").alias("part_start"), F.col("part.end").alias("part_end"))


def effective_leaves(outcomes: DataFrame) -> DataFrame:
    """Outcomes that are no other outcome's parent."""
    parents = outcomes.where("parent_request is not null").select(F.col("parent_request").alias("__parent")).distinct()
    return outcomes.join(parents, request_key() == F.col("__parent"), "left_anti")


def total_of_lengths(lists):
    """Maps of counts added up."""
    pairs = F.flatten(F.transform(lists, F.map_entries))
    lengths = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["key"])))
    count = lambda k: F.aggregate(F.filter(pairs, lambda p: p["key"] == k), F.lit(0).cast("bigint"), lambda a, p: a + p["value"])
    return F.map_from_entries(F.transform(lengths, lambda k: F.struct(k.alias("key"), count(k).alias("value"))))


def response_flaws(missing_months: Column) -> Column:
    """What speaks against rows that came in, as a list of texts (fixed values)."""
    said = lambda test, *text: F.when(test, F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in text]))
    number = lambda c: F.col(c).cast("string")
    return F.array_compact(
        F.array(
            said(F.col("fact_row_count") == 0, "no fact rows returned"),
            said(F.col("non_hs10_fact_rows") > 0, number("non_hs10_fact_rows"), " fact rows are not 10-digit numeric HS"),
            said(missing_months != "", "missing months: ", missing_months),
            said(F.col("duplicate_key_rows") > 0, "duplicate extra rows: ", number("duplicate_key_rows")),
            said(F.col("country_mismatch_rows") > 0, "country mismatch rows: ", number("country_mismatch_rows")),
        )
    )


def outcome_verdicts(outcomes: DataFrame) -> DataFrame:
    """Every request judged by itself: verdict and reasons; one that failed is open, whatever its rows."""
    missing = F.array_join(F.array_except(months_between(F.col("window_start"), F.col("window_end")), F.coalesce("months_found", F.array().cast("array<string>"))), ",")
    flaws, failed = response_flaws(missing), ~F.coalesce("success", F.lit(False))
    verdict = F.when(failed, "INCONCLUSIVE").when(F.size(flaws) > 0, "FAIL").otherwise("PASS")
    fine = F.array(F.lit("all returned fact rows are 10-digit HS; requested months covered; no duplicate keys"))
    reasons = F.when(failed, F.array(F.concat(F.lit("request status="), F.coalesce("status", F.lit(""))))).when(F.size(flaws) > 0, flaws).otherwise(fine)
    return outcomes.withColumns({"verdict": verdict, "reasons": reasons})


def root_verdicts(roots: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Per root window: its status, the leaves inside it added up, months that no response has, and a verdict.

    A month counts as found if a successful leaf's rows have it, not because it was asked for.  A failed leaf
    leaves the verdict open; otherwise missing rows or months, other codes, repeated keys and other countries
    fail it.  A balance that doesn't add up is counted and decides nothing.
    """
    key = ["country", "window_start", "window_end"]
    leaf = effective_leaves(outcomes).select(F.col("country").alias("c"), F.col("window_start").alias("s"), F.col("window_end").alias("e"), "status", "months_found", "hs_length_counts", *COUNTS)
    inside = roots.select(*key).join(leaf, (F.col("country") == F.col("c")) & (F.col("s") >= F.col("window_start")) & (F.col("e") <= F.col("window_end")), "left")
    good = F.col("status") == "success"
    empty = F.array().cast("array<string>")
    failure = F.when(F.col("c").isNotNull() & ~good, F.concat(F.col("s"), F.lit("-"), F.col("e"), F.lit(":"), F.col("status")))
    sums = [F.coalesce(F.sum(F.when(good, F.col(x))), F.lit(0)).alias(x) for x in COUNTS]
    found = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(good, F.coalesce("months_found", empty)))))).alias("found")
    out = inside.groupBy(*key).agg(F.count("c").alias("leaf_requests"), F.array_sort(F.collect_list(failure)).alias("failures"), found, total_of_lengths(F.collect_list("hs_length_counts")).alias("hs_length_counts"), *sums)
    own = outcomes.where("parent_request is null").groupBy(*key).agg(F.bool_or("success").alias("own_success"))
    out = out.join(own, key, "left")
    missing = F.array_except(months_between(F.col("window_start"), F.col("window_end")), F.col("found"))
    out = out.withColumns({"missing_months": F.array_join(missing, ","), "month_count": F.size("found"), "failed": F.size("failures")})
    flaws = response_flaws(F.col("missing_months"))
    none, failed = F.col("leaf_requests") == 0, F.col("failed") > 0
    reasons = (
        F.when(none, "no request outcomes found").when(failed, F.concat(F.lit("unresolved leaf failures: "), F.array_join("failures", ", ")))
        .when(F.size(flaws) > 0, F.array_join(flaws, "; ")).otherwise("all effective leaf responses satisfy the HS10/month/key checks")
    )
    verdict = F.when(none | failed, "INCONCLUSIVE").when(F.size(flaws) > 0, "FAIL").otherwise("PASS")
    status = F.when(none, "missing").when(F.coalesce("own_success", F.lit(False)), "success").when(failed, "failed").otherwise("split_success")
    return out.select(*key, status.alias("status"), verdict.alias("verdict"), reasons.alias("reasons"), "leaf_requests", "month_count", "missing_months", "hs_length_counts", *COUNTS)


def collection_summary(roots: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Per root: whether all its leaves came in, their rows and bytes, the codes and statuses met, what failed."""
    key = ["country", "window_start", "window_end"]
    columns = ["status", "success", "http_status", "api_result_code", "api_result_msg", "gzip_bytes", "fact_row_count", "non_hs10_fact_rows", "response_bytes"]
    leaf = effective_leaves(outcomes).select(F.col("country").alias("c"), F.col("window_start").alias("s"), F.col("window_end").alias("e"), *columns)
    inside = roots.select(*key).join(leaf, (F.col("country") == F.col("c")) & (F.col("s") >= F.col("window_start")) & (F.col("e") <= F.col("window_end")), "left")
    sums = [F.coalesce(F.sum(F.when(F.col("success"), F.col(x))), F.lit(0)).alias(x) for x in ("fact_row_count", "non_hs10_fact_rows", "response_bytes", "gzip_bytes")]
    detail = F.when(~F.col("success"), F.struct(F.col("s").alias("window_start"), F.col("e").alias("window_end"), "status", "http_status", "api_result_code", "api_result_msg"))
    out = inside.groupBy(*key).agg(F.count("c").alias("leaf_requests"), F.count_if(~F.col("success")).alias("failed_leaf_requests"), *sums, F.array_sort(F.collect_set("api_result_code")).alias("api_result_codes"), F.array_sort(F.collect_set("status")).alias("statuses"), F.array_sort(F.collect_list(detail)).alias("failure_details"))
    return out.withColumn("collection_success", (F.col("failed_leaf_requests") == 0) & (F.col("leaf_requests") > 0))


def run_totals(outcomes: DataFrame) -> DataFrame:
    """Of the leaves: how many there are and succeeded, rows, and the failures that end a run."""
    leaves = effective_leaves(outcomes)
    auth = (F.col("status") == "auth_error") | (F.col("api_result_code").isin(AUTH_CODES) & ~F.col("success"))
    has = lambda test: F.coalesce(F.bool_or(test), F.lit(False))
    return leaves.agg(
        F.count("*").alias("requests"), F.count_if(F.col("success")).alias("succeeded"), F.coalesce(F.sum(F.when(F.col("success"), F.col("fact_row_count"))), F.lit(0)).alias("rows"),
        has(F.coalesce(auth, F.lit(False))).alias("auth_failed"), has(F.col("status") == "quota_exceeded").alias("quota_exceeded"), has(F.col("status") == "rate_limited").alias("rate_limited"),
    )

