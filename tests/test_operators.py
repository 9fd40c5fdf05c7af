import pytest
from pyspark.sql import functions as F

from tradelake.functions.text import MEASURES
from tradelake.operators import analytics, normalize, outcomes, quality, reference, rollup, selection

FACT = "month string, country_code string, hs10 string, " + ", ".join(f"{m} bigint" for m in MEASURES)
RAW = "source string, ordinal bigint, month string, requested_country string, country_code_raw string, hs_code_raw string, name_ko string, exp_dlr string, exp_wgt string, imp_dlr string, imp_wgt string, bal_payments string, source_manifest string, source_finished_at string"


def facts(spark, *rows):
    return spark.createDataFrame([(m, c, h, e, 1, i, 1, e - i) for m, c, h, e, i in rows], FACT)


def test_rollup(spark):
    f = facts(spark, ("202501", "US", "0101219000", 10, 2), ("202501", "US", "0101211000", 20, 5))
    r = rollup.rollup(f, 6).collect()
    assert [(x["hs6"], x["hs4"], x["export_usd"], x["import_usd"], x["trade_balance_usd"], x["source_row_count"]) for x in r] == [("010121", "0101", 30, 7, 23, 2)]
    assert rollup.rollup(f, 8).count() == 2


def test_residuals_reach_their_level(spark):
    f = facts(spark, ("202501", "US", "7616991000", 100, 0))
    s = "month string, requested_country string, hs_code_raw string, " + ", ".join(f"{m} bigint" for m in MEASURES)
    r = spark.createDataFrame([("202501", "US", "761699", 7, 0, 0, 0, 7), ("202501", "US", "12345678901", 9, 0, 0, 0, 9), ("202502", "US", "761699", 9, 0, 0, 0, 9), ("202501", "US", "99", 3, 0, 0, 0, 3)], s)
    six = {x["hs6"]: x for x in rollup.with_residuals(f, r, 6).collect()}
    assert (six["761699"]["export_usd"], six["761699"]["residual_export_usd"], six["761699"]["exception_row_count"], six["761699"]["has_residual"]) == (107, 7, 1, True)
    eight = rollup.with_residuals(f, r, 8).collect()
    assert [(x["export_usd"], x["residual_export_usd"], x["has_residual"]) for x in eight] == [(100, 0, False)]
    two = {x["hs2"]: x["export_usd"] for x in rollup.with_residuals(f, r, 2).collect()}
    assert two == {"76": 107, "99": 3}
    assert all(x["reconciles"] for x in rollup.reconciliation(f, r).collect())


def test_source_priority(spark):
    s = spark.createDataFrame([("US", "202501", "202512", "2026-01-01", "a"), ("US", "202506", "202508", "2026-02-01", "b"), ("US", "202507", "202507", "2026-02-01", "c"), ("US", "202507", "202507", "2026-02-01", "d")], "country string, window_start string, window_end string, finished_at string, path string")
    got = {r["month"]: (r["path"], r["candidates"]) for r in selection.select_sources(selection.expand_windows(s, "202505", "202512")).collect()}
    assert got["202505"] == ("a", 1) and got["202506"] == ("b", 2) and got["202507"] == ("d", 4) and len(got) == 8


def raw(spark, *rows):
    return spark.createDataFrame([("s", i, "202501", "US", *r, "m.json", "2026-01-01") for i, r in enumerate(rows)], RAW)


def test_classification_order(spark):
    ok = ("n", "10", "1", "4", "1", "6")
    rows = raw(
        spark, ("US", "0101219000", *ok), ("JP", "0101219000", *ok), ("", "761699", *ok), ("US", "0101219000", *ok), ("US", "0101219001", "n", "10", "1", "4", "-", "6"),
        ("US", "0101219002", "n", "-1", "1", "0", "1", "-1"), ("US", "0101219003", "n", "10", "1", "4", "1", "7"), ("US", "0101219004", "n", "10", "1", "4", "-3", "6"), ("US", "0101219001", *ok),
    )
    c = normalize.classify(rows)
    got = {r["ordinal"]: (r["bucket"], r["reason"], r["warning"]) for r in c.collect()}
    assert got == {
        0: ("canonical", None, None), 1: ("fatal", "country_mismatch", None), 2: ("quarantine", "non_hs10_code", None), 3: ("fatal", "duplicate_key", None), 4: ("fatal", "missing/invalid numeric field impWgt", None),
        5: ("fatal", "negative amount", None), 6: ("fatal", "trade balance mismatch", None), 7: ("canonical", None, "negative_weight"), 8: ("fatal", "duplicate_key", None),
    }
    r = normalize.row_reconciliation(c).first()
    assert (r["assigned"], r["canonical"], r["quarantine"], r["fatal"], r["reconciles"]) == (9, 2, 1, 6, True)
    assert normalize.anomalies(c).count() == 8 and normalize.canonical(c).count() == 2


@pytest.mark.parametrize(
    "off, whole, numeric, status, kg",
    [((0, 5, 0, 3, 0), True, True, "rounding", 8), ((1, 0, 0, 0, 0), True, True, "mismatch", 0), ((0, 105, 0, 0, 0), True, True, "mismatch", 0), ((0, 0, 0, 0, 0), True, True, "match", 0), (None, True, True, "missing", 0), ((1, 0, 0, 0, 0), False, True, "not_whole", 0), ((1, 0, 0, 0, 0), True, False, "unavailable", 0)],
)
def test_summary_differences(spark, off, whole, numeric, status, kg):
    cols = ", ".join(f"{m} bigint" for m in MEASURES)
    totals = spark.createDataFrame([("s", 10, whole, numeric, 100, 50, 40, 20, 60)], f"source string, fact_rows bigint, whole boolean, numeric_ok boolean, {cols}")
    base = (100, 50, 40, 20, 60)
    said = spark.createDataFrame([("s", *[a + b for a, b in zip(base, off)])] if off else [], f"source string, {cols}")
    row = normalize.summary_reconciliation(totals, said).first()
    assert (row["status"], row["rounding_kg"], row["rounding_fields"]) == (status, kg, 2 * bool(kg))


TOTAL = "source string, ordinal bigint, month string, requested_country string, country_code_raw string, hs_code_raw string, name_ko string, exp_dlr string, exp_wgt string, imp_dlr string, imp_wgt string, bal_payments string"


def test_metrics_leave_total_rows_out(spark):
    n = ("10", "1", "4", "1", "6")
    rows = [
        ("s", 0, None, "US", "-", "-", "-", "99", "9", "9", "9", "90"), ("s", 1, "202501", "US", "US", "0101219000", "a", *n), ("s", 2, "202501", "US", "US", "0101219000", "b", *n), ("s", 3, "202503", "US", "JP", "761699", "", "0", "0", "0", "0", "1"),
        ("s", 4, "202503", "US", "", "0101219001", "c", "-", "-2", "0", "0", "0"), ("s", 5, None, "US", "US", "0101219009", "x", *n), ("t", 0, None, "US", "-", "-", "-", *n),
    ]
    df = spark.createDataFrame(rows, TOTAL)
    windows = spark.createDataFrame([("s", "202501", "202503"), ("t", "202501", "202501")], "source string, window_start string, window_end string")
    got = {r["source"]: r.asDict(recursive=True) for r in normalize.response_metrics(df, windows).collect()}
    assert got["s"] == {
        "source": "s", "row_count": 6, "fact_row_count": 4, "total_row_count": 2, "months_found": ["202501", "202503"], "missing_months": ["202502"], "month_count": 2, "hs_length_counts": {"10": 3, "6": 1}, "zero_trade_rows": 1, "negative_amount_or_weight_rows": 1,
        "balance_mismatch_rows": 1, "country_mismatch_rows": 1, "non_hs10_fact_rows": 1, "duplicate_key_rows": 1, "duplicate_key_groups": 1, "hs_name_variant_codes": 1, "hs_name_variant_examples": [{"hs10": "0101219000", "names": ["a", "b"]}],
    }
    assert (got["t"]["row_count"], got["t"]["fact_row_count"], got["t"]["total_row_count"], got["t"]["months_found"], got["t"]["hs_length_counts"]) == (1, 0, 1, [], {})
    last = {r["source"]: r["export_usd"] for r in normalize.last_summaries(df.unionByName(spark.createDataFrame([("s", 9, None, "US", "-", "", "-", "n/a", "1", "1", "1", "1")], TOTAL))).collect()}
    assert last == {"s": 99, "t": 10}  # the very last one of s can't be read
    short = normalize.short_code_observations(df)
    assert [(r["hs_code_raw"], r["hs_length"], r["country_code"]) for r in short.collect()] == [("761699", 6, "JP")]
    assert tuple(normalize.short_code_figures(short).first()) == (1, 0, 0, '{"6":1}')


def test_residual_without_a_measure_is_an_error(spark):
    f = facts(spark, ("202501", "US", "7616991000", 100, 0))
    s = "month string, requested_country string, hs_code_raw string, " + ", ".join(f"{m} bigint" for m in MEASURES)
    bad = spark.createDataFrame([("202501", "US", "761699", 7, None, 0, 0, 7)], s)
    with pytest.raises(Exception, match="residual row has missing export_weight_kg"):
        rollup.with_residuals(f, bad, 6).collect()
    assert rollup.with_residuals(f, bad.withColumn("month", F.lit("202502")), 6).count() == 1


def test_levels_add_up_every_month(spark):
    f = facts(spark, ("202501", "US", "7616991000", 100, 0), ("202502", "US", "7616992000", 5, 1), ("202502", "JP", "0101219000", 2, 2))
    s = "month string, requested_country string, hs_code_raw string, " + ", ".join(f"{m} bigint" for m in MEASURES)
    r = spark.createDataFrame([("202501", "US", "761699", 7, 0, 0, 0, 7), ("202502", "US", "76169", 7, 0, 0, 0, 7), ("202502", "US", "761699100", 1, 0, 0, 0, 1)], s)
    got = {(x["level"], x["month"]): (x["export_usd"], x["exceptions"], x["reconciles"]) for x in rollup.reconciliation(f, r, ["month"]).collect()}
    assert got[2, "202502"] == (15, 2, True) and got[8, "202502"] == (8, 1, True) and got[6, "202501"] == (107, 1, True) and len(got) == 8 and all(v[2] for v in got.values())


def test_revision_keeps_unknown_codes(spark):
    f = facts(spark, ("202501", "US", "0101219000", 1, 0), ("202501", "US", "9999999999", 1, 0)).withColumn("name_ko", F.lit("n"))
    e = spark.createDataFrame([(2025, "0101219000", "HSK-2025")], "reference_year int, hs10 string, hs_revision string")
    assert {r["hs10"]: r["hs_revision"] for r in reference.revision_lookup(f, e).collect()} == {"0101219000": "HSK-2025", "9999999999": None}
    assert [(r["year"], r["hs10"], r["rows"]) for r in reference.reference_gaps(f, e).collect()] == [("2025", "9999999999", 1)]


def test_label_fold(spark):
    rows = spark.createDataFrame([("k", 0, "말", ""), ("k", 1, "말 (산 것)", "horse"), ("k", 2, "소", "cow"), ("k", 3, "말", "horse")], "hs10 string, ordinal bigint, name_ko string, name_en string")
    r = reference.resolve_duplicates(rows, ["hs10"]).first()
    assert (r["copies"], r["name_ko"], r["name_en"], r["conflicts"]) == (4, "말 (산 것)", "horse", 1)


    assert [tuple(x)[0:2] + (x["second_ko"], x["selected_ko"], x["resolution"]) for x in r["audit"]] == [
        ("말", "", "말 (산 것)", "말 (산 것)", reference.COMPATIBLE), ("말 (산 것)", "horse", "소", "말 (산 것)", reference.PENDING), ("말 (산 것)", "horse", "말", "말 (산 것)", reference.COMPATIBLE),
    ]


def test_labels_with_spaces_are_compatible(spark):
    rows = spark.createDataFrame([("k", 0, " old x", ""), ("k", 1, "old", "")], "hs10 string, ordinal bigint, name_ko string, name_en string")
    assert reference.resolve_duplicates(rows, ["hs10"]).first()["conflicts"] == 0
    with pytest.raises(ValueError):
        reference.require_same_beside_names(rows.withColumn("chapter", F.col("ordinal").cast("string")), ["hs10"])
    reference.require_same_beside_names(rows.withColumn("chapter", F.lit("01")), ["hs10"])


def test_adjacent_years(spark):
    edition = "reference_year int, hs10 string, name_ko string, name_en string"
    e = spark.createDataFrame([(2021, "6815910000", "old", "Old"), (2022, "6815910000", "old", "Old"), (2023, "6815910000", "new", "New"), (2021, "2", "new", "New"), (2023, "2", "old", "Old"), (2021, "3", "old", "Old"), (2023, "3", "new", "other")], edition)
    p = spark.createDataFrame([(2022, c, "old", "Old", "new", "New") for c in ("6815910000", "1", "2", "3")], "reference_year int, hs10 string, first_ko string, first_en string, second_ko string, second_en string")
    reviewed = reference.adjacent_review(p, e)
    got = {r["hs10"]: (r["resolution"], r["name_ko"], r["name_en"]) for r in reviewed.collect()}
    assert got == {"6815910000": (reference.SECOND_IS_CURRENT, "new", "New"), "1": (reference.UNRESOLVED, "old", "Old"), "2": (reference.FIRST_IS_CURRENT, "old", "Old"), "3": (reference.UNRESOLVED, "old", "Old")}
    near = {r["hs10"]: (r["adjacent_previous"], r["adjacent_next"]) for r in reviewed.collect()}
    assert near["1"] == (None, None) and tuple(near["2"][0]) == ("new", "New") and tuple(near["3"][1]) == ("new", "other")
    assert reference.review_figures(reviewed).first().asDict() == {"reviewed": 4, "resolved": 2, "unresolved": 2, "annual_name_rewrites": 1}
    changes = reference.rewrites(reviewed)
    reference.require_matches(e, changes)
    changed = {(r["reference_year"], r["hs10"]): r["name_ko"] for r in reference.rewrite_name(e, changes).collect()}
    assert changed[2022, "6815910000"] == "new" and changed[2021, "6815910000"] == "old" and len(changed) == e.count()
    for bad in (spark.createDataFrame([(2020, "x", "a", "b")], edition), spark.createDataFrame([(2021, "2", "a", "b")], edition)):
        with pytest.raises(ValueError):
            reference.require_matches(e.unionByName(e.where("hs10 = '2'")), bad)


def test_a_rewritten_year_counts_for_the_next(spark):
    """A, then A against B, then B against A, then B: the first conflict is rewritten to B, which leaves the second open."""
    e = spark.createDataFrame([(2020, "1", "A", "a"), (2021, "1", "A", "a"), (2022, "1", "B", "b"), (2023, "1", "B", "b"), (2020, "2", "A", "a"), (2021, "2", "A", "a"), (2022, "2", "B", "b"), (2023, "2", "A", "a")], "reference_year int, hs10 string, name_ko string, name_en string")
    a, b = ("A", "a"), ("B", "b")
    p = spark.createDataFrame([(2021, c, 0, *a, *b) for c in "12"] + [(2022, c, 0, *b, *a) for c in "12"] + [(2021, "1", 1, "A", "a", "C", "c")], "reference_year int, hs10 string, step int, first_ko string, first_en string, second_ko string, second_en string")
    got = {(r["hs10"], r["reference_year"], r["step"]): (r["resolution"], r["name_ko"], r["adjacent_previous"]["name_ko"]) for r in reference.adjacent_review(p, e).collect()}
    used, left = reference.SECOND_IS_CURRENT, reference.UNRESOLVED
    assert got == {("1", 2021, 0): (used, "B", "A"), ("1", 2021, 1): (left, "A", "A"), ("1", 2022, 0): (left, "B", "B"), ("2", 2021, 0): (used, "B", "A"), ("2", 2022, 0): (used, "A", "B")}
    changed = {(r["hs10"], r["reference_year"]): r["name_ko"] for r in reference.rewrite_name(e, reference.rewrites(reference.adjacent_review(p, e))).collect()}
    assert [changed["2", y] for y in range(2020, 2024)] == ["A", "B", "A", "A"] and [changed["1", y] for y in range(2020, 2024)] == ["A", "B", "B", "B"]


def test_a_request_judged_by_itself(spark):
    from tradelake.operators.outcomes import outcome_verdicts

    counts = "fact_row_count bigint, non_hs10_fact_rows bigint, duplicate_key_rows bigint, country_mismatch_rows bigint"
    rows = [(1, True, "success", "202501", "202503", ["202501", "202502", "202503"], 5, 0, 0, 0), (2, True, "success", "202501", "202503", ["202502"], 0, 2, 3, 4), (3, False, "rate_limited", "202501", "202501", None, 0, 0, 0, 0), (4, None, None, "202501", "202501", [], 1, 0, 0, 0)]
    df = spark.createDataFrame(rows, f"id int, success boolean, status string, window_start string, window_end string, months_found array<string>, {counts}")
    got = {r["id"]: (r["verdict"], r["reasons"]) for r in outcome_verdicts(df).collect()}
    assert got[1] == ("PASS", ["all returned fact rows are 10-digit HS; requested months covered; no duplicate keys"]) and got[3] == ("INCONCLUSIVE", ["request status=rate_limited"]) and got[4][0] == "INCONCLUSIVE"
    assert got[2] == ("FAIL", ["no fact rows returned", "2 fact rows are not 10-digit numeric HS", "missing months: 202501,202503", "duplicate extra rows: 3", "country mismatch rows: 4"])


def test_editions_are_combined_once(spark):
    e = spark.createDataFrame([(2021, "1", "HSK-2021"), (2022, "1", "HSK-2022")], "reference_year int, hs10 string, hs_revision string")
    assert reference.combine_editions([e.where("reference_year = 2021"), e.where("reference_year = 2022")]).count() == 2
    with pytest.raises(ValueError, match="twice"):
        reference.combine_editions([e, e])
    with pytest.raises(ValueError, match="schema"):
        reference.combine_editions([e, e.withColumn("x", F.lit(1))])
    reference.require_one_revision(e.union(e))
    f = facts(spark, ("202101", "US", "1", 1, 0))
    assert reference.revision_lookup(f, e.union(e)).count() == 1
    for bad in (e.where("false"), e.unionByName(e.withColumn("hs_revision", F.lit("HSK-X")))):
        with pytest.raises(ValueError):
            reference.require_one_revision(bad)


def test_product_must_be_there(spark):
    f = facts(spark, ("202501", "US", "0101219000", 10, 2))
    analytics.require_product(f, "hs10", "0101219000")
    with pytest.raises(KeyError):
        analytics.require_product(f, "hs10", "1")


def test_na_stays_a_partner(spark):
    p = spark.createDataFrame([("NA", "matched_current_un"), ("TW", "unmatched_kcs_code"), ("KR", "matched_current_un"), ("XX", "unmatched_kcs_code")], "country_code string, un_match_status string")
    codes = lambda **k: {r[0] for r in reference.partner_universe(p, ["TW"], ["KR"], **k).select("country_code").collect()}
    assert codes() == {"NA", "TW"} and codes(na_compat=True) == {"TW"}


OUTCOME = "country string, window_start string, window_end string, status string, success boolean, parent_request string, months_found array<string>, hs_length_counts map<string,bigint>, " + ", ".join(f"{c} bigint" for c in outcomes.COUNTS)


def outcome(country, start, end, status, parent=None, months=(), rows=100, **more):
    counts = {c: 0 for c in outcomes.COUNTS} | {"fact_row_count": rows, "response_bytes": 10 * rows} | more
    return (country, start, end, status, status == "success", parent, list(months), {"10": rows}, *(counts[c] for c in outcomes.COUNTS))


def months(start, end):
    return [f"2025{i:02d}" for i in range(start, end + 1)]


def test_split_leaves_and_verdict(spark):
    year = ("US", "202501", "202512")
    quarters = [outcome("US", months(a, b)[0], months(a, b)[-1], "success", "US:202501-202512", months(a, b), balance_mismatch_rows=3) for a, b in ((1, 3), (4, 6), (7, 9), (10, 12))]
    root = spark.createDataFrame([year], "country string, window_start string, window_end string")

    def judge(rows):
        return outcomes.root_verdicts(root, spark.createDataFrame(rows, OUTCOME)).first().asDict()

    split = [outcome(*year, "transport_error", rows=0), *quarters]
    assert outcomes.effective_leaves(spark.createDataFrame(split, OUTCOME)).count() == 4
    r = judge(split)
    assert (r["status"], r["verdict"], r["month_count"], r["fact_row_count"], r["hs_length_counts"], r["leaf_requests"]) == ("split_success", "PASS", 12, 400, {"10": 400}, 4)
    r = judge([split[0], *quarters[1:]])
    assert (r["verdict"], r["missing_months"], r["reasons"]) == ("FAIL", "202501,202502,202503", "missing months: 202501,202502,202503")
    r = judge([split[0], outcome("US", "202501", "202503", "api_error", "US:202501-202512"), *quarters[1:]])
    assert (r["status"], r["verdict"], r["reasons"]) == ("failed", "INCONCLUSIVE", "unresolved leaf failures: 202501-202503:api_error")
    r = judge([outcome(*year, "success", months=months(1, 12), duplicate_key_rows=2, non_hs10_fact_rows=1, country_mismatch_rows=4, balance_mismatch_rows=9)])
    assert (r["status"], r["verdict"], r["reasons"]) == ("success", "FAIL", "1 fact rows are not 10-digit numeric HS; duplicate extra rows: 2; country mismatch rows: 4")
    r = judge([outcome(*year, "success", months=[], rows=0)])
    assert r["verdict"] == "FAIL" and r["reasons"].startswith("no fact rows returned; missing months: 202501,")
    r = judge([outcome("JP", "202501", "202512", "success")])
    assert (r["status"], r["verdict"], r["reasons"], r["leaf_requests"], r["hs_length_counts"]) == ("missing", "INCONCLUSIVE", "no request outcomes found", 0, {})


def test_concentration(spark):
    f = facts(spark, ("202501", "A", "0101210000", 0, 50), ("202501", "B", "0101210000", 0, 50), ("202501", "C", "0202000000", 0, 9)).withColumn("hs6", F.substring("hs10", 1, 6))
    got = {r["hs6"]: r for r in analytics.concentration(f, "hs6").collect()}
    assert (got["010121"]["hhi"], got["010121"]["top1_partner"], got["010121"]["top3_share"]) == (0.5, "A", 1.0)
    assert got["020200"]["hhi"] == 1.0
    assert abs(sum(r["share"] for r in analytics.partner_shares(f, "hs6").where("hs6 = '010121'").collect()) - 1) < 1e-12


def test_features_dont_leak(spark):
    p = spark.createDataFrame([("a", f"2025{i:02d}", i) for i in range(1, 8)], "hs4 string, month string, import_usd bigint")
    rows = {r["month"]: r for r in analytics.rolling_features(analytics.lag_features(p, "hs4"), "hs4").collect()}
    assert rows["202503"]["mean_3"] is None and rows["202504"]["mean_3"] == 2.0 and rows["202504"]["lag_3"] == 1
    n = analytics.next_month_features(p, "hs4").first()
    assert (n["month"], n["lag_1"], n["mean_3"], n["mean_12"]) == ("202508", 7, 6.0, None)


NORMALIZED = {
    "selected_country_months": 3, "fatal_anomalies": 0, "source_summary_mismatches": 0, "stored_row_reconciliation": {"reconciles": True},
    "normalization_stats": {"canonical_rows": 2, "partition_count": 1}, "verification": {"schema_ok": True, "parquet_rows": 2, "duplicate_keys": 0, "partition_month_mismatches": 0},
}


def test_gates_are_closed_by_what_is_missing():
    assert quality.normalization_gate(NORMALIZED)["ok"]
    assert not quality.normalization_gate({})["ok"] and not quality.normalization_gate({"canonical_rows": 1, "assigned_rows": 1})["ok"]
    for key in ("selected_country_months", "normalization_stats", "verification", "stored_row_reconciliation"):
        assert not quality.normalization_gate({k: v for k, v in NORMALIZED.items() if k != key})["ok"], key
    for bad in ({"fatal_anomalies": 1}, {"source_summary_mismatches": 1}, {"stored_row_reconciliation": {"reconciles": False}}, *({"verification": NORMALIZED["verification"] | x} for x in ({"schema_ok": False}, {"parquet_rows": 3}, {"duplicate_keys": 1}, {"partition_month_mismatches": 1}))):
        assert not quality.normalization_gate(NORMALIZED | bad)["ok"], bad
    ten, two = dict.fromkeys(MEASURES, 10), dict.fromkeys(MEASURES, 2)
    stats = {"input_rows": 5, "totals": {"hs10": ten} | {f"hs{n}": dict.fromkeys(MEASURES, 12) for n in (2, 4, 6, 8)}, "residual_totals": {str(n): two for n in (2, 4, 6, 8)}, "levels": {str(n): {} for n in (2, 4, 6, 8)}}
    good = {"levels": [8, 6, 4, 2], "stats": stats}
    assert quality.derivation_gate(good)["ok"] and not quality.derivation_gate({})["ok"]
    assert quality.derivation_gate(good | {"stats": stats | {"totals": stats["totals"] | {"hs4": ten | {"reconciles": True}}}})["reconciliation_failures"] == 1
    assert not quality.derivation_gate(good | {"levels": [8, 6, 4]})["ok"] and not quality.derivation_gate(good | {"stats": stats | {"input_rows": 0}})["ok"]


def test_dimension_and_partner_checks(spark):
    e = "reference_year int, hs10 string, name_ko string, name_en string"
    ok = lambda *rows: quality.dimension_metrics(spark.createDataFrame(rows, e)).first()
    assert ok((2025, "0101219000", "말", "Horse"))["ok"]
    bad = ok((2025, "0101219000", "말", "Horse"), (2025, "0101219000", "Horse", " "), (2024, "x", "말\ufffd", "y"))
    assert (bad["duplicate_year_hs10"], bad["invalid_hs10"], bad["missing_name_en"], bad["bad_unicode_name_ko"], bad["korean_name_without_hangul"], bad["ok"]) == (1, 1, 1, 1, 1, False)
    p = lambda *rows: quality.partner_metrics(spark.createDataFrame(rows, "country_code string, country_name_ko string")).first()
    assert p(("US", "미국"))["ok"] and not p(("US", "미국"), ("US", "미국"))["ok"] and not p(("US", ""))["ok"] and not p(("US", "USA"))["ok"]


def test_empty_tables(spark):
    f = facts(spark).where("false")
    assert rollup.rollup(f, 6).count() == 0 and rollup.totals(f).first()["export_usd"] == 0
    assert analytics.concentration(f.withColumn("hs6", F.substring("hs10", 1, 6)), "hs6").count() == 0
    assert normalize.classify(raw(spark).where("false")).count() == 0
