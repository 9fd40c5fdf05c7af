import pytest
from pyspark.sql import functions as F

from tradelake.functions import months as m
from tradelake.functions import text as t
from tradelake.functions.outcomes import outcome_status, should_split


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_months(spark):
    lit = F.lit
    assert one(spark, m.shift_month(lit("202501"), -1)) == "202412"
    assert one(spark, m.months_between(lit("201211"), lit("201302"))) == ["201211", "201212", "201301", "201302"]
    with pytest.raises(Exception, match="Invalid window"):
        one(spark, m.months_between(lit("201302"), lit("201211")))
    assert one(spark, m.months_between(lit(None).cast("string"), lit("201211"))) is None
    assert tuple(one(spark, m.analysis_bounds(lit("202607")))) == ("202508", "202408", "202507", "201901")
    assert [tuple(x) for x in one(spark, m.split_window(lit("202501"), lit("202512")))] == [("202501", "202503"), ("202504", "202506"), ("202507", "202509"), ("202510", "202512")]
    assert [tuple(x) for x in one(spark, m.split_window(lit("202501"), lit("202503")))] == [("202501", "202501"), ("202502", "202502"), ("202503", "202503")]
    assert one(spark, m.split_window(lit("202501"), lit("202501"))) == []
    assert one(spark, m.window_level(lit("202501"), lit("202612"))) == "multi_year"
    assert one(spark, m.latest_stable_month(lit("2026-09-08").cast("date"))) == "202607"
    assert one(spark, m.latest_stable_month(lit("2026-09-16").cast("date"))) == "202608"
    assert one(spark, m.parse_year_month(lit("2025.01"))) == "202501"
    assert one(spark, m.parse_year_month(lit("total"))) is None


def test_as_int(spark):
    cases = {"1,234": 1234, " 42　": 42, "-": None, "": None, "12.9": 12, "-12.9": -12, "n/a": None, "-5": -5, "+7": 7, "12.": 12, "\u2003\u00a01,0\u3000": 10, "\x1c8\x85": 8, "nan": None, "--1": None, " - ": None, "1e3": 1000, None: None, "12d": None, "5f": None, "0x1p3": None, "1e400": None, "9223372036854775807": 2**63 - 1, "9223372036854775808": None, "-9223372036854775808": -(2**63), "-9223372036854775809": None, "1_000": 1000, "1__0": None, "_1": None, ".5": 0, ".": None, "Infinity": None, "1e18": 10**18, "9.3e18": None, "\x0012": None}
    rows = spark.createDataFrame([(k,) for k in cases], "x string").select("x", t.as_int(F.col("x")).alias("y")).collect()
    assert {r["x"]: r["y"] for r in rows} == cases


def test_wide_numbers(spark):
    cases = {"9223372036854775808": 2**63, "-12345678901234567890123": -12345678901234567890123, "1e23": int(1e23), "-1.5e30": -int(1.5e30), "9.007199254740993e15": 9007199254740992, "12.9": 12, "1e39": None, "9" * 39: None, "9" * 38: int("9" * 38), "12d": None, "-": None, None: None, "-9223372036854775809": -(2**63) - 1}
    rows = spark.createDataFrame([(k,) for k in cases], "x string").select("x", t.as_wide_int(F.col("x")).alias("y")).collect()
    assert {r["x"]: None if r["y"] is None else int(r["y"]) for r in rows} == cases


def test_text_damage(spark):
    cases = {"정상 한글": None, "a�\x00": "replacement_character", "a\x00\x01": "nul_character", "a\x01": "control_character", "a\t\r\nb": None}
    rows = spark.createDataFrame([(k,) for k in cases], "x string").select("x", t.bad_unicode_reason(F.col("x")).alias("y"), t.has_hangul(F.col("x")).alias("h")).collect()
    assert {r["x"]: r["y"] for r in rows} == cases
    assert [r["x"] for r in rows if r["h"]] == ["정상 한글"]


def test_keys(spark):
    assert one(spark, t.decode_key(F.lit("a%2Fb+c%3D"))) == "a/b+c="
    assert one(spark, t.redact_key(F.lit("http://x?servicekey=abc%20d&y=1"))) == "http://x?servicekey=[REDACTED]&y=1"
    assert one(spark, t.reaches_level(F.lit("761699"), 6)) and not one(spark, t.reaches_level(F.lit("761699"), 8))
    assert not one(spark, t.reaches_level(F.lit("12345678901"), 8))


def test_labels(spark):
    assert one(spark, t.label_or(F.lit("  "), F.lit("01"))) == "01" and one(spark, t.label_or(F.lit(None).cast("string"), F.lit("01"))) == "01" and one(spark, t.label_or(F.lit(" x "), F.lit("01"))) == "x"
    assert one(spark, t.short_label(F.lit("abcdef"), 3)) == "abc"


def test_outcomes(spark):
    s = lambda http, code, said="", parsed=True, raised=False: one(spark, outcome_status(F.lit(http).cast("int"), F.lit(code).cast("string"), F.lit(said), F.lit(parsed), F.lit(raised)))
    assert s(200, "00") == "success" and s(500, "00") == "api_error" and s(200, "01") == "api_error" and s(200, None) == "api_error"
    assert s(429, "22") == "quota_exceeded" and s(200, "99", "Limited_Number_Of_Service_Requests_Exceeds_Error") == "quota_exceeded"
    assert s(200, "23") == "rate_limited" and s(429, None) == "rate_limited" and s(200, "99", "LIMITED_NUMBER_OF_SERVICE_REQUESTS_PER_SECOND_EXCEEDS_ERROR") == "rate_limited"
    assert s(403, None) == "auth_error" and s(200, "30") == "auth_error" and s(200, "00", "", False) == "parse_error"
    assert s(None, None, raised=True) == "transport_error" and s(503, None, raised=True) == "transport_error" and s(200, None, raised=True) == "transport_error" and s(403, None, raised=True) == "transport_error"
    assert s(410, None, raised=True) == "http_error"
    split = lambda status, http, months: one(spark, should_split(F.lit(status), F.lit(http).cast("int"), F.lit(months)))
    assert split("transport_error", None, 12) and split("transport_error", 504, 3)
    for status, http, months in (("transport_error", None, 1), ("transport_error", 200, 12), ("api_error", 500, 12), ("parse_error", 200, 12), ("http_error", 410, 12), ("success", 200, 12), ("auth_error", 403, 12)):
        assert not split(status, http, months), (status, http, months)
