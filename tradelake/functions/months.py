"""Months as ``YYYYMM`` strings, windows of months, and their arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_index(month: Column) -> Column:
    """Months since year 0."""
    return F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 5, 2).cast("int") - 1


def index_month(index: Column) -> Column:
    return F.concat(F.lpad(F.floor(index / 12).cast("string"), 4, "0"), F.lpad((F.pmod(index, F.lit(12)) + 1).cast("string"), 2, "0"))


def shift_month(month: Column, by) -> Column:
    return index_month(month_index(month) + by)


def months_between(start: Column, end: Column) -> Column:
    """All months of a window, ends included; a reversed window is an error, a null bound gives null."""
    a, b = month_index(start), month_index(end)
    reversed_ = F.raise_error(F.concat_ws("-", F.lit("Invalid window: "), start, end)).cast("array<string>")
    return F.when(a > b, reversed_).otherwise(F.transform(F.sequence(a, F.greatest(a, b)), index_month))


def window_size(start: Column, end: Column) -> Column:
    return month_index(end) - month_index(start) + 1


def window_level(start: Column, end: Column) -> Column:
    n = window_size(start, end)
    return F.when(n == 1, "month").when(n <= 3, "quarter").when(n <= 12, "year").otherwise("multi_year")


def split_window(start: Column, end: Column) -> Column:
    """Parts of a window that is fetched anew: chunks of three months, then months; none of a single month."""
    a, b, n = month_index(start), month_index(end), window_size(start, end)
    step = F.when(n > 3, 3).otherwise(1)
    part = lambda i: F.struct(index_month(i).alias("start"), index_month(F.least(i + step - 1, b)).alias("end"))
    return F.when(n > 1, F.transform(F.sequence(a, F.greatest(a, b), step), part)).otherwise(F.array().cast("array<struct<start:string,end:string>>"))


def latest_stable_month(day: Column, release_day: int = 15) -> Column:
    """The month before that of ``day``, or the one before it up to the day of release."""
    back = F.when(F.dayofmonth(day) > release_day, -1).otherwise(-2)
    return F.date_format(F.add_months(F.trunc(day, "month"), back), "yyyyMM")


def parse_year_month(text: Column) -> Column:
    """``YYYY.MM`` to ``YYYYMM``, else null; the month's number isn't checked."""
    return F.when(text.rlike(r"^[0-9]{4}\.[0-9]{2}$"), F.replace(text, F.lit("."), F.lit("")))


def month_number(month: Column) -> Column:
    return F.substring(month, 5, 2).cast("int")


def analysis_bounds(end: Column) -> Column:
    """First months of the last year and of the year before it, and how far back the history of ``end`` goes (90 months)."""
    return F.struct(shift_month(end, -11).alias("last_year"), shift_month(end, -23).alias("year_before"), shift_month(end, -12).alias("before_end"), shift_month(end, -90).alias("history"))
