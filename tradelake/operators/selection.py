"""Which source is valid for each country and month: the latest successful one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.months import month_index, months_between


def expand_windows(sources: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """A row for each month of each source's window, clipped to [start, end]."""
    span = month_index(F.col("window_end")) - month_index(F.col("window_start"))
    out = sources.withColumn("span", span).withColumn("month", F.explode(months_between(F.col("window_start"), F.col("window_end"))))
    for bound, keep in ((start, lambda m: m >= start), (end, lambda m: m <= end)):
        if bound is not None:
            out = out.where(keep(F.col("month")))
    return out


def priority() -> Column:
    """Newest, then narrower, then greater path."""
    return F.struct(F.col("finished_at"), -F.col("span"), F.col("path"))


def select_sources(expanded: DataFrame) -> DataFrame:
    """The best source of each (country, month) with the number of candidates: one shuffle, combined map-side."""
    return expanded.groupBy("country", "month").agg(F.max_by("path", priority()).alias("path"), F.count("*").alias("candidates"))


def overlap_counts(selected: DataFrame) -> DataFrame:
    return selected.agg(F.count("*").alias("country_months"), F.count_if(F.col("candidates") > 1).alias("overlapping"), F.max("candidates").alias("most_candidates"))


def superseded(expanded: DataFrame, selected: DataFrame) -> DataFrame:
    """Source months that another source has replaced."""
    return expanded.select("country", "month", "path").join(selected.select("country", "month", "path"), ["country", "month", "path"], "left_anti")


def assignments(selected: DataFrame) -> DataFrame:
    """Months by calendar year and source."""
    return selected.groupBy(F.substring("month", 1, 4).alias("year"), "path").agg(F.array_join(F.array_sort(F.collect_set("month")), ",").alias("months"))


def missing_months(countries: DataFrame, months: DataFrame, selected: DataFrame) -> DataFrame:
    """Country months without a source.  The grid is countries by months, both small dimensions."""
    grid = F.broadcast(months.select("month")).crossJoin(countries.select("country"))
    return grid.join(selected.select("country", "month"), ["country", "month"], "left_anti").select("country", "month")
