"""Prefix roll-ups of canonical facts with residuals of short codes, and their reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import LEVELS, MEASURES, is_full_code, level_of, reaches_level
from ..storage import written


def hierarchy(level: int) -> list[int]:
    """A level and the coarser ones."""
    return [n for n in LEVELS if n <= level]


def rollup(facts: DataFrame, level: int, code: str = "hs10") -> DataFrame:
    """Sums by month, country and prefix: one shuffle after map-side sums."""
    keys = [level_of(F.col(code), level).alias(f"hs{level}")]
    sums = [F.sum(m).alias(m) for m in MEASURES]
    out = facts.groupBy("month", "country_code", *keys).agg(*sums, F.count("*").alias("source_row_count"))
    return out.withColumns({f"hs{n}": level_of(F.col(f"hs{level}"), n) for n in hierarchy(level)[1:]})


def in_months_of(facts: DataFrame, residuals: DataFrame) -> DataFrame:
    """Short rows that some level takes: numeric, shorter than ten digits, of a month that has facts.

    A measure that is missing there is an error: nothing says what it should add.
    """
    short = residuals.where(reaches_level(F.col("hs_code_raw"), LEVELS[-1])).join(facts.select("month").distinct(), "month", "left_semi")
    named = lambda m: F.coalesce(F.col(m), F.raise_error(F.concat(F.lit(f"residual row has missing {m}: "), F.col("hs_code_raw"))).cast("bigint"))
    return short.select("month", F.col("requested_country").alias("country_code"), "hs_code_raw", *[named(m).alias(m) for m in MEASURES])


KEYS = ["month", "country_code", "code"]


def reaching(short: DataFrame, low: int, high: int) -> DataFrame:
    """Short rows of ``low`` to ``high`` digits as groups of level ``low``."""
    rows = short.where(F.length("hs_code_raw").between(low, high))
    return rows.select("month", "country_code", F.substring("hs_code_raw", 1, low).alias("code"), *MEASURES, *[F.col(m).alias(f"residual_{m}") for m in MEASURES], F.lit(1).cast("bigint").alias("source_row_count"), F.lit(1).cast("bigint").alias("exception_row_count"))


def cascade(facts: DataFrame, residuals: DataFrame | None, read=lambda level, groups: groups) -> dict[int, DataFrame]:
    """The groups of every level, each from the next finer one's: measures and counts add up.

    Facts are summed to the finest level map-side before the first shuffle; what is shuffled shrinks from level
    to level, and no group needs more than its own key, so one large country or month is no bottleneck.  A short
    code enters at the finest level that its digits reach.  ``read`` may write a level and return a reader of it.
    """
    short = None if residuals is None else in_months_of(facts, residuals)
    zero = [F.lit(0).cast("bigint").alias(f"residual_{m}") for m in MEASURES]
    finer = facts.select("month", "country_code", level_of(F.col("hs10"), LEVELS[0]).alias("code"), *MEASURES, *zero, F.lit(1).cast("bigint").alias("source_row_count"), F.lit(0).cast("bigint").alias("exception_row_count"))
    out: dict[int, DataFrame] = {}
    for level, upper in zip(LEVELS, (10, *LEVELS)):
        rows = finer.withColumn("code", F.substring("code", 1, level))
        if short is not None:
            rows = rows.unionByName(reaching(short, level, upper - 1))
        values = [c for c in rows.columns if c not in KEYS]
        out[level] = finer = read(level, rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in values]))
    return out


def level_table(groups: DataFrame, level: int) -> DataFrame:
    """Groups of a level with its code, the coarser ones and whether a short code counts in it."""
    named = groups.withColumnRenamed("code", f"hs{level}").withColumn("has_residual", F.col("exception_row_count") > 0)
    return named.withColumns({f"hs{n}": level_of(F.col(f"hs{level}"), n) for n in hierarchy(level)[1:]})


def with_residuals(facts: DataFrame, residuals: DataFrame, level: int) -> DataFrame:
    """One level's roll-up in which quarantined short codes count where their digits reach."""
    return level_table(cascade(facts, residuals)[level], level)


GROUP_VALUES = [*MEASURES, *(f"residual_{m}" for m in MEASURES), "source_row_count", "exception_row_count"]


def finest_rows(rows: DataFrame, code: str = "hs_code_raw") -> DataFrame:
    """Rows of full and short codes alike as groups of the finest level that each reaches; codes that reach none are left out.

    ``missing`` is a number for a measure that a short row lacks (``missing_text`` says it): nothing says what it
    should add.  Sums and maxima of numbers are hashed; a greatest text would have all rows sorted.
    """
    rows = rows.withColumn("__digits", counted_digits(code)).where("__digits is not null")
    full, one = F.col("__digits") == 10, F.lit(1).cast("bigint")
    own = reduce(lambda found, n: F.when(F.col("__digits") >= n, n).otherwise(found), reversed(LEVELS), F.lit(None).cast("int"))
    extra = [F.when(full, F.lit(0).cast("bigint")).otherwise(F.col(m)).alias(f"residual_{m}") for m in MEASURES]
    first = F.coalesce(*[F.when(F.col(m).isNull(), F.lit(i)) for i, m in enumerate(MEASURES, 1)])
    missing = F.when(~full & first.isNotNull(), (first.cast("bigint") * 100 + F.col("__digits")) * 10**10 + F.col(code).try_cast("bigint"))
    return rows.select("month", "country_code", F.substring(F.col(code), F.lit(1), own).alias("code"), own.alias("own"), *MEASURES, *extra, one.alias("source_row_count"), F.when(full, one - 1).otherwise(one).alias("exception_row_count"), missing.alias("missing"))


def counted_digits(code: str) -> Column:
    """How many digits of a full or short code count; null if it reaches no level."""
    return F.when(F.col(code).rlike(f"^[0-9]{{{LEVELS[-1]},10}}$"), F.length(code))


def missing_text(missing: Column) -> Column:
    """What ``missing`` of ``finest_rows`` stands for: the measure and the row's code."""
    digits = lambda n, low, size: F.floor(n / F.lit(10**low)).cast("bigint") % 10**size
    measure = F.element_at(F.array(*map(F.lit, MEASURES)), F.floor(missing / F.lit(10**12)).cast("int"))
    return F.concat(F.lit("residual row has missing "), measure, F.lit(": "), F.lpad((missing % 10**10).cast("string"), digits(missing, 10, 2).cast("int"), F.lit("0")))


def all_levels_mixed(rows: DataFrame, code: str = "hs_code_raw", months: DataFrame | None = None) -> DataFrame:
    """Every level in long form (level, code) from rows whose codes are full or short.

    Rows are summed, map-side first, to the finest level that each reaches; only those groups are dealt to the
    coarser levels and summed again.  Short codes of months without facts don't count: the months (a row each, so
    they are broadcast) come from a look at the months of full codes alone, unless they are known.
    """
    finest = finest_rows(rows, code).groupBy(*KEYS, "own").agg(*[F.sum(c).alias(c) for c in GROUP_VALUES], F.max("missing").alias("missing"))
    if months is None:
        months = rows.where(is_full_code(F.col(code))).select("month").distinct()
    finest = finest.join(F.broadcast(months), "month", "left_semi")
    # as a column, for a filter would pass the join and see months without facts
    finest = finest.withColumn("own", F.when(F.col("missing").isNotNull(), F.raise_error(missing_text(F.col("missing"))).cast("int")).otherwise(F.col("own")))
    return dealt_levels(finest).withColumn("has_residual", F.col("exception_row_count") > 0)


def dealt_levels(finest: DataFrame) -> DataFrame:
    """Groups of their finest levels (``own``) summed to every level that they reach."""
    dealt = finest.withColumn("level", F.explode(F.filter(F.array(*map(F.lit, LEVELS)), lambda n: n <= F.col("own")))).withColumn("code", F.substring("code", F.lit(1), F.col("level")))
    return dealt.groupBy("level", *KEYS).agg(*[F.sum(c).alias(c) for c in GROUP_VALUES])


def all_levels(facts: DataFrame, residuals: DataFrame | None = None) -> DataFrame:
    """Every level in long form (level, code) of facts and, if there are any, quarantined rows with short codes."""
    rows = facts.select("month", "country_code", F.col("hs10").alias("hs_code_raw"), *MEASURES)
    if residuals is None:
        zero = [F.lit(0).cast("bigint").alias(f"residual_{m}") for m in MEASURES]
        rows = rows.select("month", "country_code", level_of(F.col("hs_code_raw"), LEVELS[0]).alias("code"), F.lit(LEVELS[0]).alias("own"), *MEASURES, *zero, F.lit(1).cast("bigint").alias("source_row_count"), F.lit(0).cast("bigint").alias("exception_row_count"))
        finest = rows.groupBy(*KEYS, "own").agg(*[F.sum(c).alias(c) for c in GROUP_VALUES])
        return dealt_levels(finest).select("level", *KEYS, *MEASURES, "source_row_count")
    short = residuals.where(~is_full_code(F.col("hs_code_raw"))).select("month", F.col("requested_country").alias("country_code"), "hs_code_raw", *MEASURES)
    return all_levels_mixed(rows.unionByName(short))


def totals(facts: DataFrame) -> DataFrame:
    return facts.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEASURES])


def expected(facts: DataFrame, residuals: DataFrame, by: list[str]) -> DataFrame:
    """Per level (and ``by``): what facts and the short rows that reach it add up to, and how many these are."""
    sums = [F.sum(m).alias(f"e_{m}") for m in MEASURES]
    base = facts.groupBy(*by).agg(*sums, F.lit(0).cast("bigint").alias("mapped")).withColumn("level", F.explode(F.array(*map(F.lit, LEVELS))))
    reach = F.filter(F.array(*map(F.lit, LEVELS)), lambda n: n <= F.length("hs_code_raw"))
    near = in_months_of(facts, residuals).withColumn("level", F.explode(reach)).groupBy("level", *by).agg(*sums, F.count("*").alias("mapped"))
    both = base.unionByName(near).groupBy("level", *by)
    return both.agg(*[F.coalesce(F.sum(f"e_{m}"), F.lit(0)).alias(f"e_{m}") for m in MEASURES], F.sum("mapped").alias("mapped"))


def compared(rolled: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """The levels' totals beside what they should be."""
    sums = rolled.groupBy("level", *by).agg(*[F.sum(m).alias(m) for m in MEASURES], F.sum("exception_row_count").alias("exceptions"))
    joined = sums.join(wanted, ["level", *by], "full")
    same = reduce(lambda a, b: a & b, [F.col(m).eqNullSafe(F.col(f"e_{m}")) for m in MEASURES]) & F.col("exceptions").eqNullSafe(F.col("mapped"))
    return joined.select("level", *by, *MEASURES, "exceptions", "mapped", same.alias("reconciles"))


def reconciliation(facts: DataFrame, residuals: DataFrame, by: list[str] = ()) -> DataFrame:
    """Per level (and month, if asked for): the roll-up's totals against facts plus the residuals that reach it."""
    return compared(all_levels(facts, residuals), expected(facts, residuals, list(by)), list(by))


def reconciliation_mixed(rows: DataFrame, by: list[str] = (), code: str = "hs_code_raw") -> DataFrame:
    """``reconciliation`` of rows whose codes are full or short: one look for the totals, one for the roll-up.

    The totals are those of rows, by month and by how many digits count, which the roll-up has no part in; they
    are a few rows, written, and say which months have facts.
    """
    by = list(by)
    own = written(rows.groupBy("month", counted_digits(code).alias("digits")).agg(*[F.sum(m).alias(f"e_{m}") for m in MEASURES], F.count("*").alias("n")).where("digits is not null"), "months")
    months = own.where("digits = 10").select("month")
    dealt = own.join(F.broadcast(months), "month", "left_semi").withColumn("level", F.explode(F.filter(F.array(*map(F.lit, LEVELS)), lambda n: n <= F.col("digits"))))
    short = F.coalesce(F.sum(F.when(F.col("digits") < 10, F.col("n"))), F.lit(0)).alias("mapped")
    wanted = dealt.groupBy("level", *by).agg(*[F.coalesce(F.sum(f"e_{m}"), F.lit(0)).alias(f"e_{m}") for m in MEASURES], short)
    return compared(all_levels_mixed(rows, code, months), wanted, by)
