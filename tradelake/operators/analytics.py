"""Trends, concentration, panels and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.months import index_month, month_index, month_number, shift_month


def monthly_trend(facts: DataFrame) -> DataFrame:
    sums = facts.groupBy("month").agg(F.sum("export_usd").alias("export_usd"), F.sum("import_usd").alias("import_usd"), F.sum("trade_balance_usd").alias("trade_balance_usd"))
    return sums.withColumn("export_bn", F.round(F.col("export_usd") / 1e9, 6)).withColumn("import_bn", F.round(F.col("import_usd") / 1e9, 6))


def profile(facts: DataFrame, code: str) -> DataFrame:
    return facts.agg(F.count("*").alias("rows"), F.countDistinct("country_code").alias("partners"), F.countDistinct(code).alias("products"), F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.sum("import_usd").alias("import_usd"), F.sum("export_usd").alias("export_usd"))


def in_last_month(facts: DataFrame) -> DataFrame:
    """Facts of the latest month: the maximum is one row, broadcast and pushed into the join."""
    last = facts.agg(F.max("month").alias("month"))
    return facts.join(F.broadcast(last), "month")


def top_partners(facts: DataFrame, names: DataFrame, k: int) -> DataFrame:
    """Partners of the latest month by trade, with names; ties go to the smaller code."""
    sums = in_last_month(facts).groupBy("month", "country_code").agg(F.sum("export_usd").alias("export_usd"), F.sum("import_usd").alias("import_usd"))
    top = sums.withColumn("trade_usd", F.col("export_usd") + F.col("import_usd")).orderBy(F.desc("trade_usd"), "country_code").limit(k)
    return top.join(names, "country_code", "left").withColumn("label", F.coalesce("partner_name", "country_code")).drop("partner_name")


def top_products(facts: DataFrame, code: str, k: int) -> DataFrame:
    sums = in_last_month(facts).groupBy("month", code).agg(F.sum("export_usd").alias("export_usd"), F.sum("import_usd").alias("import_usd"))
    return sums.orderBy(F.desc("export_usd"), code).limit(k)


def drilldown(facts: DataFrame, prefix: str, code: str) -> DataFrame:
    """Groups below a prefix, by code and partner."""
    return facts.where(F.startswith(F.col(code), F.lit(prefix))).groupBy(code, "country_code").agg(F.sum("export_usd").alias("export_usd"), F.sum("import_usd").alias("import_usd"))


def partner_shares(facts: DataFrame, code: str, value: str = "import_usd") -> DataFrame:
    """Product-partner sums with share and rank in the product; ties by partner code."""
    sums = facts.where(F.col(value) > 0).groupBy(code, "country_code").agg(F.sum(value).alias("v"))
    group = Window.partitionBy(code)
    shares = sums.withColumn("total", F.sum("v").over(group)).withColumn("share", F.col("v") / F.col("total"))
    return shares.withColumn("rank", F.row_number().over(group.orderBy(F.desc("share"), "country_code")))


def concentration(facts: DataFrame, code: str, value: str = "import_usd") -> DataFrame:
    """Per product: total, partners, Herfindahl index, largest share and partner, share of the three largest."""
    s = partner_shares(facts, code, value)
    out = s.groupBy(code).agg(
        F.max("total").alias("total"), F.count("*").alias("partners"), F.round(F.sum(F.col("share") * F.col("share")), 9).alias("hhi"), F.round(F.max("share"), 9).alias("top1_share"),
        F.min_by("country_code", "rank").alias("top1_partner"), F.round(F.sum(F.when(F.col("rank") <= 3, F.col("share")).otherwise(0.0)), 9).alias("top3_share"),
    )
    return out.withColumn("exposure", F.round(F.col("total") * F.col("hhi"), 3))


def concentration_summary(metrics: DataFrame, large: int) -> DataFrame:
    high, big = F.col("hhi") >= 0.25, F.col("total") >= large
    return metrics.agg(F.count("*").alias("products"), F.count_if(high).alias("concentrated"), F.count_if(big).alias("large"), F.count_if(high & big).alias("both"), F.coalesce(F.sum(F.when(high, F.col("total"))), F.lit(0)).alias("concentrated_value"), F.sum("total").alias("value"))


def dependency_snapshot(facts: DataFrame, code: str, product: str, names: DataFrame, k: int) -> DataFrame:
    """The first partners of one product, with names."""
    chosen = partner_shares(facts.where(F.col(code) == product), code).where(F.col("rank") <= k)
    return chosen.join(names, "country_code", "left").select(code, "rank", "country_code", "partner_name", F.col("v").alias("import_usd"), F.round("share", 9).alias("share"))


def require_product(facts: DataFrame, code: str, product: str) -> None:
    if facts.where(F.col(code) == product).isEmpty():
        raise KeyError(product)


def panel_bounds(facts: DataFrame) -> dict[str, str]:
    """Months of a study: a test of the last twelve, training before it, codes chosen by its last 24, at most 91 months of history."""
    own = facts.agg(F.min("month").alias("first"), F.max("month").alias("last"))
    back = lambda n: shift_month(F.col("last"), -n)
    return own.select("last", back(12).alias("train_end"), back(35).alias("chosen_from"), F.greatest("first", back(102)).alias("history")).first().asDict()


def top_codes(facts: DataFrame, code: str, start: str, end: str, k: int) -> DataFrame:
    """The codes of most imports between two months: nothing later leaks into the choice."""
    sums = facts.where(F.col("month").between(start, end)).groupBy(code).agg(F.sum("import_usd").alias("import_usd"))
    return sums.orderBy(F.desc("import_usd"), code).limit(k)


def monthly_panel(facts: DataFrame, codes: DataFrame, code: str, start: str, end: str) -> DataFrame:
    """A row for each code and month, zero where nothing was traded."""
    own = facts.where(F.col("month").between(start, end)).groupBy("month", code).agg(F.sum("import_usd").alias("v"))
    months = F.transform(F.sequence(month_index(F.lit(start)), month_index(F.lit(end))), index_month)
    grid = codes.select(code, F.explode(months).alias("month"))
    return grid.join(own, ["month", code], "left").select(code, "month", F.coalesce("v", F.lit(0)).alias("import_usd"))


LAGS, ROLLS = (1, 2, 3, 6, 12), (3, 6, 12)


def lag_features(panel: DataFrame, code: str) -> DataFrame:
    w = Window.partitionBy(code).orderBy("month")
    return panel.withColumns({f"lag_{n}": F.lag("import_usd", n).over(w) for n in LAGS})


def rolling_features(panel: DataFrame, code: str) -> DataFrame:
    """Means of the months before the current one, null until there are enough."""
    out = {}
    for n in ROLLS:
        w = Window.partitionBy(code).orderBy("month").rowsBetween(-n, -1)
        out[f"mean_{n}"] = F.when(F.count("import_usd").over(w) == n, F.round(F.avg("import_usd").over(w), 6))
    return panel.withColumns(out)


def calendar_features(panel: DataFrame) -> DataFrame:
    angle = 2 * 3.141592653589793 * month_number(F.col("month")) / 12
    return panel.withColumns({"month_sin": F.round(F.sin(angle), 9) + 0.0, "month_cos": F.round(F.cos(angle), 9) + 0.0, "log_value": F.round(F.log1p(F.greatest(F.col("import_usd"), F.lit(0)).cast("double")), 9)})


def next_month_features(panel: DataFrame, code: str) -> DataFrame:
    """Features of the month after the panel: the panel with that month appended, by the same windows."""
    last = panel.agg(F.max("month").alias("last"))
    more = panel.select(code).distinct().crossJoin(F.broadcast(last)).select(code, index_month(month_index(F.col("last")) + 1).alias("month"), F.lit(None).cast("bigint").alias("import_usd"))
    grown = rolling_features(lag_features(panel.unionByName(more), code), code)
    return grown.join(F.broadcast(more.select("month").distinct()), "month").drop("import_usd")


def score_predictions(rows: DataFrame, actual: str, predictions: dict[str, str]) -> DataFrame:
    """WAPE and RMSLE of several prediction columns: one pass, one row a model."""
    lists = F.explode(F.array(*[F.struct(F.lit(name).alias("model"), F.col(c).cast("double").alias("p")) for name, c in sorted(predictions.items())]))
    long = rows.select(F.col(actual).cast("double").alias("a"), lists.alias("x")).select("a", "x.model", "x.p").where("p is not null")
    error = F.log1p(F.greatest(F.col("p"), F.lit(0.0))) - F.log1p(F.greatest(F.col("a"), F.lit(0.0)))
    return long.groupBy("model").agg(F.count("*").alias("n"), F.round(F.try_divide(F.sum(F.abs(F.col("p") - F.col("a"))), F.sum(F.abs("a"))), 9).alias("wape"), F.round(F.sqrt(F.avg(error * error)), 9).alias("rmsle"))


def product_errors(rows: DataFrame, code: str, actual: str, first: str, second: str) -> DataFrame:
    """Absolute errors of two predictions by product, and how much the first improves on the second."""
    e = lambda c: F.sum(F.abs(F.col(c) - F.col(actual)))
    out = rows.where(F.col(first).isNotNull() & F.col(second).isNotNull()).groupBy(code).agg(F.sum(actual).alias("actual"), e(first).alias("first_error"), e(second).alias("second_error"))
    return out.withColumn("improvement", F.round(1 - F.try_divide(F.col("first_error").cast("double"), F.col("second_error").cast("double")), 9))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Rows added, removed and changed between two snapshots: one full outer join on the key."""
    a = old.select(*keys, F.struct(*values).alias("old"))
    b = new.select(*keys, F.struct(*values).alias("new"))
    both = a.join(b, keys, "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed").otherwise("same")
    return both.select(*keys, change.alias("change"))
