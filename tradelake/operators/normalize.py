"""From raw response rows to canonical facts, a quarantine and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.months import months_between
from ..functions.text import MEASURES, as_int, is_full_code, level_of
from ..storage import small_side, written

#: Raw columns by measure, in the order in which a missing one is reported.
RAW = {"export_usd": "exp_dlr", "export_weight_kg": "exp_wgt", "import_usd": "imp_dlr", "import_weight_kg": "imp_wgt", "trade_balance_usd": "bal_payments"}
FIELD_NAMES = {"exp_dlr": "expDlr", "exp_wgt": "expWgt", "imp_dlr": "impDlr", "imp_wgt": "impWgt", "bal_payments": "balPayments"}


def is_summary(month=None, code=None):
    """A response's total row: no month that parses, or no code."""
    month, code = month if month is not None else F.col("month"), code if code is not None else F.col("hs_code_raw")
    return month.isNull() | F.coalesce(code, F.lit("")).isin("", "-")


def at_once(df: DataFrame, *columns) -> DataFrame:
    """Columns computed below a generator: filters and keys on them don't compute them again, each at its place."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def parsed(raw: DataFrame, *columns) -> DataFrame:
    """The columns, and the measures as numbers.  Each text is parsed once, not in every test of a number.

    A step parses two or three: the code of all five is one method too long for the JVM to compile.
    """
    names, done, todo = list(raw.select(*columns).columns), [], list(RAW.items())
    rows = at_once(raw, *columns, *[F.col(c).alias(f"__{m}") for m, c in todo])
    for step in (todo[:3], todo[3:]):
        todo = [x for x in todo if x not in step]
        rows = at_once(rows, *names, *done, *[as_int(F.col(f"__{m}")).alias(m) for m, _ in step], *[f"__{m}" for m, _ in todo])
        done += [m for m, _ in step]
    return rows


KEY = ["source", "month", "hs_code_raw"]


def repeated_keys(raw: DataFrame, eligible: Column) -> DataFrame:
    """``source, month, hs_code_raw, first_ordinal, open`` of the keys that several eligible rows have.

    ``open`` tells that rows may share the first ordinal, so that it alone doesn't say which one is the first.
    Counted over keys alone, map-side before the shuffle, and written: few keys repeat, so what meets the rows is small.
    """
    counted = raw.where(eligible).groupBy(*KEY).agg(F.count("*").alias("n"), F.min("ordinal").alias("first_ordinal"), F.max("ordinal").alias("last_ordinal"))
    return written(counted.where("n > 1").select(*KEY, "first_ordinal", F.expr("n > 2 or first_ordinal = last_ordinal").alias("open")), "repeated-keys")


def seen_before(raw: DataFrame, eligible: Column) -> DataFrame:
    """Rows with ``__seen``: whether the key is an earlier eligible row's, by ordinal, then by all columns.

    Rows of equal ordinals are told apart too: one of them is the first, even of plain copies.  Only rows of keys
    that may have such are numbered; all others meet the repeated keys in a join, which broadcasts them if their files are small.
    """
    repeated = repeated_keys(raw, eligible)
    key = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in KEY])
    named = lambda keys: small_side(keys.withColumnsRenamed({c: f"__{c}" for c in KEY}))
    met = raw.join(named(repeated), key, "left")
    plain = met.where(~(F.coalesce("open", F.lit(False)) & eligible)).select(*raw.columns, (F.coalesce(F.col("ordinal") > F.col("first_ordinal"), F.lit(False)) & eligible).alias("__seen"))
    shared = repeated.where("open")
    if shared.isEmpty():
        return plain
    nth = F.row_number().over(Window.partitionBy(*KEY).orderBy("ordinal", *[c for c in raw.columns if c not in (*KEY, "ordinal")]))
    numbered = raw.where(eligible).join(named(shared.select(*KEY)), key, "left_semi").withColumn("__seen", nth > 1)
    return plain.unionByName(numbered)


def flaws(country: str = "requested_country") -> tuple[Column, Column]:
    """Whether a row names another country than the one asked for, and whether its code has ten digits."""
    mismatch = (F.coalesce("country_code_raw", F.lit("")) != "") & (F.col("country_code_raw") != F.col(country))
    return F.coalesce(mismatch, F.lit(False)), F.coalesce(is_full_code(F.col("hs_code_raw")), F.lit(False))


def classify(raw: DataFrame) -> DataFrame:
    """Add ``bucket`` (canonical, quarantine, fatal), ``reason`` and ``warning`` to every assigned fact row.

    The order of tests decides: another country, a short code, a key seen before in the source, missing
    numbers, negative money, a balance that doesn't add up.  A key counts as seen even if its first row
    fails later.  A negative weight is a warning on a canonical row.  Rows aren't sorted or dealt anew for the third
    test: the keys that repeat are found by themselves first (a small job of its own).
    """
    mismatch, full = flaws()
    return reasoned(seen_before(raw, ~mismatch & full), raw.columns)


def quarantined(raw: DataFrame) -> DataFrame:
    """The rows that ``classify`` puts in quarantine.  No other row decides that, so keys aren't looked at."""
    mismatch, full = flaws()
    return reasoned(raw.where(~mismatch & ~full).withColumn("__seen", F.lit(False)), raw.columns)


def reasoned(seen: DataFrame, columns: list[str]) -> DataFrame:
    mismatch, full = flaws()
    rows = parsed(seen, *seen.columns, mismatch.alias("__mismatch"), full.alias("__full"))
    missing = F.coalesce(*[F.when(F.col(m).isNull(), F.lit(f"missing/invalid numeric field {FIELD_NAMES[c]}")) for m, c in RAW.items()])
    money, weight = (F.col("export_usd") < 0) | (F.col("import_usd") < 0), (F.col("export_weight_kg") < 0) | (F.col("import_weight_kg") < 0)
    reason = (
        F.when(F.col("__mismatch"), "country_mismatch").when(~F.col("__full"), "non_hs10_code").when(F.col("__seen"), "duplicate_key").when(missing.isNotNull(), missing)
        .when(money, "negative amount").when(F.col("export_usd") - F.col("import_usd") != F.col("trade_balance_usd"), "trade balance mismatch")
    )
    out = rows.select(*columns, *RAW, reason.alias("reason"))
    bucket = F.when(F.col("reason").isNull(), "canonical").when(F.col("reason") == "non_hs10_code", "quarantine").otherwise("fatal")
    return out.withColumn("bucket", bucket).withColumn("warning", F.when((F.col("bucket") == "canonical") & weight, "negative_weight"))


def canonical(classified: DataFrame) -> DataFrame:
    codes = {f"hs{n}": level_of(F.col("hs_code_raw"), n) for n in (10, 8, 6, 4, 2)}
    return classified.where("bucket = 'canonical'").withColumns(codes).select("month", F.col("requested_country").alias("country_code"), *codes, *MEASURES)


#: Columns of a quarantined or warned-of row besides its reason, its code's length and the measures.
ROW, SOURCE = ["month", "requested_country", "country_code_raw", "hs_code_raw"], ["source_manifest", "source_raw_path", "source_finished_at"]


def anomalies(classified: DataFrame) -> DataFrame:
    """Every row with a reason, and canonical rows with a warning, with where they come from."""
    reason = F.coalesce("reason", "warning")
    length = F.length(F.coalesce("hs_code_raw", F.lit(""))).cast("long").alias("hs_length")
    rows = classified.where(reason.isNotNull()).withColumn("source_raw_path", F.col("source"))
    return rows.select(reason.alias("reason"), *ROW, length, "name_ko", *MEASURES, *SOURCE)


def row_reconciliation(classified: DataFrame) -> DataFrame:
    """Assigned = canonical + quarantined + fatal."""
    n = lambda b: F.count_if(F.col("bucket") == b).alias(b)
    return classified.agg(F.count("*").alias("assigned"), n("canonical"), n("quarantine"), n("fatal")).withColumn("reconciles", F.expr("assigned = canonical + quarantine + fatal"))


def all_measured():
    return reduce(lambda a, b: a & b, [F.col(m).isNotNull() for m in MEASURES])


def source_totals(raw: DataFrame) -> DataFrame:
    """Totals of each source over all assigned rows whose five numbers parse, whatever their bucket.

    ``numeric_ok`` tells whether all rows' numbers do.
    """
    rows = parsed(raw, "source")
    whole = all_measured()
    return rows.groupBy("source").agg(F.count("*").alias("fact_rows"), F.bool_and(whole).alias("numeric_ok"), *[F.coalesce(F.sum(F.when(whole, F.col(m))), F.lit(0)).alias(m) for m in MEASURES])


def last_summaries(raw: DataFrame) -> DataFrame:
    """Each source's last total row whose five numbers parse; rows with a code aren't totals, whatever their month."""
    summaries = at_once(raw, F.coalesce("hs_code_raw", F.lit("")).isin("", "-").alias("summary"), "source", "ordinal", *RAW.values()).where("summary")
    rows = parsed(summaries, "source", "ordinal").where(all_measured())
    return rows.groupBy("source").agg(F.max_by(F.struct(*MEASURES), "ordinal").alias("x")).select("source", "x.*")


def summary_reconciliation(totals: DataFrame, summaries: DataFrame) -> DataFrame:
    """Compare sources with their responses' totals: weights may differ by rounding, one kg a row; money not.

    ``totals`` may have ``whole``: whether every month of the source's window is taken from it.  Others are
    never compared, and neither are sources with an unreadable number.
    """
    if "whole" not in totals.columns:
        totals = totals.withColumn("whole", F.lit(True))
    s = summaries.select("source", *[F.col(m).alias(f"summary_{m}") for m in MEASURES])
    joined = totals.join(s, "source", "left")
    off = {m: F.abs(F.col(m) - F.col(f"summary_{m}")) for m in MEASURES}
    weights = [m for m in MEASURES if m.endswith("weight_kg")]
    allowed = F.greatest(F.lit(1), F.col("fact_rows"))
    fatal = reduce(lambda a, b: a | b, [off[m] > (allowed if m in weights else 0) for m in MEASURES])
    rounded, fields = off[weights[0]] + off[weights[1]], sum((off[m] > 0).cast("int") for m in weights)
    status = (
        F.when(~F.col("whole"), "not_whole").when(F.col("summary_export_usd").isNull(), "missing").when(~F.col("numeric_ok"), "unavailable")
        .when(fatal, "mismatch").when(rounded > 0, "rounding").otherwise("match")
    )
    compared = status.isin("rounding", "match")
    return joined.select("source", "fact_rows", status.alias("status"), F.when(compared, rounded).otherwise(0).alias("rounding_kg"), F.when(compared, fields).otherwise(0).alias("rounding_fields"))


def summary_figures(checks: DataFrame) -> DataFrame:
    """Counts of a comparison's outcomes under the names of the job's manifest."""
    n = lambda *kinds: F.count_if(F.col("status").isin(*kinds))
    return checks.agg(
        n("mismatch", "rounding", "match").alias("source_summary_checked"), n("rounding", "match").alias("source_summary_matches"), n("mismatch").alias("source_summary_mismatches"),
        n("missing").alias("source_summary_missing"), n("unavailable").alias("source_summary_unavailable_numeric"), n("rounding").alias("source_summary_weight_rounding_sources"),
        F.coalesce(F.sum("rounding_fields"), F.lit(0)).alias("source_summary_weight_rounding_fields"), F.coalesce(F.sum("rounding_kg"), F.lit(0)).alias("source_summary_weight_rounding_abs_kg"),
    )


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    counted = rows.groupBy(*keys).count()
    return counted.agg(F.count_if(F.col("count") > 1).alias("duplicate_groups"), F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("extra_rows"))


def code_lengths(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.length("hs_code_raw").alias("length")).agg(F.count("*").alias("rows"))


#: Codes with several names that a response's metrics show, by first appearance, and names of each.
SHOWN_CODES, SHOWN_NAMES = 20, 5


def repeats(facts: DataFrame) -> DataFrame:
    """``source, code, seen, names`` and what repeats, of the codes of a source that have several names or a key with several rows.

    Nearly all keys of large responses differ, so nothing is combined before the shuffle: rows are dealt out once by
    source and code, and keys and names are counted where they then are.  Only numbers are aggregated, so groups are
    hashed.  Written, because both the counts and the shown codes come from it.
    """
    dealt = facts.select("source", "code", "ordinal", "m", "c", "name").repartition("source", "code")
    nothing = F.lit(None).cast("string")
    kinds = F.inline(F.array(F.struct("m", "c", nothing.alias("name")), F.struct(nothing.alias("m"), nothing.alias("c"), "name")))  # facts have a month, so a row without one is a name's
    counted = dealt.select("source", "code", "ordinal", kinds).groupBy("source", "code", "m", "c", "name").agg(F.count("*").alias("rows"), F.min("ordinal").alias("seen"))
    extra = F.when(F.col("m").isNotNull() & (F.col("rows") > 1), F.col("rows") - 1)
    codes = counted.groupBy("source", "code").agg(F.min("seen").alias("seen"), F.count("name").alias("names"), F.coalesce(F.sum(extra), F.lit(0)).alias("duplicate_key_rows"), F.count(extra).alias("duplicate_key_groups"))
    return written(codes.where("names > 1 or duplicate_key_groups > 0"), "repeats")


def first_by(rows: DataFrame, most: int, keys: list[str], *order: str) -> DataFrame:
    """The first rows of each key; each task leaves out what can't be among them before anything is shuffled."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__n") <= most).drop("__n")


def name_examples(facts: DataFrame, repeated: DataFrame) -> DataFrame:
    """Each source's first codes with several names, with some of these: looked up in the rows once the codes are known."""
    shown = written(first_by(repeated.where("names > 1"), SHOWN_CODES, ["source"], "seen", "code").select("source", "code", "seen"), "shown-codes")
    wanted = small_side(shown.withColumnsRenamed({"source": "__source", "code": "__code"}))
    named = facts.where("name is not null").select("source", "code", "name").join(wanted, F.expr("source <=> __source and code = __code")).select("source", "code", "seen", "name").distinct()
    names = first_by(named, SHOWN_NAMES, ["source", "code", "seen"], "name").groupBy("source", "code", "seen").agg(F.array_sort(F.collect_list("name")).alias("names"))
    examples = F.array_sort(F.collect_list(F.struct("seen", F.col("code").alias("hs10"), "names")))
    return names.groupBy("source").agg(F.transform(examples, lambda x: F.struct(x["hs10"].alias("hs10"), x["names"].alias("names"))).alias("hs_name_variant_examples"))


def response_metrics(raw: DataFrame, windows: DataFrame | None = None) -> DataFrame:
    """What a response is judged by, over its rows and total rows.

    Total rows are counted and left out of everything else.  Rows are looked at three times, each time for few columns:
    for what is counted by month and length, combined map-side; for keys and names that repeat; for the names that are
    shown.  So a response is never gathered, however long it is.  The latter two are jobs of their own (``raw`` should be
    cheap to read again).  ``windows`` (source, window_start, window_end) adds the months that were asked for and aren't there.
    """
    fact = ~is_summary()
    other = (F.coalesce("country_code_raw", F.lit("")) != "") & (F.col("country_code_raw") != F.col("requested_country"))
    rows = parsed(
        raw, "source", (~fact).alias("total"), F.when(fact, F.col("month")).alias("m"), F.when(fact, F.length("hs_code_raw")).alias("length"), F.coalesce(other, F.lit(False)).alias("other"),
        F.coalesce(is_full_code(F.col("hs_code_raw")), F.lit(False)).alias("full"),
    )
    four = [F.col(m) for m in MEASURES[:4]]
    zero = reduce(lambda a, b: a & b, [F.coalesce(x == 0, F.lit(False)) for x in four])
    negative = reduce(lambda a, b: a | b, [F.coalesce(x < 0, F.lit(False)) for x in four])
    flags = {"zero_trade_rows": zero, "negative_amount_or_weight_rows": negative, "balance_mismatch_rows": F.col("export_usd") - F.col("import_usd") != F.col("trade_balance_usd"), "country_mismatch_rows": F.col("other"), "non_hs10_fact_rows": ~F.col("full")}
    counted = rows.groupBy("source", "total", "m", "length").agg(F.count("*").alias("rows"), *(F.count_if(~F.col("total") & t).alias(x) for x, t in flags.items()))
    lengths = counted.groupBy("source", "length", "total").agg(F.sum("rows").alias("rows"), F.collect_set("m").alias("months"), *(F.sum(x).alias(x) for x in flags))
    facts_of = lambda x: F.coalesce(F.sum(F.when(~F.col("total"), F.col(x))), F.lit(0))
    entry = F.when(~F.col("total"), F.struct(F.col("length").cast("string").alias("key"), F.col("rows").alias("value")))
    out = lengths.groupBy("source").agg(
        F.sum("rows").alias("row_count"), facts_of("rows").alias("fact_row_count"), F.coalesce(F.sum(F.when(F.col("total"), F.col("rows"))), F.lit(0)).alias("total_row_count"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("months")))).alias("months_found"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("hs_length_counts"), *(facts_of(x).alias(x) for x in flags),
    )
    facts = at_once(raw.where("month is not null"), fact.alias("fact"), "source", F.col("hs_code_raw").alias("code"), "ordinal", F.col("month").alias("m"), F.coalesce("country_code_raw", F.lit("")).alias("c"), F.nullif(F.col("name_ko"), F.lit("")).alias("name")).where("fact")
    repeated = repeats(facts)
    sums = repeated.groupBy("source").agg(F.sum("duplicate_key_rows").alias("duplicate_key_rows"), F.sum("duplicate_key_groups").alias("duplicate_key_groups"), F.count_if(F.col("names") > 1).alias("hs_name_variant_codes"))
    examples = name_examples(facts, repeated)
    for found in (sums, examples):
        out = out.join(found.withColumnRenamed("source", "__source"), F.expr("source <=> __source"), "left").drop("__source")
    nothing = F.array().cast(examples.schema["hs_name_variant_examples"].dataType)
    out = out.withColumns({x: F.coalesce(x, F.lit(0)) for x in sums.columns[1:]} | {"hs_name_variant_examples": F.coalesce("hs_name_variant_examples", nothing), "month_count": F.size("months_found")})
    if windows is None:
        return out
    asked = windows.select("source", months_between(F.col("window_start"), F.col("window_end")).alias("asked"))
    return out.join(asked, "source", "left").withColumn("missing_months", F.array_sort(F.array_except("asked", "months_found"))).drop("asked")


def short_code_observations(rows: DataFrame) -> DataFrame:
    """Fact rows whose code isn't ten digits, as they came: nothing is padded."""
    short = ~is_summary() & ~F.coalesce(is_full_code(F.col("hs_code_raw")), F.lit(False))
    columns = ["requested_country", "country_code_raw", "month", "hs_code_raw", "name_ko", "source"]
    kept = at_once(rows.where("month is not null"), short.alias("short"), *columns, *RAW.values()).where("short")
    return parsed(kept, *columns).select("requested_country", F.col("country_code_raw").alias("country_code"), "month", "hs_code_raw", F.length("hs_code_raw").cast("long").alias("hs_length"), "name_ko", *MEASURES, F.col("source").alias("source_raw_path"))


def short_code_figures(observations: DataFrame) -> DataFrame:
    """Rows, dollars, and rows by the code's length, of all short codes."""
    by_length = observations.groupBy(F.col("hs_length").cast("string").alias("key")).agg(F.count("*").alias("value"), F.sum("export_usd").alias("e"), F.sum("import_usd").alias("i"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return by_length.agg(zero(F.sum("value")).alias("rows"), zero(F.sum("e")).alias("export_usd"), zero(F.sum("i")).alias("import_usd"), F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value"))))).alias("lengths"))
