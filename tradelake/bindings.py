"""The driver's tables in the shapes of the domain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.months import month_index, months_between
from .functions.outcomes import outcome_status
from .functions.text import MEASURES
from .operators.selection import expand_windows
from .storage import small_side, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_expr(key: str, line: str, quantity: str) -> str:
    two = lambda x: f"lpad(cast({x} as string), 2, '0')"
    return f"concat({two(key + ' % 97')}, {two(key + ' % 7')}, {two(key + ' % 5')}, {two(line)}, {two('cast(' + quantity + ' as bigint)')})"


def supplier_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with their nation's name.  The estimate of a join is a product, so the suppliers' own size is checked."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    named = suppliers.join(small_side(table(spark, sf_dir, "nation").select("n_nationkey", "n_name")), F.expr("s_nationkey = n_nationkey"))
    return F.broadcast(named) if small_side(suppliers) is not suppliers else named


def trade_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its supplier's nation as monthly facts, with the order key for derived flaws."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_linestatus", "l_shipdate")
    line = spread(line, "l_orderkey", "l_linenumber")
    amount, weight, out = "cast(round(l_extendedprice * 100) as bigint)", "cast(l_quantity as bigint)", "l_linestatus = 'O'"
    return line.join(supplier_nations(spark, sf_dir), F.expr("l_suppkey = s_suppkey")).selectExpr(
        "date_format(l_shipdate, 'yyyyMM') as month", "n_name as country_code", f"{code_expr('l_partkey', 'l_linenumber', 'l_quantity')} as hs10",
        f"if({out}, {amount}, 0) as export_usd", f"if({out}, {weight}, 0) as export_weight_kg", f"if({out}, 0, {amount}) as import_usd", f"if({out}, 0, {weight}) as import_weight_kg",
        f"if({out}, {amount}, -{amount}) as trade_balance_usd", "l_orderkey", "l_linenumber", "l_partkey",
    )


def with_levels(facts: DataFrame) -> DataFrame:
    return facts.withColumns({f"hs{n}": F.substring("hs10", 1, n) for n in (8, 6, 4, 2)})


RAW_CODE = "case when l_orderkey % 97 = 0 then substring(hs10, 1, 6) when l_orderkey % 89 = 0 then substring(hs10, 1, 9) when l_orderkey % 83 = 0 then concat(substring(hs10, 1, 9), 'X') else hs10 end"


def coded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All facts under the code that their response has, whole, cut or damaged: one scan for both kinds."""
    return trade_facts(spark, sf_dir).select("month", "country_code", F.expr(RAW_CODE).alias("hs_code_raw"), *MEASURES)


def short_code_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts whose code is cut or damaged, as quarantined rows."""
    rows = trade_facts(spark, sf_dir).withColumn("hs_code_raw", F.expr(RAW_CODE)).where("hs_code_raw <> hs10")
    return rows.select("month", F.col("country_code").alias("requested_country"), "hs_code_raw", *MEASURES)


def full_code_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_facts(spark, sf_dir).where(F.expr(RAW_CODE) == F.col("hs10"))


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts as response text with flaws at fixed orders: other countries, damaged codes, gaps, wrong signs."""
    return trade_facts(spark, sf_dir).selectExpr(
        "concat('src', cast(l_orderkey % 500 as string)) as source", "concat('request_', cast(l_orderkey % 500 as string), '.json') as source_manifest", "concat('2026-01-', lpad(cast(l_orderkey % 28 + 1 as string), 2, '0')) as source_finished_at", "l_orderkey * 10 + l_linenumber as ordinal", "month", "country_code as requested_country",
        "case when l_orderkey % 101 = 0 then 'ZZ' when l_orderkey % 7 = 0 then '' else country_code end as country_code_raw", f"{RAW_CODE} as hs_code_raw", "concat('item ', cast(l_partkey as string)) as name_ko",
        "case when l_orderkey % 103 = 0 then '-' when l_orderkey % 107 = 0 then concat('-', cast(export_usd + 1 as string)) else cast(export_usd as string) end as exp_dlr",
        "case when l_orderkey % 113 = 0 then concat('-', cast(export_weight_kg + 1 as string)) else cast(export_weight_kg as string) end as exp_wgt", "cast(import_usd as string) as imp_dlr", "concat(cast(import_weight_kg as string), '.75') as imp_wgt",
        "case when l_orderkey % 109 = 0 then cast(trade_balance_usd + 1 as string) else cast(trade_balance_usd as string) end as bal_payments",
    )


def source_number(source: str = "source"):
    return F.substring(source, 4, 10).cast("int")


def total_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total rows of the responses of ``raw_rows``: none for every tenth source, else a stale one and a last one.

    The last one is off by rounding for some sources and wrong for others; for some its first number can't be read.
    """
    raw = raw_rows(spark, sf_dir)
    sums = raw.where("exp_dlr <> '-'").groupBy("source").agg(*[F.sum(F.expr(f"cast(cast({c} as double) as bigint)")).alias(c) for c in ("exp_dlr", "exp_wgt", "imp_dlr", "imp_wgt", "bal_payments")])
    n = source_number()
    off = lambda c: F.when(n % 7 == 0, 1 if c.endswith("wgt") else 0).when(n % 11 == 0, 1).otherwise(0)
    values = ["exp_dlr", "exp_wgt", "imp_dlr", "imp_wgt", "bal_payments"]
    stale = sums.select("source", F.lit(-1).cast("bigint").alias("ordinal"), *[(F.col(c) + 5).cast("string").alias(c) for c in values])
    last = sums.select("source", F.lit(10**15).cast("bigint").alias("ordinal"), *[(F.col(c) + off(c)).cast("string").alias(c) for c in values]).withColumn("exp_dlr", F.when(n % 13 == 0, "n/a").otherwise(F.col("exp_dlr")))
    both = stale.unionByName(last).where(n % 10 != 0)
    return both.withColumns({"month": F.lit(None).cast("string"), "hs_code_raw": F.lit("-"), "country_code_raw": F.lit("-"), "name_ko": F.lit("-"), "requested_country": F.lit(None).cast("string"), "source_manifest": F.lit(""), "source_finished_at": F.lit("")}).select(raw.columns)


def response_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the responses, totals among them."""
    return raw_rows(spark, sf_dir).unionByName(total_rows(spark, sf_dir))


def source_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as requests: a window that starts at the order's month, the order's day as time of the answer."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(small_side(table(spark, sf_dir, "nation").select("n_nationkey", "n_name")), F.expr("c_nationkey = n_nationkey"))
    return o.join(c, F.expr("o_custkey = c_custkey")).selectExpr(
        "n_name as country", "date_format(o_orderdate, 'yyyyMM') as window_start", "date_format(add_months(o_orderdate, cast(o_orderkey % 12 as int)), 'yyyyMM') as window_end",
        "date_format(o_orderdate, 'yyyyMMdd') as finished_at", "o_orderkey as path", "o_orderstatus",
    )


def answered_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of the requests' windows; those of a nation in every eleventh month got no answer."""
    number = F.substring("country", 8, 10).cast("int")
    return expand_windows(source_windows(spark, sf_dir)).where(month_index(F.col("month")) % 11 != number % 11)


def partner_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Nations as partners with a two-letter code each (NA, TW, KR and others), and the international codes of two thirds of them."""
    two = "case n_nationkey when 0 then 'NA' when 1 then 'TW' when 2 then 'KR' else concat(chr(65 + n_nationkey % 26), chr(66 + n_nationkey div 26)) end"
    n = table(spark, sf_dir, "nation").withColumn("code", F.expr(two))
    world = n.where("n_nationkey % 3 <> 1").selectExpr("code as alpha2", "lpad(cast(n_nationkey as string), 3, '0') as un_m49", "concat(code, 'X') as iso_alpha3", "concat('Nation ', n_nationkey) as country_name_en")
    return n.selectExpr("code as country_code", "concat('나라 ', n_name) as country_name_ko"), world


#: Number texts of parts, by the key's remainder; the others have a price or a size.
NUMBERS = ["-", "", "1,234,567", None, " 42 ", "n/a", "12d", "5f", "0x1p3", "1e400", "9223372036854775808", "-9223372036854775808", "1_000", "+7.9", "1e3", ".5", "1__0", "1e22", "-12345678901234567890123", "1E19", "٣"]


def number_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = " ".join(f"when {i} then '{x}'" for i, x in enumerate(NUMBERS) if x is not None)
    return table(spark, sf_dir, "part").selectExpr("p_partkey", f"case p_partkey % 23 {texts} when 3 then cast(p_retailprice as string) else cast(p_size as string) end as x")


def label_conflicts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Conflicts of 2021 and 2022, each of the edition's own label with the other one, and the editions of four years.

    The bits of a part's key say which label it has in which year; every tenth is gone in 2023.
    """
    p = spread(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey").selectExpr("p_partkey as k", "cast(p_partkey as string) as hs10")
    e = p.withColumn("reference_year", F.explode(F.array(*map(F.lit, range(2020, 2024))))).where("k % 10 <> 0 or reference_year <> 2023")
    e = e.withColumn("b", F.expr("shiftright(k, reference_year - 2020) & 1"))
    label = lambda x: [F.expr(f"if({x} = 1, 'new', 'old')"), F.expr(f"if(k % 7 = 0, 'same', if({x} = 1, 'en new', 'en old'))")]
    own, other = label("b"), label("1 - b")
    conflicts = e.where("reference_year in (2021, 2022)").select("reference_year", "hs10", own[0].alias("first_ko"), own[1].alias("first_en"), other[0].alias("second_ko"), other[1].alias("second_en"))
    return conflicts, e.select("reference_year", "hs10", own[0].alias("name_ko"), own[1].alias("name_en"))


def editions(spark: SparkSession, sf_dir: str, years: range = range(1994, 2003)) -> DataFrame:
    """Annual code editions: the codes of facts whose part isn't left out, every year."""
    codes = trade_facts(spark, sf_dir).where("l_partkey % 20 <> 0").groupBy("hs10").agg(F.concat(F.lit("part "), F.min("l_partkey").cast("string")).alias("name_ko"))
    listed = codes.select("hs10", "name_ko", F.explode(F.array(*map(F.lit, years))).alias("reference_year"))
    return listed.withColumn("hs_revision", F.concat(F.lit("HSK-"), F.col("reference_year").cast("string")))


def partner_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, F.expr("n_regionkey = r_regionkey")).select(F.col("n_name").alias("country_code"), F.concat_ws(" / ", "n_name", "r_name").alias("partner_name"))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as finished requests: six for each country, a year first, then quarters and a month.

    Every fourth country's year broke off and was split; of some of these a quarter broke off again.
    """
    e = table(spark, sf_dir, "events").selectExpr("event_id", "event_id div 6 as n", "cast(event_id % 6 as int) as slot")
    e = e.selectExpr("*", "n % 4 = 1 as split", "n % 12 = 1 as split_again", "concat('C', cast(n as string)) as country")
    start = "case when slot = 0 then '202401' when slot = 5 then if(split_again, '202401', '202312') else concat(if(split, '2024', '2023'), lpad(cast(slot * 3 - 2 as string), 2, '0')) end as window_start"
    end = "case when slot = 0 then '202412' when slot = 5 then if(split_again, '202401', '202312') else concat(if(split, '2024', '2023'), lpad(cast(slot * 3 as string), 2, '0')) end as window_end"
    parent = "case when slot between 1 and 4 and split then concat(country, ':202401-202412') when slot = 5 and split_again then concat(country, ':202401-202403') end as parent_request"
    raised = "slot = 0 and n % 4 in (1, 3) or slot = 1 and split_again as raised"
    http = "case when slot = 0 and n % 4 = 1 then if(n % 8 = 1, null, 503) when slot = 0 and n % 4 = 3 then if(n % 8 = 3, 200, 410) when slot = 1 and split_again then 504 when event_id % 23 = 0 then 403 when event_id % 37 = 0 then 429 else 200 end as http_status"
    code = "case when event_id % 17 = 0 then '22' when event_id % 19 = 0 then '23' when event_id % 41 = 0 then '30' when event_id % 31 = 0 or slot = 0 and n % 4 = 2 then '99' else '00' end as api_result_code"
    said = "case when event_id % 43 = 0 then 'limited_number_of_service_requests_per_second_exceeds_error' when event_id % 62 = 0 then 'limited_number_of_service_requests_exceeds_error' else 'said' end as api_result_msg"
    rows = e.selectExpr("*", start, end, parent, raised, http, code, said, "event_id % 29 <> 0 as parsed", "if(event_id % 10 = 0, 0, event_id % 1000) as fact_row_count", "if(event_id % 7 = 0, event_id % 3, 0) as non_hs10_fact_rows")
    months = months_between(F.col("window_start"), F.col("window_end"))
    found = F.when(F.col("event_id") % 9 == 0, F.slice(months, 1, F.greatest(F.size(months) - 1, F.lit(1)))).otherwise(months)
    counts = F.create_map(F.lit("10"), F.col("fact_row_count"), F.lit("6"), F.col("non_hs10_fact_rows"))
    zero = {c: F.lit(0).cast("bigint") for c in ("zero_trade_rows", "negative_amount_or_weight_rows")}
    out = rows.withColumns({"months_found": found, "hs_length_counts": counts, "response_bytes": F.col("fact_row_count") * 275, "gzip_bytes": F.col("fact_row_count") * 32, "duplicate_key_rows": F.expr("if(event_id % 11 = 0, 1L, 0L)"), "country_mismatch_rows": F.expr("if(event_id % 13 = 0, 2L, 0L)"), "balance_mismatch_rows": F.col("event_id") % 5} | zero)
    out = out.withColumn("status", outcome_status(*map(F.col, ("http_status", "api_result_code", "api_result_msg", "parsed", "raised"))))
    return out.withColumn("success", F.col("status") == "success").drop("n", "slot", "split", "split_again")


def outcome_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The countries' year of 2024, and one that nobody asked for."""
    asked = outcomes(spark, sf_dir).select("country").distinct()
    return asked.unionByName(spark.createDataFrame([("XX",)], "country string")).withColumns({"window_start": F.lit("202401"), "window_end": F.lit("202412")})


#: Years of the tariff pages, chapters that their codes are dealt to, and keys whose codes share a page.
PAGE_YEARS, CHAPTERS, PAGE_KEYS = (2021, 2022, 2023), 20, 4_000


def tariff_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """part as the tariff service's pages: (reference_year, html) of indexes and (reference_year, chapter, html).

    A chapter has as many pages as its codes need.  In 2022 every tenth code has a second, longer label, and every fifteenth one of another year's edition.
    """
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey").selectExpr("p_partkey as k", f"lpad(cast(p_partkey % {CHAPTERS} + 1 as string), 2, '0') as chapter", "p_name")
    p = p.withColumn("hs10", F.expr("concat(chapter, lpad(cast(k as string), 8, '0'))")).withColumn("reference_year", F.explode(F.array(*map(F.lit, PAGE_YEARS))))
    moved = "(k % 15 = 0 and ((reference_year > 2022) = (k % 2 = 0)) and reference_year <> 2022)"
    first = F.expr(f"if({moved}, concat('신 ', p_name), if(k % 15 = 0, concat('구 ', p_name), concat('품 ', p_name)))")
    second = F.expr("case when reference_year = 2022 and k % 15 = 0 then concat('신 ', p_name) when reference_year = 2022 and k % 10 = 0 then concat('품 ', p_name, ' (상세)') end")
    english = lambda c: F.concat(F.lit("EN "), F.substring(c, 1, 1))
    row = lambda c: F.concat(F.lit('<tr><td><input name="hsSgn_Mn" value="'), "hs10", F.lit('" /></td><td>x</td><td class="hlzoneWrd"><a>'), c, F.lit('</a></td><td class="hlzoneWrd">'), english(c), F.lit("</td></tr>"))
    head = F.concat(F.lit('<tr><td><input name="hsSgn_Mn" value="'), F.substring("hs10", 1, 6), F.lit('" /></td><td class="hlzoneWrd">6</td></tr>'))
    rows = p.withColumn("x", F.concat(head, row(first), F.coalesce(row(second), F.lit(""))))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda r: r["x"]), "")
    chapters = rows.groupBy("reference_year", "chapter", F.floor(F.col("k") / PAGE_KEYS).alias("page")).agg(F.concat(F.lit('<table><tbody id="tblLstBody">'), body, F.lit("</tbody></table>")).alias("html"))
    inputs = F.array_join(F.transform(F.array_sort(F.collect_set("chapter")), lambda c: F.concat(F.lit('<input name="hstdCd" value="'), c, F.lit('" />'))), "")
    year = F.col("reference_year").cast("string")
    field = lambda name, value: F.concat(F.lit(f'<input name="{name}" value="'), value, F.lit('" />'))
    index = rows.groupBy("reference_year").agg(inputs.alias("i")).select("reference_year", F.concat(F.lit("<form>"), field("aplyYy", year), field("sctYear", F.concat(year, F.lit("0101"))), field("hstdYear", F.lit("20220101")), "i", F.lit("</form>")).alias("html"))
    return index, chapters
