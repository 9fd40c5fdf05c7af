"""Annual code editions and the partner dimension: lookup, gaps, conflicts, label resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..storage import by_sorting


def revision_lookup(facts: DataFrame, editions: DataFrame) -> DataFrame:
    """Facts with ``hs_revision`` of their year's edition; unknown codes stay, with null.

    Spark broadcasts the editions if its size check allows and sorts both sides otherwise.
    """
    keys = editions.select(F.col("reference_year").cast("string").alias("__year"), F.col("hs10").alias("__code"), "hs_revision").distinct()
    return facts.join(keys, (F.substring("month", 1, 4) == F.col("__year")) & (F.col("hs10") == F.col("__code")), "left").drop("__year", "__code")


def reference_gaps(facts: DataFrame, editions: DataFrame, name: str = "name_ko") -> DataFrame:
    """Codes that their year's edition lacks: rows, months and names."""
    unknown = revision_lookup(facts, editions).where("hs_revision is null")
    listed = lambda c, sep: F.array_join(F.array_sort(F.collect_set(c)), sep)
    return unknown.groupBy(F.substring("month", 1, 4).alias("year"), "hs10").agg(F.count("*").alias("rows"), listed("month", ",").alias("months"), listed(F.nullif(F.col(name), F.lit("")), " | ").alias("names"))


def require_one_revision(editions: DataFrame) -> None:
    """Raise if the table is empty or a year gives a code two revisions; a plain copy of a row is harmless."""
    if editions.isEmpty():
        raise ValueError("the code reference is empty")
    bad = reference_conflicts(editions).limit(5).collect()
    if bad:
        raise ValueError(f"several revisions of {[(r['reference_year'], r['hs10']) for r in bad]}")


def reference_conflicts(editions: DataFrame) -> DataFrame:
    """(year, code) pairs with more than one revision."""
    return editions.groupBy("reference_year", "hs10").agg(F.countDistinct("hs_revision").alias("revisions")).where("revisions > 1")


def duplicate_rows(dimension: DataFrame, keys: list[str]) -> DataFrame:
    return dimension.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def name_inventory(facts: DataFrame, name: str = "name_ko") -> DataFrame:
    """Per code: its names, years and countries as JSON lists, the first and the last month."""
    listed = lambda c: F.to_json(F.array_sort(F.collect_set(c)))
    own = F.nullif(F.col(name), F.lit(""))
    return facts.groupBy("hs10").agg(
        F.countDistinct(own).alias("name_count"), listed(own).alias("names_json"), listed(F.substring("month", 1, 4)).alias("years_observed_json"), listed("country_code").alias("countries_observed_json"),
        F.min("month").alias("first_trade_month_observed"), F.max("month").alias("last_trade_month_observed"),
    )


def name_variants(facts: DataFrame, order: list[str], name: str = "name_ko", examples: int = 20, names_each: int = 5) -> DataFrame:
    """The first codes with several names, by first appearance in ``order``, and some of these names."""
    sets = facts.groupBy("hs10").agg(F.array_sort(F.collect_set(name)).alias("n"), F.min(F.struct(*order)).alias("seen"))
    return sets.where(F.size("n") > 1).orderBy("seen", "hs10").limit(examples).select("hs10", F.array_join(F.slice("n", 1, names_each), "|").alias("names"))


def labels_compatible(a: Column, b: Column) -> Column:
    """Equal, or one begins with the other, or one is blank; white space at the ends doesn't count."""
    a, b = strip(F.coalesce(a, F.lit(""))), strip(F.coalesce(b, F.lit("")))
    return (a == "") | (b == "") | F.startswith(a, b) | F.startswith(b, a)


def label_score(ko: Column, en: Column) -> Column:
    """Non-blank labels, their length, the first one's length."""
    ko, en = F.coalesce(ko, F.lit("")), F.coalesce(en, F.lit(""))
    return F.struct(((ko != "").cast("int") + (en != "").cast("int")).alias("filled"), (F.length(ko) + F.length(en)).alias("total"), F.length(ko).alias("first"))


#: What a duplicate's audit says.
COMPATIBLE, PENDING = "prefer_more_specific_compatible_label", "prefer_first_source_order_pending_adjacent_year_review"


def resolve_duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key by a left fold in document order.

    A compatible later label replaces the kept one if it scores strictly higher; an incompatible one leaves the
    kept one and is a conflict.  ``audit`` lists each step that met another label: the kept and the new pair,
    the pair chosen, and how.  A key's rows are the copies in one response, so a group is a handful of rows.
    """
    item = F.struct("ordinal", "name_ko", "name_en")
    step = "struct<first_ko:string,first_en:string,second_ko:string,second_en:string,selected_ko:string,selected_en:string,resolution:string>"
    start = F.struct(F.col("x")[0]["name_ko"].alias("name_ko"), F.col("x")[0]["name_en"].alias("name_en"), F.lit(0).alias("conflicts"), F.array().cast(f"array<{step}>").alias("audit"))

    def fold(kept: Column, new: Column) -> Column:
        same = kept["name_ko"].eqNullSafe(new["name_ko"]) & kept["name_en"].eqNullSafe(new["name_en"])
        fits = labels_compatible(kept["name_ko"], new["name_ko"]) & labels_compatible(kept["name_en"], new["name_en"])
        better = fits & (label_score(new["name_ko"], new["name_en"]) > label_score(kept["name_ko"], kept["name_en"]))
        ko, en = (F.when(better, new[c]).otherwise(kept[c]) for c in ("name_ko", "name_en"))
        note = F.struct(
            kept["name_ko"].alias("first_ko"), kept["name_en"].alias("first_en"), new["name_ko"].alias("second_ko"), new["name_en"].alias("second_en"),
            ko.alias("selected_ko"), en.alias("selected_en"), F.when(fits, COMPATIBLE).otherwise(PENDING).alias("resolution"),
        )
        audit = F.when(same, kept["audit"]).otherwise(F.concat(kept["audit"], F.array(note)))
        return F.struct(ko.alias("name_ko"), en.alias("name_en"), (kept["conflicts"] + F.when(fits, 0).otherwise(1)).alias("conflicts"), audit.alias("audit"))

    lists = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("x"))
    kept = F.aggregate(F.slice("x", 2, F.greatest(F.size("x"), F.lit(1))), start, fold)
    return lists.select(*keys, F.size("x").alias("copies"), kept.alias("k")).select(*keys, "copies", "k.name_ko", "k.name_en", "k.conflicts", "k.audit")


def require_same_beside_names(rows: DataFrame, keys: list[str], names: tuple[str, ...] = ("name_ko", "name_en", "ordinal")) -> None:
    """Raise if copies of a key differ in anything but their labels."""
    rest = [c for c in rows.columns if c not in (*keys, *names)]
    if rest:
        own = F.struct(*rest)
        bad = rows.groupBy(*keys).agg(F.min(own).alias("least"), F.max(own).alias("most")).where("not least <=> most").select(*keys).limit(5).collect()
        if bad:
            raise ValueError(f"conflicting copies of {[tuple(r) for r in bad]}")


#: What a review by the neighbouring years ends in.
FIRST_IS_CURRENT, SECOND_IS_CURRENT, UNRESOLVED = (
    "adjacent_year_validated_revision_transition_first_is_current",
    "adjacent_year_validated_revision_transition_second_is_current",
    "unresolved_conflicting_label_after_adjacent_year_review",
)
PAIR = "struct<name_ko:string,name_en:string>"


def adjacent_review(pending: DataFrame, editions: DataFrame) -> DataFrame:
    """Settle pending label conflicts (year, code, first and second pair of labels) by the neighbouring years' pairs.

    Before second, after first: the first is current.  Before first, after second: the second replaces it.  Years are
    reviewed in order, as a fold over each code's pending years: a year that the review rewrote counts with
    its new pair for the next.  Several conflicts of one year are told apart by ``step`` (0 where there is
    none), and the last rewrite of a year stays.  A code's group is its pending years and their conflicts, not rows.
    """
    key = ["reference_year", "hs10"]
    if "step" not in pending.columns:
        pending = pending.withColumn("step", F.lit(0))
    item = F.struct("step", F.struct(F.col("first_ko").alias("name_ko"), F.col("first_en").alias("name_en")).alias("first"), F.struct(F.col("second_ko").alias("name_ko"), F.col("second_en").alias("name_en")).alias("second"))
    years = pending.groupBy(*key).agg(F.array_sort(F.collect_list(item)).alias("conflicts"))
    pair = lambda by, name: editions.select((F.col("reference_year") + by).alias("reference_year"), "hs10", F.struct(F.col("name_ko").cast("string").alias("name_ko"), F.col("name_en").cast("string").alias("name_en")).alias(name))
    years = years.join(by_sorting(pair(1, "previous")), key, "left").join(by_sorting(pair(-1, "following")), key, "left")
    codes = years.groupBy("hs10").agg(F.array_sort(F.collect_list(F.struct("reference_year", "conflicts", "previous", "following"))).alias("years"))

    same = lambda a, b: F.coalesce(a.isNotNull() & a["name_ko"].eqNullSafe(b["name_ko"]) & a["name_en"].eqNullSafe(b["name_en"]), F.lit(False))

    def decided(x: Column, before: Column, after: Column) -> Column:
        keep, use = same(before, x["second"]) & same(after, x["first"]), same(before, x["first"]) & same(after, x["second"])
        resolution = F.when(keep, FIRST_IS_CURRENT).when(use, SECOND_IS_CURRENT).otherwise(UNRESOLVED)
        return F.struct(x["step"].alias("step"), resolution.alias("resolution"), F.when(use, x["second"]).otherwise(x["first"]).alias("chosen"), before.alias("adjacent_previous"), after.alias("adjacent_next"))

    decision = f"struct<step:int,resolution:string,chosen:{PAIR},adjacent_previous:{PAIR},adjacent_next:{PAIR}>"
    start = F.struct(F.lit(None).cast("int").alias("year"), F.lit(None).cast(PAIR).alias("rewritten"), F.array().cast(f"array<struct<reference_year:int,decisions:array<{decision}>>>").alias("out"))

    def fold(state: Column, y: Column) -> Column:
        carried = (state["year"] == y["reference_year"] - 1) & state["rewritten"].isNotNull()
        before = F.when(F.coalesce(carried, F.lit(False)), state["rewritten"]).otherwise(y["previous"])
        decisions = F.transform(y["conflicts"], lambda x: decided(x, before, y["following"]))
        last = F.element_at(F.concat(F.array(F.lit(None).cast(PAIR)), F.transform(F.filter(decisions, lambda d: d["resolution"] == SECOND_IS_CURRENT), lambda d: d["chosen"])), -1)
        year = y["reference_year"].cast("int")
        return F.struct(year.alias("year"), last.alias("rewritten"), F.concat(state["out"], F.array(F.struct(year.alias("reference_year"), decisions.cast(f"array<{decision}>").alias("decisions")))).alias("out"))

    out = codes.select("hs10", F.explode(F.aggregate("years", start, fold, lambda s: s["out"])).alias("y")).select("hs10", "y.reference_year", F.explode("y.decisions").alias("d"))
    year = out["reference_year"].cast(editions.schema["reference_year"].dataType)
    return out.select(year.alias("reference_year"), "hs10", "d.step", "d.resolution", "d.chosen.name_ko", "d.chosen.name_en", "d.adjacent_previous", "d.adjacent_next")


def rewrites(reviewed: DataFrame) -> DataFrame:
    """The label changes that a review asks for: of a year's several the last."""
    used = reviewed.where(F.col("resolution") == SECOND_IS_CURRENT)
    return used.groupBy("reference_year", "hs10").agg(F.max_by(F.struct("name_ko", "name_en"), "step").alias("x")).select("reference_year", "hs10", "x.*")


def review_figures(reviewed: DataFrame) -> DataFrame:
    n = lambda *d: F.count_if(F.col("resolution").isin(*d))
    return reviewed.agg(F.count("*").alias("reviewed"), n(FIRST_IS_CURRENT, SECOND_IS_CURRENT).alias("resolved"), n(UNRESOLVED).alias("unresolved"), n(SECOND_IS_CURRENT).alias("annual_name_rewrites"))


def rewrite_name(editions: DataFrame, changes: DataFrame) -> DataFrame:
    """Editions with the changed labels (year, code, name_ko, name_en)."""
    new = changes.select("reference_year", "hs10", F.struct("name_ko", "name_en").alias("__new"))
    out = editions.join(by_sorting(new), ["reference_year", "hs10"], "left")
    label = lambda c: F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c))
    return out.withColumns({c: label(c) for c in ("name_ko", "name_en")}).select(editions.columns)


def require_matches(editions: DataFrame, changes: DataFrame) -> None:
    """Raise unless each change meets exactly one row."""
    counts = changes.join(by_sorting(editions.select("reference_year", "hs10", F.lit(1).alias("one"))), ["reference_year", "hs10"], "left").groupBy("reference_year", "hs10").agg(F.count("one").alias("n"))
    if not counts.where("n <> 1").isEmpty():
        raise ValueError("a label change must match exactly one row")


def combine_editions(editions: list[DataFrame]) -> DataFrame:
    """Union of annual tables; schemas must agree and (year, code) must be unique."""
    out = editions[0]
    for e in editions[1:]:
        if e.dtypes != out.dtypes:
            raise ValueError("annual tables differ in their schema")
        out = out.unionByName(e)
    if not duplicate_rows(out, ["reference_year", "hs10"]).isEmpty():
        raise ValueError("a year lists a code twice")
    return out


def enrich_partners(partners: DataFrame, international: DataFrame) -> DataFrame:
    """Partners with international names and codes by exact two-letter code; blanks where there is none."""
    i = international.select("alpha2", "un_m49", "iso_alpha3", "country_name_en")
    out = partners.join(i, partners["country_code"] == i["alpha2"], "left")
    status = F.when(F.col("alpha2").isNotNull(), "matched_current_un").otherwise("unmatched_kcs_code")
    return out.select("country_code", "country_name_ko", *[F.coalesce(c, F.lit("")).alias(c) for c in ("country_name_en", "un_m49", "iso_alpha3")], status.alias("un_match_status"))


def partner_universe(partners: DataFrame, extra: list[str], without: list[str] = (), na_compat: bool = False) -> DataFrame:
    """Matched partners and some others; ``na_compat`` drops NA, as readers do that take it for a missing value."""
    chosen = partners.where((F.col("un_match_status") == "matched_current_un") | F.col("country_code").isin(list(extra)))
    gone = [*without, *(["NA"] if na_compat else [])]
    return chosen.where(~F.col("country_code").isin(gone)) if gone else chosen
