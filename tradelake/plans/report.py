"""What a trial collection shows: outcomes as JSON and CSV, audits of names and short codes, a report to read."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators import normalize, outcomes, reference
from ..sources import responses
from . import release

#: Lines of a kind that the report shows; the CSV files have all.
SHOWN = 20
RULE = "A country's year passes if none of its requests stayed unanswered, rows came for each month that was asked for, their codes all have ten digits, and no month lists a country and code twice."


def name_audit(rows: DataFrame) -> DataFrame:
    """Inventory of the names under which ten-digit codes appear in raw rows."""
    facts = rows.where("month is not null and hs_code_raw rlike '^[0-9]{10}$'")
    return reference.name_inventory(facts.select("month", F.col("hs_code_raw").alias("hs10"), F.col("requested_country").alias("country_code"), "name_ko"))


def markdown(figures: dict, roots: list[dict], notes: list[str] = ()) -> str:
    """The report's text; ``notes`` are lines on names that changed and on codes of several lengths."""
    head = ["# What a trial collection brought", "", "## In numbers", "", *[f"- {k}: {v}" for k, v in figures.items()], "", "## Countries and years", ""]
    table = ["| Partner | Months asked | Outcome | Requests | Rows | Rows by code length | Months found | Months missing | Judgement |", "|---|---|---|---:|---:|---|---:|---|---|"]
    for r in roots:
        lengths = json.dumps(r["hs_length_counts"] or {}, ensure_ascii=False)
        table.append(f"| {r['country']} | {r['window_start']}-{r['window_end']} | {r['status']} | {r['leaf_requests']} | {r['fact_row_count']:,} | `{lengths}` | {r['month_count']} | {r['missing_months'] or '-'} | {r['verdict']}: {r['reasons']} |")
    return "\n".join([*head, *table, "", "## Names and short codes", "", *(notes or ["Nothing to tell."]), "", "## When a year passes", "", RULE, ""])


def write_pilot(spark: SparkSession, done: DataFrame, roots: DataFrame, target: str) -> dict:
    """Write ``pilot_results`` (JSON, CSV), ``hs_name_inventory``, ``hs_name_changes``, ``non_hs10_rows`` and ``pilot_report.md``."""
    done.coalesce(1).write.mode("overwrite").json(f"{target}/pilot_results.json")
    release.write_csv(done, f"{target}/pilot_results.csv", ["country", "window_start", "window_end"])
    leaves = outcomes.effective_leaves(done)
    good = leaves.where("success")
    paths = [r["raw_path"] for r in good.select("raw_path").collect()]  # a trial's
    rows, notes = responses.raw_columns(responses.read_items(spark, paths)) if paths else None, []
    figures = {
        "Country years": roots.count(), "Requests that count": leaves.count(), "Requests answered": len(paths), "Requests unanswered": leaves.where("not success").count(),
        **{label: good.agg(F.coalesce(F.sum(c), F.lit(0))).first()[0] for label, c in (("Rows read", "fact_row_count"), ("Bytes of XML", "response_bytes"), ("Rows of short codes", "non_hs10_fact_rows"), ("Rows listed again", "duplicate_key_rows"))},
    }
    if rows is not None:
        inventory = name_audit(rows)
        release.write_csv(inventory, f"{target}/hs_name_inventory.csv", ["hs10"])
        changes = inventory.where("name_count > 1")
        release.write_csv(changes, f"{target}/hs_name_changes.csv", ["hs10"])
        short = normalize.short_code_observations(rows)
        release.write_csv(short, f"{target}/non_hs10_rows.csv", ["requested_country", "month", "hs_code_raw"])
        own = normalize.short_code_figures(short).first()
        notes += [f"- {r['hs10']} is called {r['names_json']} from {r['first_trade_month_observed']} to {r['last_trade_month_observed']}" for r in changes.orderBy("hs10").limit(SHOWN).collect()]
        mixed = rows.where(~normalize.is_summary()).groupBy("requested_country", "month").agg(F.array_sort(F.collect_set(F.length("hs_code_raw"))).alias("lengths")).where("size(lengths) > 1")
        notes += [f"- {r['requested_country']} has codes of {', '.join(map(str, r['lengths']))} digits in {r['month']}" for r in mixed.orderBy("requested_country", "month").limit(SHOWN).collect()]
        figures |= {"Codes with several names": changes.count(), "Short codes by length": own["lengths"], "Exports of short codes, USD": own["export_usd"], "Imports of short codes, USD": own["import_usd"]}
    verdicts = [r.asDict() for r in outcomes.root_verdicts(roots, done).orderBy("country", "window_start").collect()]  # a trial's
    storage.write_text(spark, f"{target}/pilot_report.md", markdown(figures, verdicts, notes))
    return figures
