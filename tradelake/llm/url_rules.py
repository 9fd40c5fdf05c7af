"""URL filter by hashed expressions: host suffixes and path prefixes, short hash prefixes, full digests.

The lookup works as safe-browsing lists do.  Every rule is a host and a path (``example.com/en/``); it
fits its host and all subdomains of it, where the URL's path starts with the rule's.  A URL is expanded
into the expressions that a rule fitting it could have: its host suffixes at label boundaries, each with
its path's prefixes of the lengths that rules have.  Expressions and rules are joined on the first four
bytes of their SHA-256, matches confirmed by the whole digest, and the longest rule wins.

Everything is DataFrame expressions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower

#: Rules up to this many take part in the join as a broadcast side if Spark's own size check allows it.
PREFIX_HEX = 8
DEFAULT_VERDICT = "allow"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (verdict, host, path) as a DataFrame with columns ``verdict``, ``rule_host`` and ``rule_path``."""
    return spark.createDataFrame(rules, "verdict string, rule_host string, rule_path string")


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``pages``; columns of these names are replaced.

    A null URL or one without ``://`` has an empty host and path and gets the default.  An empty host or
    path is still expanded, so a rule with an empty host or path would fit it.  Of rules of one length the
    one with the longer host wins, then block before allow.  Rules with a null part never fit.  Repeated
    rows are kept.  Each distinct pair of host and path is judged once, so a URL that a third of all rows
    share costs one lookup and the rows get their verdicts from a join that adaptive execution can split.
    """
    rows = pages.drop("host", "path", "rule", "verdict").withColumns({"host": url_host(F.col(url_col)), "path": url_path(F.col(url_col))})
    rules = (
        rules.where("verdict is not null and rule_host is not null and rule_path is not null")
        .select("verdict", ascii_lower(F.col("rule_host")).alias("rule_host"), "rule_path")
        .distinct()
        .withColumn("digest", F.sha2(F.concat("rule_host", F.lit("\n"), "rule_path").cast("binary"), 256))
        .withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    )
    lengths = [r[0] for r in rules.select(F.length("rule_path")).distinct().collect()]  # as many as rules' paths have lengths
    pairs = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_distinct(F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths] or [F.lit(None).cast("string")]), lambda p: p.isNotNull()))
    asked = (
        pairs.select("host", "path", F.explode(suffixes).alias("s"), prefixes.alias("prefixes"))
        .select("host", "path", "s", F.explode("prefixes").alias("p"))
        .select("host", "path", F.sha2(F.concat("s", F.lit("\n"), "p").cast("binary"), 256).alias("asked"))
        .withColumn("short", F.substring("asked", 1, PREFIX_HEX))
    )
    order = F.struct(F.length(F.concat("rule_host", "rule_path")), F.length("rule_host"), F.col("verdict"), F.col("rule_host"), F.col("rule_path"))
    judged = (
        asked.join(rules, "short")
        .where(F.col("asked") == F.col("digest"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), order).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    return rows.join(judged, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
