"""Annual code editions: pages of the tariff service to one reference of all years."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators import reference
from ..sources import html_tables, web

SOURCE, KEY = "annual tariff tables", ["reference_year", "hs10"]


def cached_pages(spark: SparkSession, year: int, cache: str, fetch: Callable[[str, dict], bytes], force: bool = False, only: list[str] | None = None, told: list[dict] | None = None, pause: float = 0.0) -> tuple[dict, list[tuple[int, str, str]], int]:
    """A year's index, its (year, chapter, page) and how many were in the cache; ``fetch`` posts "index" or "detail" forms.

    ``told`` gets where each chapter's page is kept, its bytes and SHA-256, and whether it was there.
    """
    folder = f"{cache}/year={year}"
    page, reused = web.cached(spark, f"{folder}/index.html.gz", lambda: fetch("index", web.form(year)), force)
    index = html_tables.year_index(web.html_text(page), year)
    chapters = index["chapters"] if only is None else [c for c in index["chapters"] if c in only]
    if only is not None and set(only) - set(chapters):
        raise ValueError(f"unknown chapters of {year}: {sorted(set(only) - set(chapters))}")
    pages, n = [], int(reused)
    for chapter in chapters:
        path = f"{folder}/chapter={chapter}.html.gz"
        body, was = web.cached(spark, path, lambda c=chapter: fetch("detail", web.form(year, index, c)), force)
        pages.append((year, chapter, web.html_text(body)))
        n += was
        if told is not None:
            told.append({"chapter": chapter, "cache_path": path, "bytes": len(body), "sha256": hashlib.sha256(body).hexdigest(), "cache_reused": was})
        if not was and pause:
            time.sleep(pause)
    return index, pages, n


def collect_year(spark: SparkSession, year: int, cache: str, root: str, fetch: Callable[[str, dict], bytes], force: bool = False, only: list[str] | None = None, pause: float = 0.0, url: str = "") -> tuple[dict, DataFrame]:
    """Write a year's edition below ``root`` and say where each of its chapters comes from; returns that and the labels' audit.

    With ``only``, some chapters for a trial, the table is a probe file beside the edition, which stays as it is.
    """
    told: list[dict] = []
    index, pages, reused = cached_pages(spark, year, cache, fetch, force, only, told, pause)
    rows = storage.written(html_tables.chapter_table(spark.createDataFrame(pages, "reference_year int, chapter string, html string")), "chapters")
    counts = {r["chapter"]: r["count"] for r in rows.groupBy("chapter").count().collect()}  # a row a chapter
    if not counts:
        raise ValueError(f"no code on the pages of {year}")
    labels, audit = labelled_rows(rows)
    audit = storage.written(audit, "label-audit")
    years = spark.createDataFrame([(year, index["clip_sct_year"], index["clip_hstd_year"])], "reference_year int, clip_sct_year string, clip_hstd_year string")
    chosen = [t["chapter"] for t in told]
    full = set(chosen) == set(index["chapters"])
    target = f"{root}/year={year}/" + ("hsk10.parquet" if full else f"hsk10_probe_{'-'.join(chosen)}.parquet")
    html_tables.edition_rows(labels, years, SOURCE, url).orderBy("hs10").write.mode("overwrite").option("compression", "zstd").parquet(f"{target}.staging")
    storage.swap(spark, f"{target}.staging", target)
    edition = spark.read.parquet(target)
    blank = lambda c: F.count_if(F.coalesce(F.trim(c), F.lit("")) == "")
    figures = edition.agg(F.count("*").alias("hsk10_rows"), blank("name_ko").alias("missing_name_ko"), blank("name_en").alias("missing_name_en")).first().asDict()
    told = [t | {"hsk10_rows": counts.get(t["chapter"], 0)} for t in told]
    stats = {"year": year, "clip_sct_year": index["clip_sct_year"], "clip_hstd_year": index["clip_hstd_year"], "chapter_count": len(chosen), "full_year": full, **figures, "duplicate_name_variant_count": audit.count()}
    return stats | {"fetched_files": 1 + len(told) - reused, "cached_files": reused, "annual_parquet": target, "source_files": told}, audit


def combine(spark: SparkSession, years: list[int], root: str, target: str, audit: DataFrame | None = None) -> dict:
    """One reference of the years' written editions; pending conflicts of ``audit`` are settled first, or stop it."""
    found = []
    for year in years:
        path = f"{root}/year={year}/hsk10.parquet"
        if not storage.exists(spark, path):
            raise FileNotFoundError(f"no edition of {year}: {path}")
        found.append(spark.read.parquet(path))
    whole = reference.combine_editions(found)
    figures = {}
    if audit is not None:
        names, decisions = reviewed(whole.select(F.col("reference_year").cast("int"), "hs10", "name_ko", "name_en"), audit)
        figures = reference.review_figures(decisions).first().asDict()
        if figures["unresolved"]:
            raise ValueError(f"{figures['unresolved']} labels conflict after the neighbouring years' review")
        whole = whole.drop("name_ko", "name_en").join(storage.by_sorting(names.withColumn("reference_year", F.col("reference_year").cast("smallint"))), KEY).select(found[0].columns)
    whole.orderBy(*KEY).write.mode("overwrite").option("compression", "zstd").parquet(f"{target}.staging")
    storage.swap(spark, f"{target}.staging", target)
    counts = {str(r["reference_year"]): r["count"] for r in spark.read.parquet(target).groupBy("reference_year").count().collect()}
    return {"rows": sum(counts.values()), "year_rows": counts} | figures


def collect_editions(spark: SparkSession, years: list[int], cache: str, root: str, target: str, manifest: str, fetch: Callable[[str, dict], bytes], force: bool = False, pause: float = 0.0, url: str = "") -> dict:
    """All years' editions, reviewed and combined, and a manifest of where everything comes from."""
    each = [collect_year(spark, year, cache, root, fetch, force, pause=pause, url=url) for year in years]
    audits = [a for _, a in each]
    combined = combine(spark, years, root, target, reduce(DataFrame.unionByName, audits))
    out = {"source": SOURCE, "source_url": url, "years": years, "year_stats": [s for s, _ in each], "combined": combined}
    storage.write_text(spark, manifest, json.dumps(out, ensure_ascii=False, indent=2))
    return out


def labelled_rows(chapters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row for each year and code, and the audit of copies with other labels.  A code in two chapters is an error.

    ``chapters`` is read twice, so it should be a written table; the folded codes are written, because rows and audit read them.
    """
    reference.require_same_beside_names(chapters, KEY)
    resolved = storage.written(reference.resolve_duplicates(chapters, KEY), "labels")
    audit = resolved.select(*KEY, F.posexplode("audit").alias("step", "a")).select(*KEY, "step", "a.*")
    return resolved.select(*KEY, "name_ko", "name_en"), audit


def reviewed(rows: DataFrame, audit: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose pending conflicts the neighbouring years have settled, in the years' order, and the decisions."""
    pending = audit.where(F.col("resolution") == reference.PENDING).select(*KEY, "step", "first_ko", "first_en", "second_ko", "second_en")
    decisions = storage.written(reference.adjacent_review(pending, rows), "decisions")
    changes = reference.rewrites(decisions)
    reference.require_matches(rows, changes)
    return reference.rewrite_name(rows, changes), decisions


def build(spark: SparkSession, index_pages: DataFrame, chapter_pages: DataFrame, target: str, url: str = "") -> dict:
    """Write the reference of all years; a conflict that the neighbouring years leave open stops it."""
    path = storage.scratch(spark, "editions")
    html_tables.chapter_table(chapter_pages).write.parquet(f"{path}/chapters")
    index = html_tables.index_table(index_pages)
    rows, audit = labelled_rows(spark.read.parquet(f"{path}/chapters"))
    rows, decisions = reviewed(rows, audit)
    figures = reference.review_figures(decisions).first().asDict()
    if figures["unresolved"]:
        raise ValueError(f"{figures['unresolved']} labels conflict after the neighbouring years' review")
    editions = html_tables.edition_rows(rows, index, SOURCE, url)
    years = [editions.where(F.col("reference_year") == r[0]) for r in editions.select("reference_year").distinct().orderBy("reference_year").collect()]
    whole = reference.combine_editions(years)
    staging = f"{target}.staging"
    whole.orderBy(*KEY).write.mode("overwrite").option("compression", "zstd").parquet(staging)
    storage.swap(spark, staging, target)
    written = spark.read.parquet(target)
    counts = {str(r["reference_year"]): r["count"] for r in written.groupBy("reference_year").count().collect()}
    return {"rows": sum(counts.values()), "year_rows": counts, "duplicate_name_variants": audit.count()} | figures
