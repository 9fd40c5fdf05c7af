"""Command line of the jobs: ``python -m tradelake.cli collect|pilot|editions|normalize|derive|qa|release ...``."""

from __future__ import annotations

import argparse
import json
import os
import sys
import uuid
from datetime import date

from . import storage
from .plans import collect, editions, release, report, stage11
from .session import build_session
from .sources import dimensions, http_api, web


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tradelake")
    p.add_argument("--data-dir", default="data")
    p.add_argument("--master")
    sub = p.add_subparsers(dest="job", required=True)
    c = sub.add_parser("collect", help="ask the service for a plan of countries and years")
    c.add_argument("mode", choices=["backfill", "refresh"])
    c.add_argument("--url", required=True)
    c.add_argument("--start-month", default="201201")
    c.add_argument("--end-month")
    c.add_argument("--lookback-months", type=int, default=12)
    c.add_argument("--countries", nargs="+")
    c.add_argument("--order", choices=["year-country", "country-year"], default="year-country")
    c.add_argument("--max-roots", type=int)
    c.add_argument("--retries", type=int, default=2)
    c.add_argument("--rate-limit-retries", type=int, default=4)
    c.add_argument("--request-delay", type=float, default=0.15)
    c.add_argument("--key-name", required=True, help="the environment's or .env file's name of the key")
    c.add_argument("--force", action="store_true")
    c.add_argument("--dry-run", action="store_true")
    t = sub.add_parser("pilot", help="a trial of some countries and years, with a report")
    t.add_argument("--url", required=True)
    t.add_argument("--countries", nargs="+", required=True)
    t.add_argument("--years", nargs="+", type=int, required=True)
    t.add_argument("--retries", type=int, default=2)
    t.add_argument("--key-name", required=True, help="the environment's or .env file's name of the key")
    t.add_argument("--force", action="store_true")
    e = sub.add_parser("editions", help="annual code tables from the tariff service's pages")
    e.add_argument("step", choices=["probe", "collect", "combine"])
    e.add_argument("--index-url", default="")
    e.add_argument("--detail-url", default="")
    e.add_argument("--start-year", type=int, required=True)
    e.add_argument("--end-year", type=int)
    e.add_argument("--chapter", default="01")
    e.add_argument("--sleep", type=float, default=0.2)
    e.add_argument("--force", action="store_true")
    n = sub.add_parser("normalize", help="responses to canonical facts")
    n.add_argument("--start-month")
    n.add_argument("--end-month")
    n.add_argument("--require-full-coverage", action="store_true")
    n.add_argument("--dry-run", action="store_true")
    d = sub.add_parser("derive", help="facts to levels")
    d.add_argument("--levels", nargs="+", type=int, default=[8, 6, 4, 2])
    q = sub.add_parser("qa", help="check what a release is made of")
    q.add_argument("--documents", nargs="*", default=[])
    r = sub.add_parser("release", help="package what passed")
    r.add_argument("--output", required=True)
    r.add_argument("--title", default="Trade by partner and product")
    r.add_argument("--documents", nargs="*", default=[])
    for x in (n, d, r):
        x.add_argument("--overwrite", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    """0: well; 2: a check or some requests failed; 3: a limit ended the collection; 130: it was interrupted."""
    a = parser().parse_args(argv)
    spark = build_session("tradelake", a.master)
    partners = lambda wanted=None: dimensions.read_partners(spark, f"{a.data_dir}/reference/country_reference.csv", requested=wanted)
    if a.job == "collect":
        start, end = collect.refresh_range(spark, date.today().isoformat(), a.lookback_months, a.end_month)
        if a.mode == "backfill":
            start = a.start_month
        roots = collect.root_plan(spark, partners(a.countries), start, end, a.order == "country-year", a.max_roots)
        if a.dry_run:
            print(json.dumps({"collection_range": f"{start}-{end}", "planned_roots": roots.count()}))
            return 0
        http_api.read_dotenv(".env")
        options = {"url": a.url, "key": os.environ[a.key_name], "data_dir": a.data_dir, "retries": str(a.retries), "delay": str(a.request_delay)}
        run = collect.collect(spark, roots, options, rate_limit_retries=a.rate_limit_retries, force=a.force or a.mode == "refresh", progress=lambda line: print(line, file=sys.stderr, flush=True))
        print(json.dumps({k: v for k, v in run.items() if k != "roots"}))
        return collect.exit_code(run)
    if a.job == "pilot":
        http_api.read_dotenv(".env")
        plan = [(c.upper(), f"{y}01", f"{y}12") for c in a.countries for y in a.years]
        roots = spark.createDataFrame(plan, "country string, window_start string, window_end string")
        options = {"url": a.url, "key": os.environ[a.key_name], "data_dir": a.data_dir, "retries": str(a.retries), "run": f"audits/runs/pilot-{uuid.uuid4().hex}"}
        done = collect.collect_with_split(spark, roots, options, force=a.force)
        collect.save_manifests(spark, done, a.data_dir, a.url)
        storage.delete(spark, f"{a.data_dir}/{options['run']}")
        figures = report.write_pilot(spark, done, roots, f"{a.data_dir}/audits/pilot")
        print(json.dumps(figures, ensure_ascii=False))
        return 3 if done.where("status = 'quota_exceeded'").count() else 2 if figures["Requests unanswered"] else 0
    try:
        if a.job == "editions":
            years, top = list(range(a.start_year, (a.end_year or a.start_year) + 1)), f"{a.data_dir}/reference"
            fetch = lambda kind, form: web.post(a.index_url if kind == "index" else a.detail_url, form)
            cache, root, target = f"{top}/source/pages", f"{top}/hsk_codes", f"{top}/hsk_code_reference.parquet"
            if a.step == "probe":
                out = {k: v for k, v in editions.collect_year(spark, a.start_year, cache, root, fetch, a.force, [a.chapter.zfill(2)], url=a.detail_url)[0].items() if k != "source_files"}
            elif a.step == "combine":
                out = editions.combine(spark, years, root, target)
            else:
                out = editions.collect_editions(spark, years, cache, root, target, f"{a.data_dir}/audits/hsk_reference/hsk_reference_manifest.json", fetch, a.force, a.sleep, a.detail_url)["combined"]
        elif a.job == "normalize":
            codes = spark.read.parquet(f"{a.data_dir}/reference/hsk_code_reference.parquet")
            out = stage11.normalize_job(spark, a.data_dir, codes, partners(), a.start_month, a.end_month, a.require_full_coverage, a.overwrite, a.dry_run)
        elif a.job == "derive":
            out = stage11.derive_job(spark, a.data_dir, tuple(dict.fromkeys(a.levels)), a.overwrite)
        elif a.job == "qa":
            out = release.qa_report(spark, a.data_dir, a.documents)
            print(json.dumps({k: out[k] for k in ("release_gate_pass", "fatal_sections", "warnings")}))
            return 0 if out["release_gate_pass"] else 2
        else:
            out = release.build(spark, a.data_dir, a.output, a.title, a.documents, overwrite=a.overwrite)
    except (stage11.CheckFailed, FileExistsError, FileNotFoundError, ValueError) as error:
        print(error, file=sys.stderr)
        return 2
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
