"""Whole jobs: collection from a service on this machine, normalization, levels, checks, release, command line."""

import gzip
import json
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F
from test_io import collected, write_response  # noqa: F401

from tradelake import cli
from tradelake.operators import outcomes
from tradelake.plans import collect, release, report, stage11
from tradelake.sources import http_api, web

KEY = "SECRET+KEY=="
ENVELOPE = "<OpenAPI_ServiceResponse><cmmMsgHeader><errMsg>SERVICE ERROR</errMsg><returnAuthMsg>{}</returnAuthMsg><returnReasonCode>{}</returnReasonCode></cmmMsgHeader></OpenAPI_ServiceResponse>"


def answer(country, start, end):
    months = [f"{start[:4]}.{m:02d}" for m in range(int(start[4:]), int(end[4:]) + 1)]
    item = "<n:item xmlns:n='u'>" if country == "NS" else "<item>"
    items = "".join(f"<item><year>{m}</year><statCd>{country}</statCd><hsCd>0101219000</hsCd><statKor>말</statKor><expDlr>10</expDlr><expWgt>1</expWgt><impDlr>4</impDlr><impWgt>1</impWgt><balPayments>6</balPayments></item>" for m in months)
    return f"<response><header><resultCode>00</resultCode><resultMsg>NORMAL</resultMsg></header><body><items><item><year>total</year><hsCd>-</hsCd></item>{items}</items></body></response>", item


class Service(BaseHTTPRequestHandler):
    asked: Counter = Counter()

    def log_message(self, *_):
        pass

    def reply(self, status, body, announced=None):
        self.send_response(status)
        self.send_header("Content-Length", str(announced or len(body.encode())))
        self.end_headers()
        self.wfile.write(body.encode())

    def do_GET(self):
        q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        country, start, end = q["cntyCd"], q["strtYymm"], q["endYymm"]
        self.asked[country, start, end] += 1
        assert q["serviceKey"] == KEY
        good = answer(country, start, end)[0]
        if country == "US" and self.asked[country, start, end] == 1:
            return self.reply(200, good, len(good.encode()) + 50)  # broken off
        if country == "CN" and (end[4:] == "12" and start[4:] == "01" or start[4:] == "04" and end[4:] == "06"):
            return self.reply(503, "")
        if country == "QQ":
            return self.reply(200, ENVELOPE.format("LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS_ERROR", 22))
        if country == "RR" and self.asked[country, start, end] == 1:
            return self.reply(429, ENVELOPE.format("PER SECOND", 23))
        if country == "AA":
            return self.reply(403, ENVELOPE.format("UNREGISTERED", 30))
        if country == "HH":
            return self.reply(410, "gone")
        if country == "BB":
            return self.reply(200, "<response><header>")
        return self.reply(200, good)


    def do_POST(self):
        form = parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode(), keep_blank_values=True)
        self.asked["POST", self.path] += 1
        if self.path == "/empty":
            return self.reply(200, "")
        if self.path == "/later" and self.asked["POST", self.path] == 1:
            return self.reply(503, "")
        if self.path == "/never":
            return self.reply(404, "")
        return self.reply(200, f"{form['cntyNm'][0]} {form['searchVal'][0]}")


@pytest.fixture(scope="module")
def service():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/api"
    server.shutdown()


def options(service, folder):
    return {"url": service, "key": "SECRET%2BKEY%3D%3D", "data_dir": str(folder), "retries": "1", "pause": "0", "delay": "0", "timeout": "20"}


def roots_of(spark, *countries):
    return spark.createDataFrame([(c, "202501", "202512") for c in countries], "country string, window_start string, window_end string")


def test_collection_splits_keeps_and_resumes(spark, service, tmp_path):
    Service.asked.clear()
    run = collect.collect(spark, roots_of(spark, "US", "CN", "HH", "BB"), options(service, tmp_path))
    assert (run["attempted_roots"], run["successful_roots"], run["fact_row_count"], run["stopped_reason"]) == (4, 2, 24, None) and collect.exit_code(run) == 2
    assert Service.asked["US", "202501", "202512"] == 2 and Service.asked["CN", "202501", "202512"] == 2 and Service.asked["HH", "202501", "202512"] == 1
    assert {k[1:] for k in Service.asked if k[0] == "CN"} == {("202501", "202512"), ("202501", "202503"), ("202504", "202506"), ("202507", "202509"), ("202510", "202512"), ("202504", "202504"), ("202505", "202505"), ("202506", "202506")}
    statuses = {r["country"]: r["statuses"] for r in run["roots"]}
    assert statuses == {"US": ["success"], "CN": ["success"], "HH": ["http_error"], "BB": ["parse_error"]}
    raw = tmp_path / http_api.raw_path("US", "202501", "202512")
    assert gzip.decompress(raw.read_bytes()).decode() == answer("US", "202501", "202512")[0]
    texts = [p.read_text() for p in tmp_path.rglob("*.json")]
    assert texts and not any("SECRET" in t for t in texts)
    own = json.loads((tmp_path / http_api.manifest_path("US", "202501", "202512")).read_text())
    assert (own["status"], own["retry_count"], own["fact_row_count"], own["month_count"], own["hs_length_counts"], len(own["sha256"]), own["hsSgn_omitted"]) == ("success", 1, 12, 12, {"10": 12}, 64, True)

    before = Counter(Service.asked)
    again = collect.collect(spark, roots_of(spark, "US", "CN"), options(service, tmp_path))
    new = Service.asked - before
    assert (again["successful_roots"], again["checkpoint_reused_roots"], collect.exit_code(again)) == (2, 1, 0)
    assert set(new) == {("CN", "202501", "202512"), ("CN", "202504", "202506")}  # what had failed; its parts are kept

    done = collect.collect_with_split(spark, roots_of(spark, "US", "CN"), options(service, tmp_path), force=False)
    verdicts = {r["country"]: (r["status"], r["verdict"], r["leaf_requests"]) for r in outcomes.root_verdicts(roots_of(spark, "US", "CN"), done).collect()}
    assert verdicts == {"US": ("success", "PASS", 1), "CN": ("split_success", "PASS", 6)}
    figures = report.write_pilot(spark, done, roots_of(spark, "US", "CN"), str(tmp_path / "pilot"))
    assert figures["Rows read"] == 24 and figures["Requests unanswered"] == 0 and figures["Exports of short codes, USD"] == 0
    text = (tmp_path / "pilot/pilot_report.md").read_text()
    assert "| CN | 202501-202512 | split_success | 6 | 12 | `{\"10\": 12}` | 12 | - | PASS: all effective" in text
    assert (tmp_path / "pilot/hs_name_inventory.csv").is_dir() and (tmp_path / "pilot/non_hs10_rows.csv").is_dir()


def test_limits_end_a_run(spark, service, tmp_path):
    Service.asked.clear()
    run = collect.collect(spark, roots_of(spark, "QQ", "ZZ"), options(service, tmp_path), wave=1, force=True)
    assert (run["stopped_reason"], run["planned_roots"], run["attempted_roots"], collect.exit_code(run)) == (collect.QUOTA, 2, 1, 3) and not any(k[0] == "ZZ" for k in Service.asked)
    assert run["roots"][0]["failure_details"][0]["api_result_code"] == "22"
    run = collect.collect(spark, roots_of(spark, "RR"), options(service, tmp_path), force=True, pause=0.01)
    assert (run["stopped_reason"], run["successful_roots"], run["roots"][0]["rate_limit_retries"]) == (None, 1, 1)
    run = collect.collect(spark, roots_of(spark, "AA"), options(service, tmp_path), force=True)
    assert run["stopped_reason"] == collect.AUTH and Service.asked["AA", "202501", "202512"] == 1


def test_a_limit_stops_the_wave_that_it_comes_in(spark, service, tmp_path):
    """Requests after a quota answer are counted: none in its task, at most the one that each other task was in."""
    Service.asked.clear()
    many = ["QQ", *(f"W{i:02}" for i in range(30))]
    run = collect.collect(spark, roots_of(spark, *many), options(service, tmp_path / "one"), at_once=1, force=True)
    assert dict(Service.asked) == {("QQ", "202501", "202512"): 1} and (run["stopped_reason"], run["attempted_roots"], run["planned_roots"]) == (collect.QUOTA, 1, 31)
    Service.asked.clear()
    slow = options(service, tmp_path / "four") | {"delay": "0.3"}
    run = collect.collect(spark, roots_of(spark, *many), slow, at_once=3, force=True)
    assert run["stopped_reason"] == collect.QUOTA and run["attempted_roots"] == sum(Service.asked.values()) < 16
    assert not list((tmp_path / "four/audits/runs").glob("running-*"))
    again = collect.collect(spark, roots_of(spark, *many[1:]), options(service, tmp_path / "four"), at_once=3)
    assert again["successful_roots"] == 30 and again["checkpoint_reused_roots"] == run["successful_roots"]


def test_only_what_was_too_fast_is_sent_again(spark, service, tmp_path):
    Service.asked.clear()
    run = collect.collect(spark, roots_of(spark, "RR", "V1", "V2", "V3"), options(service, tmp_path), force=True, pause=0.01)
    assert {k[0]: n for k, n in Service.asked.items()} == {"RR": 2, "V1": 1, "V2": 1, "V3": 1} and run["successful_roots"] == 4
    assert {r["country"]: r["rate_limit_retries"] for r in run["roots"]} == {"RR": 1, "V1": 0, "V2": 0, "V3": 0}
    guard = http_api.Guard(options(service, tmp_path) | {"run": "audits/runs/x", "delay": "0.2"})
    assert guard.pace() == 0.2 and guard.stopped() is None
    guard.slow_down()
    guard.slow_down()
    guard.stop("why")
    assert guard.pace() == 0.8 and guard.stopped() == "why"


def test_an_interrupt_keeps_what_came(spark, service, tmp_path, monkeypatch):
    lines, old = [], collect.collect_with_split

    def interrupted(spark, asked, *rest):
        if asked.first()["country"] == "V2":
            raise KeyboardInterrupt
        return old(spark, asked, *rest)

    monkeypatch.setattr(collect, "collect_with_split", interrupted)
    run = collect.collect(spark, roots_of(spark, "V1", "V2", "V3"), options(service, tmp_path), wave=1, force=True, progress=lines.append)
    assert (run["stopped_reason"], run["attempted_roots"], run["successful_roots"], collect.exit_code(run)) == ("interrupted", 1, 1, 130)
    assert lines == ["progress=1/3 success=1 rows=12 checkpoint=0 stopping_reason=-"] and list((tmp_path / "audits/runs").glob("collection_*.json"))


def test_plan_and_data_source(spark, service, tmp_path):
    partners = spark.createDataFrame([("US",), ("CN",)], "country_code string")
    plan = [tuple(r) for r in collect.root_plan(spark, partners, "202411", "202502").select("country", "window_start", "window_end").collect()]
    assert [p[1] for p in plan] == ["202411"] * 2 + ["202501"] * 2 and {p[0] for p in plan} == {"US", "CN"}
    assert collect.root_plan(spark, partners, "202411", "202502", most=3).count() == 3
    assert collect.refresh_range(spark, "2026-09-08") == ("202507", "202607") and collect.refresh_range(spark, "2026-09-08", 2, "202601") == ("202511", "202601")
    spark.dataSource.register(http_api.TradeApi)
    rows = spark.read.format("trade_api").options(**options(service, tmp_path), requests=json.dumps([["VN", "202501", "202502"], ["HH", "202501", "202501"]])).load().collect()
    got = {r["country"]: (r["http_status"], r["api_result_code"], r["raised"]) for r in rows}
    assert got == {"VN": (200, "00", False), "HH": (410, None, True)}
    assert http_api.told(b"<a xmlns='u'><resultCode> 00 </resultCode></a>")[:2] == ("00", None) and http_api.told(ENVELOPE.format("", 22).encode())[:2] == ("22", "SERVICE ERROR")
    (tmp_path / ".env").write_text("# x\nTRADELAKE_TEST_KEY='abc'\n")
    assert http_api.read_dotenv(str(tmp_path / ".env")) == {"TRADELAKE_TEST_KEY": "abc"} and http_api.read_dotenv(str(tmp_path / "no")) == {}
    assert http_api.redacted(f"x?serviceKey=abc&y {KEY}", KEY) == "x?serviceKey=[REDACTED]&y [REDACTED]"


def test_forms_and_attachments(spark, service, tmp_path):
    Service.asked.clear()
    top = service.rpartition("/")[0]
    assert web.post(f"{top}/form", web.form(2022, {"clip_sct_year": "1"}, "01")).decode() == "한국 01"
    assert web.post(f"{top}/later", web.form(2022), pause=0).decode() == "한국 " and Service.asked["POST", "/later"] == 2
    with pytest.raises(Exception, match="404"):
        web.post(f"{top}/never", web.form(2022), pause=0)
    assert Service.asked["POST", "/never"] == 1
    with pytest.raises(RuntimeError, match="empty"):
        web.post(f"{top}/empty", web.form(2022))
    n = web.download(spark, f"{service}?serviceKey=SECRET%2BKEY%3D%3D&cntyCd=VN&strtYymm=202501&endYymm=202501", str(tmp_path / "a.xml"))
    assert (tmp_path / "a.xml").stat().st_size == n > 100


def references(folder, partners=("US",), codes=("0101219000",)):
    import pandas as pd

    (folder / "reference").mkdir(exist_ok=True)
    names = {"US": "미국", "JP": "일본", "CN": "중국"}
    head = "country_code,country_name_ko,country_name_en,un_m49,iso_alpha3,un_match_status,kcs_source_version,kcs_source_row\n"
    (folder / "reference/country_reference.csv").write_text(head + "".join(f"{p},{names[p]},x,001,XXX,matched_current_un,v,1\n" for p in partners))
    rows = [{"reference_year": 2025, "hs_revision": "HSK-2025", "valid_from": "2025-01-01", "valid_to": "2025-12-31", "clip_sct_year": "1", "clip_hstd_year": "1", "hs10": c, "hs8": c[:8], "hs6": c[:6], "hs4": c[:4], "hs2": c[:2], "name_ko": "말", "name_en": "Horse", "source": "s", "source_url": "u"} for c in codes]
    pd.DataFrame(rows).astype({"reference_year": "int16"}).to_parquet(folder / "reference/hsk_code_reference.parquet")


def normalized(spark, folder, **more):
    editions = spark.read.parquet(f"{folder}/reference/hsk_code_reference.parquet")
    partners = spark.read.option("header", "true").csv(f"{folder}/reference/country_reference.csv")
    return stage11.normalize_job(spark, str(folder), editions, partners, **more)


def test_whole_job(spark, collected):  # noqa: F811
    write_response(collected, "JP", "202501", "202503", [("2025.01", "JP", "0101219000", 5, 1), ("2025.03", "JP", "9999999999", 3, 0)], "2026-01-01T00:00:00+00:00")
    references(collected, ("US", "JP"))
    assert normalized(spark, collected, dry_run=True)["selected_country_months"] == 6 and not (collected / "normalized").exists()
    m = normalized(spark, collected, full_coverage=True)
    stats = m["normalization_stats"]
    assert (m["selected_country_months"], m["overlap_country_months"], m["successful_source_manifests"], m["selected_unique_raw_sources"]) == (6, 1, 3, 3)
    assert {k: stats[k] for k in ("items_seen", "summary_or_nonfact_rows", "superseded_month_rows_skipped", "assigned_fact_rows", "canonical_rows", "non_hs10_rows", "fatal_anomalies")} == {"items_seen": 10, "summary_or_nonfact_rows": 3, "superseded_month_rows_skipped": 1, "assigned_fact_rows": 6, "canonical_rows": 5, "non_hs10_rows": 1, "fatal_anomalies": 0}
    # the partly superseded source isn't compared
    assert (m["source_summary_checked"], m["source_summary_matches"], m["source_summary_missing"], m["hsk_reference_unknown_rows"], m["failed_checks"]) == (2, 2, 0, 1, [])
    assert m["verification"] | {"parquet_bytes": 0} == {"parquet_rows": 5, "partition_month_mismatches": 0, "duplicate_keys": 0, "partition_count": 3, "parquet_files": 3, "parquet_bytes": 0, "schema_ok": True}
    facts = {(r["month"], r["country_code"], r["hs10"]): (r["export_usd"], r["hs_revision"]) for r in spark.read.parquet(str(collected / "normalized/hs10")).collect()}
    assert facts["202501", "US", "0101219000"] == (11, "HSK-2025") and facts["202503", "JP", "9999999999"] == (3, None) and len(facts) == 5
    gaps = spark.read.option("header", "true").csv(str(collected / "audits/normalization/hsk_reference_unknown_codes.csv")).collect()
    assert [tuple(r) for r in gaps] == [("2025", "9999999999", "1", "202503", "말")]
    chosen = {(r["country_code"], r["month"]): r["selected_window_end"] for r in spark.read.option("header", "true").csv(str(collected / "audits/normalization/source_selection.csv")).collect()}
    assert chosen["US", "202501"] == "202501" and chosen["US", "202502"] == "202503" and len(chosen) == 6
    bad = spark.read.parquet(str(collected / "audits/normalization/normalization_anomalies.parquet"))
    assert [x.split()[0] for x in stage11.schemas.ANOMALY.split(", ")] == bad.columns and bad.first()["source_finished_at"] == "2026-01-01T00:00:00+00:00"

    d = stage11.derive_job(spark, str(collected))
    assert d["stats"]["levels"]["6"] == {"rows": 6, "months": 3, "mapped_residual_rows": 1} and d["stats"]["totals"]["hs6"]["export_usd"] == 47 and d["stats"]["residual_totals"]["8"]["export_usd"] == 0
    six = {(r["month"], r["country_code"], r["hs6"]): (r["export_usd"], r["has_residual"]) for r in spark.read.parquet(str(collected / "derived/hs6")).collect()}
    assert six["202502", "US", "761699"] == (7, True) and six["202502", "US", "010121"] == (20, False)

    (collected / "SOURCES.md").write_text("# 출처")
    q = release.qa_report(spark, str(collected), [str(collected / "SOURCES.md")])
    assert q["release_gate_pass"] and q["fatal_sections"] == [] and any("unknown_unique 1" in w for w in q["warnings"])
    r = release.build(spark, str(collected), str(collected / "release"), "Trade", [str(collected / "SOURCES.md")], files=1, isPrivate=False)
    assert r["coverage"] | {} == {"start_month": "202501", "end_month": "202503", "partner_codes": 2, "country_month_assignments": 6, "source_fact_rows": 6, "canonical_hsk10_rows": 5, "non_hsk10_source_rows": 1, "negative_weight_warning_rows": 0, "hsk_reference_unknown_fact_rows": 1, "hsk_reference_unknown_unique_year_codes": 1, "annual_hsk_reference_rows": 1}
    assert r["files"]["trade_hs10_monthly.parquet"]["rows"] == 5 and r["files"]["trade_hs6_sample.csv"]["rows"] == 2 and all(len(f["sha256"]) == 64 for f in r["files"].values())
    released = spark.read.parquet(str(collected / "release/source_code_exceptions.parquet"))
    assert released.columns[:7] == ["reason", "month", "country_code", "country_code_raw", "raw_hs_code", "raw_hs_length", "name_ko"] and released.columns[-1] == "source_finished_at" and len(released.columns) == 13 and released.first()["raw_hs_code"] == "761699"
    meta = json.loads((collected / "release/dataset-metadata.json").read_text())
    sample = next(x for x in meta["resources"] if x["path"] == "trade_hs6_sample.csv")
    assert meta["isPrivate"] is False and {f["name"]: f["type"] for f in sample["schema"]["fields"]}["hs6"] == "string"
    with pytest.raises(FileExistsError):
        release.build(spark, str(collected), str(collected / "release"), "Trade", overwrite=False)
    (collected / "SOURCES.md").write_bytes("bad �".encode())
    assert release.qa_report(spark, str(collected), [str(collected / "SOURCES.md")])["fatal_sections"] == ["text:SOURCES.md"]
    with pytest.raises(ValueError, match="has not passed"):
        release.build(spark, str(collected), str(collected / "release"), "Trade")
    assert (collected / "release/release_manifest.json").exists()


def test_whole_responses_without_items_miss_their_totals(spark, collected):  # noqa: F811
    """Two answers of a trade of nothing, one without any item, one with a total row only that can't be read; one fine."""
    write_response(collected, "JP", "202501", "202502", [("2025.01", "JP", "0101219000", 5, 1)], "2026-01-01T00:00:00+00:00")
    for country in ("CN", "DE"):
        write_response(collected, country, "202501", "202502", [], "2026-01-01T00:00:00+00:00")
    empty = "<response><header><resultCode>00</resultCode></header><body><items>{}</items></body></response>"
    for country, items in (("CN", ""), ("DE", "<item><year>total</year><hsCd>-</hsCd><expDlr>12d</expDlr></item>")):
        (collected / http_api.raw_path(country, "202501", "202502")).write_bytes(gzip.compress(empty.format(items).encode()))
    references(collected, ("US", "JP"))
    editions = spark.read.parquet(f"{collected}/reference/hsk_code_reference.parquet")
    m = stage11.normalize_job(spark, str(collected), editions, spark.createDataFrame([(c,) for c in ("US", "JP", "CN", "DE")], "country_code string"))
    assert (m["source_summary_checked"], m["source_summary_matches"], m["source_summary_missing"]) == (2, 2, 2) and m["failed_checks"] == []
    audit = {(r["country_code"], r["month"]): r["raw_path"] for r in spark.read.option("header", "true").csv(str(collected / "audits/normalization/source_selection.csv")).collect()}
    assert audit["CN", "202502"] == http_api.raw_path("CN", "202501", "202502") and all((collected / p).exists() for p in audit.values())


def test_the_release_gate_looks_at_the_editions_columns(spark, collected):  # noqa: F811
    references(collected)
    path = str(collected / "reference/hsk_code_reference.parquet")
    good = release.edition_check(spark, path)
    assert good["ok"] and good["schema_ok"] and good["bytes"] > 1000 and good["missing_name_en"] == 0
    wrong = str(collected / "wrong.parquet")
    spark.read.parquet(path).withColumn("reference_year", F.col("reference_year").cast("bigint")).write.parquet(wrong)
    assert not release.edition_check(spark, wrong)["ok"] and release.edition_check(spark, wrong)["rows"] == 1


def test_failed_checks_leave_the_old_table(spark, collected):  # noqa: F811
    references(collected)
    normalized(spark, collected)
    rows = [("2025.01", "US", "0101219000", 11, 4)]
    write_response(collected, "US", "202501", "202501", rows, "2026-03-01T00:00:00+00:00", total=(12, 4))
    with pytest.raises(stage11.CheckFailed) as failed:
        normalized(spark, collected)
    assert failed.value.manifest["failed_checks"] == ["source_summaries"] and spark.read.parquet(str(collected / "normalized/hs10")).count() == 3
    assert not release.quality.normalization_gate(json.loads((collected / "audits/normalization/normalization_manifest.json").read_text()))["ok"]
    write_response(collected, "US", "202501", "202501", rows * 2, "2026-03-01T00:00:00+00:00")
    with pytest.raises(stage11.CheckFailed) as failed:
        normalized(spark, collected)
    assert failed.value.manifest["failed_checks"] == ["fatal_anomalies"]
    write_response(collected, "US", "202501", "202501", rows, "2026-03-01T00:00:00+00:00")
    editions = spark.read.parquet(f"{collected}/reference/hsk_code_reference.parquet")
    partners = spark.createDataFrame([("US",), ("CN",)], "country_code string")
    job = lambda e=editions, p=partners, **k: stage11.normalize_job(spark, str(collected), e, p, **k)
    with pytest.raises(ValueError, match="several revisions"):
        job(editions.unionByName(editions.withColumn("hs_revision", F.lit("HSK-X"))))
    with pytest.raises(ValueError, match="full coverage misses 3"):
        job(full_coverage=True)
    with pytest.raises(ValueError, match="unknown countries"):
        job(p=partners.where("country_code = 'CN'"))
    with pytest.raises(FileExistsError):
        job(overwrite=False)
    (collected / http_api.raw_path("US", "202501", "202501")).unlink()
    with pytest.raises(ValueError, match="missing raw files: 1"):
        job()
    assert spark.read.parquet(str(collected / "normalized/hs10")).count() == 3


def test_command_line(spark, service, collected, monkeypatch, capsys):  # noqa: F811
    references(collected, ("US", "CN"))
    top = ["--data-dir", str(collected)]
    assert cli.main([*top, "collect", "backfill", "--key-name", "TRADE_KEY", "--url", service, "--start-month", "202301", "--end-month", "202402", "--dry-run"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"collection_range": "202301-202402", "planned_roots": 4}
    monkeypatch.setenv("TRADE_KEY", KEY)
    assert cli.main([*top, "collect", "backfill", "--key-name", "TRADE_KEY", "--url", service, "--start-month", "202401", "--end-month", "202402", "--countries", "CN", "--max-roots", "1", "--request-delay", "0"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["fact_row_count"] == 2
    assert cli.main(["--data-dir", str(collected / "trial"), "pilot", "--key-name", "TRADE_KEY", "--url", service, "--countries", "vn", "--years", "2025", "--retries", "0"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["Rows read"] == 12 and (collected / "trial/audits/pilot/pilot_report.md").exists()
    assert cli.main([*top, "editions", "combine", "--start-year", "1990"]) == 2
    assert cli.main([*top, "normalize"]) == 0 and cli.main([*top, "derive"]) == 0 and cli.main([*top, "qa"]) == 0
    assert cli.main([*top, "release", "--output", str(collected / "out")]) == 0 and (collected / "out/release_manifest.json").exists()
    assert cli.main([*top, "normalize"]) == 2 and cli.main([*top, "normalize", "--overwrite"]) == 0
