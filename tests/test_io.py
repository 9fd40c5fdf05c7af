import gzip
import json

import pytest
from pyspark.sql import functions as F

from tradelake import schemas, storage
from tradelake.functions.text import MEASURES
from tradelake.operators import rollup
from tradelake.plans import editions, release
from tradelake.sources import dimensions, html_tables, responses, web, workbook
from tradelake.sources.fixtures import workbook_bytes
from tradelake.streaming import refresh

ITEM = "<item><year>{}</year><statCd>{}</statCd><hsCd>{}</hsCd><statKor>말</statKor><expDlr>{}</expDlr><expWgt>1</expWgt><impDlr>{}</impDlr><impWgt>1</impWgt><balPayments>{}</balPayments></item>"


def write_response(root, country, start, end, rows, finished, total=None, name="말"):
    """A response and its manifest in their places; ``total`` replaces the sums that its total row states."""
    raw, manifests = root / f"raw/year={start[:4]}/country={country}", root / f"audits/manifests/year={start[:4]}/country={country}"
    for folder in (raw, manifests):
        folder.mkdir(parents=True, exist_ok=True)
    items = "".join(ITEM.format(y, c, h, e, i, e - i).replace("말", name) for y, c, h, e, i in rows)
    e, i = total or (sum(r[3] for r in rows), sum(r[4] for r in rows))
    said = f"<item><year>total</year><statCd>-</statCd><hsCd>-</hsCd><statKor>-</statKor><expDlr>{e}</expDlr><expWgt>{len(rows)}</expWgt><impDlr>{i}</impDlr><impWgt>{len(rows)}</impWgt><balPayments>{e - i}</balPayments></item>"
    page = f"<response><header><resultCode>00</resultCode><resultMsg>ok</resultMsg></header><body><items>{said}{items}</items></body></response>"
    (raw / f"response_{start}-{end}.xml.gz").write_bytes(gzip.compress(page.encode()))
    (manifests / f"request_{start}-{end}.json").write_text(json.dumps({"country": country, "window_start": start, "window_end": end, "success": True, "status": "success", "requested_at": finished, "finished_at": finished}))


@pytest.fixture
def collected(tmp_path):
    write_response(tmp_path, "US", "202501", "202503", [("2025.01", "US", "0101219000", 10, 4), ("2025.02", "US", "0101219000", 20, 5), ("2025.02", "US", "761699", 7, 0), ("2025.03", "US", "0101219000", 1, 0)], "2026-01-01T00:00:00+00:00")
    write_response(tmp_path, "US", "202501", "202501", [("2025.01", "US", "0101219000", 11, 4)], "2026-02-01T00:00:00+00:00")
    return tmp_path


def test_status_of_responses(spark, collected):
    (collected / "raw/year=2025/country=US/response_202504-202504.xml.gz").write_bytes(gzip.compress(b"<OpenAPI_ServiceResponse><cmmMsgHeader><errMsg>E</errMsg><returnAuthMsg>LIMIT</returnAuthMsg><returnReasonCode>22</returnReasonCode></cmmMsgHeader></OpenAPI_ServiceResponse>"))
    assert sorted((r["code"], r["message"]) for r in responses.read_status(spark, str(collected / "raw")).collect()) == [("00", "ok"), ("00", "ok"), ("22", "LIMIT")]


def test_pulled_responses(spark, tmp_path):
    """Name spaces, odd items, several gzip members, damage of each kind."""
    from tradelake.sources import pull

    space = '<?xml version="1.0" encoding="UTF-8"?><k:response xmlns:k="urn:a" xmlns:m="urn:b"><m:header><m:resultCode> 00 </m:resultCode><resultMsg/></m:header><k:body><m:items><m:item><k:year> 2025.01 </k:year><m:hsCd>0101219000</m:hsCd><k:hsCd>second</k:hsCd><x><expDlr>deep</expDlr></x></m:item><item/></m:items></k:body></k:response>'.encode()
    files = {"space": gzip.compress(space), "plain": space, "members": gzip.compress(space[:100]) + gzip.compress(space[100:]), "cut": gzip.compress(space)[:-9], "half": gzip.compress(space[:-36]), "empty": b"", "none": gzip.compress(b"<a/>"), "text": b"no xml"}
    many = b"<r>" + b"<item><year>2025.01</year></item>" * (pull.BATCH * 2) + b"</r>"
    files["many"] = gzip.compress(many)
    for name, data in files.items():
        (tmp_path / f"{name}.xml.gz").write_bytes(data)
    rows = pull.read_responses(spark, str(tmp_path)).withColumn("name", F.regexp_extract("source", r"([a-z]+)\.xml", 1)).cache()
    ends = {r["name"]: (r["ordinal"], r["code"], r["message"], r["parse_error"] and r["parse_error"].split(":")[0]) for r in rows.where("kind = 'file'").collect()}
    assert ends == {"space": (2, "00", "", None), "plain": (2, "00", "", None), "members": (2, "00", "", None), "cut": (0, None, None, "EOFError"), "half": (1, None, None, "ParseError"), "none": (0, None, None, None), "text": (0, None, None, "ParseError"), "many": (pull.BATCH * 2, None, None, None)}
    own = rows.where("kind = 'item' and name = 'space'").orderBy("ordinal").collect()
    assert [(r["ordinal"], r["year"], r["hsCd"], r["expDlr"]) for r in own] == [(0, "2025.01", "0101219000", None), (1, None, None, None)]
    assert pull.whole_items(rows).count() == 2 * 3 + pull.BATCH * 2 and {r["items"] for r in pull.damaged_files(rows).collect()} == {0, 1}
    with pytest.raises(Exception, match="damaged response"):
        responses.read_items(spark, str(tmp_path)).collect()
    (tmp_path / "ok").mkdir()
    (tmp_path / "ok/space.xml.gz").write_bytes(files["space"])
    assert responses.raw_columns(responses.read_items(spark, str(tmp_path / "ok"))).select("month", "hs_code_raw").where("month is not null").collect() == [("202501", "0101219000")]


def monthly(spark, folder):
    rows = [(f"20250{i % 3 + 1}", f"C{i % 5}", f"{i:010}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "month string, country_code string, hs10 string, export_usd bigint")
    release.write_monthly(df, str(folder), ["country_code", "hs10"])
    return df


@pytest.mark.parametrize("files", [1, None])
@pytest.mark.parametrize("harm", ["lost row", "changed value", "other month", None])
def test_consolidation_proves_what_was_written(spark, tmp_path, monkeypatch, files, harm):
    """A file of the written table is tampered with before the check."""
    import pyarrow.parquet as pq

    from tradelake.sources import footers

    df, own = monthly(spark, tmp_path / "m"), footers.table_figures

    def tampered(spark, path, bounds="month"):
        if path.endswith("one") and harm:
            file = next(p for p in sorted((tmp_path / "one").glob("*.parquet")) if pq.ParquetFile(p).metadata.num_rows > 2)
            t = pq.read_table(file).to_pandas()
            t = t.iloc[1:] if harm == "lost row" else t.assign(export_usd=t["export_usd"] + (t.index == 0)) if harm == "changed value" else t.assign(month="202512")
            schema = pq.read_schema(file).remove_metadata()
            import pyarrow as pa

            pq.write_table(pa.Table.from_pandas(t, schema, preserve_index=False), file)
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
        return own(spark, path, bounds)

    monkeypatch.setattr(footers, "table_figures", tampered)
    run = lambda: release.consolidate(spark, str(tmp_path / "m"), str(tmp_path / "one"), ["month", "country_code", "hs10"], files)
    if harm:
        with pytest.raises(release.Unequal if harm != "lost row" else release.Unequal):
            run()
    else:
        figures = run()
        assert (figures["rows"], figures["source_files"], figures["columns"]) == (300, 3, df.columns)


def test_footers_tell_rows_columns_and_months(spark, tmp_path):
    from tradelake.sources import footers

    monthly(spark, tmp_path / "m")
    told = footers.table_figures(spark, str(tmp_path / "m"))
    assert (told.files, told.rows, told.low, told.high, len(told.columns)) == (3, 300, "202501", "202503", 4) and told.bytes == sum(p.stat().st_size for p in (tmp_path / "m").rglob("*.parquet"))
    assert [(f.low, f.high, f.rows) for f in footers.footers(spark, str(tmp_path / "m"))] == [(m, m, 100) for m in ("202501", "202502", "202503")]
    spark.createDataFrame([(1,)], "month int").write.parquet(str(tmp_path / "m/year=2026/mm=01"))
    with pytest.raises(ValueError, match="schema mismatch"):
        footers.table_figures(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError, match="no files"):
        (tmp_path / "none").mkdir()
        footers.table_figures(spark, str(tmp_path / "none"))


def test_sorted_csv_comes_from_many_tasks(spark, tmp_path):
    """The joined parts are the bytes that one task would have written."""
    rows = [(i * 7919 % 1000, f'text "{i}", {i}' if i % 3 else None, [i, i + 1]) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, t string, l array<int>").repartition(5)
    assert release.write_csv(df, str(tmp_path / "joined"), ["k"]) == 1000
    flat = df.withColumn("l", F.to_json("l"))
    flat.orderBy("k").coalesce(1).write.option("header", "true").csv(str(tmp_path / "plain"))
    one = lambda folder: [p for p in (tmp_path / folder).iterdir() if p.name.startswith("part-")]
    assert len(one("joined")) == 1 and one("joined")[0].read_bytes() == one("plain")[0].read_bytes()
    assert release.write_csv(df.limit(0), str(tmp_path / "joined"), ["k"]) == 0 and one("joined")[0].read_text() == "k,t,l\n"


def test_missing_raw_and_unknown_country(spark, collected):
    sources = responses.read_manifests(spark, str(collected / "audits/manifests"))
    assert responses.without_raw_file(spark, sources, str(collected / "raw")).count() == 0
    with pytest.raises(ValueError):
        responses.require_known_countries(sources, spark.createDataFrame([("JP",)], "country_code string"))


def test_partner_csv_keeps_na(spark, tmp_path):
    (tmp_path / "p.csv").write_text("country_code,un_m49\nNA,016\nus,840\n")
    rows = dimensions.read_partners(spark, str(tmp_path / "p.csv"), "country_code string, un_m49 string")
    assert sorted((r[0], r[1]) for r in rows.collect()) == [("NA", "016"), ("US", "840")]
    with pytest.raises(ValueError):
        dimensions.read_partners(spark, str(tmp_path / "p.csv"), "country_code string, un_m49 string", ["JP"])


INDEX = '<form><input name="aplyYy" value="2022" /><input name="sctYear" value="20220101" /><input name="hstdYear" value=" 20220101 " /><input name="hstdCd" value="02" /><input name="hstdCd" value="01" /><input name="hstdCd" value="01" /><input name="hstdCd" value="0101" /></form>'


def code_row(code, *names):
    cells = "".join(f'<td class="x hlzoneWrd"><a>{n}</a></td>' for n in names)
    return f'<tr><td><input name="hsSgn_Mn" value="{code}" /></td><td>x</td><td>y</td>{cells}</tr>'


def chapter_page(*rows):
    return f'<table><tbody id="other">{code_row("0101210000", "no", "no")}</tbody></table><table><tbody id="tblLstBody">{"".join(rows)}</tbody></table>'


def test_tariff_pages():
    assert html_tables.year_index(INDEX, 2022) == {"year": 2022, "clip_sct_year": "20220101", "clip_hstd_year": "20220101", "chapters": ["01", "02"]}
    for page, year in ((INDEX, 2021), ("<form><input name='aplyYy' value='2022'></form>", 2022), ("", 2022)):
        with pytest.raises(ValueError):
            html_tables.year_index(page, year)
    page = chapter_page(code_row("010121", "heading", "heading"), code_row("0101211000", "농가 <b>사육용</b>", "For farm &amp; breeding"), code_row("0101219000", "기타"), code_row("0101219000"))
    assert html_tables.chapter_rows(page, "01") == [(0, "0101211000", "농가 사육용", "For farm & breeding"), (1, "0101219000", "기타", None), (2, "0101219000", None, None)]
    with pytest.raises(ValueError, match="stands on a page"):
        html_tables.chapter_rows(page, "02")


def test_country_table():
    un = "<table><tr><th>Country or Area</th><th>M49 Code</th><th>ISO-alpha2 Code</th><th>ISO-alpha3 Code</th></tr><tr><td>Namibia</td><td>516</td><td>NA</td><td>NAM</td></tr><tr><td>x</td><td>1</td><td></td><td>y</td></tr><tr><td>short</td></tr></table>"
    assert html_tables.alpha2_table(un) == [("Namibia", "516", "NA", "NAM")]
    with pytest.raises(ValueError):
        html_tables.alpha2_table("<table><tr><th>Country</th></tr></table>")


def test_editions_of_several_years(spark, tmp_path):
    chapters, index = "reference_year int, chapter string, html string", "reference_year int, html string"
    old, new = code_row("6815910000", "구 정의", "Old"), code_row("6815910000", "신 정의", "New")
    pages = [(2021, "68", chapter_page(old)), (2022, "68", chapter_page(old, new, code_row("6815990000", "기타", "Other"), code_row("6815990000", "기타 (상세)", "Other"))), (2023, "68", chapter_page(new))]
    indexes = [(y, INDEX.replace("2022", str(y)).replace('"01"', '"68"')) for y in (2021, 2022, 2023)]
    figures = editions.build(spark, spark.createDataFrame(indexes, index), spark.createDataFrame(pages, chapters), str(tmp_path / "all"))
    assert figures == {"rows": 4, "year_rows": {"2021": 1, "2022": 2, "2023": 1}, "duplicate_name_variants": 2, "reviewed": 1, "resolved": 1, "unresolved": 0, "annual_name_rewrites": 1}
    got = {(r["reference_year"], r["hs10"]): r for r in spark.read.parquet(str(tmp_path / "all")).collect()}
    assert got[2022, "6815910000"]["name_ko"] == "신 정의" and got[2022, "6815990000"]["name_ko"] == "기타 (상세)" and got[2021, "6815910000"]["valid_to"] == "2021-12-31" and got[2021, "6815910000"]["hs6"] == "681591"
    kinds = {f.name: f.dataType.simpleString() for f in spark.read.parquet(str(tmp_path / "all")).schema}
    assert kinds == dict(x.split() for x in schemas.EDITION.split(", "))
    with pytest.raises(ValueError, match="conflict"):
        editions.build(spark, spark.createDataFrame(indexes, index), spark.createDataFrame(pages[:2], chapters), str(tmp_path / "all"))
    with pytest.raises(ValueError, match="conflicting copies"):
        editions.build(spark, spark.createDataFrame(indexes, index), spark.createDataFrame([(2021, "68", chapter_page(old)), (2021, "", chapter_page(old))], chapters), str(tmp_path / "all"))
    assert spark.read.parquet(str(tmp_path / "all")).count() == 4


def test_chapters_have_their_provenance(spark, tmp_path):
    import hashlib

    old, new = code_row("6815910000", "구 정의", "Old"), code_row("6815910000", "신 정의", "New")
    body = {("2021", "68"): chapter_page(old), ("2022", "68"): chapter_page(old, new, code_row("6815990000", "기타", "Other")), ("2023", "68"): chapter_page(new)}
    body |= {(y, "69"): chapter_page(code_row("6901000000", "벽돌", "Bricks")) for y in ("2021", "2022", "2023")}

    def fetch(kind, form):
        y = form["aplyYy"]
        return (INDEX.replace("2022", y).replace('"01"', '"68"').replace('"02"', '"69"') if kind == "index" else body[y, form["searchVal"]]).encode()

    cache, root, target, manifest = (str(tmp_path / x) for x in ("cache", "root", "all.parquet", "m/manifest.json"))
    probe, _ = editions.collect_year(spark, 2022, cache, root, fetch, only=["69"])
    assert probe["annual_parquet"].endswith("year=2022/hsk10_probe_69.parquet") and (probe["full_year"], probe["hsk10_rows"], probe["fetched_files"], probe["cached_files"]) == (False, 1, 2, 0)
    out = editions.collect_editions(spark, [2021, 2022, 2023], cache, root, target, manifest, fetch, url="u")
    assert json.loads((tmp_path / "m/manifest.json").read_text()) == out
    assert out["combined"] == {"rows": 7, "year_rows": {"2021": 2, "2022": 3, "2023": 2}, "reviewed": 1, "resolved": 1, "unresolved": 0, "annual_name_rewrites": 1}
    year = out["year_stats"][1]
    assert (year["full_year"], year["hsk10_rows"], year["duplicate_name_variant_count"], year["fetched_files"], year["cached_files"]) == (True, 3, 1, 1, 2)
    page = body["2022", "68"].encode()
    assert year["source_files"][0] == {"chapter": "68", "cache_path": f"{cache}/year=2022/chapter=68.html.gz", "bytes": len(page), "sha256": hashlib.sha256(page).hexdigest(), "cache_reused": False, "hsk10_rows": 3} and year["source_files"][1]["cache_reused"]
    names = {(r["reference_year"], r["hs10"]): r["name_ko"] for r in spark.read.parquet(target).collect()}
    assert names[2022, "6815910000"] == "신 정의" and names[2021, "6815910000"] == "구 정의" and {f.name: f.dataType.simpleString() for f in spark.read.parquet(target).schema} == dict(x.split() for x in schemas.EDITION.split(", "))
    assert editions.combine(spark, [2021, 2023], root, target)["rows"] == 4
    with pytest.raises(FileNotFoundError):
        editions.combine(spark, [2024], root, target)


def test_pages_are_cached(spark, tmp_path):
    asked = []

    def fetch(kind, form):
        asked.append((kind, form["aplyYy"], form["sctYear"], form["searchVal"]))
        return (INDEX if kind == "index" else f"<p>{form['searchVal']} 말</p>").encode()

    index, pages, reused = editions.cached_pages(spark, 2022, str(tmp_path), fetch)
    assert [p[1:] for p in pages] == [("01", "<p>01 말</p>"), ("02", "<p>02 말</p>")] and reused == 0
    assert asked == [("index", "2022", "", ""), ("detail", "2022", "20220101", "01"), ("detail", "2022", "20220101", "02")]
    assert editions.cached_pages(spark, 2022, str(tmp_path), fetch, only=["02"])[1:] == ([(2022, "02", "<p>02 말</p>")], 2) and len(asked) == 3
    editions.cached_pages(spark, 2022, str(tmp_path), fetch, force=True)
    assert len(asked) == 6
    with pytest.raises(ValueError, match="unknown"):
        editions.cached_pages(spark, 2022, str(tmp_path), fetch, only=["77"])
    with pytest.raises(UnicodeDecodeError):
        web.html_text(b"\xff")
    assert web.attachments('<a href="/f.xlsx?x=1">Codes</a><a href="d?id=3">list <b>two</b>.xlsx</a><a href="x.pdf">x</a>', "http://h/p/") == [("http://h/f.xlsx?x=1", "Codes"), ("http://h/p/d?id=3", "list two .xlsx")]


def test_workbook(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes([["code", "name"], ["US", "미국"], ["NA", "a<b"]]))
    assert [(r["row_number"], r["code"], r["name"]) for r in workbook.read_workbook(spark, str(tmp_path / "a.xlsx"), ["code", "name"]).collect()] == [(2, "US", "미국"), (3, "NA", "a<b")]


def test_swap_keeps_the_old_table_on_failure(spark, tmp_path):
    (tmp_path / "old").mkdir()
    (tmp_path / "old/x").write_text("1")
    with pytest.raises(Exception):
        storage.swap(spark, str(tmp_path / "missing"), str(tmp_path / "old"))
    assert (tmp_path / "old/x").read_text() == "1"
    (tmp_path / "new").mkdir()
    storage.swap(spark, str(tmp_path / "new"), str(tmp_path / "old"))
    assert not (tmp_path / "old/x").exists() and not (tmp_path / "new").exists()


def test_release_metadata_and_text_gate(spark, tmp_path):
    df = spark.createDataFrame([("202607", "010121", 1)], "month string, hs6 string, value bigint")
    fields = release.metadata("t", "d", {"a.parquet": df}, keywords=["x"])["resources"][0]["schema"]["fields"]
    assert [f["type"] for f in fields] == ["string", "string", "integer"]
    (tmp_path / "good.txt").write_text("한글")
    (tmp_path / "bad.txt").write_bytes(b"\xff")
    assert [r["reason"] for r in release.damaged_text_files(spark, str(tmp_path)).collect()] == ["not_utf8"]
    assert release.latest_sample(df.unionByName(spark.createDataFrame([("202606", "x", 2)], df.schema)), str(tmp_path / "csv")) == 1


def test_refresh_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put = lambda name, end, at: (tmp_path / "in" / name).write_text(json.dumps({"country": "US", "window_start": "202501", "window_end": end, "success": True, "status": "success", "finished_at": at}))
    put("a.json", "202503", "2026-01-01")
    for _ in range(2):
        refresh.refresh(spark, str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()
        put("b.json", "202501", "2026-02-01")
    got = {r["month"]: r["path"].rpartition("/")[2] for r in spark.read.parquet(str(tmp_path / "state")).collect()}
    assert got == {"202501": "b.json", "202502": "a.json", "202503": "a.json"}


def test_monthly_folders_and_one_table(spark, tmp_path):
    df = spark.createDataFrame([("202502", "US", "0101219000", 2), ("202501", "US", "0101219000", 1), ("202501", "JP", "0101219000", 3)], "month string, country_code string, hs10 string, value bigint")
    release.write_monthly(df, str(tmp_path / "m"), ["country_code", "hs10"])
    assert sorted(p.parent.relative_to(tmp_path / "m").as_posix() for p in (tmp_path / "m").rglob("*.parquet")) == ["year=2025/mm=01", "year=2025/mm=02"]
    for files in (1, None):
        info = release.consolidate(spark, str(tmp_path / "m"), str(tmp_path / f"one-{files}"), ["month", "country_code", "hs10"], files)
        assert (info["rows"], info["source_files"], len(info["sha256"]), info["columns"]) == (3, 2, 64, df.columns)
    assert [r["value"] for r in spark.read.parquet(str(tmp_path / "one-1")).collect()] == [3, 1, 2]
    with pytest.raises(Exception):
        release.consolidate(spark, str(tmp_path / "nothing"), str(tmp_path / "x"), ["month"])
    release.write_csv(df, str(tmp_path / "c.csv"), ["month"])
    figures = release.copy_with_figures(spark, str(tmp_path / "c.csv"), str(tmp_path / "d.csv"))
    assert (figures["rows"], figures["columns"], len(figures["sha256"])) == (3, df.columns, 64)
    with pytest.raises(FileNotFoundError):
        release.copy_with_figures(spark, str(tmp_path / "gone.csv"), str(tmp_path / "e.csv"))


def test_level_schemas(spark):
    assert schemas.level_schema(4).startswith("month string, country_code string, hs4 string, hs2 string, export_usd bigint") and schemas.level_schema(4).endswith("has_residual boolean")
    f = spark.createDataFrame([("202501", "US", "0101219000", 1, 1, 0, 0, 1)], "month string, country_code string, hs10 string, " + ", ".join(f"{m} bigint" for m in MEASURES))
    for level in (8, 6, 4, 2):
        made = rollup.with_residuals(f, f.select("month", f.country_code.alias("requested_country"), f.hs10.alias("hs_code_raw"), *MEASURES), level)
        assert {(x.name, x.dataType.simpleString()) for x in made.schema} == {tuple(x.split()) for x in schemas.level_schema(level).split(", ")}
