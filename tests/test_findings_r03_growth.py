"""What the third round's findings on growth named: less work a row, the same results."""

from xml.etree import ElementTree

from pyspark.sql import functions as F
from test_oracles import SF

from tradelake import bindings


def test_asked_fields_alone_are_read(spark, tmp_path):
    from tradelake.sources import pull, responses

    page = "<r xmlns:k='u'><items><item><k:year> 2025.01 </k:year><year>2</year><hsCd>1<b>x</b>9</hsCd><x><statKor>deep</statKor></x></item><item><statKor/><item><year>in</year></item><year>out</year></item></items>tail</r>"
    (tmp_path / "a.xml").write_text(page)
    rows = responses.read_items(spark, str(tmp_path), ["year", "hsCd", "statKor"]).orderBy("ordinal")
    assert rows.columns == ["source", "ordinal", "year", "hsCd", "statKor"]
    assert [tuple(r)[1:] for r in rows.collect()] == [(0, "2025.01", "1", None), (1, "in", None, None), (2, "out", None, "")]
    assert responses.raw_columns(rows).columns == ["source", "ordinal", "month", "requested_country", "hs_code_raw", "name_ko"]
    blocks = list(pull.parsed_file(b"<r>" + b"<item><year>1</year></item>" * (3 * pull.BATCH) + b"</r>", ["year"]))
    assert sum(len(x[2] or ()) for x in blocks) == blocks[-1][1] == 3 * pull.BATCH and len(blocks) > 2


def test_files_of_items_are_written_line_by_line(spark):
    """Files of a source hold its items in order, none too many; no page is gathered in one row."""
    import gzip
    from pathlib import Path

    from tradelake.sources.fixtures import xml_responses

    raw = bindings.raw_rows(spark, SF).where("source in ('src1', 'src2')")
    for damaged in (None, F.col("source") == "src2"):
        folder = Path(xml_responses(spark, raw, file_items=5, damaged=damaged))
        for source in ("src1", "src2"):
            want = [r["hs_code_raw"] for r in raw.where(F.col("source") == source).orderBy("ordinal").collect()]
            pages = [gzip.decompress(p.read_bytes()).decode() for p in sorted((folder / f"source={source}").glob("*.gz"), key=lambda p: p.name.split(".")[-3])]
            assert len(pages) == -(-len(want) // 5) and all(p.count("\n") == min(5, len(want) - 5 * i) for i, p in enumerate(pages))
            for i, p in enumerate(pages):
                if damaged is not None and source == "src2":
                    try:
                        ElementTree.fromstring(p)
                    except ElementTree.ParseError:
                        continue
                    raise AssertionError(p)
                assert [x.findtext("hsCd") for x in ElementTree.fromstring(p).iter("item")] == ["-", *want[5 * i : 5 * i + 5]]


def test_levels_are_hashed_and_looked_at_once(spark):
    """No text is summed up, so rows aren't sorted; a reconciliation scans the rows for the levels alone, and tells what is missing."""
    import pytest

    from tradelake import catalog
    from tradelake.functions.text import MEASURES
    from tradelake.operators import rollup

    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan(catalog.rollup_with_residuals(spark, SF))
    for query in (catalog.rollup_reconciliation, catalog.rollup_reconciliation_monthly):
        found = plan(query(spark, SF))
        assert "SortAggregate" not in found and found.count("lineitem.parquet") == 1
    rows = bindings.coded_rows(spark, SF)
    full, short = bindings.full_code_facts(spark, SF), bindings.short_code_rows(spark, SF)
    for by in ([], ["month"]):
        assert sorted(map(str, rollup.reconciliation_mixed(rows, by).collect())) == sorted(map(str, rollup.reconciliation(full, short, by).collect()))
    s = "month string, country_code string, hs_code_raw string, " + ", ".join(f"{m} bigint" for m in MEASURES)
    own = [("202501", "US", "0101219000", 1, 1, 1, 1, 0), ("202501", "US", "0012345", 7, 0, 0, None, 7), ("202502", "US", "0012345", 7, 0, 0, None, 7)]
    with pytest.raises(Exception, match="residual row has missing import_weight_kg: 0012345"):
        rollup.all_levels_mixed(spark.createDataFrame(own[:2], s)).collect()
    assert rollup.all_levels_mixed(spark.createDataFrame([own[0], own[2]], s)).count() == 4
    assert [(r["exceptions"], r["reconciles"]) for r in rollup.reconciliation_mixed(spark.createDataFrame([own[0], own[2]], s)).collect()] == [(0, True)] * 4


def test_models_look_at_the_facts_once(spark):
    """What models learn from and are asked about is read from written monthly sums, not from lineitem again."""
    from tradelake import catalog
    from tradelake.operators import analytics

    files = lambda df: {f.rsplit("/", 2)[-1] for f in df.inputFiles()}
    panel, cutoff = catalog.panel_and_cutoff(spark, SF)
    assert panel.inputFiles() and "lineitem.parquet" not in files(panel)
    facts = bindings.with_levels(bindings.trade_facts(spark, SF))
    at = analytics.panel_bounds(facts)
    codes = analytics.top_codes(facts, "hs4", at["chosen_from"], at["train_end"], 100)
    want = analytics.monthly_panel(facts, codes.select("hs4"), "hs4", at["history"], at["last"])
    assert cutoff == at["train_end"] and sorted(map(tuple, panel.collect())) == sorted(map(tuple, want.collect()))


def test_metrics_hash_keys_and_names(spark, monkeypatch):
    """Keys and names of rows are counted in one shuffle and hashed, none gathered; no step's code is too long for the JVM to compile."""
    import contextlib
    import io
    import re

    from tradelake import catalog
    from tradelake.operators import normalize

    written, plans = normalize.written, {}

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name)

    monkeypatch.setattr(normalize, "written", watched)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found, said = catalog.response_metrics(spark, SF), io.StringIO()
        with contextlib.redirect_stdout(said):
            found.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", said.getvalue())]
    assert sizes and max(sizes) < 8000
    rows = plans["repeats"]
    assert "SortAggregate" not in rows and "ObjectHashAggregate" not in rows and rows.count("hashpartitioning(source") == 1 and rows.count("lineitem.parquet") == 1
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not [x for x in lines if "partial_collect" in x and "name_ko" in x]


def test_metrics_count_as_plain_loops_do(spark):
    """Keys, names and shown codes of random rows, sources and names that are missing among them."""
    import random
    from collections import defaultdict

    from tradelake.operators import normalize

    r = random.Random(20)
    kinds = "source string, ordinal bigint, month string, requested_country string, country_code_raw string, hs_code_raw string, name_ko string, exp_dlr string, exp_wgt string, imp_dlr string, imp_wgt string, bal_payments string"
    codes = [f"{i:010d}" for i in range(60)] + ["01", "-", "", None]
    rows = [(r.choice(["s", "t", None]), i // 2, r.choice(["202501", "202502", "202503", None]), "US", r.choice(["US", "JP", "", None]), r.choice(codes), r.choice(["", None, *"abcdefgh"]), r.choice(["1", "-", "0"]), "2.75", "0", "0", "1") for i in range(3000)]
    rows += [("u", 0, None, "US", "-", "-", "x", "1", "1", "1", "1", "0")]
    want = defaultdict(lambda: {"total": 0, "keys": defaultdict(int), "names": defaultdict(set), "seen": {}, "lengths": defaultdict(int), "months": set()})
    for source, ordinal, month, _, country, code, name, *_ in rows:
        x = want[source]
        if month is None or (code or "") in ("", "-"):
            x["total"] += 1
            continue
        x["keys"][month, country or "", code] += 1
        x["names"][code] |= {name} - {"", None}
        x["seen"][code] = min(ordinal, x["seen"].get(code, ordinal))
        x["lengths"][str(len(code))] += 1
        x["months"].add(month)
    got = {x["source"]: x for x in normalize.response_metrics(spark.createDataFrame(rows, kinds).repartition(5)).collect()}
    assert set(got) == set(want)
    for source, x in want.items():
        g, n = got[source], sum(x["keys"].values())
        assert (g["row_count"], g["fact_row_count"], g["total_row_count"]) == (n + x["total"], n, x["total"])
        assert (g["duplicate_key_rows"], g["duplicate_key_groups"]) == (n - len(x["keys"]), sum(v > 1 for v in x["keys"].values()))
        assert (g["months_found"], g["month_count"], g["hs_length_counts"]) == (sorted(x["months"]), len(x["months"]), dict(x["lengths"]))
        several = sorted((c for c, names in x["names"].items() if len(names) > 1), key=lambda c: (x["seen"][c], c))
        assert g["hs_name_variant_codes"] == len(several)
        assert [(e["hs10"], e["names"]) for e in g["hs_name_variant_examples"]] == [(c, sorted(x["names"][c])[:5]) for c in several[:20]]


def test_plain_fractions_are_cut_off_alike(spark):
    """The short way for plain fractions gives what the double gives."""
    from tradelake.functions.text import as_int

    texts = ["12.75", "-12.75", "0.999999", "-0.5", "999999999.999999", "-999999999.999999", "000000001.000001", "1234567890.5", "12.9999999", "99999999999999.99", "1.", ".5", " 3.5 ", "1_0.5", "1.5\n"]
    got = spark.createDataFrame([(t,) for t in texts], "x string").select("x", as_int(F.col("x")).alias("n")).collect()
    assert {g["x"]: g["n"] for g in got} == {t: int(float(t.strip())) for t in texts}


def test_parsing_of_five_numbers_is_compiled(spark):
    """Other queries that parse all five numbers of a row: no method is too long for the JVM to compile."""
    import contextlib
    import io
    import re

    from tradelake import catalog

    for query in (catalog.source_totals, catalog.last_summaries, catalog.short_code_observations, catalog.classify_rows):
        found, said = query(spark, SF), io.StringIO()
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            with contextlib.redirect_stdout(said):
                found.select("*").explain("codegen")
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", said.getvalue())]
        assert sizes and max(sizes) < 8000, query.__name__
