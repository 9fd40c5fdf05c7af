"""What the third round's findings named."""

import duckdb
import numpy as np
from test_oracles import SF, TABLES

from tradelake import catalog, oracles


def copies(path, times: int = 2):
    """The smallest tables with every row of lineitem several times: rows that share their key and their ordinal."""
    for t in TABLES:
        (path / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    (path / "lineitem.parquet").unlink()
    c = duckdb.connect()
    c.sql(f"COPY (SELECT l.* FROM '{SF}/lineitem.parquet' l, range({times})) TO '{path}/lineitem.parquet' (FORMAT parquet)")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet'")
    return c


def counted(rows) -> dict:
    out: dict = {}
    for r in rows:
        out[tuple(map(str, r))] = out.get(tuple(map(str, r)), 0) + 1
    return out


def test_rows_of_equal_ordinals_are_told_apart(spark, tmp_path):
    duck = copies(tmp_path)
    for name in ("classify_rows", "canonical_facts", "anomaly_table", "row_reconciliation", "anomaly_text_qa", "coverage_report_long"):
        got, want = catalog.queries()[name](spark, str(tmp_path)), duck.sql(oracles.oracle_sql()[name])
        columns = ", ".join(got.columns)
        assert counted(got.collect()) == counted(want.select(columns).fetchall()), name


def test_quarantine_alone_is_that_of_all_rows(spark):
    from tradelake import bindings
    from tradelake.operators import normalize

    raw = bindings.raw_rows(spark, SF)
    whole = normalize.classify(raw).where("bucket = 'quarantine'")
    alone = normalize.quarantined(raw)
    assert alone.columns == whole.columns and counted(alone.collect()) == counted(whole.collect())


def test_quality_learns_from_every_labelled_row(spark):
    import random

    from tradelake.llm import quality

    draw, words = random.Random(3), ["river", "stone", "garden", "window", "market", "letter"]
    text = lambda poor: " ".join(draw.choice(words) + ("%%%" if poor and draw.random() < 0.5 else "") for _ in range(12))
    rows = [(i, text(i % 3 == 0), int(i % 3 > 0)) for i in range(900)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    ranker = quality.learn(docs, labels, rows=100)
    own = quality.Features()
    x = np.array([own.of(r[1]) for r in rows]).astype("<f4").astype(float)
    assert np.allclose(ranker.mean, x.mean(0)) and np.allclose(ranker.scale, x.std(0) + 1e-6)
    assert np.isclose(ranker.cut, quality.quantile_cut(ranker.rank(x), 300))
    got = {r["doc_id"]: r["predicted"] for r in quality.score_texts(docs, ranker).collect()}
    assert sum(got[i] == good for i, _, good in rows) >= 880


def test_kth_smallest_score(spark):
    from tradelake.llm import quality

    values = [0.0] * 6_000 + [1e-12 * i for i in range(5_000)] + [-5.0, 7.0, 7.0]
    scores = spark.createDataFrame([(v,) for v in values], "r double")
    for k in (1, 2, 6_001, 6_003, 9_000, len(values) - 1, len(values)):
        assert quality.smallest(scores, k) == sorted(values)[k - 1], k
        assert quality.exact_cut(scores, k) == quality.quantile_cut(np.array(values), k), k


def test_tariff_pages_are_parsed_once_and_not_for_the_index(spark, monkeypatch):
    from tradelake.sources import html_tables

    rows, audit = catalog.tariff_labels(spark, SF)
    decisions = catalog.tariff_reviewed(spark, SF)[1]
    assert all("/labels-" in f for f in rows.inputFiles() + audit.inputFiles()) and all("/decisions-" in f for f in decisions.inputFiles())
    monkeypatch.delattr(html_tables, "chapter_table")
    assert catalog.tariff_index(spark, SF).count() == 60


def test_parts_are_dealt_out_before_their_years(spark):
    from tradelake import bindings

    cores = spark.sparkContext.defaultParallelism
    assert all(df.rdd.getNumPartitions() >= cores for df in bindings.label_conflicts(spark, SF))


def test_files_are_told_without_their_items():
    import gzip

    from tradelake.sources import pull

    page = "<r><header><resultCode> 00 </resultCode><resultMsg>ok<b>x</b>no</resultMsg></header><items>" + "<item><year>2024.01</year><hsCd>1</hsCd></item>" * 3000 + "<resultCode>99</resultCode></items></r>"
    other = "<t:r xmlns:t='u'><t:returnReasonCode>30</t:returnReasonCode><t:errMsg></t:errMsg><t:item/></t:r>"
    texts = [page, other, page[: len(page) // 2], page + "<", "", "<a>&x;</a>", "<t:a/>", other[:40]]
    files = [t.encode() for t in texts] + [gzip.compress(t.encode()) for t in texts]
    files += [gzip.compress(page.encode())[:-9], gzip.compress(page.encode())[:60] + b"x" * 40]
    for content in files:
        rows = list(pull.parsed_file(content))
        damaged = rows[-1][-1] is not None
        assert list(pull.file_row(content)) == rows[-1:], content[:80]
        assert list(pull.whole_file(content)) == (rows[-1:] if damaged else rows), content[:80]
    assert pull.fed(page.encode(), pull.Wellformed()) is None and pull.fed(page[:99].encode(), pull.Wellformed())
