"""Whitening, periodic runs and line dedup against plain versions, on small tables with odd rows."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from tradelake.llm import common, line_dedup, periodic_runs, queries, sql, whitening

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, n_lines bigint, drop string"


# 11


def plain_whitening(rows, k):
    """Rows (id, vector) by dense linear algebra: id to (deviation, whitened), shares and the fit list's size."""
    good = [(i, [int(np.floor(64 * c)) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], float) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = []
    for i, x in good:
        d = [n * c - s for c, s in zip(x, sums)]
        out.append((i, sum(c * c for c in d), (np.array(d, float) / n) @ u / np.sqrt(e)))
    return out, e / (y * y).sum() * n, n


def test_whitening_matches_dense_algebra(spark):
    draw = random.Random(2)
    rows = [(i, [draw.gauss(0, 1 + j % 5) for j in range(40)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)] + [(300, None), (301, [None] + [0.0] * 39), (302, [float("nan")] * 40), (303, [float("inf")] + [0.0] * 39), (3, rows[3][1]), (None, rows[5][1])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<double>, n int, component string").repartition(5)
    got = whitening.whiten(df, k=6).collect()
    want, explained, n = plain_whitening(rows, 6)
    assert n == 150 and len(got) == 6 * len(want) and {r["n"] for r in got} == {150}
    key = lambda i, d: (i is None, i or 0, d)
    found = sorted(((r["vec_id"], r["deviation"], r["component"], r["whitened"]) for r in got), key=lambda r: (*key(r[0], r[1]), r[2], r[3]))
    table = np.array([r[3] for r in sorted(found, key=lambda r: (r[2], *key(r[0], r[1])))]).reshape(6, -1).T
    want = sorted(want, key=lambda r: key(r[0], r[1]))
    dense = np.array([r[2] for r in want])
    sign = np.sign((table * dense).sum(0))
    assert np.abs(table - dense * sign).max() < 1e-9
    assert sorted({(r["vec_id"] is None, r["vec_id"] or 0, r["deviation"]) for r in got}) == sorted({key(r[0], r[1]) for r in want})
    assert all(abs(r["explained"] - explained[r["component"] - 1]) < 1e-12 and r["identity_error"] < 1e-9 for r in got)


def test_block_iteration_certifies_and_widens():
    draw = np.random.default_rng(5)

    def passes(values, k):
        d = len(values)
        basis = np.linalg.qr(draw.standard_normal((d, d)))[0]
        v, calls = basis * values @ basis.T, []

        def multiply(_fit, _n, _sums, q):
            calls.append(q.shape[1])
            return v @ q, float(np.trace(v))

        e, u, _ = whitening.components_of(None, 1, [0] * d, k, multiply=multiply)
        assert np.abs(e - values[:k]).max() < 1e-9 * values[0] and np.abs(v @ u - u * e).max() < 1e-9 * values[0] and np.abs(u.T @ u - np.eye(k)).max() < 1e-12
        return calls

    steep = passes(np.array([100.0 * 0.1**i + 1e-3 for i in range(200)]), 3)
    assert set(steep) == {19} and 2 <= len(steep) <= 12  # falls fast: the first block does
    flat = passes(np.linspace(2, 1, 90), 5)
    assert flat[0] == 21 and flat[-1] == 90 and len(flat) < 12  # flat: widened until one pass is exact


def test_whitening_of_small_and_degenerate_tables(spark):
    schema = "vec_id bigint, embedding array<double>"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    assert whitening.whiten(frame([])).count() == 0 and whitening.whiten(frame([(1, None), (2, [])])).count() == 0
    assert whitening.whiten(frame([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # one distinct vector has no spread
    two = whitening.whiten(frame([(1, [0.0, 2.0]), (2, [1.0, 2.0])])).collect()  # one component has any
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], round(abs(r["whitened"]), 9), round(r["explained"], 9)) for r in sorted(two)] == [(1, 1, 2, 4096, 1.0, 1.0), (2, 1, 2, 4096, 1.0, 1.0)]
    mixed = whitening.whiten(frame([(1, [0.0]), (2, [1.0]), (3, [0.0, 0.0]), (4, [1.0, 0.5]), (5, [0.25, 1.0])])).collect()  # each length on its own
    assert sorted((r["vec_id"], r["component"], r["n"]) for r in mixed) == [(1, 1, 2), (2, 1, 2), (3, 1, 3), (3, 2, 3), (4, 1, 3), (4, 2, 3), (5, 1, 3), (5, 2, 3)]
    huge = whitening.whiten(frame([(1, [1e14, 1.0]), (2, [-1e14, 2.0]), (3, [1e300, 1.0])])).collect()  # the sum of squares is no long; 1e300 has no whole number
    assert {(r["vec_id"], r["n"], r["deviation"]) for r in huge} == {(1, 2, None), (2, 2, None)} and all(abs(abs(r["whitened"]) - 1) < 1e-9 for r in huge if r["component"] == 1)


def test_exact_sums():
    x = np.array([[3, -5], [7, 1 << 40]])
    assert whitening.times_n(x, 10, [10, -4]).tolist() == [[20, -46], [60, 10 * (1 << 40) + 4]]
    far = whitening.times_n(np.array([[1 << 61]]), 1000, [5])
    assert far.dtype == object and far[0, 0] == 1000 * (1 << 61) - 5
    assert whitening.square_sums(np.array([[3, 4], [1 << 32, 0]])) == [25, None] and whitening.square_sums(np.array([[3, 4]])) == [25]


# 12


def plain_runs(words, least):
    """(start, length, period) of all runs: every period's maximal stretches, kept where no smaller period fits."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                part = words[i : i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_description(text, least):
    words = (text or "").encode("utf-8").split()
    runs = plain_runs(words, least)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return len(words), len(runs), *best, "".join(f"{a},{b},{c}\n" for a, b, c in runs), b" ".join(w for i, w in enumerate(words) if i not in gone).decode("utf-8")


def run_texts():
    draw, out = random.Random(4), [None, "", "  \n\t ", "one", "a " * 12, "a b " * 5, "a\x0bb\x0cc \x85 é x " * 4, "x y z " * 3000, "w" * 50_000]
    for _ in range(150):
        kinds, n = draw.choice([1, 2, 3, 9]), draw.randint(1, 70)
        words = [f"w{draw.randrange(kinds)}" for _ in range(n)]
        if draw.random() < 0.5:
            p, a = draw.randint(1, max(1, n // 3)), draw.randrange(n)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        out.append(draw.choice([" ", "  ", "\n", "\t "]).join(words))
    return out


@pytest.mark.parametrize("least", [2, 12])
def test_runs_match_plain_loops(spark, least, monkeypatch):
    texts = run_texts()
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (None, "b a b a b a b a b a b a b")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, length string").repartition(3)
    monkeypatch.setattr(periodic_runs, "CHUNK_BYTES", 700)  # several documents a piece, several pieces
    got = sorted((tuple(r) for r in periodic_runs.find_runs(df, least).collect()), key=str)
    assert got == sorted(((i, *plain_description(t, least)) for i, t in rows), key=str)
    assert periodic_runs.find_runs(df.limit(0)).count() == 0


def test_query_of_runs_matches_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda x: hashlib.sha256(x.encode("utf-8")).hexdigest()
    want = []
    for i, text in docs:
        h = zlib.crc32(str(i).encode())
        words = [w.decode() for w in text.encode().split()]
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[j] if j < a else words[a + (j - a) % p] for j in range(n))
        _, runs, start, length, period, lines, rest = plain_description(text, 12)
        want.append((i, runs, start, length, period, None if period is None else 1000 * length // period, sha(lines), sha(rest)))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = queries.op12_periodic_runs(spark, SF)
    assert [t for _, t in got.select(names).dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want) and sum(r[1] > 0 for r in want) > 10


def test_refinement_moves_few_positions():
    """On a periodic text of n words each level asks a few positions, not all."""
    n = 4000
    words = np.append(np.arange(n) % 7, 99)
    r, asked, splitters = periodic_runs.Refinement(words), 0, np.arange(1, n + 1)
    while len(splitters):
        splitters = r.refine(splitters)
        asked += len(splitters)
    assert asked < 4 * n and (r.size[: r.classes] == 1).all()


# 13


LINES = [
    (5, "Shared line number one\nown of five\nShared line number one"), (2, "  SHARED line NUMBER one\t\nown of two"), (9, "shared line number one\r\nshort\nshort"), (9, "shared line number one\r\nshort\nshort"), (11, "short\n\nshared LINE number one"),
    (12, None), (13, ""), (14, "\n\n"), (15, "ten chars!"), (16, "TEN CHARS!"), (17, "nine char"), (18, "nine char"), (None, "Shared line number one\nx"), (20, "é中文🙂 abcdef"), (21, "é中文🙂 ABCDEF\n" + "y" * 50_000), (22, "y" * 50_000),
    (23, "\x85shared line number one"), (30, "two texts of one id\nshared line number one"), (30, "another text of it\nvery own line of it"), (31, "another text of it\nvery own line of it\nafter"), *[(100 + i, f"hot line of a third\nown line number {i:05}") for i in range(80)],
]


def plain_lines(rows):
    strip = lambda line: line.strip(" \t\n\x0b\x0c\r")
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in strip(line))
    owners = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                owners.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < 10 or i == min(owners[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches,fan_in", [(1, 3), (4, 2), (7, 3)])
def test_lines_match_plain_version(spark, batches, fan_in):
    df = spark.createDataFrame([(i, t, "en", 0, "x") for i, t in LINES], DOCS).repartition(3)
    got = sorted((tuple(r) for r in line_dedup.dedup_lines(df, batches=batches, fan_in=fan_in).collect()), key=str)
    assert got == plain_lines(LINES) and sum(r[2] for r in got) > 80
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_runs_are_compacted_by_levels(spark):
    work = common.Workspace(spark, "levels")
    store = line_dedup.LineStore(spark, work, buckets=3, fan_in=2)
    for b in range(7):
        store.add(spark.createDataFrame([(b * 10 + i, i + 2 * b, i) for i in range(10)], "doc_id bigint, h1 bigint, h2 bigint"))
    assert [len(level) for level in store.levels] == [1, 1, 1]  # seven runs, in binary
    owners = {(r["h1"], r["h2"]): r["owner"] for run in store.runs() for r in run.collect()}
    want = {}
    for b in range(7):
        for i in range(10):
            want.setdefault((i + 2 * b, i), b * 10 + i)
    assert owners == want and sum(run.count() for run in store.runs()) == len(want)
    plan = store.unseen(spark.createDataFrame([(1, 1)], "h1 bigint, h2 bigint"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1  # the runs aren't dealt anew
    store.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_lines_on_native_functions_only(spark):
    plan = line_dedup.dedup_lines(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_line_query_matches_sql(spark):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = sorted(map(tuple, queries.op13_line_dedup(spark, SF).collect()))
    assert got == sorted(c.sql(sql.LINE_DEDUP).fetchall())


# 6


def test_class_words_are_hints_that_a_region_must_prove():
    from tradelake.llm.html_text import slots_text, token_key

    story = "Main story of several words, told at some length."
    assert slots_text(f'<div class="card widget-text"><p>{story}</p></div><p>x</p>') == f"{story} x"
    assert slots_text(f'<article><p>a</p><div class="related-topic-summary">{story}</div><ul class="menu-items-of-restaurant"><li>Soup<li>Fish</ul></article>') == f"a {story} Soup Fish"
    links = '<div class="related-topic-summary"><a href="1">Another story</a> <a href="2">and one more</a> see</div>'
    assert slots_text(f"<article><p>{story}</p>{links}</article>") == story  # links outweigh its text
    note = '<div class="notice-of-site">Shown on every page</div>'
    key = token_key((1, "/article/div.notice-of-site", 1, 0, "Shown on every page"))
    assert slots_text(f"<article><p>{story}</p>{note}</article>") == f"{story} Shown on every page" and slots_text(f"<article><p>{story}</p>{note}</article>", [], [], [key]) == story
    for name in ("ad", "sidebar-left", "comment-list", "site-menu", "cookie_banner", "share-buttons top"):
        assert slots_text(f'<article><p>{story}</p><div class="{name}">Something else that varies</div></article>') == story, name
    nested = f'<div class="widget-text"><div class="comments">So wrong</div><p>{story}</p><div id="promo">Buy</div></div>'
    assert slots_text(nested) == story
    held = f'<div class="notice-board"><article><p>{story}</p></article></div>'
    assert slots_text(held) == story
