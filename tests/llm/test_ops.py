"""The operators against brute force, exact round trips and held-out rows, on small tables with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tradelake.llm import byte_bpe, common, components, decontaminate, html_text, near_dup, ngram_lm, quality, queries, sql, token_records, toxicity, url_rules, vector_search

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Nulls, empty and very long texts, ties, repeated rows.
ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one two"), (5, "One TWO"), (6, "a b c d e f g"), (6, "a b c d e f g"), (7, "a b c d e f g"), (None, "a b c d e f g"), (8, "word  two\n\n  spaces \x85 end\n"),
    (9, "long " * 30_000 + "end"), (10, "x" * 40_000), (11, "<|endoftext|> é ñ 中文 🙂 don't 1234"), (12, None), (13, "ends with newline\n"), (14, "\u00a0odd\u2003space\x1c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in ODD], DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def key(x):
    return tuple("" if v is None else str(v) for v in x)


def reference_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


# 1


def expected_records(rows):
    t, start, out = reference_tokenizer(), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=key), start


def test_records_round_trip(spark, odd, tmp_path):
    got = token_records.token_table(odd.withColumns({"start": F.lit(1), "shard": F.lit("x"), "offset": F.lit(None)}), P.path("byte_bpe_50k.json"), 0, str(tmp_path / "r")).collect()
    want, total = expected_records(ODD)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=key) == want
    ordered = sorted(got, key=lambda r: (r["shard"], r["ordinal"]))
    assert [r["start"] for r in ordered] == np.cumsum([0, *[r["n_tokens"] for r in ordered][:-1]]).tolist()
    ids = [r["doc_id"] for r in ordered]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    shuffled = token_records.read_shuffled(spark, str(tmp_path / "r"), 3).collect()
    assert sorted(((r["doc_id"], len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in shuffled), key=key) == want


def test_special_tokens_follow_the_library(spark):
    texts = ["hello <|endoftext|> there", "a <|endoftext|>  b", "x<|endoftext|>", "<|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for as_text in (False, True):
        t = reference_tokenizer()
        t.encode_special_tokens = as_text
        want = {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)}
        work = common.Workspace(spark, "special")
        got = token_records.write_token_records(df, work.path, P.path("byte_bpe_50k.json"), 0, special_as_text=as_text).collect()
        assert {r["doc_id"]: r["n_tokens"] - 1 for r in got} == want


def test_texts_encoded_in_parts(documents, monkeypatch):
    """Chunks of a few words, long texts cut, words too long to keep, letters beyond ASCII."""
    import pyarrow as pa
    import tiktoken

    texts = [r["text"] for r in documents.limit(30).collect()] + [t for _, t in ODD] + ["été naïve, Straße. ñandú \u01c5ab ǅ, " * 40, "a" * 150 + " b " + "c" * 150, "中文 字, ab' it's, x.\nY don't."]
    t, ranks = reference_tokenizer(), byte_bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    library, codec = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), byte_bpe.TextCodec(ranks, P.PATTERN)
    for chunk in (common.CHUNK_BYTES, 200):
        monkeypatch.setattr(common, "CHUNK_BYTES", chunk)
        first = token_records.tokenizer_encoder(P.path("byte_bpe_50k.json"), 0, False)
        second = common.TextEncoder(lambda parts, before: [codec.packed(before + x) for x in parts], codec.kind, 50)
        for _ in range(2):
            assert [x.tolist() for x in first.encoded(pa.array(texts))] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]
            assert [x.tolist() for x in second.encoded(pa.array(texts))] == [library.encode_ordinary(x or "") for x in texts]


def test_kept_results_are_bounded():
    kept = common.Kept(10)
    for i in range(100):
        words = [str(i), "often", "x" * 200]
        assert kept.all(words, lambda new: [w.upper() for w in new]) == [w.upper() for w in words] and kept.one(f"y{i}", str.upper) == f"Y{i}"
    assert len(kept.young) + len(kept.old) <= 24 and "often" in kept.young | kept.old and "x" * 200 not in kept.young | kept.old


def test_damaged_records_are_found():
    data = token_records.frame(b"payload") + b"\n" + token_records.frame(b"") + b"\n"
    assert [p for _, p in token_records.frames(data)] == [b"payload", b""]
    for i in range(len(data)):
        bad = data[:i] + bytes([data[i] ^ 1]) + data[i + 1 :]
        with pytest.raises(ValueError):
            list(token_records.frames(bad))
    with pytest.raises(ValueError):
        list(token_records.frames(data[:-1]))


def test_records_of_an_empty_table(empty, tmp_path):
    assert token_records.token_table(empty, P.path("byte_bpe_50k.json"), 0, str(tmp_path / "r")).collect() == []


# 2


def brute_components(rows, size, percent=80):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((i, frozenset([tuple(w)] if 0 < len(w) < size else (tuple(w[k : k + size]) for k in range(len(w) - size + 1)))))
    part = {i: i for i, _ in sets if i is not None}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                i, j = find(i), find(j)
                part[max(i, j)] = min(i, j)
    return sorted(((i, len(x), None if i is None else find(i), True if i is None else find(i) == i) for i, x in sets), key=key)


def found_components(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()), key=key)


def test_near_duplicates_of_odd_rows(odd, empty):
    assert found_components(near_dup.near_duplicates(odd, 4)) == brute_components(ODD, 4)
    assert near_dup.near_duplicates(empty, 4).collect() == []


def test_near_duplicates_match_brute_force(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    draw = random.Random(5)
    words = rows[0][1].split()
    for k in range(60):  # a group whose members differ more from each other than from its base
        w = words[:]
        for _ in range(draw.randint(0, 9)):
            w[draw.randrange(len(w))] = f"edit{k}"
        rows.append((1000 + k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found_components(near_dup.near_duplicates(df, 4)) == brute_components(rows, 4)
    kept = {r["doc_id"] for r in near_dup.deduplicate(df.withColumn("kept", F.lit(1)), 5).collect()}
    assert kept == {i for i, _, _, k in brute_components(rows, 5) if k}


def test_sketch_fills_and_estimates():
    draw = np.random.default_rng(1)
    for n in (1, 2, 7, 100, 3000):
        assert near_dup.fast_sketch(draw.integers(0, 2**63, n, dtype=np.uint64), 128).max() < np.iinfo(np.uint64).max
    x = draw.integers(0, 2**63, 1800, dtype=np.uint64)
    a, b = near_dup.fast_sketch(x[:1500], 512), near_dup.fast_sketch(x[300:], 512)
    assert abs((a == b).mean() - 1200 / 1800) < 0.1


def test_components_of_a_long_path(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101)], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in components.connected_components(edges, common.Workspace(spark, "t"), "c").collect()}
    assert got == {i: 0 for i in range(n + 1)} | {100: 100, 101: 100}


# 3


def test_vector_search(spark):
    draw = np.random.default_rng(2)
    x = draw.standard_normal((400, 64))
    x[300:340] = x[5]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(400, None), (401, [0.0] * 64), (402, [float("nan")] * 64), (403, [None] * 64), (404, [1.0, 2.0]), (405, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("list", F.lit(1))
    got: dict = {}
    for r in vector_search.nearest(df, F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    u = x / np.linalg.norm(x, axis=1)[:, None]
    hits = 0
    for q in range(0, 400, 50):
        s = u @ u[q]
        s[q] = -9
        best = np.lexsort((np.arange(400), -np.round(s, 12)))[:5]
        hits += len({v for v, _ in got[q]} & set(best.tolist()))
        assert all(abs(score - s[v]) < 1e-12 for v, score in got[q]) and len(got[q]) == 5
    assert hits >= 0.9 * 40
    ties = [v for v, s in got[300] if s > 1 - 1e-9]
    assert ties == [5, 301, 302, 303, 304]
    assert vector_search.nearest(df.where("vec_id > 399"), F.lit(True), 5).collect() == []
    assert len(vector_search.nearest(df.where("vec_id < 3"), F.col("vec_id") == 0, 5).collect()) == 2


# 4


def test_bpe_matches_the_library(odd, empty, documents):
    import tiktoken

    ranks = byte_bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df in (odd, documents, empty):
        rows = {(r["doc_id"], r["text"]) for r in df.collect()}
        want = []
        for i, t in rows:
            ids = library.encode_ordinary(t or "")
            want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
        clash = df.withColumns({"n_tokens": F.lit("x"), "ids": F.lit(1), "ids_sha256": F.lit(None)})
        got = byte_bpe.encode_texts(clash, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, with_ids=True)
        assert {tuple(r)[:4] for r in got.collect()} == set(want) and got.count() == df.count()


def test_bpe_edits():
    bpe = byte_bpe.PrefixBPE(byte_bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")))
    draw, e = random.Random(3), byte_bpe.EditableEncoding(bpe)
    for _ in range(200):
        new = bytes(draw.choice(b"abcdeth ing.\xc3\xa9") for _ in range(draw.randint(0, 8)))
        if draw.random() < 0.5:
            e.append(new)
        else:
            a, b = sorted(draw.randint(0, len(e.piece)) for _ in range(2))
            e.replace(a, b, new)
        assert e.ids() == ([bpe.ranks[e.piece]] if e.piece in bpe.ranks else bpe.merge(e.piece))


# 5


def edit_distance(a, b):
    row = [0] * (len(b) + 1)
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_myers():
    draw = random.Random(1)
    for _ in range(500):
        a, b = ("".join(draw.choice("abc") for _ in range(draw.randint(k, 20))) for k in (1, 0))
        assert decontaminate.myers(a, b)[0] == edit_distance(a, b)


def test_leaks_match_brute_force(spark, odd, empty):
    draw = random.Random(2)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(draw.randint(6, 20)))) for i in range(12)] + [(50, ""), (51, None), (None, "x y z")]
    docs = []
    for d in range(60):
        text = [word() for _ in range(30)]
        if d % 2:
            chars = list(items[d % 12][1])
            for _ in range(draw.randint(0, int(len(chars) * 0.14))):
                chars[draw.randrange(len(chars))] = draw.choice(["x", "", "yy"])
            text.insert(draw.randint(0, 30), "".join(chars).upper() + " !")
        docs.append((d, " ".join(text)))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS)
    want = {}
    for d, t in docs:
        n = decontaminate.normalize(t)
        want[d] = sorted(i for i, x in items if i is not None and x and edit_distance(decontaminate.normalize(x), n) <= int(len(decontaminate.normalize(x)) * 0.1))
    got = decontaminate.find_leaks(df, bench)
    assert {r["doc_id"]: r["item_ids"] for r in got.collect()} == want and any(want.values()) and not all(want.values())
    blocks = decontaminate.find_leaks(df, bench, block_chars=100)
    assert {r["doc_id"]: r["item_ids"] for r in blocks.collect()} == want
    kept = decontaminate.decontaminate(df.withColumn("matches", F.lit(1)), bench)
    assert {r["doc_id"] for r in kept.collect()} == {d for d in want if not want[d]} and kept.columns[-1] == "matches"
    assert decontaminate.find_leaks(odd, bench).where("contaminated").count() == 0 and decontaminate.find_leaks(odd, bench).count() == len(ODD)
    assert decontaminate.find_leaks(empty, bench).count() == 0 and decontaminate.decontaminate(odd, bench.limit(0)).count() == len(ODD)


# 6


def article(page):
    page = page[page.index("<article>") + 9 : page.index("</article>")]
    import html

    return " ".join(html.unescape(re.sub(r"</?(p|br|h1)>", " ", re.sub(r"</?b>", "", page))).split())


def test_pages_match_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    assert {r["page_id"]: r["text"] for r in html_text.extract_text(pages.withColumn("host", F.lit("x"))).collect()} == want


def test_pages_without_articles(spark):
    page = lambda i, x: (i, f"http://h.com/{i}", f"<body><div class='top'>Site name</div><ul class='menu'><li>Home</li></ul><div id='c{i}'><h2>Title {i}</h2><p>{x} &amp; more</p><!-- no --><aside>Side</aside></div><div class='comments'><p>Nice</p></div><form><p>Mail</p></form><div>All rights</div></body>")
    rows = [page(i, f"body number {i} with words") for i in range(4)] + [(9, None, None), (10, "nonsense", ""), (11, "http://h.com/x", "plain text"), (11, "http://h.com/x", "plain text"), (None, "http://h.com/y", "<article><header>By</header>ab<b>c</b><br>d<script>x</script></article>"), (12, "http://g.com", "<p>unclosed <b>tag")]
    got = html_text.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    text = {}
    for r in got:
        text.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert text[2] == ["Title 2 body number 2 with words & more"]
    assert text[9] == [""] and text[10] == [""] and text[11] == ["plain text"] * 2 and text[None] == ["abc d"] and text[12] == ["unclosed tag"]


def test_template_texts_in_articles_go(spark):
    same = "Prose that some pages quote."
    body = lambda i: "".join(f"<p>{same if i % 2 and k == i % 5 else f'Page {i} says its own thing, number {k}.'}</p>" for k in range(5))
    rows = [(i, f"http://h.com/{i}", f"<body><article><div class='x'>By the staff</div><h1>Title {i}</h1>{body(i)}<p>Read more of it</p></article></body>") for i in range(8)]
    copies = [(20 + i, f"http://g.com/{i}", f"<body><main><p>One long text that all pages of this host hold.</p><p>Copy {i}</p></main></body>") for i in range(5)]
    text = {r["page_id"]: r["text"] for r in html_text.extract_text(spark.createDataFrame(rows + copies, "page_id bigint, url string, html string")).collect()}
    for i in range(8):
        assert text[i] == f"Title {i} " + " ".join(re.findall("<p>(.*?)</p>", body(i))) and (same in text[i]) == bool(i % 2)
    assert all(text[20 + i] == f"One long text that all pages of this host hold. Copy {i}" for i in range(5))


def test_the_template_decides(spark, empty):
    """With the template left out, texts that all pages repeat would stay, on pages with an article and without."""
    bare = lambda i: f"<body><p>Our daily news</p><div class='story'><p>First part {i}.</p></div><div class='story b{i}'><p>Second part {i}.</p></div><p>All rights</p></body>"
    full = lambda i: f"<body><article><p>Our daily news</p><h1>Title {i}</h1><p>Story number {i} is told here.</p><p>Read on</p></article></body>"
    rows = [(i, f"http://h.com/{i}", bare(i)) for i in range(6)] + [(10 + i, f"http://g.com/{i}", full(i)) for i in range(6)]
    rows.append((99, "http://long.com/", "<p>start</p>" + "<div><p>one more block</p></div>" * 20_000))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, host string, token int")
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(df).collect()}
    for i in range(6):
        assert got[i] == f"First part {i}. Second part {i}." != html_text.slots_text(bare(i))
        assert got[10 + i] == f"Title {i} Story number {i} is told here." != html_text.slots_text(full(i))
    assert got[99] == "start" + " one more block" * 20_000
    none = {r["page_id"]: r["text"] for r in html_text.extract_text(df, share=2.0).collect()}
    assert all(none[r[0]] == html_text.slots_text(r[2]) for r in rows)
    assert html_text.extract_text(df.limit(0)).collect() == []


def test_wrappers_of_the_content_are_no_asides():
    text = html_text.slots_text
    inner = "<nav>Home</nav><article><p>The whole text</p><div class='share-buttons'>Tell</div></article><div class='comments'><article>Nice</article></div>"
    for page in ("<body class='no-sidebar'>{}</body>", "<body class='modal'>{}</body>", "<div id='page-with-sidebar'>{}</div>", "<div class='header-fixed layout'>{}</div>", "<form id='all'><div class='widget'>{}</div></form>"):
        assert text(page.format(inner)) == "The whole text", page
    assert text("<div id='x'>A long text without an article</div><div class='related'><article>Teaser</article></div>") == "A long text without an article"
    assert text("<div class='page-with-sidebar'>Text</div><div class='sidebar'>Side</div>") == "Text"


# 7


class Recursion:
    """The model as a recursion on counts, without states."""

    def __init__(self, texts, order, mu=ngram_lm.MU):
        self.order, self.mu, self.docs, self.counts = order, mu, len(texts), Counter()
        for text in texts:
            tokens = [ngram_lm.START] * (order - 1) + (text or "").encode().lower().split() + [ngram_lm.END]
            for i in range(order - 1, len(tokens)):
                self.counts.update(tuple(tokens[i - n + 1 : i + 1]) for n in range(1, order + 1))
        single = [c for g, c in self.counts.items() if len(g) == 1]
        self.total, self.distinct = sum(single), len(single)
        self.d = ngram_lm.discount(single.count(1), single.count(2))

    def size(self, state):
        return self.docs if all(x == ngram_lm.START for x in state) else self.counts[state]

    def probability(self, state, word):
        if not state:
            c = self.counts[(word,)]
            return ((c - self.d) if c else self.d * self.distinct) / self.total if self.total else 1.0
        return (self.counts[(*state, word)] + self.mu * self.probability(state[1:], word)) / (self.size(state) + self.mu)

    def failures(self, state, word):
        """Contexts, from the longest on, that have no arc for the word."""
        while state and not self.size(state):
            state = state[1:]
        n = 0
        while state and not self.counts[(*state, word)]:
            n, state = n + 1, state[1:]
        return n

    def walk(self, text):
        state, score, failed = (ngram_lm.START,) * (self.order - 1), 0.0, 0
        for word in [*(text or "").encode().lower().split(), ngram_lm.END]:
            score += math.log10(self.probability(state, word))
            failed += self.failures(state, word)
            state = (*state, word)[1:] if self.order > 1 else ()
        return score, failed


def plain_texts(draw, n):
    return [" ".join(draw.choice("The a cat dog sat mat ran far".split()) for _ in range(draw.randint(0, 40))) for _ in range(n)]


def test_automaton_scores_match_the_recursion(spark, odd, empty):
    rows = [*enumerate(plain_texts(random.Random(4), 80)), *ODD]
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id bigint, text string, score double, words string").repartition(3)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    train = [t for i, t in rows if not held(i)]
    for order in (1, 2, 3, 4):
        model = Recursion(train, order)
        n, v = model.total, model.distinct
        want = []
        for i, t in rows:
            tokens = [*(t or "").encode().lower().split(), ngram_lm.END]
            c = [model.counts[(w,)] for w in tokens]
            want.append((i, held(i), len(tokens), sum(x > 0 for x in c), n, sum(math.log10((x + 1) / (n + v + 1)) for x in c), model.walk(t)[0]))
        got = [tuple(r) for r in ngram_lm.score_documents(df, order=order, block_bytes=2000).collect()]
        flat = lambda rs: sorted(((*r[:5], round(r[5], 6), round(r[6], 6)) for r in rs), key=key)
        assert flat(got) == flat(want)
    assert ngram_lm.score_documents(empty).collect() == []
    none = ngram_lm.score_documents(df, held_out=F.lit(True)).collect()
    assert all(r["base_score"] == 0 and r["score"] == 0 and r["held_out"] for r in none)


@pytest.mark.parametrize("lane_words", [1, 2, 7, 1000])
def test_traversal_carries_its_state_and_fails_as_it_should(lane_words):
    texts = plain_texts(random.Random(9), 60)
    held = np.array([i % 3 == 0 for i in range(60)])
    block = ngram_lm.Block()
    for i, t in enumerate(texts):
        block.add(i, bool(held[i]), t + " unseen" * (i % 6 == 0))
    row = block.row(0)
    for order in (1, 2, 3, 4):
        model = Recursion([t for t, h in zip(texts, held) if not h], order)
        found, starts, place = ngram_lm.grams(row[4], np.concatenate(block.tokens), held, order)
        ends = np.zeros(len(place), bool)
        ends[np.append(starts[1:], len(place)) - 1] = True
        automaton = ngram_lm.Automaton([x[1] for x in found], [x[3] for x in found], [x[2].astype(np.int64) for x in found], place, ends, model.docs, model.total, model.distinct, model.d, model.mu)
        scores, failures = automaton.traverse(found[0][1].astype(np.int64), lane_words)
        walks = [model.walk(t + " unseen" * (i % 6 == 0)) for i, t in enumerate(texts)]
        assert np.allclose(np.add.reduceat(scores, starts), [s for s, _ in walks]) and failures == sum(f for _, f in walks)


def test_probabilities_sum_to_one():
    model = Recursion(["a b c a", "b b d", "a"], 3)
    words = [w for (w,) in (g for g in model.counts if len(g) == 1)] + [b"unseen"]
    for state in ((b"a", b"b"), (ngram_lm.START, ngram_lm.START), (b"x", b"y"), (b"unseen", b"a")):
        assert abs(sum(model.probability(state, w) for w in words) - 1) < 1e-9


def test_scores_beat_the_base_on_held_out_rows(documents):
    r = ngram_lm.score_documents(documents).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r["s"] > r["b"]


# 8


def test_url_rules_match_sql(spark):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    got = queries.op8_url_rules(spark, SF)
    assert {tuple(r) for r in got.select("page_id", "host", "path", "rule", "verdict").collect()} == set(c.sql(sql.oracle_sql()["op8_url_rules"]).fetchall())


def test_url_rules_on_odd_urls(spark):
    cases = {
        "http://WWW.Example.COM/en/x?q#f": ("www.example.com", "/en/x", "www.example.com/en/", "allow"), "https://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"), "http://example.com/english": ("example.com", "/english", "com/", "allow"),
        "http://net/es/": ("net", "/es/", "net/es/", "block"), "http://xnet/es/": ("xnet", "/es/", None, "allow"), "http://a.net/fr/1?x=://b.net/es/": ("a.net", "/fr/1", "net/fr/", "block"), "http://com": ("com", "", None, "allow"), "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"),
        "x://a.com?p=/en/": ("a.com", "", None, "allow"), "HTTP://É.com/": ("É.com", "/", "com/", "allow"),
    }
    df = spark.createDataFrame([(u, "x", 1) for u in cases] * 2, "url string, host string, verdict int")
    got = url_rules.judge_urls(df, url_rules.rules_frame(spark, queries.URL_RULES)).collect()
    assert len(got) == 2 * len(cases) and all((r["host"], r["path"], r["rule"], r["verdict"]) == cases[r["url"]] for r in got)
    rules = url_rules.rules_frame(spark, queries.URL_RULES)
    assert url_rules.judge_urls(df.limit(0), rules).collect() == [] and url_rules.judge_urls(df.where("false"), rules.where("false")).collect() == []
    long = spark.createDataFrame([("http://a.net/es/" + "x" * 100_000, 1)], "url string, short int")
    assert url_rules.judge_urls(long, rules).first()["rule"] == "net/es/"
    none = url_rules.judge_urls(df, rules.limit(0)).collect()
    assert {r["verdict"] for r in none} == {"allow"}


# 9


def labelled(spark):
    draw = random.Random(6)
    word = lambda: "".join(draw.choice(["an", "the", "re", "in", "on", "er", "st"]) for _ in range(draw.randint(1, 3)))
    docs, labels = [], []
    for i in range(400):
        words = [word() for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                words.insert(draw.randrange(60), draw.choice(["idiot", "moron", "stupid"]))
        docs.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, int(i % 3 > 0), int(bad)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_finds_disguised_words(spark, odd, empty):
    docs, labels = labelled(spark)
    out = toxicity.toxicity(docs, labels).join(labels, "doc_id")
    r = out.where("held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("right")).first()
    assert r["right"] > 0.95
    model = toxicity.learn(docs, labels)
    restore = toxicity.Restorer(model.chars)
    for disguised, word in {"1d1ot": "idiot", "m0r0n": "moron", "stuuuupid": "stupid", "$tupid": "stupid", "IDIOOOT!!": "idiot"}.items():
        assert word in restore.words(f"the {disguised} there"), (disguised, restore.words(disguised))
    assert "idiot" in restore.words("an i d i o t here") and "moron" in restore.words("m.o.r.o.n")
    assert restore.words("the%%% ansh*** WORD!! 1234 plain") == {"the", "ansh", "word", "1234", "plain"}
    got = toxicity.score_texts(odd, model)
    assert got.count() == len(ODD) and got.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.drop_toxic(docs.withColumn("score", F.lit(1)), model).where("doc_id % 4 = 0").count() == 0
    assert toxicity.score_texts(empty, model).count() == 0
    nothing = toxicity.learn(docs, labels.limit(0))
    assert toxicity.drop_toxic(odd, nothing).count() == len(ODD)


def test_toxicity_reads_every_disguise(spark):
    docs, labels = labelled(spark)
    restore = toxicity.Restorer(toxicity.learn(docs, labels).chars)
    for disguised, word in {
        "stuupid": "stupid", "moroon": "moron", "i d ! o t": "idiot", "$ t u p i d": "stupid", "m\to\tr\t0\tn": "moron", "i\nd\ni\no\nt": "idiot",
        "mor.on": "moron", "st-upid": "stupid", "id_iot": "idiot", "i*d*i*o*t": "idiot", "(stupid)": "stupid", "an": "an",
    }.items():
        assert word in restore.words(f"the {disguised} there"), (disguised, restore.words(disguised))
    restore = toxicity.Restorer(toxicity.CharModel(dict.fromkeys(("worthless", "the", "well", "known"), 50)))
    assert "worthless" in restore.words("worthle$$") and "worthless" in restore.words("worthle$$!!")
    assert restore.words("the! 12-34 (the) the*** known.") == {"the", "12-34", "known"}
    assert {"well", "known", "well-known"} <= restore.words("well-known")
    assert restore.words("* * * * - - 1 2 3") == {"", "1", "2", "3"}


# 10


def test_quality_ranks_held_out_rows(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.quality(docs, labels).join(labels, "doc_id").where("held_out and quality is not null")
    assert out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right")).first()["right"] > 0.9
    ranker = quality.learn(docs, labels)
    got = quality.score_texts(odd, ranker)
    assert got.count() == len(ODD) and got.where("score is null or score < 0 or score > 1").count() == 0
    assert quality.score_texts(empty, ranker).count() == 0
    assert quality.drop_poor(odd, quality.learn(docs, labels.limit(0))).count() == len(ODD)


# pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        assert after.join(docs, docs.columns, "left_anti").count() == 0
        docs = after.cache()
    out = corpus_pipeline.run(spark, SF)
    assert out.count() == docs.count() > 0
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs.collect()}


@pytest.mark.parametrize("name", ["op2_near_dup", "op6_html_text"])
def test_queries_match_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = c.sql(sql.oracle_sql()[name])
    assert {tuple(r) for r in queries.queries()[name](spark, SF).select(*want.columns).collect()} == set(want.fetchall())
