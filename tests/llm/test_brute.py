"""Operators whose results SQL can't express, against plain enumeration, formulas and double loops; the pipeline stage by stage."""

import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tradelake.llm import common, decontaminate, near_dup, quality, toxicity, vector_search

SYLLABLES = ["an", "the", "re", "in", "on", "er", "st"]
BAD = ["idiot", "moron", "stupid"]
ODD = [(None, "no id here"), (901, None), (902, ""), (903, " \n\t "), (904, "x" * 30_000), (905, "word " * 20_000), (906, "same text twice"), (906, "same text twice"), (907, "中文 é 🙂 <|endoftext|>")]


def word(draw):
    return "".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 3)))


def corpus(n=240):
    """Rows (id, text), labels (id, quality, toxic): every fourth toxic, every third poor."""
    draw, docs, labels = random.Random(6), [], []
    for i in range(n):
        words = [word(draw) for _ in range(60)]
        if i % 4 == 0:
            for _ in range(3):
                words.insert(draw.randrange(60), draw.choice(BAD))
        if i % 3 == 0:
            words = [w + draw.choice(["%%%", "&&&", "***"]) if draw.random() < 0.6 else w for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 3 > 0), int(i % 4 == 0)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    return spark.createDataFrame(docs + ODD, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


# 9


def test_decoding_matches_enumeration():
    draw = random.Random(3)
    model = toxicity.CharModel(Counter(word(draw) for _ in range(400)) + Counter(BAD * 40))

    def best(token):
        found = {}
        for path in itertools.product(*toxicity.lattice(token)):
            score, state = sum(cost for _, cost in path), "^^"
            for letters, _ in path:
                if letters == toxicity.SPLIT:
                    if state != "^^":
                        score += model.log(state + "$")
                        state = "^^"
                else:
                    for c in letters:
                        score += model.log(state + c)
                        state = state[1] + c
            text = "".join(letters for letters, _ in path)
            found[text] = max(found.get(text, -math.inf), score + model.log(state + "$"))
        return found

    for token in ["1d1ot", "m0r0n", "$tup!d", "st.u.p1d", "id-iot", "stuupiid!!", "a*b", "i_d i0t", "..x", "mor#on", "*", "7h3"]:
        found = best(token)
        assert math.isclose(found[toxicity.decode(token, model)], max(found.values()), abs_tol=1e-9), token


def test_character_counts_cover_all_documents(spark, tables):
    docs, _ = tables
    words = Counter(w.strip(toxicity.EDGES) for r in docs.collect() for w in (r["text"] or "").lower().split())
    want = np.zeros(toxicity.BINS, np.int64)
    for w, n in words.items():
        for i in range((len(w) + 1) * w.isalpha()):
            a, b, c = f"^^{w}$"[i : i + 3]
            for key in ((toxicity.THREE, a + b + c), (toxicity.TWO, b + c), (toxicity.ONE, c), (toxicity.CONTEXT, a + b), (toxicity.MIDDLE, b), (toxicity.ALL, "")):
                want[toxicity.bin_of(*key)] += n
    assert (toxicity.count_grams(docs.repartition(5)) == want).all()
    assert not toxicity.count_grams(docs.limit(0)).any()


def plain_toxicity(model, text):
    restorer, found = toxicity.Restorer(model.chars), set()
    for raw in (text or "").lower().split():
        for w in restorer.word(raw):
            found.update(f for f in toxicity.features_of(w) if f in model.weights)
    for words in restorer.spaced((text or "").lower()):
        found.update(f for w in words for f in toxicity.features_of(w) if f in model.weights)
    z = model.bias + math.fsum(model.weights[f] for f in found)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_toxicity_scores_follow_the_formula(spark, tables):
    docs, labels = tables
    more = docs.withColumns({"score": F.lit("x"), "predicted": F.lit(7), "toxic": F.lit(1)})
    model = toxicity.learn(more, labels)
    want = Counter((r["doc_id"], round(plain_toxicity(model, r["text"]), 9)) for r in docs.collect())
    assert Counter((r["doc_id"], round(r["score"], 9)) for r in toxicity.score_texts(more, model).collect()) == want
    kept = toxicity.drop_toxic(more, model)
    assert kept.columns == more.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter(i for (i, s), n in want.items() if s < toxicity.THRESHOLD for _ in range(n))
    alike = toxicity.learn(docs.union(docs.where("doc_id < 9")).repartition(3), labels.union(labels.limit(5)))
    assert alike.weights.keys() == model.weights.keys()  # repeated rows teach once


# 10


def test_pair_loss_gradient_and_cut():
    draw = np.random.default_rng(2)
    z, w = draw.standard_normal((30, 4)), draw.standard_normal(4)
    a, b = draw.integers(0, 30, 90), draw.integers(0, 30, 90)
    value, gradient = quality.loss(w, z, a, b)
    plain = lambda w: sum(math.log(1 + math.exp(-(sum(z[i] * w) - sum(z[j] * w)))) for i, j in zip(a, b)) / 90 + quality.DECAY / 2 * sum(w * w)
    assert math.isclose(value, plain(w), rel_tol=1e-9)
    for k in range(4):
        step = np.eye(4)[k] * 1e-5
        assert math.isclose(gradient[k], (plain(w + step) - plain(w - step)) / 2e-5, rel_tol=1e-4, abs_tol=1e-6)
    scores = draw.standard_normal(50)
    for poor in (1, 7, 49):
        assert (scores < quality.quantile_cut(scores, poor)).sum() == poor


def test_quality_scores_follow_the_formula(spark, tables):
    docs, labels = tables
    more = docs.withColumns({"score": F.lit("x"), "label": F.lit(7), "quality": F.lit(1)})
    ranker = quality.learn(more, labels)

    def plain(text):
        words = (text or "").split()
        x = [*quality.form(text, Counter(words)), *[0.0] * quality.WORD_BINS]
        for k, n in Counter(quality.word_bins(words)).items():
            x[len(quality.FEATURES) + k] = math.sqrt(n / len(words))
        z = [max(-8.0, min(8.0, (v - m) / s)) for v, m, s in zip(x, ranker.mean, ranker.scale)]
        f = len(quality.FEATURES)
        total = sum(v * w for v, w in zip([*z[:f], *map(abs, z[:f]), *(v * v / 8 for v in z[:f]), *(v * quality.WORD_SCALE for v in z[f:])], ranker.weights))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total - ranker.cut + math.log(0.3 / 0.7)))))

    want = Counter((r["doc_id"], round(plain(r["text"]), 6)) for r in docs.collect())
    assert Counter((r["doc_id"], round(r["score"], 6)) for r in quality.score_texts(more, ranker).collect()) == want
    kept = quality.drop_poor(more, ranker)
    assert kept.columns == more.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter(i for (i, s), n in want.items() if s >= 0.3 for _ in range(n))


def test_words_of_classes_are_learned():
    """Texts of one form that differ in their words only."""
    draw, own = random.Random(1), quality.Features()
    texts = [" ".join(draw.choice(["alpha", "bravo", "delta"] if i % 2 else ["gamma", "omega", "theta"]) for _ in range(40)) for i in range(200)]
    x, y = np.array([own.of(t) for t in texts]), np.arange(200) % 2
    ranker = quality.fit(x[:150], y[:150])
    assert ((ranker.score(x[150:]) >= 0.3) == y[150:]).mean() > 0.95


# 3


def plain_nearest(rows, is_query, k):
    out = []
    for q in sorted({i for i, v in rows if is_query(i)}):
        own = next(v for i, v in rows if i == q)
        top = max(map(abs, own))
        scores = []
        for i, v in rows:
            if i != q and len(v) == len(own):
                a, b = np.array(own) / top, np.array(v) / max(map(abs, v))
                scores.append((-round(float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)), 12), i))
        out += [(q, r, i) for r, (_, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def test_search_of_lengths_repeats_and_large_components(spark):
    draw = np.random.default_rng(5)
    rows = [(i, draw.standard_normal(16).tolist()) for i in range(60)] + [(100 + i, draw.standard_normal(3).tolist()) for i in range(9)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (10, rows[10][1]), (200, [1e200] + [0.0] * 15), (201, [1e-200] * 16), (202, [1.0] * 16)]
    df = spark.createDataFrame([*rows, (None, [1.0] * 16), (300, [math.inf] * 16), (301, [0.0] * 16)], "vec_id bigint, embedding array<double>").withColumns({"q": F.lit(1), "known": F.lit(2.0)})
    got = vector_search.nearest(df, F.col("vec_id") % 10 == 0, 5, cover=1.0).orderBy("query_id", "rank")
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got.collect()] == plain_nearest(rows, lambda i: i % 10 == 0, 5)


def test_search_widens_until_enough_are_found(spark):
    """Lists that hold few rows: the probed ones don't hold k candidates."""
    draw = np.random.default_rng(8)
    far = [(i, (np.eye(8)[i % 8] * 50 + draw.standard_normal(8) * 0.01).tolist()) for i in range(24)]
    df = spark.createDataFrame(far, "vec_id bigint, embedding array<double>")
    got = vector_search.nearest(df, F.col("vec_id") % 6 == 0, 9, cover=0.01, block_rows=3, group_queries=2).collect()
    assert Counter(r["query_id"] for r in got) == {0: 9, 6: 9, 12: 9, 18: 9}
    close = {q: {r["vec_id"] for r in got if r["query_id"] == q and r["rank"] <= 2} for q in (0, 6, 12, 18)}
    assert all(close[q] == {i for i, _ in far if i % 8 == q % 8 and i != q} for q in close)


# the pipeline


def edit_distance(a, b):
    row = [0] * (len(b) + 1)
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def plain_groups(rows, size=5):
    """Ids that aren't the smallest of their group."""
    shingles = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        if i is not None and w:
            shingles[i] = {tuple(w)} if len(w) < size else {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
    lowest = {i: i for i in shingles}
    for _ in shingles:
        for x, y in itertools.combinations(shingles, 2):
            if 100 * len(shingles[x] & shingles[y]) >= 80 * len(shingles[x] | shingles[y]):
                lowest[x] = lowest[y] = min(lowest[x], lowest[y])
        if all(lowest[lowest[i]] == lowest[i] for i in lowest):
            break
    return {i for i in lowest if lowest[i] != i}


def test_stages_match_plain_versions(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    docs, labels = corpus(120)
    draw = random.Random(11)
    items = [(k, " ".join(word(draw) for _ in range(12))) for k in range(4)] + [(9, ""), (None, "a b")]
    clean = [i for i, q, t in labels if q and not t]
    text = dict(docs)
    for k, i in enumerate(clean[:4]):  # items inside clean texts, each with an edit
        chars = list(items[k][1])
        chars[5] = "z"
        docs.append((300 + i, " ".join([*text[i].split()[::-1][:30], "".join(chars).upper(), *text[i].split()[:20]])))
    for i in clean[4:10]:  # near copies and copies
        words = text[i].split()
        docs += [(500 + i, " ".join(words[:-1] + ["ends"])), (600 + i, text[i]), (700 + i, " ".join(["starts"] + words[1:]))]
    rows = docs + ODD
    cut = [(i, t, "en", "s", len(t or ""), "own") for i, t in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string"
    spark.createDataFrame(cut, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sf, stages = str(tmp_path), dict(corpus_pipeline.STAGES)
    table = lambda df: Counter(map(tuple, df.collect()))
    now, frame = Counter(cut), spark.read.parquet(f"{sf}/documents.parquet")
    label_rows = spark.read.parquet(f"{sf}/labels.parquet")

    tox, rank = toxicity.learn(frame, label_rows), None
    plain = {
        "toxicity": lambda r: plain_toxicity(tox, r[1]) < toxicity.THRESHOLD,
        "quality": lambda r: rank.score(quality.Features().of(r[1])) >= quality.THRESHOLD,
        "near_duplicates": lambda r: r[0] not in gone,
        "decontamination": lambda r: not any(i is not None and x and edit_distance(x, decontaminate.normalize(r[1])) <= len(x) // 10 for i, x in items),
    }
    for name in plain:
        if name == "quality":
            rank = quality.learn(frame, label_rows)
        gone = plain_groups([r[:2] for r in now]) if name == "near_duplicates" else set()
        want = Counter({r: n for r, n in now.items() if plain[name](r)})
        frame = stages[name](spark, frame, sf)
        assert frame.columns == [c.split()[0] for c in schema.split(", ")]
        assert table(frame) == want and len(want) < len(now), name
        now = want
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={**__import__("tradelake.llm.byte_bpe", fromlist=["x"]).load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))}, special_tokens={})
    want = Counter()
    for r, n in now.items():
        ids = library.encode_ordinary(r[1] or "")
        want[(r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest())] += n
    assert table(stages["byte_bpe"](spark, frame, sf)) == want
    assert table(corpus_pipeline.run(spark, sf)) == want
    none = spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf).count() == 0, name


def test_items_in_blocks_are_one_pass_each(spark):
    docs, _ = corpus(30)
    items = [(i, " ".join(t.split()[5:20])) for i, t in docs[::3]]
    df, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    whole = decontaminate.find_leaks(df, bench)
    assert sorted(map(str, decontaminate.find_leaks(df, bench, block_chars=150).collect())) == sorted(map(str, whole.collect()))
    assert {r["doc_id"] for r in whole.where("contaminated").collect()} >= {i for i, _ in docs[::3]}
    assert decontaminate.decontaminate(df, bench, block_chars=150).count() == whole.where("not contaminated").count()


def test_many_copies_learn_their_component(spark):
    rows = [(i, "one text that many documents share with each other") for i in range(100, 300)] + [(5, "another text that stands for itself alone here")]
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 4).collect()}
    assert got == {i: (100, i == 100) for i in range(100, 300)} | {5: (5, True)}


def test_the_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(Conf)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session)


def test_a_block_of_items_fits_a_worker(spark):
    """Eight million characters of items of a thousand each: blocks of bounded size, automata built in seconds, runs made when met."""
    import time

    draw = random.Random(8)
    text = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(200_000))
    items = [(i, text[s : s + 1000]) for i, s in enumerate(draw.randrange(199_000) for _ in range(8_000))]
    bench = spark.createDataFrame(items + [(None, "no id"), (9_000, None), (9_001, " .,! ")], "item_id bigint, text string")
    began, blocks = time.monotonic(), list(decontaminate.item_blocks(bench, "item_id", "text", decontaminate.BLOCK_CHARS))
    assert [i for b in blocks for i, _ in b] == list(range(8_000)) and all(sum(len(t) for _, t in b) < decontaminate.BLOCK_CHARS + 1001 for b in blocks) and len(blocks) == 8
    began = time.process_time()
    matcher = decontaminate.Matcher(blocks[0], 0.1)
    assert time.process_time() - began < 5 and not matcher.known  # ten seconds for all eight
    item = blocks[0][77][1]
    assert (77, 0) in [x[:2] for x in matcher.find("before " + item + " after")] and 0 < len(matcher.known) <= decontaminate.ITEMS_KEPT


def test_words_of_items_have_no_edges(spark):
    docs = spark.createDataFrame([(1, "concatenate"), (2, "dog")], "doc_id bigint, text string")
    found = decontaminate.find_leaks(docs, spark.createDataFrame([(5, "Cat")], "item_id bigint, text string")).where("contaminated").collect()
    assert [(r["doc_id"], r["item_ids"]) for r in found] == [(1, [5])]


def test_many_rows_of_one_leaking_text(spark):
    """Several blocks: a text that many rows share is one hit, and all its rows go."""
    rows = [(i, "the same leaking passage of words" if i % 3 else f"own text {i}") for i in range(90)] + [(None, "the same leaking passage of words"), (91, None), (92, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, h1 string").repartition(4)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(["leaking passage of words", "never there at all", "the same leaking passage"])], "item_id bigint, text string")
    found = decontaminate.find_leaks(docs, bench, block_chars=10).collect()
    assert sorted((r["doc_id"] or -1, tuple(r["item_ids"])) for r in found) == sorted((i or -1, (0, 2) if t and "leaking" in t else ()) for i, t in rows)
    kept = decontaminate.decontaminate(docs, bench, block_chars=10)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, t in rows if not (t and "leaking" in t))
