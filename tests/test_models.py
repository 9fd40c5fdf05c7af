"""Boosting and permutation importance against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradelake.operators import boosting, forecast

NAMES = ["a", "b", "c"]


def table(n=240, seed=3):
    draw, rows = random.Random(seed), []
    for _ in range(n):
        a, b, c = draw.randint(0, 30), draw.choice([0.5, 1.5, 2.5]), draw.gauss(0, 1)
        y = math.sin(a / 5) * b + 0.3 * draw.gauss(0, 1) + (25 if draw.random() < 0.04 else 0)
        rows.append((float(a), b, c, y))
    return rows


def share(values, q):
    """The smallest value that a share q of the values doesn't exceed."""
    values = sorted(values)
    return next(v for i, v in enumerate(values) if i + 1 >= q * len(values) - 1e-9)


def plain_boosting(rows, edges, trees, step, depth, alpha):
    """Predictions after the trees: every edge of every feature tried in every node."""
    x, y = [r[:3] for r in rows], [r[3] for r in rows]
    score = [share(y, 0.5)] * len(y)
    for _ in range(trees):
        r = [b - a for a, b in zip(score, y)]
        clip = share([abs(v) for v in r], alpha)
        g = [max(-clip, min(clip, v)) for v in r]

        def grow(members, left):
            best = None
            if left:
                total = sum(g[i] for i in members)
                for j in range(3):
                    for e in edges[j]:
                        low = [i for i in members if x[i][j] <= e]
                        if 0 < len(low) < len(members):
                            n, m = len(low), len(members) - len(low)
                            s = sum(g[i] for i in low)
                            gain = n * m / (n + m) * (s / n - (total - s) / m) ** 2
                            if best is None or gain > best[0] + 1e-9:
                                best = (gain, j, e)
            if best is None or best[0] < 1e-9:
                values = [r[i] for i in members]
                middle = share(values, 0.5)
                value = middle + sum(math.copysign(min(abs(v - middle), clip), v - middle) for v in values) / len(values)
                for i in members:
                    score[i] += step * value
                return
            _, j, e = best
            grow([i for i in members if x[i][j] <= e], left - 1)
            grow([i for i in members if x[i][j] > e], left - 1)

        grow(list(range(len(y))), depth)
    return score


@pytest.fixture(scope="module")
def rows(spark):
    data = table()
    return data, spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id int, a double, b double, c double, y double").repartition(3)


def test_boosting_matches_plain_loops(spark, rows, monkeypatch):
    data, df = rows
    monkeypatch.setattr(boosting, "CUT", 3)  # scores are rewritten on the way
    model = boosting.fit(df, NAMES, "y", trees=8, step=0.3, depth=3, bins=24)
    want = plain_boosting(data, model.edges, 8, 0.3, 3, 0.9)
    got = {r["id"]: r["p"] for r in df.select("id", model.column(F.array(*NAMES)).alias("p")).collect()}
    assert max(abs(got[i] - w) for i, w in enumerate(want)) < 1e-9
    assert len({round(v, 6) for v in want}) > 20 and model.trees[0].feature[0] >= 0


def test_large_leaves_are_summarized(spark, rows, monkeypatch):
    data, df = rows
    exact = boosting.fit(df, NAMES, "y", trees=5, step=0.3, depth=2, bins=24)
    monkeypatch.setattr(boosting, "CENTROIDS", 24)
    near = boosting.fit(df, NAMES, "y", trees=5, step=0.3, depth=2, bins=24)
    x = np.array([r[:3] for r in data])
    assert 0 < np.abs(exact.predict(x) - near.predict(x)).mean() < 0.1


def test_huber_loss_resists_outliers(spark):
    df = spark.createDataFrame([(float(i % 2), float(i % 2) + (1000.0 if i % 50 == 0 else 0.0)) for i in range(400)], "a double, y double")
    model = boosting.fit(df, ["a"], "y", trees=40, step=0.3, depth=1)
    assert np.abs(model.predict(np.array([[0.0], [1.0]])) - [0, 1]).max() < 0.2


def test_odd_rows_of_a_fit(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (float("nan"), 2.0), (2.0, 5.0), (2.0, 5.0)], "a double, y double")
    assert boosting.fit(df, ["a"], "y", trees=2).predict(np.array([[2.0], [9.0]])).tolist() == [5.0, 5.0]
    with pytest.raises(ValueError):
        boosting.fit(df.limit(0), ["a"], "y")


def test_numbers_are_dealt_as_permutations():
    for n in (1, 2, 3, 7, 64, 1000):
        for key in range(4):
            assert sorted(forecast.dealt(np.arange(n), n, key).tolist()) == list(range(n))
    assert not np.array_equal(forecast.dealt(np.arange(1000), 1000, 1), forecast.dealt(np.arange(1000), 1000, 2))


def test_importance_matches_plain_loops(spark, rows):
    kinds = len(forecast.FEATURES)
    draw = random.Random(9)
    test = [(f"{i % 7:02}", f"2024{i // 7 + 1:02}", draw.gauss(0, 1), *[draw.gauss(0, 1) for _ in range(kinds)]) for i in range(70)]
    df = spark.createDataFrame(test, ["hs4", "month", "log_value", *forecast.FEATURES])
    model = boosting.fit(df.withColumn("log_value", F.col("lag_1") * 2 + F.col("mean_3")), forecast.FEATURES, "log_value", trees=6, step=0.4)
    got = {r["feature"]: r["importance"] for r in forecast.permuted(model, df, ["hs4", "month"], 4).collect()}
    ordered = sorted(test)
    x, y = np.array([r[3:] for r in ordered]), np.array([r[2] for r in ordered])
    base = np.abs(model.predict(x) - y).mean()
    for j, name in enumerate(forecast.FEATURES):
        errors = []
        for r in range(4):
            mixed = x.copy()
            mixed[:, j] = x[forecast.dealt(np.arange(70), 70, j * 4 + r), j]
            errors.append(np.abs(model.predict(mixed) - y).mean() - base)
        assert abs(got[name] - np.mean(errors)) < 1e-8
    assert len(got) == kinds and any(abs(v) > 1e-3 for v in got.values())


def test_forecast_of_a_series_that_repeats(spark):
    panel = [(f"{c:04}", f"{2015 + i // 12}{i % 12 + 1:02}", 1000 * (c + 1) * (i % 12 + 1)) for c in range(3) for i in range(60)]
    df = spark.createDataFrame(panel, "hs4 string, month string, import_usd bigint")
    got = forecast.forecast(df, "hs4", "201812", trees=60, step=0.2).collect()
    assert len(got) == 36 and sorted({r["month"] for r in got}) == [f"2019{i:02}" for i in range(1, 13)]
    assert np.median([abs(r["forecast"] / r["import_usd"] - 1) for r in got]) < 0.1
    nxt = forecast.forecast_next(df, "hs4", trees=60, step=0.2).collect()
    assert {(r["hs4"], r["month"]) for r in nxt} == {(f"{c:04}", "202001") for c in range(3)} and all(abs(r["forecast"] / (1000 * (int(r["hs4"]) + 1)) - 1) < 0.3 for r in nxt)
