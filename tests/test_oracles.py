"""Every query of the catalogue against its SQL on the smallest data."""

import duckdb
import pytest

from tradelake import catalog, oracles

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    return repr(round(v, 9)) if isinstance(v, float) else v if v is None else str(v)


def test_every_query_has_sql_or_is_a_model():
    assert set(catalog.queries()) - set(SQL) == {"ml_forecast", "forecast_next", "permutation_importance"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    want = duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    rows = want.fetchall()
    at = [want.columns.index(c) for c in columns]
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str) == sorted((tuple(plain(r[i]) for i in at) for r in rows), key=str)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
