"""Every query against its SQL on the smallest tables."""

import math

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v.item() if hasattr(v, "item") else v


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(map(plain, r)) for r in pdf[cols].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got, want = rows(entry.queries()[name](spark, SF).toPandas()), rows(duck.sql(entry.oracle_sql()[name]).df())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_own_query_has_sql():
    from lociflow import queries

    assert set(queries.QUERIES) == set(queries.SQL)
