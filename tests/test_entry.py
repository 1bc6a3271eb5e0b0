"""Driver contract: entry(), queries(), oracle_sql(); every query equals its
DuckDB oracle on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tradewell.plans import queries as library
from tradewell.plans.fixtures import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"accession", "trade_type", "price", "qty", "value"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert set(library.QUERIES) == set(library.ORACLE)
    assert set(library.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(library.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    res = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    cols = sorted(df.columns)
    s = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    idx = [res.columns.index(c) for c in cols]
    o = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert s == o
