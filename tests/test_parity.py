"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest
from conftest import plan

import __spark_entry__ as entry
from rollcall import oracle
from rollcall.queries import QUERIES

DIR = "/root/testdata/sf0.001"
NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SQL = oracle.statements()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in NAMES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    result = duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(result.columns)
    got = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    at = [result.columns.index(c) for c in columns]
    want = sorted(str([plain(r[i]) for i in at]) for r in result.fetchall())
    assert got == want
    text = plan(df)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_flagship(spark):
    df = entry.entry(spark)
    assert "event_date" in df.columns and df.count() > 0
