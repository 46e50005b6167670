"""Registered queries against their SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from rollcall.llm.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    got = QUERIES[name](spark, DIR).toPandas()
    want = con.sql(SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    as_text = lambda df: sorted(map(str, df[columns].astype(object).values.tolist()))
    assert as_text(got) == as_text(want)


def test_entry_registers_the_operators():
    names = set(entry.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "language ID"
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = corpus_pipeline.run(spark, DIR)
    assert out.columns == [*docs.columns, "piece_ids", "n_pieces"]
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and 0 < len(ids) <= docs.count()
