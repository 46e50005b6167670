"""Checks taken while writing give what checks over the written table give."""

import pytest
from conftest import plan, rows

from rollcall.operators import quality, watch

CHECKS = (
    quality.not_null("id", "v") + quality.unique("id") + quality.accepted("v", ["a", "b"])
    + quality.accepted("f", [True, False]) + quality.accepted("v", ["a"], "id is not null") + quality.unique("v")
)
SCHEMA = "id int, v string, f boolean"


@pytest.mark.parametrize("data", [
    [(1, "a", True), (1, "b", None), (None, "z", False), (None, None, True), (3, "q", None), (4, "q", None)],
    [(1, "a", True)],
])
def test_same_as_run_checks(spark, tmp_path, data):
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    watched, seen = watch.watch(df, "m", CHECKS)
    watched.write.parquet(str(tmp_path / "t"))
    written = spark.read.parquet(str(tmp_path / "t"))
    got = watch.results(written, "m", CHECKS, seen, minimum=3)
    want = rows(quality.run_checks(written, "m", CHECKS))
    short = max(0, 3 - len(data))
    assert set(rows(got)) == {*want, ("m", "*", watch.ROWS, short, "ERROR" if short else "PASS")}
    assert got.count() == len(CHECKS) + 1


def test_a_clean_table_is_scanned_for_unique_only(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", True), (2, "b", False)], SCHEMA)
    checks = quality.not_null("id", "v") + quality.accepted("v", ["a", "b"]) + quality.unique("id")
    watched, seen = watch.watch(df, "m", checks)
    watched.write.parquet(str(tmp_path / "t"))
    got = watch.results(spark.read.parquet(str(tmp_path / "t")), "m", checks, seen)
    assert plan(got).count("FileScan") == 1
    assert {r.status for r in got.collect()} == {"PASS"}


def test_an_empty_table(spark, tmp_path):
    watched, seen = watch.watch(spark.createDataFrame([], SCHEMA), "m", CHECKS)
    watched.write.parquet(str(tmp_path / "t"))
    got = watch.results(spark.read.schema(SCHEMA).parquet(str(tmp_path / "t")), "m", CHECKS, seen, minimum=2)
    assert {(r.check, r.failures) for r in got.collect()} == {
        (watch.ROWS, 2), ("not_null", 0), ("unique", 0), ("accepted_values", 0),
    }
