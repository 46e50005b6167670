"""Partial writes, versions behind a pointer, history tables: results, and which files stay."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rollcall.operators import history
from rollcall.settings import APPROVED, PENDING, REFUSED
from rollcall.sources import histories, layouts, tables, versions

UTC = dt.timezone.utc


def days(spark, pairs):
    return spark.createDataFrame(pairs, "d string, v string")


def test_replace_days_writes_only_what_it_must(spark, tmp_path):
    path = str(tmp_path / "t")
    old = days(spark, [("2026-09-30", "o"), ("2026-10-01", "o"), ("2026-10-02", "o"), (None, "o"), ("2026-10-03", "o")])
    new = days(spark, [("2026-10-02", "n"), ("2026-10-02", "n"), ("2026-10-04", "n")])
    layouts.write_days(old, path, "d")
    before = layouts.partition_files(spark, path, "d")
    assert layouts.replace_days(new, path, "d", "2026-10-01") == ["2026-10-01", "2026-10-03", layouts.NO_VALUE]
    read = lambda: spark.read.schema("v string, d string").parquet(path).select("d", "v")
    assert rows(read()) == rows(tables.window_rows(old, new, "d", "2026-10-01"))
    after = layouts.partition_files(spark, path, "d")
    assert after["2026-09-30"] == before["2026-09-30"] and not after["2026-10-02"] & before["2026-10-02"]
    # The same load again, and one without rows.
    layouts.replace_days(new, path, "d", "2026-10-01")
    assert rows(read()) == rows(tables.window_rows(old, new, "d", "2026-10-01"))
    assert layouts.replace_days(new.limit(0), path, "d", "2026-10-03") == ["2026-10-04"]
    assert sorted(layouts.partition_files(spark, path, "d")) == ["2026-09-30", "2026-10-02"]


def test_a_failed_load_leaves_the_days(spark, tmp_path):
    path = str(tmp_path / "t")
    layouts.write_days(days(spark, [("2026-10-01", "1"), ("2026-10-02", "2")]), path, "d")
    before = layouts.partition_files(spark, path, "d")
    broken = days(spark, [("2026-10-02", "x")]).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        layouts.replace_days(broken, path, "d", "2026-10-01")
    assert layouts.partition_files(spark, path, "d") == before


def test_upsert_touches_only_its_buckets(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id int, status string, seq int"
    old = [(i, PENDING, 2 * i) for i in range(40)] + [(7, APPROVED, 90), (None, PENDING, 91), (None, PENDING, 92)]
    new = [(3, PENDING, 100), (3, REFUSED, 101), (7, PENDING, 102), (50, PENDING, 103), (None, APPROVED, 104)]
    before, changed = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    want = rows(tables.upsert_rows(before, changed, "id", "status", "seq"))
    layouts.write_buckets(before, path, "id", "status", "seq", 16)
    files = layouts.partition_files(spark, path, layouts.BUCKET)
    touched = layouts.upsert_buckets(changed, path, "id", "status", "seq", 16)
    got = layouts.read_buckets(spark, path).select("id", "status", "seq")
    assert rows(got) == want and (None, APPROVED, 104) in want and (7, PENDING, 102) in want
    after = layouts.partition_files(spark, path, layouts.BUCKET)
    assert len(touched) <= 4
    assert all(after[b] == f for b, f in files.items() if int(b) not in touched)
    assert all(not after[str(b)] & files.get(str(b), set()) for b in touched)
    assert layouts.upsert_buckets(changed.limit(0), path, "id", "status", "seq", 16) == []


def test_refresh_reads_its_greatest_day_from_names(spark, tmp_path):
    path = str(tmp_path / "t")
    assert layouts.latest_day(spark, path, "d") is None
    table = days(spark, [("2026-01-01", "a"), ("2026-01-02", "b"), ("2026-01-02", "late"), ("2026-01-03", "c"), (None, "n")])
    first = table.filter("d IS NULL OR d < '2026-01-03' AND v <> 'late'")
    asked = []

    def build(source):
        def run(since):
            asked.append(since)
            return source if since is None else source.filter(F.col("d") >= since)

        return run

    layouts.refresh_days(build(first), path, "d", spark)
    files = layouts.partition_files(spark, path, "d")
    layouts.refresh_days(build(table), path, "d", spark)
    assert asked == [None, "2026-01-02"]
    got = spark.read.schema("v string, d string").parquet(path).select("d", "v")
    assert rows(got) == rows(table)
    after = layouts.partition_files(spark, path, "d")
    assert all(after[d] == files[d] for d in ("2026-01-01", layouts.NO_VALUE))


def test_versions_stay_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    assert versions.publish(spark.range(5), path) == 1
    held = versions.read(spark, path)
    assert versions.publish(versions.read(spark, path).filter("id > 2"), path) == 2
    assert rows(versions.read(spark, path)) == [(3,), (4,)] and held.count() == 5
    assert versions.read(spark, path, version=1).count() == 5
    # A write that dies publishes nothing.
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        versions.publish(broken, path)
    assert rows(versions.read(spark, path)) == [(3,), (4,)]
    assert versions.recover(spark, path) in ("clean", "dropped") and versions.recover(spark, path) == "clean"


def test_rewrites_are_verified_and_recovered(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.publish(spark.range(6), path)
    assert versions.verified_rewrite(spark, path) and max(versions.versions(spark, path)) == 2
    assert not versions.publish_if_equal(spark, path, versions.stage(spark.range(5), path))
    assert versions.recover(spark, path) == "clean" and versions.read(spark, path).count() == 6
    versions.stage(spark.range(2), path)
    assert versions.recover(spark, path) == "dropped"
    versions.publish(spark.range(1), path)
    tables.drop(spark, f"{versions.versions(spark, path)[3]}/_SUCCESS")
    assert versions.recover(spark, path) == "restored" and versions.read(spark, path).count() == 6
    for n in range(4):
        versions.publish(spark.range(n), path)
    assert versions.expire(spark, path, keep=1) == [1, 2, 3, 4] and sorted(versions.versions(spark, path)) == [5, 6]
    assert versions.read(spark, path).count() == 3
    taken = f"{path}/manifest/{7:012d}"
    fs, file = tables._fs(spark, taken)
    fs.create(file, False).close()
    with pytest.raises(Exception, match="already exists"):
        fs.create(file, False)


def test_history_table_keeps_closed_versions(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "ID int, a string, other int"
    stamps = [dt.datetime(2026, 1, d, tzinfo=UTC) for d in range(1, 5)]
    loads = [
        [(1, "x", 1), (2, "x", 1), (3, None, 1)],
        [(1, "y", 2), (3, None, 2)],  # 2 vanishes, 3 changes only where nobody looks
        [(1, "y", 3), (2, "x", 3), (3, "z", 3)],  # 2 comes back as it was
        [(1, "x", 4), (2, "w", 4), (4, "n", 4)],
    ]
    expected, kept = None, {}
    for ts, load in zip(stamps, loads, strict=True):
        batch = spark.createDataFrame(load, schema)
        histories.load(batch, path, "ID", ["a"], ts)
        expected = history.open_history(batch, ts) if expected is None else history.scd2_check(expected, batch, "ID", ["a"], ts)
        expected = spark.createDataFrame(expected.collect(), expected.schema)
        files = layouts.partition_files(spark, path, histories.STATE)
        assert all(files[s] == f for s, f in kept.items())
        kept = {s: f for s, f in files.items() if s != histories.OPEN}
    names = ["ID", "a", "other", "valid_from", "valid_to"]
    assert rows(histories.read(spark, path), *names) == rows(expected, *names)
    assert len(kept) == 3
    # The last load again changes no version.
    histories.load(spark.createDataFrame(loads[-1], schema), path, "ID", ["a"], stamps[-1])
    assert rows(histories.read(spark, path), *names) == rows(expected, *names)
    then = histories.read(spark, path, dt.datetime(2026, 1, 2, 12, tzinfo=UTC))
    assert rows(then, "ID", "a", "other") == [(1, "y", 2), (2, "x", 1), (3, None, 1)]
