"""Folded change logs, published marts and whole load runs."""

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rollcall.plans import loads, pipeline, staging
from rollcall.sources import histories, landing, star, versions
from rollcall.streaming import changes

SCHEMA = "id bigint, status string, seq bigint"
PENDING, DONE = "Chờ duyệt", "Đã duyệt"
AT = dt.datetime(2024, 1, 23, tzinfo=dt.timezone.utc)


def batch(spark, log, number, *values):
    spark.createDataFrame(values, SCHEMA).write.mode("overwrite").parquet(f"{log}/batch_id={number}")


def test_fold_reads_only_the_tail_and_survives_a_replay(spark, tmp_path):
    log = str(tmp_path / "log")
    schema = spark.createDataFrame([], SCHEMA).schema
    state = lambda: rows(changes.current_state(spark, log, schema, "id", "status", "seq"))
    fold = lambda: changes.fold(spark, log, schema, "id", "status", "seq")
    assert fold() == -1 and state() == []
    batch(spark, log, 0, (1, PENDING, 5), (2, DONE, 6), (None, PENDING, 7))
    batch(spark, log, 1, (2, "Từ chối", 1), (3, None, 2), (1, PENDING, 1))
    whole = [(None, PENDING, 7), (1, PENDING, 5), (2, DONE, 6), (3, None, 2)]
    assert sorted(state(), key=str) == sorted(whole, key=str)
    assert fold() == 1 and fold() == 1
    assert sorted(state(), key=str) == sorted(whole, key=str)
    # The stream replays its last batch: nothing changes, also not by the next fold.
    batch(spark, log, 1, (2, "Từ chối", 1), (3, None, 2), (1, PENDING, 1))
    batch(spark, log, 2, (1, DONE, 1), (4, PENDING, 9))
    whole = [(None, PENDING, 7), (1, DONE, 1), (2, DONE, 6), (3, None, 2), (4, PENDING, 9)]
    assert sorted(state(), key=str) == sorted(whole, key=str)
    read = changes.current_state(spark, log, schema, "id", "status", "seq").inputFiles()
    assert {f.split("/")[-2] for f in read} == {"upto=1", "batch_id=2"}
    assert fold() == 2 and sorted(state(), key=str) == sorted(whole, key=str)
    assert sorted(p.name for p in (tmp_path / "log").glob("batch_id=*")) == ["batch_id=2"]
    assert sorted(p.name for p in (tmp_path / "log/snapshots").glob("upto=*")) == ["upto=1", "upto=2"]
    # A batch and a snapshot without a success file are not read.
    for broken in ("batch_id=3", "snapshots/upto=3"):
        (tmp_path / "log" / broken).mkdir()
    assert sorted(state(), key=str) == sorted(whole, key=str) and fold() == 2


def test_run_publishes_versions_and_clears_up_when_a_model_fails(spark, tmp_path, monkeypatch):
    source = star.sources(spark, "/root/testdata/sf0.001")
    names = ["mart_headcount_snapshot", "dim_date"]
    first = pipeline.run(spark, source, star.SETTINGS, str(tmp_path), names)
    held = spark.read.parquet(first["dim_date"])
    second = pipeline.run(spark, source, star.SETTINGS, str(tmp_path), names)
    path = str(tmp_path / "MART/dim_date")
    assert first["dim_date"] != second["dim_date"] == versions.current(spark, path).removeprefix("file:")
    assert held.count() == versions.read(spark, path).count() > 0
    monkeypatch.setattr(pipeline.marts, "mart_headcount_snapshot", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        pipeline.run(spark, source, star.SETTINGS, str(tmp_path), names)
    assert list((tmp_path / "STG").glob("*/*")) == []
    assert len(versions.versions(spark, path)) == 3
    assert len(versions.versions(spark, str(tmp_path / "MART/mart_headcount_snapshot"))) == 2


def land(tmp_path, table, name, *lines):
    folder = tmp_path / "in" / table
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(x, ensure_ascii=False) + "\n" for x in lines), encoding="utf-8")


def envelope(*records):
    return json.dumps({"data": list(records), "error": False}, ensure_ascii=False)


def test_settled_documents_reach_the_request_list(spark, tmp_path):
    root = str(tmp_path / "out")
    land(tmp_path, "approvals", "a.json", {"SYNC_TIME": "2024-01-01T00:00:00Z", "RAW_DATA": envelope(
        {"ID": "1", "personnel_code": "NV1", "app_approval_status": PENDING},
        {"ID": "2", "personnel_code": "NV2", "app_approval_status": PENDING})})
    documents = [
        {"APPROVAL_ID": 1, "RAW_DATA": json.dumps({"data": {"ID": "1", "personnel_code": "NV1", "app_approval_status": DONE}}, ensure_ascii=False)},
        {"APPROVAL_ID": 3, "RAW_DATA": json.dumps({"error": True})},
        {"APPROVAL_ID": 4, "RAW_DATA": json.dumps({"data": None})},
    ]
    land(tmp_path, "details", "d.json", *documents)
    for table in ("approvals", "details"):
        landing.load_new(spark, str(tmp_path / "in" / table), table, root, AT, table != "details")
    assert landing.list_documents(spark, root, AT) == 1 and landing.list_documents(spark, root, AT) == 0
    listed = staging.stg_approvals(landing.read_raw(spark, root, "approvals"))
    assert rows(listed, "ID", "app_approval_status") == [(1, DONE), (2, PENDING)]
    # A later load of the list keeps what the documents brought.
    assert landing.load_new(spark, str(tmp_path / "in/approvals"), "approvals", root, AT) == 0
    assert landing.read_raw(spark, root, "approvals").count() == 2


def test_a_load_replaces_its_days_and_adds_nothing_when_repeated(spark, tmp_path):
    root = str(tmp_path / "out")
    record = lambda day, hours: {"SYNC_TIME": "2024-01-22T00:00:00Z", "SYNC_DATE": day, "RAW_DATA": envelope(
        {"ID": "1", "personnel_code": "NV1", "date": day, "cal_workhour": hours})}
    land(tmp_path, "timekeep", "a.json", record("2024-01-10", "1"), record("2024-01-21", "2"), record("2024-01-22", "3"))
    land(tmp_path, "profiles", "p.json", {"SYNC_TIME": "2024-01-22T00:00:00Z", "RAW_DATA": envelope(
        {"ID": "1", "code": "NV1", "name": "An", "department_full": "P1"})})
    go = lambda at: loads.load(spark, str(tmp_path / "in"), root, star.SETTINGS, at, models=["mart_attendance_events"])
    first = go(AT)
    assert first.files == {"profiles": 1, "approvals": 0, "details": 0, "timekeep": 1} and first.gone_days == []
    land(tmp_path, "timekeep", "b.json", record("2024-01-22", "4"))
    second = go(AT + dt.timedelta(hours=1))
    assert second.files["timekeep"] == 1 and second.gone_days == ["2024-01-21"]
    again = go(AT + dt.timedelta(hours=2))
    assert sum(again.files.values()) == 0 and again.gone_days == []
    for done in (second, again):
        mart = spark.read.parquet(done.marts["mart_attendance_events"])
        assert rows(mart.select(F.col("event_date").cast("string"), "cal_workhour")) == [("2024-01-10", 1.0), ("2024-01-22", 4.0)]
    assert {r.status for r in again.checks.collect()} <= {"PASS", "ERROR"} and again.checks.count() > 0
    assert histories.read(spark, f"{root}/HISTORY/staff").count() == 1
