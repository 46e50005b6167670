import datetime as dt
import json

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rollcall.operators import flatten, latest
from rollcall.plans import columns, staging
from rollcall.settings import Settings
from rollcall.sources import raw

CFG = Settings(as_of=dt.date(2026, 10, 9))
OLD, NEW = "2026-10-01 00:00:00", "2026-10-02 00:00:00"


def request(i, status, **more):
    return {"ID": i, "personnel_code": "NV1", "app_approval_status": status, **more}


def test_settled_status_beats_a_newer_pending_one(envelopes):
    df = envelopes(
        [
            (NEW, [request(1, "Chờ duyệt"), request(2, None), request(3, "Đã duyệt", desc="new")]),
            (OLD, [request(1, "Đã duyệt"), request(2, "Chờ duyệt"), request(3, "Từ chối")]),
            (None, [request(4, "Chờ duyệt"), request(4, "Không duyệt")]),
        ]
    )
    got = rows(staging.stg_approvals(df), "ID", "app_approval_status")
    assert got == [(1, "Đã duyệt"), (2, None), (3, "Đã duyệt"), (4, "Không duyệt")]


def test_snapshot_without_person_never_wins(envelopes):
    blank = request(1, "Đã duyệt", desc="blank") | {"personnel_code": ""}
    df = envelopes([(NEW, [blank]), (OLD, [request(1, "Chờ duyệt", desc="kept")]), (OLD, [blank | {"ID": 2}])])
    assert rows(staging.stg_approvals(df), "ID", "description_text") == [(1, "kept")]


def test_strict_columns_fail_and_safe_ones_do_not(envelopes):
    bad = envelopes([(NEW, [request("x", "Đã duyệt")])])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_approvals(bad).collect()
    day = {"personnel_code": "NV1", "late_minute": "x", "checkin": "2026", "cal_workhour": "7.5", "is_holiday": "1"}
    row = staging.stg_timekeep(envelopes([(NEW, "2026-10-01", [day])])).first()
    assert (row.late_minute, row.checkin, row.cal_workhour, row.is_holiday) == (None, None, 7.5, True)
    assert row.is_day_off is None


def test_column_counts(envelopes):
    kinds = {}
    for f in columns.PROFILE_FIELDS:
        kinds[f.kind] = kinds.get(f.kind, 0) + 1
    assert kinds == {"int": 22, "float": 19, "date": 44, "text": 149, "json": 10}
    df = envelopes([(NEW, [{"ID": 1, "birthday": "8/1/1990", "jobs": [1], "json_visa": None}])])
    staged = staging.stg_profiles(df)
    assert len(staged.columns) == 245
    row = staged.first()
    assert (row.ID, row.birthday, row.jobs, row.json_visa, row.json_family) == (
        1, dt.date(1990, 1, 8), None, "null", None,
    )


def test_empty_and_absent_envelopes_drop_out(spark):
    df = spark.createDataFrame(
        [('{"data":[]}',), ('{"data":null}',), ("{}",), (None,), ('{"data":[{"ID":5}]}',)],
        "RAW_DATA string",
    )
    assert flatten.unnest_envelope(df, "RAW_DATA", []).count() == 1


def test_details_errors_versions_and_stamps(documents):
    doc = lambda status, **more: {"data": {"ID": 1, "app_approval_status": status, **more}}
    df = documents(
        [
            (1, doc("Đã duyệt"), OLD),
            (1, doc("Chờ duyệt"), NEW),
            (2, {"error": True, "message": "Post not found"}, NEW),
            (3, {"error": "true"}, NEW),
            (4, doc("Chờ duyệt", _loaded_at="2026-11-01 00:00:00"), OLD),
            (4, doc("Đã duyệt"), NEW),
            (5, {"error": False, "data": {"overtime": None, "leave": [], "inout": [{"a": 1}]}}, NEW),
        ]
    )
    staged = staging.stg_approval_details(df, CFG)
    assert len(staged.columns) == 31
    assert rows(staged, "ID", "app_approval_status") == [(1, "Đã duyệt"), (4, "Chờ duyệt"), (5, None)]
    five = staged.filter("ID = 5").first()
    assert (five.overtime, five.leave_data, five.inout, five.absence) == ("null", "[]", '[{"a":1}]', None)


def test_timekeep_keeps_one_load_per_requested_day(envelopes):
    day = {"personnel_code": "NV1", "date": "2026-10-01", "late_minute": "1"}
    df = envelopes(
        [
            (OLD, "2026-10-01", [day]),
            (NEW, "2026-10-01", [day | {"late_minute": "2"}]),
            (NEW, "2026-10-02", [day | {"late_minute": "3"}]),
        ]
    )
    staged = staging.stg_timekeep(df)
    assert len(staged.columns) == 38
    got = rows(staged, "attendance_date", "record_date", "late_minute")
    # One record date under two requested days stays twice.
    assert got == [("2026-10-01", "2026-10-01", 2), ("2026-10-02", "2026-10-01", 3)]


def test_sheets(spark):
    head = list(raw.HR_MASTER_COLUMNS)
    at = head.index("NGAY_VAO_NGAY_KY_H_TV")

    def contract(code, day):
        row = [None] * len(head)
        row[0], row[at] = code, day
        return tuple(row)

    sheet = spark.createDataFrame(
        [contract("A", None), contract("A", "2020-01-01"), contract("B", None)],
        ", ".join(f"{h} string" for h in head),
    )
    staged = staging.stg_hr_master_data(sheet)
    assert rows(staged, "personnel_code", "date_join") == [("A", "2020-01-01"), ("B", None)]
    assert len(staged.columns) == 25

    tracking = spark.createDataFrame(
        [("c1", "A", "2026-10-01", None, " ", None, "x"), (" ", "A", None, None, None, None, None),
         ("c1", "A", "2026", None, "Đã xử lý", None, None)],
        ", ".join(f"{h} string" for h in raw.TRACKING_COLUMNS),
    )
    got = rows(staging.stg_exception_status(tracking), "case_id", "case_date", "processing_status")
    assert got == [("c1", dt.date(2026, 10, 1), "Chưa xử lý")]


def test_pack_and_unnest_are_inverse(spark):
    records = spark.range(0, 2500, 1, 3).select(F.to_json(F.struct("id")).alias("rec"))
    packed = flatten.pack_envelopes(records, 500)
    sizes = [r[0] for r in packed.select(raw.landed_records(F.col("RAW_DATA"))).collect()]
    assert max(sizes) == 500 and sum(sizes) == 2500
    back = flatten.unnest_envelope(packed, "RAW_DATA", []).select(F.from_json("rec", "id bigint").alias("r"))
    assert sorted(r[0] for r in back.select("r.id").collect()) == list(range(2500))


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    events = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), "id"
    )
    picked = latest.first_by(events, ["key"], [F.col("id").desc()])
    text = plan(picked)
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")
    got = dict(rows(picked, "key", "id"))
    assert got[0] == 8997 and len(got) == 6001


def test_forward_first_counts_missing_status_as_settled(spark):
    df = spark.createDataFrame(
        [(1, "Chờ duyệt", 1), (1, None, 2), (1, "Đã duyệt", 3), (2, "Chờ duyệt", 9), (2, "Chờ duyệt", 8),
         (None, "Chờ duyệt", 1), (None, "Đã duyệt", 2)],
        "id int, status string, seq int",
    )
    got = rows(latest.forward_first(df, "id", "status", [F.col("seq").asc()]), "id", "seq")
    assert got == [(None, 2), (1, 2), (2, 8)]
    settled = latest.settled_first(df, "id", "status", [F.col("seq").asc()])
    assert rows(settled, "id", "seq") == [(None, 2), (1, 3), (2, 8)]


ARRAYS = ["inout", "overtime", "absence", "leave_data"]


def test_arrays_cut_out_of_a_document_are_those_a_variant_writes(documents):
    values = [
        [], None, "[]", "[1]", "x", "", 5, 1.50, True, {}, {"overtime": []}, {"a": [1]}, [{"b": 1, "a": ["x", None, {}]}], [[]], [1.50, 1e3],
        [{"hours": 1.0}], [-0.0], [10**20], [{"desc": "\u0001 \"q\" [b], \\ Đơn"}], [{"overtime": "x"}], [None], [{"overtime": [2]}],
    ]
    rows_ = [(n, {"data": {"app_approval_status": "a", "overtime": v, "z": v}}, NEW) for n, v in enumerate(values)]
    rows_ += [(100, {"data": {"z": {"overtime": [1]}}}, NEW), (101, {"data": {"overtime": "[1]", "z": {"overtime": [1]}}}, NEW)]
    rows_ += [(102, {"data": '{"\\u006fvertime": null, "leave" : "[]", "inout" :  [ { "b" : 1 } ]}'}, NEW), (103, {"data": '{"overtime": [1'}, NEW)]
    df = documents(rows_)
    cut = {r.ID: r for r in staging.stg_approval_details(df, CFG, ["ID", *ARRAYS]).collect()}
    whole = {r.ID: r for r in staging.stg_approval_details(df, CFG).collect()}
    assert len(cut) == len(whole) == len(rows_)
    form = lambda t: t if t is None else json.dumps(json.loads(t), sort_keys=True)
    for i, row in whole.items():
        for c in ARRAYS:
            assert form(cut[i][c]) == form(row[c]), (i, c, cut[i][c], row[c])
    assert cut[12].overtime == '[{"b":1,"a":["x",null,{}]}]'
    assert (cut[1].overtime, cut[2].overtime, cut[13].overtime, cut[14].overtime) == ("null", '"[]"', "[[]]", whole[14].overtime)
