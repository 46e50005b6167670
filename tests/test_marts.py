import datetime as dt
import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rollcall.operators import sets, spine
from rollcall.plans import marts, staging
from rollcall.settings import Settings

D = dt.date
CFG = Settings(as_of=D(2026, 10, 9))
T = "2026-10-01 00:00:00"


def listed(i, person="NV1", **more):
    return {"ID": i, "personnel_code": person, "date_created": "01/10/2026", **more}


def doc(i, **more):
    return (i, {"data": {"ID": i, "personnel_code": "NV9", **more}}, T)


@pytest.fixture
def build(envelopes, documents):
    def make(requests, docs, people=({"ID": 1, "code": "NV1", "name": "An"},)):
        return marts.mart_approvals(
            staging.stg_approval_details(documents(docs), CFG),
            staging.stg_approvals(envelopes([(T, requests)])),
            staging.stg_profiles(envelopes([(T, list(people))])),
        )

    return make


def test_two_level_flatten(build):
    overtime = [
        {"desc": "a", "types": "1", "detail": [
            {"personnel_code": "NV1", "date": "2026-10-08", "hours": "2"},
            {"personnel_code": "NV1", "date": "2026-10-08", "hours": "2"},
            {"personnel_code": "NV1", "date": "2026-10-08", "hours": "x"},
        ]},
        {"desc": "a", "types": 2, "detail": []},
        {"desc": "b", "types": "", "detail": [{"personnel_code": "NV1", "date": "bad"}]},
        {"desc": "no detail"},
    ]
    leave = [
        {"reason": "Phép năm", "detail": []},
        {"personnel_code": "NV1", "reason": " ", "detail": [
            {"date_start": "2026-10-09", "time_start": "13:00", "day_number": "0.5"},
            {"date_start": "2026-10-09", "time_start": "08:00", "day_number": "1"},
        ]},
    ]
    mart = build([listed(1), listed(2)], [doc(1, overtime=overtime), doc(2, leave=leave)])
    got = rows(mart.filter("approval_id = 1"), "date_record", "hours_amount", "ot_type", "reason")
    # Repeats go, events without a person go, every other event stays.
    assert got == [
        (None, None, "Chưa xác định", "b"),
        (D(2026, 10, 8), None, "Ngày nghỉ", "a"),
        (D(2026, 10, 8), 2.0, "Ngày nghỉ", "a"),
    ]
    got = rows(mart.filter("approval_id = 2"), "personnel_code", "date_record", "days_amount", "leave_type")
    # One row a day, the earliest; an empty detail keeps the request itself.
    assert got == [("NV1", D(2026, 10, 9), 1.0, "Chưa xác định"), ("NV9", None, None, "Phép năm")]


def test_other_requests_and_json_null(build):
    mart = build(
        [listed(1, app_sub_object="Đổi ca"), listed(2), listed(3), listed(4, app_sub_object="Photocopy")],
        [doc(1, overtime=[], leave=[]), doc(2, overtime=None), doc(3, absence=[{"detail": None}])],
    )
    # 2 has a JSON null array and 3 an element without rows: neither is "other".
    got = rows(mart, "approval_id", "approval_type", "reason")
    assert got == [(1, "Đơn khác", "Không có lý do"), (4, "Đơn làm thêm", "Không có lý do")]


def test_null_ids_follow_not_in(build):
    inout = [{"inoutinfo": [{"date": "2026-10-08"}]}]
    none = build([listed(None), listed(5)], [doc(7)])
    assert rows(none, "approval_id") == [(None,), (5,)]
    some = build([listed(None), listed(5)], [doc(7, inout=inout)])
    assert rows(some, "approval_id") == [(5,), (7,)]
    unknown = (None, {"data": {"personnel_code": "NV9", "inout": inout}}, T)
    assert rows(build([listed(None), listed(5)], [unknown]), "approval_id", "personnel_code") == [(None, "NV9")]


def test_status_and_created_fallbacks(build):
    absence = [{"detail": [{"date_start": "2026-10-09", "hour_number": "2"}]}]
    mart = build(
        [
            listed(1, app_approval_status="Chờ duyệt"),
            listed(2, app_approval_status="Đã duyệt"),
            listed(3) | {"date_created": "01/10/2026 11:19"},
        ],
        [
            doc(1, app_approval_status="Không duyệt", absence=absence),
            doc(2, app_approval_status="Chờ duyệt", absence=absence),
            doc(3, absence=absence),
            doc(4, app_approval_status="Chờ duyệt", absence=absence),
        ],
    )
    assert rows(mart, "approval_id", "approval_status", "date_created") == [
        (1, "Không duyệt", D(2026, 10, 1)),
        (2, "Đã duyệt", D(2026, 10, 1)),
        (3, "Không xác định", D(2026, 10, 9)),
        (4, "Chờ duyệt", D(2026, 10, 9)),
    ]


def test_incremental_window(envelopes, documents):
    staged = (
        staging.stg_approval_details(documents([doc(9)]), CFG),
        staging.stg_approvals(envelopes([(T, [listed(1), listed(2) | {"date_created": "20/09/2026"}])])),
        staging.stg_profiles(envelopes([(T, [{"ID": 1, "code": "NV1"}])])),
    )
    assert rows(marts.mart_approvals(*staged, incremental_since=D(2026, 10, 1)), "approval_id") == [(1,)]


def test_first_element_model_differs(documents):
    absence = [{"detail": [{"date_start": "2026-10-08", "hour_number": 3}]}, {"detail": [{"date_start": "2026-10-09"}]}]
    staged = staging.stg_approval_details(
        documents([doc(1, absence=absence), doc(2, overtime=[{"detail": []}]), doc(3, overtime=[{"detail": None}]),
                   doc(4, overtime=[{}]), doc(5, inout=[{"inoutinfo": [{"date": "2026-10-08", "time": "08:00"}]}])]),
        CFG,
    )
    got = rows(marts.int_approval_details_flat(staged), "approval_id", "detail_type", "date_record", "hours_number")
    assert got == [
        (1, "absence", D(2026, 10, 8), 3.0),
        (2, "overtime", None, None),
        (3, "overtime", None, None),
        (5, "inout", D(2026, 10, 8), None),
    ]
    both = marts.detail_events(staged).filter("ID = 1")
    assert both.count() == 2


@pytest.mark.parametrize(
    "department, staff_block, request_block",
    [
        ("Kho Tổng Cửa hàng", "Khối Kho", "Khối Cửa hàng"),
        ("Phòng Kinh doanh cửa hàng", "Khối Văn phòng", "Khối Cửa hàng"),
        ("HN_CH 1", "Khối Cửa hàng", "Khối Cửa hàng"),
        ("Phòng Kế hoạch", "Khối Văn phòng", "Khối Cửa hàng"),
        ("Phòng Kế hoạch Sản xuất", "Khối Sản xuất", "Khối Cửa hàng"),
        ("Kho NPL", "Khối Sản xuất", "Khối Văn phòng"),
        ("Kho Miền Nam", "Khối Kho", "Khối Văn phòng"),
        ("Kế toán", "Khối Văn phòng", "Khối Văn phòng"),
        (" ", "Chưa phân bổ", "Khối Văn phòng"),
        (None, "Chưa phân bổ", "Khối Văn phòng"),
    ],
)
def test_blocks(spark, department, staff_block, request_block):
    df = spark.createDataFrame([(department,)], "d string")
    got = df.select(marts.department_block(F.col("d")), marts.request_block(F.col("d"))).first()
    assert tuple(got) == (staff_block, request_block)


def test_profiles_and_people_seen_elsewhere(envelopes):
    profiles = staging.stg_profiles(
        envelopes([(T, [
            {"ID": 1, "code": "A", "birthday": "31/12/2001", "job_date_join": "01/10/2026",
             "job_date_out": "30/09/2026", "job_status": "Thử việc", "json_insurance": None,
             "json_degrees": [{"level_name": "Đại học"}]},
            {"ID": 2, "code": None, "name": "no code"},
        ])])
    )
    approvals = staging.stg_approvals(
        envelopes([(T, [{"ID": 1, "personnel_code": "B", "personnel_name": n} | {"ID": i} for i, n in enumerate(["b1", "b2", None])])])
    )
    timekeep = staging.stg_timekeep(
        envelopes([(T, "2026-10-01", [{"personnel_code": c} for c in ("A", "B", "C", None)])])
    )
    mart = marts.mart_profiles(profiles, approvals, timekeep, CFG)
    assert rows(mart, "profile_id", "personnel_code", "name") == [
        (-1, "B", "b2"), (-1, "C", "Chưa xác định"), (1, "A", None), (2, None, "no code"),
    ]
    a = mart.filter("personnel_code = 'A'").first()
    assert (a.age, a.age_group, a.job_date_out, a.tenure_months, a.tenure_group) == (
        25, "25 - 30 tuổi", None, -1, "< 6 tháng",
    )
    assert (a.is_active, a.has_insurance, a.has_degree, a.highest_degree_level) == (True, True, True, "Đại học")
    b = mart.filter("personnel_code = 'B'").first()
    assert (b.is_active, b.salary_real, b.department, b.department_group) == (
        False, 0.0, "Chưa phân bổ", "Khối Văn phòng",
    )
    regions = profiles.sparkSession.createDataFrame([("Chưa phân bổ", "Bắc")], "department string, region string")
    placed = marts.mart_profiles(profiles, approvals, timekeep, CFG, regions)
    assert placed.columns == mart.columns
    assert rows(placed.filter("personnel_code in ('A', 'B')"), "region") == [("Bắc",), ("Bắc",)]
    events = marts.mart_employee_events(mart)
    assert rows(events, "personnel_code", "event_type") == [("A", "Tuyển mới")]


def test_headcount_equals_the_theta_join(spark):
    rnd = random.Random(5)
    people = []
    for i in range(300):
        joined = D(2018, 1, 1) + dt.timedelta(rnd.randrange(3300))
        out = joined + dt.timedelta(rnd.randrange(-60, 900)) if rnd.random() < 0.5 else None
        people.append((rnd.choice("xyz") if rnd.random() < 0.9 else None, i if i % 7 else None, joined, out))
    df = spark.createDataFrame(people, "g string, code int, joined date, left date")
    got = spine.month_headcount(df, ["g"], "code", "joined", "left", CFG)
    text = plan(got)
    assert "NestedLoop" not in text and "Cartesian" not in text
    months = [D(y, m, 1) for y in range(2020, 2027) for m in range(1, 13) if D(y, m, 1) <= CFG.as_of]
    want = []
    for month in months:
        for g in {p[0] for p in people}:
            group = [p for p in people if p[0] == g and p[2].replace(day=1) <= month]
            if group:
                active = sum(p[3] is None or p[3].replace(day=1) > month for p in group)
                want.append((month, g, sum(p[1] is not None for p in group), active))
    assert rows(got) == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])


def test_day_spine_guards_reversed_and_clips(spark):
    df = spark.createDataFrame(
        [("a", D(2026, 1, 3), D(2026, 1, 1)), ("b", D(2019, 12, 30), D(2020, 1, 2)), ("c", None, D(2026, 1, 1))],
        "p string, s date, e date",
    )
    assert rows(spine.day_spine(df, "s", "e", CFG, "day"), "p", "day") == [
        ("b", D(2020, 1, 1)), ("b", D(2020, 1, 2)),
    ]


def test_set_operators(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "i int")
    assert rows(sets.not_in(left, "k", ids(2, 3), "i")) == [(1,)]
    assert rows(sets.not_in(left, "k", ids(2, None), "i")) == []
    assert rows(sets.not_in(left, "k", ids(), "i")) == [(None,), (1,), (2,)]
    assert rows(sets.flag_members(left, "k", ids(1, 1), "i", "in")) == [(None, False), (1, True), (2, False)]
    branch = spark.createDataFrame([(1,), (1,)], "k int")
    assert sets.union_of_distinct(branch, branch).count() == 2
    assert rows(sets.union_distinct_ids(ids(1, 1), ids(1, 2))) == [(1,), (2,)]
