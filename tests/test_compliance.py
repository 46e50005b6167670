import datetime as dt

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rollcall.plans import compliance as c
from rollcall.settings import Settings

D = dt.date
AS_OF = D(2026, 10, 9)
CFG = Settings(as_of=AS_OF)
OFFICE, STOCK, STORE = "Khối Văn phòng", "Khối Kho", "Khối Cửa hàng"

APPROVAL = (
    "approval_id bigint, approval_type string, approval_status string, date_created date, time_created string, "
    "date_approved date, time_approved string, personnel_code string, name string, date_record date, "
    "start_time string, hours_amount double, reason string"
)
PERSON = (
    "personnel_code string, name string, department string, department_group string, position_title string, "
    "is_active boolean, job_date_join date, job_date_out date"
)
DAY = (
    "personnel_code string, record_date string, checkin timestamp, checkout timestamp, shift_code string, "
    "is_check_log string, cal_workhour double, late_minute bigint, soon_minute bigint, is_holiday boolean"
)


def person(code, block=OFFICE, active=True, joined=D(2020, 1, 1), out=None, dept="P1"):
    return (code, code, dept, block, "x", active, joined, out)


def request(i, code="A", kind="Đơn xin nghỉ", status="Đã duyệt", on=D(2026, 10, 7), hours=8.0, **o):
    return (
        i, kind, status, o.get("created", D(2026, 10, 1)), o.get("time_created", "08:00"),
        o.get("approved", D(2026, 10, 2)), o.get("time_approved", "08:00"), code, code, on,
        o.get("start", "08:00:00"), hours, f"r{i}",
    )


def day(code, on, checkin=True, log="Không", holiday=False):
    at = dt.datetime(2026, 10, 1, 8, tzinfo=dt.timezone.utc) if checkin else None
    return (code, on, at, None, "HC", log, 8.0, 0, 0, holiday)


@pytest.fixture
def frames(spark):
    return lambda people, days, requests: (
        spark.createDataFrame(people, PERSON),
        spark.createDataFrame([(p[0], None, f"M {p[0]}") for p in people],
                              "code string, live_manager_id string, live_manager_code string"),
        spark.createDataFrame(days, DAY),
        spark.createDataFrame(requests, APPROVAL),
    )


def kinds(schedule, code="A"):
    picked = schedule.filter(F.col("personnel_code") == code)
    return {r.schedule_date: (r.exception_type, r.severity_level) for r in picked.collect()}


def test_every_branch(frames):
    week = {n: D(2026, 9, n) for n in range(1, 31)}
    # September 2026: the 1st is a Tuesday.
    people = [person("A")]
    cases = {
        1: ("half", True, c.HALF_DAY_OK, None),
        2: ("half", False, c.OVERSTAYED, "Trung bình"),
        3: ("full", False, c.LEAVE_OK, None),
        4: ("full", True, c.WORKED_ON_LEAVE, "Trung bình"),
        7: ("pending", False, c.NOT_YET_APPROVED, "Cao"),
        8: ("refused", False, c.AGAINST_RULES, "Cao"),
        9: ("pending", True, c.CHECK_INVALID, "Trung bình"),
        10: ("refused", True, c.CHECK_INVALID, "Trung bình"),
        11: (None, False, c.ABSENT, "Cao"),
        14: (None, True, c.NORMAL, None),
        15: ("unknown", False, c.AGAINST_RULES, "Cao"),
        16: ("nohours", False, c.LEAVE_OK, None),
    }
    status = {"half": "Đã duyệt", "full": "Đã duyệt", "nohours": "Đã duyệt", "pending": "Chờ duyệt",
              "refused": "Không duyệt", "unknown": "Không xác định"}
    hours = {"half": 4.0, "nohours": None}
    days, requests = [], []
    for n, (leave, seen, _, _) in cases.items():
        days.append(day("A", str(week[n]), checkin=seen))
        if leave:
            requests.append(request(n, status=status[leave], on=week[n], hours=hours.get(leave, 8.0)))
    # Sundays: with and without approved overtime, and one without a check-in.
    days += [day("A", "2026-09-06"), day("A", "2026-09-13"), day("A", "2026-09-20", checkin=False, log="Có")]
    requests.append(request(90, kind="Đơn làm thêm", on=week[6]))
    requests.append(request(91, status="Chờ duyệt", on=AS_OF))
    got = kinds(c.schedule_daily(*frames(people, days, requests), CFG))
    for n, (_, _, kind, level) in cases.items():
        assert got[week[n]] == (kind, level), n
    assert got[week[6]] == (c.OVERTIME_OK, None)
    assert got[week[13]] == (c.CHECK_NO_OVERTIME, "Trung bình")
    assert got[week[20]] == (c.CHECK_NO_OVERTIME, "Trung bình")
    assert got[week[27]] == (c.NORMAL, None)
    assert got[AS_OF] == (c.PENDING_TODAY, "Thấp")
    assert len(got) == 61


def test_saturdays_and_holidays(frames):
    people = [person("A"), person("B", STOCK)]
    days = [day("Z", "2026-09-02", holiday=True), day("Z", "bad", holiday=True)]
    schedule = c.schedule_daily(*frames(people, days, [request(1)]), CFG)
    work = {(r.personnel_code, r.schedule_date): r.is_scheduled_workday for r in schedule.collect()}
    # The anchor week runs from 31 August: Saturday the 5th on, the 12th off.
    assert [work["A", D(2026, *x)] for x in ((8, 29), (9, 5), (9, 12), (9, 19))] == [False, True, False, True]
    assert all(work["B", D(2026, *x)] for x in ((8, 29), (9, 5), (9, 12), (9, 19)))
    assert not work["A", D(2026, 9, 6)] and not work["B", D(2026, 9, 2)]


def test_population_and_ranges(frames):
    people = [
        person("A", out=D(2026, 10, 8)), person("S", STORE), person("I", active=False),
        person("N", joined=D(2026, 10, 9)), person("L", joined=D(2026, 10, 5), out=D(2026, 10, 1)),
        person("J", joined=None), person(None),
    ]
    schedule = c.schedule_daily(*frames(people, [day("A", "2026-10-01")], [request(1)]), CFG)
    counts = {r.personnel_code: r["count"] for r in schedule.groupBy("personnel_code").count().collect()}
    assert counts == {"A": 60, "N": 1}
    text = plan(schedule)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_best_status_speaks_for_the_day(frames):
    requests = [
        request(1, status="Không duyệt", hours=2.0), request(2, status="Đã duyệt", hours=3.0),
        request(10, status="Đã duyệt", hours=None, kind="Đơn vắng mặt"),
    ]
    approvals = frames([person("A")], [day("A", "2026-10-01")], requests)[3]
    days = approvals.select("personnel_code", F.col("date_record").alias("schedule_date")).distinct()
    row = c.leave_by_day(approvals, days).first()
    assert (row.leave_status, row.leave_reason, row.total_leave_hours, row.is_half_day_leave) == (
        "Đã duyệt", "r2", 5.0, True,
    )
    assert row.leave_approval_ids == "1,10,2"


def test_checkin_reliability(frames):
    days = [day("A", f"2026-09-{n:02}", checkin=n == 1) for n in range(1, 11)]
    people, managers, timekeep, approvals = frames([person("A"), person("B")], days, [request(1)])
    schedule = c.schedule_daily(people, managers, timekeep, approvals, CFG)
    got = schedule.select("personnel_code", "personnel_checkin_rate_overall", "is_low_checkin_reliability").distinct()
    assert rows(got) == [("A", 0.1, True), ("B", None, True)]


@pytest.mark.parametrize(
    "created, start, late, after, approved_late",
    [("08:01", "08:00:00", False, True, True), ("08:00", "08:00", True, False, True),
     ("07:00", "08:00:00", True, False, True), ("06:59", "08:00:00", False, False, True),
     ("", None, True, False, True), ("bad", "08:00", None, None, True)],
)
def test_timing_flags(frames, created, start, late, after, approved_late):
    on = D(2026, 10, 7)
    rows_ = [request(1, created=on, time_created=created, start=start, on=on, approved=D(2026, 10, 8))]
    people, _, _, approvals = frames([person("A")], [day("A", "2026-10-01")], rows_)
    got = c.approval_timing(approvals, people, CFG).first()
    assert (got.flag_xin_nghi_sat_gio, got.flag_tao_don_hoi_to, got.flag_duyet_hoi_to) == (late, after, approved_late)


def test_timing_scope_and_overdue(frames):
    requests = [
        request(1, status="Chờ duyệt", created=D(2026, 10, 5), approved=None),
        request(2, status="Chờ duyệt", created=D(2026, 10, 6), approved=None),
        request(3, code="S"), request(4, kind="Đơn công tác"), request(5, on=None),
        request(6, code="I"),
    ]
    people, _, _, approvals = frames(
        [person("A"), person("S", STORE), person("I", active=False)], [day("A", "2026-10-01")], requests
    )
    got = c.approval_timing(approvals, people, CFG)
    assert rows(got, "approval_id", "flag_don_ton_cho_duyet_qua_han", "flag_duyet_hoi_to") == [
        (1, True, False), (2, False, False), (6, False, False),
    ]


def test_exception_rows_and_kpis(spark, frames):
    on = D(2026, 10, 7)
    people, managers, timekeep, approvals = frames(
        [person("A"), person("B", dept="P2"), person("C", dept="P3", active=True)],
        [day("A", "2026-10-07", checkin=False)],
        [request(1, on=on), request(2, on=on, status="Không duyệt")],
    )
    schedule = c.schedule_daily(people, managers, timekeep, approvals, CFG)
    timing = c.approval_timing(approvals, people, CFG)
    tracking = spark.createDataFrame(
        [("B_20261007", "Đã xử lý", "HR", "n")],
        "case_id string, processing_status string, handled_by string, note string",
    )
    detail = c.exception_detail(schedule, people, managers, timing, tracking).cache()
    # Two requests on one day give two rows for it.
    a = detail.filter("personnel_code = 'A' and exception_date = '2026-10-07'")
    assert rows(a, "approval_id", "exception_type", "manager_name") == [
        (1, c.LEAVE_OK, "Phụ trách P1"), (2, c.LEAVE_OK, "Phụ trách P1"),
    ]
    states = detail.filter("exception_date = '2026-10-07'").select("case_id", "processing_status")
    assert rows(states.distinct()) == [
        ("A_20261007", None), ("B_20261007", "Đã xử lý"), ("C_20261007", "Chưa xử lý"),
    ]

    kpi = c.kpi_overview(detail, timing, people, CFG)
    row = kpi.filter("exception_date = '2026-10-07'").first()
    assert (row.total_headcount, row.total_personnel_with_record, row.total_luot_nghi) == (3, 3, 2)
    assert (row.total_hop_le, row.total_ngoai_le, row.case_chua_xu_ly) == (2, 2, 1)
    assert "Cartesian" not in plan(kpi)

    gone = people.filter("personnel_code != 'A'")
    dept = c.kpi_by_dept(detail, gone, CFG).filter("period_month = '2026-09-01'")
    ranks = {r.department: (r.ngoai_le_tren_100_nhan_su is None, r.xep_hang_tuan_thu) for r in dept.collect()}
    # No headcount, no rate, first place; equal rates share a place.
    assert ranks == {"P1": (True, 1), "P2": (False, 2), "P3": (False, 2)}


def test_leave_of_unknown_people_is_not_grouped(spark):
    day = dt.date(2024, 1, 5)
    kinds = c.LEAVE_TYPES
    requests = [("" if n % 3 else "NV1", day, kinds[0], "Đã duyệt", 4.0, n, "x") for n in range(90)]
    approvals = spark.createDataFrame(
        requests,
        "personnel_code string, date_record date, approval_type string, approval_status string, "
        "hours_amount double, approval_id bigint, reason string",
    )
    days = spark.createDataFrame([("NV1", day)], "personnel_code string, schedule_date date")
    got = c.leave_by_day(approvals, days).collect()
    assert [r.personnel_code for r in got] == ["NV1"] and len(got[0].leave_approval_ids.split(",")) == 30


def shuffles_of_days(df):
    """How many times the rows of the day spine are dealt out, in a plan without broadcasts by size."""
    def walk(node):
        if node.nodeName() == "Generate" and "sequence(" in node.toString().split("\n")[0]:
            return [0]
        below = [n for i in range(node.children().size()) for n in walk(node.children().apply(i))]
        return [n + (node.nodeName() == "Exchange") for n in below]

    return max(walk(df._jdf.queryExecution().executedPlan().initialPlan()))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


CASES = [
    "A_20261007", "A_20261007", "B_20261006", "_20261007", "A_B_20261005", "A_20261007\n", "A_20260231", "A_2026100",
    "20261007", "C_20261007", "Đ_20261007", "", None,
]


@pytest.mark.usefixtures("no_broadcast")
def test_days_are_dealt_out_once_and_keep_their_rows(spark, frames):
    codes = ["A", "A", "B", "", "A_B", "Đ", None]
    requests = [request(1), request(2, status="Chờ duyệt"), request(3, code="B"), request(4, code="Z"), request(5, code="")]
    requests += [request(6, kind="Đơn làm thêm"), request(7, on=None), request(8, on=D(2020, 1, 1))]
    days = [day("A", "2026-10-07"), day("A", "2026-10-07", checkin=False), day("", "2026-10-07"), day("B", "bad")]
    people, managers, timekeep, approvals = frames([person(k) for k in codes], days, requests)
    timing = c.approval_timing(approvals, people, CFG)
    tracking = spark.createDataFrame(
        [(case, f"s{n}" if n % 5 else None, "HR", f"n{n}") for n, case in enumerate(CASES)],
        "case_id string, processing_status string, handled_by string, note string",
    )
    inputs = (people, managers, timekeep, approvals, CFG)
    plain = c.schedule_daily(*inputs)
    brought = c.schedule_daily(*inputs, with_staff=True)
    detail = c.exception_detail(brought, people, managers, timing, tracking)
    assert shuffles_of_days(plain) == shuffles_of_days(detail) == 1

    want = rows(c.exception_detail(plain, people, managers, timing, tracking))
    assert rows(detail) == want
    # A row for every tracking row with the text of its case, as a join on that text gives them.
    bare = c.exception_detail(plain, people, managers, timing, tracking.limit(0))
    states = tracking.select("case_id", F.col("processing_status").alias("s"), F.col("handled_by").alias("h"), F.col("note").alias("n"))
    joined = bare.join(states, "case_id", "left").withColumns(
        {"processing_status": F.coalesce("s", "processing_status"), "handled_by": F.col("h"), "processing_note": F.col("n")}
    )
    assert rows(joined.select(*detail.columns)) == want
    # Two profiles, two managers and two employee rows of two managers each make 16 rows of a day of A.
    per_day = detail.filter("personnel_code = 'A' and exception_date = '2026-10-06'")
    assert per_day.count() == 16
