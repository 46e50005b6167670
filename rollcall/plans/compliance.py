"""Leave compliance: request timing, daily schedule, exceptions and KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions import safe
from rollcall.operators.sets import first_by_rank, text_set
from rollcall.operators.spine import day_spine, is_six_day_week
from rollcall.settings import (
    APPROVED,
    BLOCK_PRODUCTION,
    BLOCK_WAREHOUSE,
    PENDING,
    REFUSED,
    TODO,
    TYPE_ABSENCE,
    TYPE_LEAVE,
    TYPE_OVERTIME,
    Settings,
)

# Results of comparing a person's day with the schedule.
NORMAL = "Bình thường"
HALF_DAY_OK = "Bình thường (nghỉ nửa ngày hợp lệ)"
OVERSTAYED = "Nghỉ vượt đơn"
LEAVE_OK = "Bình thường (nghỉ có phép)"
WORKED_ON_LEAVE = "Có đơn nghỉ cả ngày (đã duyệt) nhưng vẫn chấm công đi làm"
PENDING_TODAY = "Đơn đang chờ duyệt (trong ngày)"
NOT_YET_APPROVED = "Nghỉ khi chưa được duyệt"
AGAINST_RULES = "Nghỉ sai quy định"
CHECK_INVALID = "Cần kiểm tra (đơn chưa hợp lệ nhưng vẫn chấm công)"
ABSENT = "Vắng không phép"
OVERTIME_OK = "Bình thường (OT ngày nghỉ)"
CHECK_NO_OVERTIME = "Cần kiểm tra (chấm công ngày nghỉ không có đơn OT)"
UNCLASSIFIED = "Chưa phân loại"
SEVERITY = {
    "Cao": [ABSENT, AGAINST_RULES, NOT_YET_APPROVED],
    "Trung bình": [OVERSTAYED, WORKED_ON_LEAVE, CHECK_INVALID, CHECK_NO_OVERTIME],
    "Thấp": [PENDING_TODAY],
}
LEAVE_TYPES = [TYPE_LEAVE, TYPE_ABSENCE]
STAFF_COLUMNS = ["name", "department", "position_title", "manager_name", "manager_code"]
STATUS_RANK = {APPROVED: 1, PENDING: 2, REFUSED: 3}

TIMEKEEP_INPUT = [
    "personnel_code", "record_date", "checkin", "checkout", "shift_code", "is_check_log",
    "cal_workhour", "late_minute", "soon_minute", "is_holiday",
]


def is_normal(exception_type: Column) -> Column:
    return exception_type.startswith(NORMAL)


def approval_timing(approvals: DataFrame, people: DataFrame, cfg: Settings) -> DataFrame:
    """When a leave request was made and approved, against the start of the leave."""
    staff = people.filter(F.col("department_group").isin(*cfg.backoffice_blocks))
    base = approvals.filter(
        F.col("approval_type").isin(*LEAVE_TYPES)
        & F.col("date_created").isNotNull()
        & F.col("date_record").isNotNull()
    ).select(
        "approval_id",
        "personnel_code",
        "name",
        "approval_type",
        "approval_status",
        "date_created",
        "time_created",
        "date_approved",
        "time_approved",
        "date_record",
        "start_time",
        "reason",
    )
    rows = base.join(staff.select("personnel_code"), "personnel_code", "inner")
    rows = rows.select(*base.columns)
    for clock in ("time_created", "time_approved", "start_time"):
        rows = rows.withColumn(f"{clock}_norm", safe.clock_minutes(F.col(clock)))
    stamp = lambda day, clock: safe.minute_stamp(F.col(day), F.col(clock))
    rows = rows.withColumns(
        {
            "created_datetime": stamp("date_created", "time_created_norm"),
            "approved_datetime": stamp("date_approved", "time_approved_norm"),
            "leave_start_datetime": stamp("date_record", "start_time_norm"),
        }
    )
    start, approved = F.col("leave_start_datetime"), F.col("approved_datetime")
    rows = rows.withColumns(
        {
            "minutes_created_to_leave_start": safe.minutes_between(
                start, F.col("created_datetime")
            ),
            "minutes_leave_start_to_approved": safe.minutes_between(approved, start),
        }
    )
    notice = F.col("minutes_created_to_leave_start")
    waiting = F.datediff(F.lit(cfg.as_of), F.col("date_created"))
    return rows.withColumns(
        {
            "flag_xin_nghi_sat_gio": notice.between(0, cfg.late_notice_minutes),
            "flag_tao_don_hoi_to": notice < 0,
            "flag_duyet_hoi_to": approved.isNotNull() & (approved > start),
            "flag_don_ton_cho_duyet_qua_han": (F.col("approval_status") == PENDING)
            & (waiting > cfg.overdue_pending_days),
        }
    )


def checkin_rates(timekeep: DataFrame) -> DataFrame:
    """Share of a person's recorded days that have a check-in."""
    return (
        timekeep.groupBy("personnel_code")
        .agg(F.count("*").alias("days"), F.count("checkin").alias("checked"))
        .select(
            "personnel_code",
            safe.ratio(F.col("checked"), F.col("days")).alias("checkin_rate"),
        )
    )


def company_holidays(timekeep: DataFrame, cfg: Settings) -> DataFrame:
    """Days flagged as holiday on anyone's record, at most one row per calendar day."""
    day = safe.cast_date(F.col("record_date"))
    return (
        timekeep.filter(F.col("is_holiday"))
        .select(day.alias("holiday_date"))
        .filter(F.col("holiday_date").between(F.lit(cfg.calendar_start), F.lit(cfg.calendar_end)))
        .distinct()
    )


def leave_by_day(approvals: DataFrame, days: DataFrame, last: str = "schedule_date") -> DataFrame:
    """Leave of a person on a day; the best status speaks for all requests.

    Only leave on the scheduled ``days`` is grouped: requests without a usable
    person code would make one ever larger group a day that no schedule asks for.
    A row of ``days`` may stand for all days from its ``schedule_date`` to ``last``.
    Every aggregate folds partially before the shuffle. Ties on the status rank
    go to the lowest request id, then type and reason.
    """
    status = F.col("approval_status")
    rank = F.lit(4)
    for value, place in reversed(STATUS_RANK.items()):
        rank = F.when(status == value, place).otherwise(rank)
    order = [rank, "approval_id", "approval_type", "reason"]
    best = first_by_rank(["approval_status", "approval_type", "reason"], *order)
    hours = F.sum(F.coalesce("hours_amount", F.lit(0.0)))
    ids = text_set(F.col("approval_id"))
    leave = approvals.filter(
        F.col("approval_type").isin(*LEAVE_TYPES) & F.col("date_record").isNotNull()
    )
    asked = days.select(
        F.col("personnel_code").alias("_person"), F.col("schedule_date").alias("_first"), F.col(last).alias("_last")
    ).distinct()
    on_a_day = F.col("date_record").between(F.col("_first"), F.col("_last"))
    leave = leave.join(asked, (F.col("personnel_code") == F.col("_person")) & on_a_day, "left_semi")
    return (
        leave.groupBy("personnel_code", "date_record")
        .agg(best.alias("b"), hours.alias("total_leave_hours"), ids.alias("leave_approval_ids"))
        .select(
            "personnel_code",
            "date_record",
            F.col("b.approval_status").alias("leave_status"),
            F.col("b.approval_type").alias("leave_approval_type"),
            F.col("b.reason").alias("leave_reason"),
            "total_leave_hours",
            ((F.col("total_leave_hours") > 0) & (F.col("total_leave_hours") < 8)).alias(
                "is_half_day_leave"
            ),
            "leave_approval_ids",
        )
    )


def approved_overtime(approvals: DataFrame) -> DataFrame:
    approved = (F.col("approval_type") == TYPE_OVERTIME) & (F.col("approval_status") == APPROVED)
    return approvals.filter(approved).select("personnel_code", "date_record").distinct()


def scheduled_staff(people: DataFrame, managers: DataFrame, cfg: Settings) -> DataFrame:
    """Active office staff with the first and last of their scheduled days."""
    active = people.filter(
        F.col("department_group").isin(*cfg.backoffice_blocks)
        & F.col("personnel_code").isNotNull()
        & F.col("is_active")
        & F.col("job_date_join").isNotNull()
    ).select("personnel_code", "department_group", "job_date_join", "job_date_out")
    # Repeated codes among the profiles repeat a person here, as they do there.
    staff = active.join(
        managers.select(F.col("code").alias("personnel_code")), "personnel_code", "left"
    )
    today = F.lit(cfg.as_of)
    return staff.select(
        "personnel_code",
        "department_group",
        F.greatest("job_date_join", F.date_sub(today, cfg.schedule_days)).alias("range_start"),
        F.least(F.coalesce("job_date_out", today), today).alias("range_end"),
    )


def schedule_spine(staff: DataFrame, cfg: Settings) -> DataFrame:
    """Scheduled days over the last weeks, with what else is known of a person."""
    days = day_spine(staff, "range_start", "range_end", cfg, "schedule_date")
    weekday = F.dayofweek("schedule_date")
    six_days = is_six_day_week(F.col("schedule_date"), cfg)
    always_saturday = F.col("department_group").isin(BLOCK_WAREHOUSE, BLOCK_PRODUCTION)
    workweek = (weekday != 1) & ((weekday != 7) | always_saturday | six_days)
    return days.withColumn("is_workweek_day", workweek).drop("department_group", "range_start", "range_end")


def classify(today: Column) -> Column:
    """Exception type of a person's day, first match wins."""
    work, seen = F.col("is_scheduled_workday"), F.col("has_checkin")
    status, half = F.col("leave_status"), F.col("is_half_day_leave")
    approved = work & (status == APPROVED)
    pending = work & (status == PENDING)
    refused = work & status.isNotNull() & ~status.isin(APPROVED, PENDING)
    unsettled = work & status.isNotNull() & (status != APPROVED)
    none = work & status.isNull()
    day = F.col("schedule_date")
    return (
        F.when(approved & half & seen, HALF_DAY_OK)
        .when(approved & half & ~seen, OVERSTAYED)
        .when(approved & ~half & ~seen, LEAVE_OK)
        .when(approved & ~half & seen, WORKED_ON_LEAVE)
        .when(pending & (day >= today) & ~seen, PENDING_TODAY)
        .when(pending & (day < today) & ~seen, NOT_YET_APPROVED)
        .when(refused & ~seen, AGAINST_RULES)
        .when(unsettled & seen, CHECK_INVALID)
        .when(none & ~seen, ABSENT)
        .when(none & seen, NORMAL)
        .when(~work & seen & F.col("has_approved_ot"), OVERTIME_OK)
        .when(~work & seen & ~F.col("has_approved_ot"), CHECK_NO_OVERTIME)
        .when(~work & ~seen, NORMAL)
        .otherwise(UNCLASSIFIED)
    )


def severity(exception_type: Column) -> Column:
    level = F.when(is_normal(exception_type), F.lit(None).cast("string"))
    for label, types in SEVERITY.items():
        level = level.when(exception_type.isin(*types), label)
    return level.otherwise("Thấp")


def schedule_daily(
    people: DataFrame,
    managers: DataFrame,
    timekeep: DataFrame,
    approvals: DataFrame,
    cfg: Settings,
    with_staff: bool = False,
) -> DataFrame:
    """Expected work calendar against check-ins and requests, per person and day.

    Spine, attendance, leave and overtime meet on person and day, so a person
    with a large share of the rows still spreads over the days. What is known of
    a person is joined before the days are made, which are dealt out once.
    ``with_staff`` adds ``STAFF_COLUMNS``, a row for each row of the person there.
    """
    staff = scheduled_staff(people, managers, cfg)
    ranges = staff.withColumnRenamed("range_start", "schedule_date")
    known = staff.join(checkin_rates(timekeep), "personnel_code", "left")
    if with_staff:
        known = known.join(staff_in_charge(people, managers), "personnel_code", "left")
    spine = schedule_spine(known, cfg)
    # Bounded by the calendar (about 4,000 days), whatever the attendance holds.
    holidays = F.broadcast(company_holidays(timekeep, cfg))
    key = ["personnel_code", "schedule_date"]
    carried = ["checkin_rate", *(STAFF_COLUMNS if with_staff else [])]
    days = spine.join(holidays, F.col("schedule_date") == F.col("holiday_date"), "left").select(
        *key,
        *carried,
        "is_workweek_day",
        F.col("holiday_date").isNotNull().alias("is_company_holiday"),
        (F.col("is_workweek_day") & F.col("holiday_date").isNull()).alias("is_scheduled_workday"),
    )
    present = F.col("checkin").isNotNull() | (F.col("is_check_log") == "Có")
    attendance = timekeep.select(
        "personnel_code",
        safe.cast_date(F.col("record_date")).alias("schedule_date"),
        "checkin",
        "checkout",
        "shift_code",
        "cal_workhour",
        "late_minute",
        "soon_minute",
        present.alias("has_checkin"),
    )
    on_day = lambda df: df.withColumnRenamed("date_record", "schedule_date")
    overtime = on_day(approved_overtime(approvals)).withColumn("overtime", F.lit(True))
    rows = (
        days.join(attendance, key, "left")
        .join(on_day(leave_by_day(approvals, ranges, "range_end")), key, "left")
        .join(overtime, key, "left")
    )
    no = F.lit(False)
    rows = rows.select(
        *key,
        "is_workweek_day",
        "is_company_holiday",
        "is_scheduled_workday",
        F.coalesce("has_checkin", no).alias("has_checkin"),
        "checkin",
        "checkout",
        "shift_code",
        "cal_workhour",
        "late_minute",
        "soon_minute",
        "leave_status",
        "leave_approval_type",
        "leave_reason",
        "total_leave_hours",
        F.coalesce("is_half_day_leave", no).alias("is_half_day_leave"),
        "leave_approval_ids",
        F.col("overtime").isNotNull().alias("has_approved_ot"),
        F.col("checkin_rate").alias("personnel_checkin_rate_overall"),
        (F.coalesce("checkin_rate", F.lit(0.0)) < cfg.low_checkin_rate).alias(
            "is_low_checkin_reliability"
        ),
        *(STAFF_COLUMNS if with_staff else []),
    )
    rows = rows.withColumn("exception_type", classify(F.lit(cfg.as_of)))
    return rows.withColumn("severity_level", severity(F.col("exception_type")))


def staff_in_charge(people: DataFrame, managers: DataFrame) -> DataFrame:
    """``STAFF_COLUMNS`` of every employee, by person code; repeated codes repeat a row."""
    lead = managers.select(
        F.col("code").alias("personnel_code"), "live_manager_id", "live_manager_code"
    )
    in_charge = F.concat(F.lit("Phụ trách "), F.col("department"))
    return (
        people.select("personnel_code", "name", "department", "position_title")
        .join(lead, "personnel_code", "left")
        .select(
            "personnel_code",
            "name",
            "department",
            "position_title",
            F.coalesce(F.nullif(safe.strip(F.col("live_manager_id")), F.lit("")), in_charge).alias(
                "manager_name"
            ),
            F.col("live_manager_code").alias("manager_code"),
        )
    )


def states_by_day(tracking: DataFrame) -> DataFrame:
    """Processing states by the person and day that a case id consists of."""
    case = F.col("case_id")
    tail = F.right(case, F.lit(8))
    day = F.when(case.rlike(r"_[0-9]{8}\z"), F.try_to_date(tail, "yyyyMMdd"))
    return tracking.select(
        F.expr("left(case_id, length(case_id) - 9)").alias("personnel_code"),
        F.when(F.date_format(day, "yyyyMMdd") == tail, day).alias("schedule_date"),
        "processing_status",
        "handled_by",
        F.col("note").alias("processing_note"),
    ).filter(F.col("schedule_date").isNotNull())


def exception_detail(
    schedule: DataFrame,
    people: DataFrame,
    managers: DataFrame,
    timing: DataFrame,
    tracking: DataFrame,
) -> DataFrame:
    """Schedule rows with employee, request and processing state, one per request.

    Requests and states meet the days on person and day. The employee's columns are
    joined unless the schedule has them (``schedule_daily(with_staff=True)``).
    """
    requests = timing.select(
        "personnel_code",
        F.col("date_record").alias("schedule_date"),
        "approval_id",
        F.col("approval_type").alias("leave_approval_type"),
        F.col("approval_status").alias("leave_approval_status"),
        F.col("reason").alias("leave_reason"),
        "time_created",
        "time_approved",
        "minutes_created_to_leave_start",
        "minutes_leave_start_to_approved",
        "flag_xin_nghi_sat_gio",
        "flag_tao_don_hoi_to",
        "flag_duyet_hoi_to",
        "flag_don_ton_cho_duyet_qua_han",
    )
    key = ["personnel_code", "schedule_date"]
    days = schedule.drop("leave_approval_type", "leave_reason")
    rows = days.join(requests, key, "left").join(states_by_day(tracking), key, "left")
    if not set(STAFF_COLUMNS) <= set(schedule.columns):
        rows = rows.join(staff_in_charge(people, managers), "personnel_code", "left")
    is_exception = F.col("severity_level").isNotNull()
    return rows.select(
        F.col("schedule_date").alias("exception_date"),
        "personnel_code",
        *STAFF_COLUMNS,
        F.when(F.col("is_scheduled_workday"), "Ngày làm")
        .otherwise("Ngày nghỉ (cuối tuần/lễ)")
        .alias("scheduled_day_label"),
        *[c for c in requests.columns if c not in key],
        "has_checkin",
        "checkin",
        "checkout",
        "shift_code",
        "cal_workhour",
        "late_minute",
        "exception_type",
        "severity_level",
        is_exception.alias("is_exception"),
        "personnel_checkin_rate_overall",
        "is_low_checkin_reliability",
        F.concat("personnel_code", F.lit("_"), F.date_format("schedule_date", "yyyyMMdd")).alias(
            "case_id"
        ),
        F.coalesce("processing_status", F.when(is_exception, TODO)).alias("processing_status"),
        "handled_by",
        "processing_note",
    )


def office_staff(people: DataFrame, cfg: Settings) -> DataFrame:
    """Active staff of the monitored blocks."""
    return people.filter(
        F.col("department_group").isin(*cfg.backoffice_blocks) & F.col("is_active")
    )


def kpi_overview(
    detail: DataFrame, timing: DataFrame, people: DataFrame, cfg: Settings
) -> DataFrame:
    """Daily indicators; counts run over detail rows, one per request."""
    kind = F.col("exception_type")
    todo = (F.col("processing_status") == TODO) & F.col("is_exception")
    daily = detail.groupBy("exception_date").agg(
        F.countDistinct("personnel_code").alias("total_personnel_with_record"),
        F.count_if(~is_normal(kind)).alias("total_ngoai_le"),
        F.count_if(is_normal(kind)).alias("total_hop_le"),
        F.count_if(kind == ABSENT).alias("case_vang_khong_phep"),
        F.count_if(kind == NOT_YET_APPROVED).alias("case_don_chua_duyet_da_nghi"),
        F.count_if(kind == AGAINST_RULES).alias("case_nghi_sai_quy_dinh"),
        F.count_if(kind == OVERSTAYED).alias("case_nghi_vuot_don"),
        F.count_if(todo).alias("case_chua_xu_ly"),
        F.count("leave_approval_status").alias("total_luot_nghi"),
    )
    requests = timing.groupBy(F.col("date_record").alias("exception_date")).agg(
        F.count_if("flag_duyet_hoi_to").alias("so_don_duyet_hoi_to"),
        F.count_if("flag_tao_don_hoi_to").alias("so_don_tao_hoi_to"),
        F.count_if("flag_don_ton_cho_duyet_qua_han").alias("so_don_ton_qua_han"),
    )
    headcount = office_staff(people, cfg).agg(F.countDistinct("personnel_code")).scalar()
    good, bad = F.col("total_hop_le"), F.col("total_ngoai_le")
    zero = F.lit(0).cast("long")
    return daily.join(requests, "exception_date", "left").select(
        "exception_date",
        headcount.alias("total_headcount"),
        "total_personnel_with_record",
        "total_luot_nghi",
        "total_ngoai_le",
        "total_hop_le",
        safe.ratio(good, good + bad).alias("ty_le_nghi_hop_le"),
        "case_vang_khong_phep",
        "case_don_chua_duyet_da_nghi",
        "case_nghi_sai_quy_dinh",
        "case_nghi_vuot_don",
        "case_chua_xu_ly",
        *[
            F.coalesce(c, zero).alias(c)
            for c in ("so_don_duyet_hoi_to", "so_don_tao_hoi_to", "so_don_ton_qua_han")
        ],
    )


def kpi_by_dept(detail: DataFrame, people: DataFrame, cfg: Settings) -> DataFrame:
    """Monthly indicators per department, ranked by exceptions per 100 staff.

    A department without headcount has no rate and ranks first.
    """
    kind = F.col("exception_type")
    monthly = (
        detail.groupBy(F.trunc("exception_date", "month").alias("period_month"), "department")
        .agg(
            F.count("leave_approval_status").alias("total_luot_nghi"),
            F.count_if(~is_normal(kind)).alias("total_ngoai_le"),
            F.count_if(is_normal(kind)).alias("total_hop_le"),
            F.count_if("flag_duyet_hoi_to").alias("so_don_duyet_hoi_to"),
        )
    )
    headcount = (
        office_staff(people, cfg)
        .groupBy("department")
        .agg(F.countDistinct("personnel_code").alias("headcount"))
    )
    good, bad = F.col("total_hop_le"), F.col("total_ngoai_le")
    rated = monthly.join(headcount, "department", "left").select(
        "period_month",
        "department",
        "headcount",
        "total_luot_nghi",
        "total_ngoai_le",
        "total_hop_le",
        safe.ratio(good, good + bad).alias("ty_le_tuan_thu"),
        safe.ratio(bad * 100, F.col("headcount")).alias("ngoai_le_tren_100_nhan_su"),
        "so_don_duyet_hoi_to",
    )
    place = F.rank().over(
        Window.partitionBy("period_month").orderBy(F.col("ngoai_le_tren_100_nhan_su").asc())
    )
    return rated.withColumn("xep_hang_tuan_thu", place.cast("long"))
