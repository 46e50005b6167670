"""Employee, request, attendance and headcount marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import jsonx, safe
from rollcall.operators.flatten import two_level
from rollcall.operators.latest import first_by
from rollcall.operators.sets import presence
from rollcall.operators.spine import month_headcount
from rollcall.settings import (
    BLOCK_OFFICE,
    BLOCK_PRODUCTION,
    BLOCK_STORE,
    BLOCK_WAREHOUSE,
    NOT_UPDATED,
    PENDING,
    TYPE_ABSENCE,
    TYPE_CHECKIN,
    TYPE_LEAVE,
    TYPE_OTHER,
    TYPE_OVERTIME,
    TYPE_RESIGN,
    TYPE_TRIP,
    UNASSIGNED,
    UNKNOWN,
    Settings,
)

NO_REASON = "Không có lý do"

# Words in a department name that decide its block, first match wins.
BLOCK_WORDS: list[tuple[str, list[str]]] = [
    (BLOCK_WAREHOUSE, ["Kho Tổng Cửa hàng"]),
    (BLOCK_OFFICE, ["Kinh doanh Cửa hàng"]),
    (BLOCK_STORE, ["_CH", "Cửa hàng"]),
    (
        BLOCK_PRODUCTION,
        ["Kế hoạch Sản xuất", "Kho Nguyên phụ liệu", "Kho NPL", "Mua hàng", "Cung ứng", "Xưởng"],
    ),
    (BLOCK_WAREHOUSE, ["Kho"]),
    (BLOCK_OFFICE, ["Văn phòng"]),
]

# Words in a request type that decide its class, first match wins.
TYPE_WORDS: list[tuple[str, list[str]]] = [
    (TYPE_RESIGN, ["thôi việc", "nghỉ việc"]),
    (TYPE_TRIP, ["công tác"]),
    (TYPE_OVERTIME, ["làm thêm", "tăng ca", "ot"]),
    (TYPE_CHECKIN, ["checkin", "inout", "chấm công"]),
    (TYPE_ABSENCE, ["vắng"]),
    (TYPE_LEAVE, ["nghỉ", "phép"]),
]

# Overtime codes, and the raw type each kind of document gets.
OVERTIME_CODES = {"0": "Ngày thường", "1": "Ngày nghỉ", "2": "Ngày lễ"}
KIND_TYPES = {
    "overtime": "Đơn làm thêm",
    "inout": "Đơn checkin/out",
    "leave": "Đơn nghỉ phép",
    "absence": "Đơn vắng",
}
DETAIL_KINDS = {
    "overtime": "overtime",
    "inout": "inout",
    "leave": "leave_data",
    "absence": "absence",
}

# Staging columns each mart reads; callers stage no more than these.
PROFILE_INPUT = [
    "sync_time", "ID", "code", "name", "department_full", "department_id", "department_num_id",
    "gender", "position_title", "job_title_name", "job_status", "work_place", "birthday",
    "job_date_join", "job_date_out", "salary_real", "salary_total", "json_insurance",
    "json_degrees", "marital_status", "mobile", "email", "live_manager_id", "live_manager_code",
]
APPROVAL_INPUT = [
    "ID", "personnel_code", "personnel_name", "app_approval_status", "app_sub_object",
    "app_approval_current_id", "date_created", "time_created", "date_approve", "time_approve",
    "date_start", "department_id", "description_text", "reason",
]
DETAIL_INPUT = [
    "ID", "personnel_code", "app_approval_status", "date_approve",
    "inout", "overtime", "absence", "leave_data",
]


def _first_match(text: Column, rules: list[tuple[str, list[str]]]):
    chosen = F
    for label, words in rules:
        hit = F.lit(False)
        for word in words:
            hit = hit | text.contains(word.lower())
        chosen = chosen.when(hit, label)
    return chosen


def department_block(department: Column) -> Column:
    """Block of an employee's department."""
    blank = department.isNull() | (safe.strip(department) == "")
    rules = _first_match(F.lower(department), BLOCK_WORDS)
    return rules.when(blank, UNASSIGNED).otherwise(BLOCK_OFFICE)


def request_block(department: Column) -> Column:
    """The coarser block shown on requests.

    ``_`` is a wildcard here, so any department with a letter before "ch" is
    taken for a store.
    """
    low = F.lower(department)
    store = low.like("%_ch%") | low.like("%cửa hàng%")
    return F.when(store, BLOCK_STORE).otherwise(BLOCK_OFFICE)


def request_type(raw_type: Column) -> Column:
    return _first_match(F.lower(raw_type), TYPE_WORDS).otherwise(TYPE_OTHER)


def age_band(age: Column) -> Column:
    return (
        F.when(age.isNull(), UNKNOWN)
        .when(age < 18, "Lỗi dữ liệu")
        .when(age < 25, "< 25 tuổi")
        .when(age <= 30, "25 - 30 tuổi")
        .when(age <= 40, "31 - 40 tuổi")
        .otherwise("> 40 tuổi")
    )


def tenure_band(months: Column) -> Column:
    return (
        F.when(months.isNull(), UNKNOWN)
        .when(months < 6, "< 6 tháng")
        .when(months <= 12, "6 - 12 tháng")
        .when(months <= 36, "1 - 3 năm")
        .otherwise("> 3 năm")
    )


def missing_people(profiles: DataFrame, approvals: DataFrame, timekeep: DataFrame) -> DataFrame:
    """Codes seen only in requests (with their greatest name) or only in attendance.

    Both fact sides are reduced together to one row per code, map side first, before
    the one join, so the join runs on people rather than on facts.
    """
    known = profiles.filter(F.col("code").isNotNull()).select("code").distinct()
    code = F.col("personnel_code").alias("code")
    by_request = approvals.select(code, F.col("personnel_name").alias("name"), F.lit(True).alias("requested"))
    by_day = timekeep.select(code, F.lit(None).cast("string").alias("name"), F.lit(False).alias("requested"))
    people = (
        by_request.unionByName(by_day)
        .filter(F.col("code").isNotNull())
        .groupBy("code")
        .agg(F.max("name").alias("name"), F.bool_or("requested").alias("requested"))
    )
    name = F.when(F.col("requested"), F.col("name")).otherwise(F.lit(UNKNOWN))
    return people.join(known, "code", "left_anti").select("code", name.alias("name"))


def mart_profiles(
    profiles: DataFrame,
    approvals: DataFrame,
    timekeep: DataFrame,
    cfg: Settings,
    regions: DataFrame | None = None,
) -> DataFrame:
    """One row per employee, and per person known from requests or attendance only."""
    columns = [c for c in PROFILE_INPUT if c != "department_num_id"]
    columns = [c for c in columns if not c.startswith("live_manager")]
    staff = profiles.select(*columns)
    fixed = {
        "ID": F.lit(-1),
        "code": F.col("code"),
        "name": safe.blank_to(F.col("name"), UNKNOWN),
        "department_full": F.lit(UNASSIGNED),
        "position_title": F.lit(NOT_UPDATED),
        "job_title_name": F.lit(NOT_UPDATED),
        "job_status": F.lit(NOT_UPDATED),
        "salary_real": F.lit(0),
        "salary_total": F.lit(0),
        "sync_time": F.lit(cfg.as_of_ts),
    }
    extra = missing_people(profiles, approvals, timekeep).select(
        *[
            fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in staff.schema.fields
        ]
    )
    people = staff.unionByName(extra)

    today = F.lit(cfg.as_of)
    joined, left = F.col("job_date_join"), F.col("job_date_out")
    age = safe.years_between(today, F.col("birthday"))
    months = safe.months_between(F.coalesce(left, today), joined)
    degree = jsonx.record_struct(
        F.get(jsonx.elements(F.col("json_degrees")), F.lit(0)), ["level_name", "specialization"]
    )
    people = people.withColumns(
        {
            "_degree": F.get(jsonx.elements(F.col("json_degrees")), F.lit(0)),
            "_d": degree,
            "_age": age,
            "_months": months,
        }
    )
    filled = lambda c, d=NOT_UPDATED: safe.blank_to(F.col(c), d)
    result = people.select(
        F.col("ID").alias("profile_id"),
        F.col("code").alias("personnel_code"),
        "name",
        filled("gender").alias("gender"),
        filled("department_full", UNASSIGNED).alias("department"),
        department_block(F.col("department_full")).alias("department_group"),
        "department_id",
        filled("position_title").alias("position_title"),
        filled("job_title_name").alias("job_title"),
        filled("job_status").alias("job_status"),
        filled("work_place").alias("work_place"),
        F.coalesce(F.col("job_status").isin(*cfg.active_statuses), F.lit(False)).alias("is_active"),
        "birthday",
        "job_date_join",
        F.when(~F.coalesce(left < joined, F.lit(False)), left).alias("job_date_out"),
        F.col("_age").alias("age"),
        age_band(F.col("_age")).alias("age_group"),
        F.col("_months").alias("tenure_months"),
        tenure_band(F.col("_months")).alias("tenure_group"),
        F.coalesce("salary_real", F.lit(0.0)).alias("salary_real"),
        F.coalesce("salary_total", F.lit(0.0)).alias("salary_total"),
        jsonx.has_items(F.col("json_insurance")).alias("has_insurance"),
        jsonx.has_items(F.col("json_degrees")).alias("has_degree"),
        F.coalesce(jsonx.scalar("_d", "level_name", "_degree"), F.lit("Không có")).alias(
            "highest_degree_level"
        ),
        F.coalesce(jsonx.scalar("_d", "specialization", "_degree"), F.lit("Không có")).alias(
            "highest_degree_specialization"
        ),
        filled("marital_status").alias("marital_status"),
        "mobile",
        "email",
        "sync_time",
    )
    if regions is None:
        return result.withColumn("region", F.lit(None).cast("string"))
    columns = [*result.columns, "region"]
    return result.join(regions.select("department", "region"), "department", "left").select(columns)


OUTER_SCALARS = ["personnel_code", "desc", "description_text", "types", "reason", "reason_name"]
INNER_SCALARS = [
    "personnel_code", "date", "date_start", "time", "start_time", "end_time", "time_start",
    "time_end", "hours", "day_number", "hour_number", "reason_name", "app_approval_status",
]


def detail_events(
    details: DataFrame, carry: tuple[str, ...] = ("ID",), keep_parent: bool = False
) -> DataFrame:
    """Typed events of the four document kinds, one per request, kind and day.

    Overtime keeps every distinct event. The other kinds keep one event per
    request and day, the earliest by clock and then by the remaining columns.
    Rows stay partitioned by request id throughout. ``carry`` names the columns
    of a document that its events take along.
    """
    flat = two_level(
        details.select(*carry, "personnel_code", *DETAIL_KINDS.values()),
        DETAIL_KINDS,
        OUTER_SCALARS,
        ["detail", "inoutinfo"],
        INNER_SCALARS,
        keep_parent,
    )
    kind = F.col("kind")
    outer = lambda k: jsonx.scalar("outer_j", k, "outer_rec")
    inner = lambda k: jsonx.scalar("inner_j", k, "inner_rec")
    number = lambda k: inner(k).try_cast("double")
    overtime, inout, leave, absence = (kind == k for k in DETAIL_KINDS)

    code = F.coalesce(outer("types"), F.lit(""))
    ot_type = F.when(safe.strip(code) == "", UNKNOWN)
    for value, label in OVERTIME_CODES.items():
        ot_type = ot_type.when(code == value, label)
    raw_type = F.element_at(
        F.create_map(*[F.lit(x) for pair in KIND_TYPES.items() for x in pair]), kind
    )
    events = flat.select(
        *carry,
        "kind",
        raw_type.alias("raw_type"),
        F.when(overtime, inner("personnel_code"))
        .otherwise(F.coalesce(outer("personnel_code"), F.col("personnel_code")))
        .alias("event_person"),
        safe.date_ymd(
            F.when(overtime | inout, inner("date")).otherwise(inner("date_start"))
        ).alias("date_record"),
        F.when(overtime, inner("start_time"))
        .when(inout, inner("time"))
        .otherwise(inner("time_start"))
        .alias("start_time"),
        F.when(overtime, inner("end_time"))
        .when(leave | absence, inner("time_end"))
        .alias("end_time"),
        F.when(overtime, number("hours"))
        .when(leave, number("day_number") * 8)
        .when(absence, number("hour_number"))
        .alias("hours_amount"),
        F.when(leave, number("day_number")).alias("days_amount"),
        F.when(leave, outer("reason")).alias("leave_type"),
        F.when(overtime, ot_type.otherwise(outer("types"))).alias("ot_type"),
        F.when(inout, F.coalesce(inner("reason_name"), outer("reason_name"))).alias("inout_reason"),
        F.coalesce(outer("desc"), outer("description_text")).alias("reason"),
    )
    values = [
        "start_time", "end_time", "hours_amount", "days_amount", "leave_type", "ot_type",
        "inout_reason", "reason", "event_person",
    ]
    # NULL for the kinds that keep one row a day, the whole row for overtime.
    own = F.when(F.col("kind") == "overtime", F.struct(*values))
    return first_by(
        events.withColumn("_own", own),
        ["ID", "kind", "date_record", "_own"],
        [F.col(v).asc() for v in values],
    ).drop("_own")


def mart_approvals(
    details: DataFrame,
    approvals: DataFrame,
    profiles: DataFrame,
    incremental_since: dt.date | None = None,
) -> DataFrame:
    """Request events: document details, and one event for every other request.

    Both inputs are unique per id. Documents are flattened where they lie, each
    with one row for the document itself, and joined to the list once; that join
    yields the status of every event and shows which requests have no details.
    ``details`` is read twice, so pass a written table where it is large.
    """
    has_detail = F.lit(False)
    for c in DETAIL_KINDS.values():
        has_detail = has_detail | jsonx.has_items(F.col(c))

    # A request without an id cannot be matched. One among the documents makes
    # "not in the documents" unknown for every listed request, and a listed one
    # is only known to be absent when no document has details at all.
    detailed = details.filter(has_detail)
    some_detailed, unknown = presence(detailed, "ID")

    known = F.col("ID").isNotNull()
    documents = details.select(
        "ID",
        "personnel_code",
        *DETAIL_KINDS.values(),
        has_detail.alias("detailed"),
        F.when(known, F.col("app_approval_status")).alias("app_approval_status"),
        F.when(known, F.col("date_approve")).alias("date_approve"),
    )
    listed = approvals.select(
        *[F.col(c).alias(f"l_{c}") for c in APPROVAL_INPUT], F.lit(True).alias("listed")
    )
    # Placed by id once, before flattening: the pick per day and the join below
    # both find their rows where they are.
    carry = ("ID", "detailed", "app_approval_status", "date_approve")
    events = detail_events(documents.repartition("ID"), carry, keep_parent=True)
    events = events.join(listed, F.col("ID") == F.col("l_ID"), "full_outer")
    # A row is an event of a document, or else stands for a whole request. The
    # latter counts when it is listed and its document has no details.
    whole = F.col("kind").isNull()
    unmatchable = F.col("l_ID").isNull() & some_detailed
    other = F.col("listed") & ~F.coalesce("detailed", F.lit(False)) & ~unmatchable & ~unknown
    events = events.filter(~whole | other)

    instead = lambda column, value: F.when(whole, value).otherwise(F.col(column))
    events = events.withColumns(
        {
            "raw_type": instead("raw_type", F.coalesce("l_app_sub_object", F.lit(TYPE_OTHER))),
            "event_person": instead("event_person", F.col("l_personnel_code")),
            "date_record": instead("date_record", F.coalesce("l_date_start", "l_date_created")),
            "start_time": instead("start_time", F.col("l_time_created")),
            "reason": instead(
                "reason", F.coalesce("l_description_text", "l_reason", F.lit(NO_REASON))
            ),
        }
    ).filter(F.col("event_person").isNotNull())

    matched = F.col("l_ID").isNotNull()
    own = lambda c: F.when(matched, F.col(f"l_{c}"))
    settled = F.col("app_approval_status") != PENDING
    created = F.coalesce(own("date_created"), F.col("date_record"))
    if incremental_since is not None:
        events = events.filter(created >= F.lit(incremental_since))

    people = profiles.select(
        F.col("code").alias("p_code"),
        F.col("name").alias("p_name"),
        F.col("department_full").alias("p_department"),
        "position_title",
        "work_place",
    )
    rows = events.join(people, F.col("event_person") == F.col("p_code"), "left")
    return rows.select(
        F.coalesce("ID", "l_ID").alias("approval_id"),
        request_type(F.col("raw_type")).alias("approval_type"),
        F.when(settled, F.col("app_approval_status"))
        .otherwise(
            F.coalesce(
                own("app_approval_status"), F.col("app_approval_status"), F.lit("Không xác định")
            )
        )
        .alias("approval_status"),
        created.alias("date_created"),
        own("time_created").alias("time_created"),
        F.coalesce(own("date_approve"), F.col("date_approve")).alias("date_approved"),
        own("time_approve").alias("time_approved"),
        own("app_approval_current_id").alias("approver_name"),
        F.col("event_person").alias("personnel_code"),
        F.coalesce("p_name", own("personnel_name")).alias("name"),
        F.coalesce("p_department", own("department_id")).alias("department_full"),
        request_block(F.col("p_department")).alias("department_group"),
        "position_title",
        "work_place",
        "date_record",
        "start_time",
        "end_time",
        "hours_amount",
        "days_amount",
        safe.blank_to(F.col("leave_type"), UNKNOWN).alias("leave_type"),
        safe.blank_to(F.col("ot_type"), UNKNOWN).alias("ot_type"),
        safe.blank_to(F.col("inout_reason"), UNKNOWN).alias("inout_reason"),
        safe.blank_to(F.col("reason"), NO_REASON).alias("reason"),
    )


def int_approval_details_flat(details: DataFrame) -> DataFrame:
    """Events of the first element of each document array only."""
    pairs = F.array(
        *[
            F.struct(
                F.lit("leave" if c == "leave_data" else c).alias("detail_type"),
                # Most arrays are empty; those need no parsing.
                F.when(F.col(c) != "[]", F.get(jsonx.elements(F.col(c)), F.lit(0))).alias("head"),
            )
            for c in DETAIL_KINDS.values()
        ]
    )
    rows = details.select(F.col("ID").alias("approval_id"), F.explode(pairs).alias("_p"))
    rows = rows.select("approval_id", "_p.detail_type", "_p.head").filter(F.col("head").isNotNull())
    keys = ["detail", "inoutinfo"]
    rows = rows.withColumn("_f", jsonx.record_struct(F.col("head"), [], arrays=keys))
    inout = F.col("detail_type") == "inout"
    own = lambda f: F.when(inout, f["inoutinfo"]).otherwise(f["detail"])
    found = own(F.col("_f"))
    # A value that is no array, JSON null included, counts as present without events. Only
    # where no array was found the element is read again to tell such a value from none.
    other = own(jsonx.record_struct(F.col("head"), [], keys))
    alone = F.array(F.lit(None).cast("string"))
    events = F.explode(
        F.when(found.isNotNull(), jsonx.present_or_null(found)).when(other.isNotNull(), alone)
    )
    rows = rows.select("approval_id", "detail_type", events.alias("rec")).withColumn(
        "_j", jsonx.record_struct(F.col("rec"), INNER_SCALARS)
    )

    get = lambda k: jsonx.scalar("_j", k, "rec")
    kind = F.col("detail_type")
    overtime, leave = kind == "overtime", kind == "leave"
    return rows.select(
        "approval_id",
        "detail_type",
        safe.date_ymd(F.when(overtime | inout, get("date")).otherwise(get("date_start"))).alias(
            "date_record"
        ),
        F.when(overtime, get("start_time"))
        .when(inout, get("time"))
        .otherwise(get("time_start"))
        .alias("start_time"),
        F.when(overtime, get("end_time")).when(~inout, get("time_end")).alias("end_time"),
        F.when(overtime, get("hours").cast("double"))
        .when(leave, get("day_number").cast("double") * 8)
        .when(kind == "absence", get("hour_number").cast("double"))
        .alias("hours_number"),
        get("app_approval_status").alias("detail_status"),
    )


ATTENDANCE_INPUT = [
    "attendance_date", "personnel_code", "job_status", "cal_workday", "cal_workhour",
    "total_cal_workhour", "total_cal_workday", "late_minute", "soon_minute", "fine_late",
    "fine_soon", "leave_p", "leave_co", "leave_ts", "leave_dh", "leave_nvsc", "leave_nkl",
    "workhour_overtime", "ot_normal_light", "ot_normal_night", "ot_dayoff_light",
    "ot_holiday_light", "time_start", "time_end",
]


def mart_attendance_events(timekeep: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row per person and day."""
    measures = [
        c
        for c in ATTENDANCE_INPUT
        if c not in ("attendance_date", "personnel_code", "job_status", "time_start", "time_end")
    ]
    people = profiles.select(
        F.col("code").alias("personnel_code"),
        "name",
        safe.blank_to(F.col("department_full"), UNASSIGNED).alias("department_full"),
        safe.blank_to(F.col("position_title"), NOT_UPDATED).alias("position_title"),
    )
    days = timekeep.filter(F.col("personnel_code").isNotNull()).select(*ATTENDANCE_INPUT)
    return days.join(people, "personnel_code", "left").select(
        safe.cast_date(F.col("attendance_date")).alias("event_date"),
        "personnel_code",
        F.coalesce("name", F.lit(UNKNOWN)).alias("name"),
        F.coalesce("department_full", F.lit(UNASSIGNED)).alias("department_full"),
        F.coalesce("position_title", F.lit(NOT_UPDATED)).alias("position_title"),
        *measures,
        F.lit("Timekeep").alias("event_category"),
        F.col("job_status").alias("event_status"),
        F.col("time_start").alias("start_time"),
        F.col("time_end").alias("end_time"),
        F.col("total_cal_workhour").alias("hours_amount"),
    )


def mart_employee_events(mart_profiles: DataFrame) -> DataFrame:
    """Hire and leave events, both from one pass over the employees."""
    event = lambda day, label: F.when(
        F.col(day).isNotNull(),
        F.struct(F.col(day).alias("event_date"), F.lit(label).alias("event_type")),
    )
    events = F.array(event("job_date_join", "Tuyển mới"), event("job_date_out", "Nghỉ việc"))
    kept = [
        "profile_id", "personnel_code", "name", "department", "department_group", "position_title",
    ]
    rows = mart_profiles.select(*kept, F.explode(events).alias("e"))
    return rows.filter(F.col("e").isNotNull()).select(*kept, "e.*")


def mart_headcount_snapshot(profiles: DataFrame, cfg: Settings) -> DataFrame:
    """Headcount per month, department and position."""
    people = profiles.select(
        F.col("department_num_id").alias("department_id"),
        "department_full",
        "position_title",
        "code",
        "job_date_join",
        "job_date_out",
    )
    group = ["department_id", "department_full", "position_title"]
    return month_headcount(people, group, "code", "job_date_join", "job_date_out", cfg)
