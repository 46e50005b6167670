"""Declarative data checks and load validation."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    column: str
    kind: str  # not_null | unique | accepted_values
    values: tuple = ()
    where: str | None = None


def not_null(*columns: str) -> list[Check]:
    return [Check(c, "not_null") for c in columns]


def unique(*columns: str) -> list[Check]:
    return [Check(c, "unique") for c in columns]


def accepted(column: str, values: Sequence, where: str | None = None) -> list[Check]:
    return [Check(column, "accepted_values", tuple(values), where)]


# The checks declared for each model.
REQUEST_STATUSES = ["Đã duyệt", "Chờ duyệt", "Từ chối", "Đã hủy", "Chưa duyệt", "Không duyệt"]
BLOCKS = ["Khối Cửa hàng", "Khối Kho", "Khối Sản xuất", "Khối Văn phòng", "Chưa phân bổ"]
REQUEST_TYPES = [
    "Đơn làm thêm",
    "Đơn checkin/out",
    "Đơn xin nghỉ",
    "Đơn vắng mặt",
    "Đơn công tác",
    "Đơn thôi việc",
    "Đơn khác",
]
SUITES: dict[str, list[Check]] = {
    "stg_profiles": not_null("ID", "code", "name") + unique("ID"),
    "stg_approvals": not_null("ID", "personnel_code")
    + unique("ID")
    + accepted("app_approval_status", REQUEST_STATUSES),
    "stg_approval_details": not_null("ID", "personnel_code") + unique("ID"),
    "stg_timekeep": not_null("personnel_code", "attendance_date"),
    "stg_hr_master_data": not_null("personnel_code") + unique("personnel_code"),
    "int_approval_details_flat": not_null("approval_id", "detail_type")
    + accepted("detail_type", ["overtime", "inout", "absence", "leave"]),
    "mart_profiles": not_null("personnel_code", "name", "is_active", "department_group")
    + unique("personnel_code")
    + accepted("is_active", [True, False])
    + accepted("department_group", BLOCKS),
    "mart_approvals": not_null("approval_id", "approval_type", "personnel_code", "approval_status")
    + accepted("approval_type", REQUEST_TYPES),
    "mart_attendance_events": not_null("personnel_code", "event_date"),
    "mart_employee_events": not_null("personnel_code", "event_type", "event_date")
    + accepted("event_type", ["Tuyển mới", "Nghỉ việc"]),
    "mart_headcount_snapshot": not_null("snapshot_month", "total_employees", "active_employees"),
    "mart_compliance_schedule_daily": not_null("personnel_code", "schedule_date", "exception_type")
    + accepted("severity_level", ["Cao", "Trung bình", "Thấp"], "severity_level is not null"),
    "mart_compliance_approval_timing": not_null("approval_id", "personnel_code"),
    "mart_compliance_exception_detail": not_null("personnel_code", "exception_date", "case_id"),
    "dim_date": not_null("date", "year", "is_weekday") + unique("date"),
}


def run_checks(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check: model, column, kind, failures, status.

    Failures count null rows, repeated values or distinct unexpected values.
    All null checks share one pass. The value checks group on the column, with
    partial counts before the shuffle.
    """
    parts = []
    nulls = [c for c in checks if c.kind == "not_null"]
    if nulls:
        counted = df.agg(
            *[F.count_if(F.col(c.column).isNull()).alias(f"n{i}") for i, c in enumerate(nulls)]
        )
        lines = F.array(
            *[
                F.struct(
                    F.lit(c.column).alias("column_name"),
                    F.lit(c.kind).alias("check"),
                    F.col(f"n{i}").alias("failures"),
                )
                for i, c in enumerate(nulls)
            ]
        )
        parts.append(counted.select(F.explode(lines).alias("l")).select("l.*"))
    for c in checks:
        if c.kind == "not_null":
            continue
        rows = df.filter(c.where) if c.where else df
        values = rows.filter(F.col(c.column).isNotNull()).groupBy(c.column).count()
        bad = F.col("count") > 1 if c.kind == "unique" else ~F.col(c.column).isin(*c.values)
        parts.append(
            values.agg(F.count_if(bad).alias("failures")).select(
                F.lit(c.column).alias("column_name"), F.lit(c.kind).alias("check"), "failures"
            )
        )
    return functools.reduce(DataFrame.unionByName, parts).select(
        F.lit(model).alias("model"),
        "column_name",
        "check",
        "failures",
        F.when(F.col("failures") == 0, "PASS").otherwise("ERROR").alias("status"),
    )


def summary(results: DataFrame) -> DataFrame:
    """PASS, WARN, ERROR, SKIP and TOTAL counts of check results."""
    states = ["PASS", "WARN", "ERROR", "SKIP"]
    counts = [F.count_if(F.col("status") == s).alias(s) for s in states]
    return results.agg(*counts, F.count("*").alias("TOTAL"))


def require_rows(df: DataFrame, minimum: int, name: str) -> int:
    """Row count of a loaded table; raises when it is below ``minimum``."""
    actual = df.count()
    if actual < minimum:
        raise ValueError(f"row count too low for {name}: {actual} < {minimum}")
    return actual


def freshness(
    df: DataFrame,
    source: str,
    loaded_at: str,
    as_of: dt.datetime,
    warn_hours: int = 25,
    error_hours: int = 49,
) -> DataFrame:
    """Age of the newest row against the two limits, both exclusive."""
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("max_loaded_at")
    hour = 3_600_000_000
    return newest.select(
        F.lit(source).alias("source"),
        "max_loaded_at",
        _age_status(age, warn_hours * hour, error_hours * hour).alias("status"),
    )


def _age_status(age: Column, warn: int, error: int) -> Column:
    return (
        F.when(age.isNull() | (age > error), "ERROR").when(age > warn, "WARN").otherwise("PASS")
    )
