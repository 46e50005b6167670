"""Staging models: landed JSON to typed rows, one per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import jsonx, safe
from rollcall.operators.flatten import unnest_envelope
from rollcall.operators.latest import first_by, is_pending
from rollcall.plans.columns import (
    APPROVAL_FIELDS,
    DETAIL_FIELDS,
    PROFILE_FIELDS,
    STRICT_KINDS,
    TIMEKEEP_FIELDS,
    Field,
    project,
)
from rollcall.settings import TODO, Settings
from rollcall.sources.raw import HR_MASTER_COLUMNS, TRACKING_COLUMNS, sheet_rows

# A record's own text settles ties between rows with the same load stamp.
_TIE = "xxhash64(rec) AS _tie"
DOCUMENT_ARRAYS = ("inout", "overtime", "absence", "leave_data")


def _with(only: Sequence[str] | None, *needed: str) -> list[str] | None:
    return None if only is None else [*only, *needed]


def _output(df: DataFrame, only: Sequence[str] | None) -> DataFrame:
    return df.drop("_tie") if only is None else df.select(*only)


def stg_profiles(raw: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Latest record per employee id.

    The pick carries the record as text: its 245 columns, mostly empty, would take
    several times the memory in the sort. Strict columns are read before the pick as
    well, so that bad text fails the job in records that lose, too; equal records have
    equal ones, so they decide nothing.
    """
    fields = PROFILE_FIELDS if only is None else [f for f in PROFILE_FIELDS if f.name in {*only, "ID"}]
    strict = [f for f in fields if f.kind in STRICT_KINDS]
    records = unnest_envelope(raw, "RAW_DATA", ["SYNC_TIME AS sync_time"])
    read = project(records, strict, "rec", ["sync_time", "rec", _TIE])
    strict_hash = F.xxhash64(*[F.col(f"`{f.name}`") for f in strict])
    read = read.select("sync_time", F.col("ID").alias("_id"), "rec", "_tie", strict_hash.alias("_strict"))
    latest = first_by(read, ["_id"], [F.col("sync_time").desc(), F.col("_tie"), F.col("_strict")])
    rows = project(latest, fields, "rec", ["sync_time"])
    return rows if only is None else rows.select(*only)


def stg_approvals(raw: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Latest snapshot per request; a settled snapshot beats a newer pending one."""
    records = unnest_envelope(raw, "RAW_DATA", ["SYNC_TIME AS sync_time"])
    needed = _with(only, "ID", "personnel_code", "app_approval_status")
    rows = project(records, APPROVAL_FIELDS, "rec", ["sync_time", _TIE], needed)
    # Snapshots without a person do not count: they come last, and go if picked.
    nobody = F.coalesce(F.col("personnel_code"), F.lit("")) == ""
    order = [
        nobody.asc(),
        is_pending(F.col("app_approval_status")).asc(),
        F.col("sync_time").desc(),
        F.col("_tie"),
    ]
    return _output(first_by(rows, ["ID"], order).filter(~nobody), only)


def stg_approval_details(
    raw: DataFrame, cfg: Settings, only: Sequence[str] | None = None
) -> DataFrame:
    """Latest document per request, API errors left out.

    Documents seldom carry ``_loaded_at``, so most of them tie on ``sync_time``;
    a settled status, then the ingest time, decide. The whole table has its arrays as
    a variant writes them; where ``only`` some columns are staged, for the marts, which
    parse them again, arrays keep their keys in the order of the document.
    """
    doc = jsonx.parse_once(raw, F.from_json("RAW_DATA", "error string, data string"), "_d")
    error = jsonx.scalar("_d", "error", "RAW_DATA")
    doc = doc.filter((error != "true") | error.isNull())
    doc = doc.selectExpr("APPROVAL_ID AS ID", "INGEST_TS", "_d.data AS rec")
    fields = [*DETAIL_FIELDS, Field("_loaded", "_loaded_at", "timestamp")]
    if only is not None:
        fields = [replace(f, kind="array") if f.name in DOCUMENT_ARRAYS else f for f in fields]
    needed = _with(only, "app_approval_status", "_loaded")
    rows = project(doc, fields, "rec", ["ID", "INGEST_TS", _TIE], needed)
    stamped = F.coalesce("_loaded", F.lit(cfg.as_of_ts))
    rows = rows.select(stamped.alias("sync_time"), "*").drop("_loaded")
    order = [
        F.col("sync_time").desc(),
        is_pending(F.col("app_approval_status")).asc(),
        F.col("INGEST_TS").desc(),
        F.col("_tie"),
    ]
    return _output(first_by(rows, ["ID"], order).drop("INGEST_TS"), only)


def stg_timekeep(raw: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Latest record per person and requested day."""
    keep = ["SYNC_TIME", "SYNC_DATE AS attendance_date"]
    records = unnest_envelope(raw, "RAW_DATA", keep)
    rows = project(
        records,
        TIMEKEEP_FIELDS,
        "rec",
        ["attendance_date", "SYNC_TIME", _TIE],
        _with(only, "personnel_code"),
    )
    latest = first_by(
        rows, ["personnel_code", "attendance_date"], [F.col("SYNC_TIME").desc(), F.col("_tie")]
    )
    return _output(latest, only)


def stg_hr_master_data(sheet: DataFrame) -> DataFrame:
    """Latest contract per person; rows without a join date come last."""
    rows = sheet_rows(sheet, HR_MASTER_COLUMNS)
    rest = [F.col(c) for c in rows.columns if c not in ("personnel_code", "date_join")]
    return first_by(rows, ["personnel_code"], [F.col("date_join").desc_nulls_last(), *rest])


def stg_exception_status(sheet: DataFrame) -> DataFrame:
    """One tracking row per case.

    The source leaves open which of several rows of a case wins; here it is the
    latest case date, then the remaining columns in order.
    """
    case = F.col("MA_CASE")
    rows = sheet_rows(sheet.filter(case.isNotNull() & (safe.strip(case) != "")), TRACKING_COLUMNS)
    rows = rows.withColumns(
        {
            "case_date": safe.cast_date(F.col("case_date")),
            "processing_status": safe.blank_to(F.col("processing_status"), TODO),
        }
    )
    rest = ["personnel_code", "exception_type_note", "processing_status", "handled_by", "note"]
    return first_by(rows, ["case_id"], [F.col("case_date").desc(), *map(F.col, rest)])
