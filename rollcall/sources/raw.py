"""Schemas and readers of the landed tables and sheets."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import jsonx, safe

PROFILE_SCHEMA = "SYNC_TIME timestamp, RAW_DATA string"
APPROVALS_SCHEMA = "SYNC_TIME timestamp, RAW_DATA string"
# INGEST_TS is ours: the landed details carry no load stamp of their own.
DETAILS_SCHEMA = "APPROVAL_ID bigint, RAW_DATA string, INGEST_TS timestamp"
TIMEKEEP_SCHEMA = "SYNC_TIME timestamp, SYNC_DATE string, RAW_DATA string"
SCHEMAS = {
    "profiles": PROFILE_SCHEMA,
    "approvals": APPROVALS_SCHEMA,
    "details": DETAILS_SCHEMA,
    "timekeep": TIMEKEEP_SCHEMA,
}

# Sheet headers and the names they get, in sheet order.
HR_MASTER_COLUMNS = {
    "MA_NV": "personnel_code",
    "TEN_NHAN_VIEN": "name",
    "KHOI": "department_block",
    "PHONG_BAN": "department",
    "CAP_BAC": "job_level",
    "VI_TRI_CHUC_DANH": "job_title",
    "TINH_TRANG": "status",
    "HINH_THUC": "contract_type",
    "NGAY_VAO_NGAY_KY_H_TV": "date_join",
    "NGAY_KET_THUC_H_TV": "date_end_probation",
    "NGAY_KY_H_KV": "date_sign_contract_1",
    "NGAY_KET_THUC_H_KV": "date_end_contract_1",
    "NGAY_KY_H_L_LAN_1": "date_sign_contract_2",
    "KET_THUC_H_LAN_1": "date_end_contract_2",
    "NGAY_NGHI_VIEC": "date_resign",
    "THAM_NIEN": "tenure_months",
    "THANG_SINH": "birth_month",
    "O_TUOI": "age_group",
    "GIOI_TINH": "gender",
    "CCCD_HO_CHIEU": "has_id_card",
    "SHK_XAC_NHAN_CU_TRU": "has_residence_proof",
    "BAN_SAO_BANG_CAP": "has_degree_copy",
    "SO_YEU_LY_LICH": "has_resume",
    "GIAY_KHAI_SINH": "has_birth_certificate",
    "GIAY_KHAM_SUC_KHOE": "has_health_certificate",
}
TRACKING_COLUMNS = {
    "MA_CASE": "case_id",
    "MA_NV": "personnel_code",
    "NGAY": "case_date",
    "LOAI_NGOAI_LE": "exception_type_note",
    "TRANG_THAI_XU_LY": "processing_status",
    "NGUOI_XU_LY": "handled_by",
    "GHI_CHU": "note",
}


@dataclass
class Sources:
    """Landed tables of a run; the sheets are optional."""

    profiles: DataFrame
    approvals: DataFrame
    details: DataFrame
    timekeep: DataFrame
    hr_master: DataFrame | None = None
    tracking: DataFrame | None = None


def load_stamp(stamp: Column, batch_ts: dt.datetime) -> Column:
    """A missing load stamp defaults to the batch time."""
    return F.coalesce(stamp, F.lit(batch_ts).cast("timestamp"))


def read_landed_json(
    spark: SparkSession, path: str, table: str, batch_ts: dt.datetime
) -> DataFrame:
    """Newline-delimited landing files; RAW_DATA keeps its JSON text."""
    df = spark.read.schema(SCHEMAS[table]).json(path)
    stamp = "INGEST_TS" if table == "details" else "SYNC_TIME"
    return df.withColumn(stamp, load_stamp(F.col(stamp), batch_ts))


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(path)


def read_sheet(spark: SparkSession, path: str, headers: dict[str, str]) -> DataFrame:
    """An exported sheet as text columns; blank cells are NULL."""
    schema = ", ".join(f"`{h}` string" for h in headers)
    return spark.read.schema(schema).option("header", True).csv(path)


def sheet_rows(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(h).alias(n) for h, n in headers.items()])


def landed_records(raw: Column) -> Column:
    """Number of records an envelope carries."""
    return F.coalesce(F.size(jsonx.envelope_records(raw)), F.lit(0))


def reload_days(utc_ts: Column, days_back: int = 3) -> Column:
    """Days a timekeeping reload asks for, as the text keys of its table."""
    return F.transform(safe.window_days(utc_ts, days_back), lambda d: d.cast("string"))
