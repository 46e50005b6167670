"""Run parameters, fixed labels and session set-up."""

from __future__ import annotations

import datetime as dt
import tempfile
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Labels that appear in the data or in the published marts.
PENDING = "Chờ duyệt"
APPROVED = "Đã duyệt"
REFUSED = "Không duyệt"

UNKNOWN = "Chưa xác định"
NOT_UPDATED = "Chưa cập nhật"
UNASSIGNED = "Chưa phân bổ"

BLOCK_STORE = "Khối Cửa hàng"
BLOCK_WAREHOUSE = "Khối Kho"
BLOCK_OFFICE = "Khối Văn phòng"
BLOCK_PRODUCTION = "Khối Sản xuất"

TYPE_RESIGN = "Đơn thôi việc"
TYPE_TRIP = "Đơn công tác"
TYPE_OVERTIME = "Đơn làm thêm"
TYPE_CHECKIN = "Đơn checkin/out"
TYPE_ABSENCE = "Đơn vắng mặt"
TYPE_LEAVE = "Đơn xin nghỉ"
TYPE_OTHER = "Đơn khác"

TODO = "Chưa xử lý"


@dataclass(frozen=True)
class Settings:
    """Everything a run depends on besides its input tables.

    ``as_of`` stands for "today" wherever a model asks for the current date.
    """

    as_of: dt.date
    backoffice_blocks: tuple[str, ...] = (BLOCK_OFFICE, BLOCK_WAREHOUSE, BLOCK_PRODUCTION)
    late_notice_minutes: int = 60
    overdue_pending_days: int = 3
    six_day_anchor_monday: dt.date = dt.date(2026, 8, 31)
    schedule_days: int = 60
    low_checkin_rate: float = 0.2
    calendar_start: dt.date = dt.date(2020, 1, 1)
    calendar_end: dt.date = dt.date(2030, 12, 31)
    headcount_start: dt.date = dt.date(2020, 1, 1)
    active_statuses: tuple[str, ...] = field(default=("Đang làm việc", "Thử việc", "Thực tập"))

    def __post_init__(self):
        if self.as_of > self.calendar_end:
            raise ValueError(f"the calendar ends on {self.calendar_end}, before {self.as_of}")

    @property
    def as_of_ts(self) -> dt.datetime:
        return dt.datetime.combine(self.as_of, dt.time(), dt.timezone.utc)


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set the SQL options the models rely on; leaves cluster sizing alone."""
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # A person or a request may own a large share of the fact rows: let the
        # runtime split such partitions even where it costs one more exchange.
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.json.enablePartialResults": "true",
        # The JVM never compiles a method of over 8,000 bytes: Spark's fused code of a wide
        # projection would stay interpreted, while its unfused form comes in small methods.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a session that names none (unit tests, local trial runs) gets a local
    temporary one.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="rollcall-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")
