"""HR-shaped landed tables derived from the star schema test tables.

Customers stand for employees, orders for requests and their documents, events
for attendance. Every landed row comes from one base row by arithmetic on its
key (attendance: from one hash aggregate), so nothing is gathered into a group
and the landed tables grow with the base tables.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import expr

from rollcall.settings import APPROVED, PENDING, REFUSED, Settings
from rollcall.sources.raw import HR_MASTER_COLUMNS

AS_OF = dt.date(2024, 1, 30)
SETTINGS = Settings(as_of=AS_OF)
#: Base rows a task turns into landed rows.
TASK_ROWS = 50_000

# One department per block rule, with look-alikes, blank and none.
DEPARTMENTS = [
    "Kho Tổng Cửa hàng",
    "Phòng Kinh doanh Cửa hàng",
    "HN_CH 1",
    "Cửa hàng Hà Nội",
    "Phòng Kế hoạch Sản xuất",
    "Kho NPL",
    "Xưởng May",
    "Kho Miền Nam",
    "Văn phòng Công ty",
    "Phòng Kế hoạch",
    "  ",
    None,
]
REQUEST_TYPES = [
    "Đơn công tác",
    "Đơn xin thôi việc",
    "Đơn tăng ca",
    "Đơn xin nghỉ phép",
    "Đơn vắng mặt",
    "Chấm công bù",
    "Đổi ca",
    None,
    "Photocopy",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The same rows, by ``keys`` if any are given, over tasks of about ``TASK_ROWS`` rows.

    A row becomes hundreds of times its size as JSON, so the few splits of a small file
    would be the only tasks of all that is derived from it.
    """
    return df.repartition(max(1, -(-df.count() // TASK_ROWS)), *keys)


def _pick(values: list, at: str) -> str:
    """SQL that picks a fixed value by position."""
    items = ", ".join("NULL" if v is None else "'" + v.replace("'", "\\'") + "'" for v in values)
    return f"get(array({items}), CAST({at} AS INT))"


def _day(offset: str, start: str = "2024-01-01") -> str:
    return f"date_add(DATE '{start}', CAST({offset} AS INT))"


def _dmy(day: str) -> str:
    return f"date_format({day}, 'dd/MM/yyyy')"


def _two(n: str) -> str:
    return f"lpad(CAST({n} AS STRING), 2, '0')"


def _object(fields: dict[str, str]) -> str:
    """SQL for a JSON object; NULL members are left out."""
    members = ", ".join(f"'{key}', {value}" for key, value in fields.items())
    return f"to_json(named_struct({members}))"


def _with_members(json: str, members: list[str]) -> str:
    """Add ready JSON members to a non-empty object; NULL adds none."""
    return f"concat(concat_ws(',', left({json}, length({json}) - 1), {', '.join(members)}), '}}')"


def _envelope(record: str) -> str:
    return f"concat('{{\"data\":[', {record}, '],\"error\":false}}')"


def _loads(df: DataFrame, versions: dict[str, str | None], *columns: str) -> DataFrame:
    """A row per version of each input row: ``versions`` names stamps, and when a row has them.

    ``columns`` are built after the rows are repeated; they tell versions apart by ``v`` and
    find the stamp as ``at``. So the code of a record is there once, not once a version: the
    JVM never compiles a method of over 8,000 bytes.
    """
    there = [f"CASE WHEN {when} THEN {v} END" if when else str(v) for v, when in enumerate(versions.values())]
    rows = df.selectExpr("*", f"explode(array({', '.join(there)})) AS v").filter("v IS NOT NULL")
    stamps = ", ".join(f"TIMESTAMP '{stamp}'" for stamp in versions)
    return rows.selectExpr("*", f"get(array({stamps}), v) AS at").selectExpr(*columns)


def profiles_raw(customer: DataFrame) -> DataFrame:
    """An employee per customer; some also have an older load."""
    joined = _day("k * 37 % 1800", "2019-01-01")
    record = _object(
        {
            "ID": "k",
            "code": "CASE WHEN k % 101 = 7 THEN NULL WHEN k % 211 = 5 THEN concat('NV', k - 1) "
            "ELSE concat('NV', k) END",
            "name": "c_name",
            "department_full": _pick(DEPARTMENTS, "k % 12"),
            "department_id": "c_mktsegment",
            "department_num_id": "CAST(k % 12 AS STRING)",
            "gender": _pick(["Nam", "Nữ", ""], "k % 3"),
            "position_title": "CASE WHEN k % 9 = 0 THEN ' ' ELSE c_mktsegment END",
            "job_title_name": "CASE WHEN k % 14 != 0 THEN concat('Bậc ', k % 4) END",
            "job_status": "CASE WHEN k % 10 = 0 THEN 'Đã nghỉ việc' WHEN k % 10 = 1 THEN 'Thử việc' "
            "WHEN k % 10 = 2 THEN 'Thực tập' WHEN k % 50 = 49 THEN '' ELSE 'Đang làm việc' END",
            "work_place": "CASE WHEN k % 8 != 0 THEN concat('Khu ', c_nationkey) END",
            "birthday": "CASE WHEN k % 40 = 3 THEN '' WHEN k % 41 = 5 THEN '31/02/1990' "
            f"ELSE {_dmy(_day('k * 37 % 18000', '1960-01-01'))} END",
            "job_date_join": f"CASE WHEN k % 23 != 0 THEN {_dmy(joined)} END",
            "job_date_out": "CASE WHEN k % 10 = 0 THEN "
            + _dmy(f"date_add({joined}, CAST(k % 700 - 30 AS INT))")
            + " ELSE '' END",
            "salary_real": "c_acctbal",
            "salary_total": "CASE WHEN k % 7 != 0 THEN CAST(k % 7 * 100 AS STRING) END",
            "marital_status": _pick(["Độc thân", "Đã kết hôn", "", None], "k % 4"),
            "email": "concat('nv', k, '@example.com')",
            "live_manager_id": "CASE WHEN k % 6 != 0 THEN concat('Quản lý ', k % 20) ELSE '' END",
            "live_manager_code": "concat('NV', k div 10)",
        }
    )
    members = [
        _pick(
            [
                None,
                '"json_insurance":[]',
                '"json_insurance":[{"code":"BH"}]',
                '"json_insurance":null',
            ],
            "k % 4",
        ),
        _pick(
            [
                None,
                '"json_degrees":[]',
                '"json_degrees":[{"level_name":"Đại học","specialization":"Kế toán"}]',
                '"json_degrees":[{"level_name":"Cao đẳng"},{"level_name":"Khác"}]',
                '"json_degrees":{"level_name":"Khác"}',
            ],
            "k % 5",
        ),
        # A string and an array that look alike as text.
        _pick(['"jobs":"[1]"', '"jobs":[1]', None], "k % 3"),
    ]
    older = _object({"ID": "k", "name": "'Tên cũ'"})
    text = f"CASE v WHEN 0 THEN {_with_members('record', members)} ELSE {older} END"
    rows = customer.selectExpr("*", "c_custkey AS k").selectExpr("k", f"{record} AS record")
    versions = {"2024-01-29 00:00:00": None, "2024-01-28 00:00:00": "k % 13 = 0"}
    return _loads(rows, versions, "at AS SYNC_TIME", f"{_envelope(text)} AS RAW_DATA")


def request_columns(orders: DataFrame) -> DataFrame:
    """What a request and its document have in common, one row per order."""
    status = (
        f"CASE o_orderstatus WHEN 'O' THEN '{PENDING}' WHEN 'F' THEN '{APPROVED}' "
        f"ELSE '{REFUSED}' END"
    )
    return orders.selectExpr(
        "o_orderkey AS o",
        "CASE WHEN o_orderkey % 53 = 0 THEN '' "
        "WHEN o_orderkey % 37 = 0 THEN concat('NX', o_custkey % 50) "
        "ELSE concat('NV', o_custkey) END AS person",
        "concat('Người ', o_custkey % 50) AS person_name",
        f"CASE WHEN o_orderkey % 29 != 0 THEN {status} END AS status",
        f"{status} AS any_status",
        f"{_day('o_orderkey % 30')} AS created",
    )


def approvals_raw(orders: DataFrame) -> DataFrame:
    """A snapshot per request; some also have a stale pending one, newer by load time."""
    approved = f"any_status = '{APPROVED}'"

    description = (
        "CASE v WHEN 0 THEN CASE WHEN o % 4 != 1 THEN concat('Lý do ', o % 11) END "
        "WHEN 1 THEN 'Bản cũ' ELSE 'Bản trước' END"
    )
    record = _object(
        {
            "ID": "o",
            "personnel_code": "person",
            "personnel_name": "person_name",
            "app_approval_status": f"CASE v WHEN 1 THEN '{PENDING}' ELSE status END",
            "app_sub_object": _pick(REQUEST_TYPES, "o % 9"),
            "app_approval_current_id": "concat('QL ', o % 20)",
            "date_created": f"concat({_dmy('created')}, "
            "CASE WHEN o % 31 = 0 THEN ' 11:19' ELSE '' END)",
            "time_created": "CASE WHEN o % 19 = 0 THEN '' "
            f"ELSE concat({_two('o * 7 % 24')}, ':', {_two('o * 13 % 60')}) END",
            "date_approve": f"CASE WHEN {approved} THEN "
            + _dmy("date_add(created, CAST(o % 4 AS INT))")
            + " END",
            "time_approve": f"CASE WHEN {approved} THEN concat({_two('o * 5 % 24')}, ':30') END",
            "date_start": "CASE WHEN o % 3 != 0 THEN "
            + _dmy("date_add(created, CAST(o % 5 AS INT))")
            + " END",
            "department_id": "concat('D', o % 7)",
            "desc": description,
            "reason": "CASE WHEN o % 2 = 0 THEN '[Gấp] việc riêng' END",
            "num_file": "o % 3",
        }
    )
    versions = {
        "2024-01-29 00:00:00": None,
        "2024-01-30 00:00:00": "o % 4 = 0",
        "2024-01-28 00:00:00": "o % 8 = 3",
    }
    return _loads(
        request_columns(orders), versions, "at AS SYNC_TIME", f"{_envelope(record)} AS RAW_DATA"
    )


def details_raw(orders: DataFrame) -> DataFrame:
    """A document per request: its kind, elements and inner rows follow from the key."""
    day = f"date_format({_day('(o + i + j) % 30')}, 'yyyy-MM-dd')"

    def clock(after: int, seconds: str = ":00") -> str:
        return f"concat({_two(f'(i + {after}) % 24')}, ':', {_two('o % 60')}, '{seconds}')"

    def element(fields: dict[str, str], inner_key: str, inner: dict[str, str]) -> str:
        """An array of outer elements, each with its array of inner rows."""
        row = ", ".join(f"'{k}', {v}" for k, v in inner.items())
        own = "".join(f"'{k}', {v}, " for k, v in fields.items())
        rows = f"transform(inners, j -> named_struct({row}))"
        return f"to_json(transform(outers, i -> named_struct({own}'{inner_key}', {rows})))"

    overtime = element(
        {
            "ID": "CAST(i + 1 AS STRING)",
            "desc": "concat('Tăng ca ', i)",
            "types": _pick(["0", "1", "2", "", "9"], "o % 7"),
        },
        "detail",
        {
            "personnel_code": "person",
            "date": day,
            "start_time": clock(17),
            "end_time": clock(19),
            "hours": "CAST(j + 1 AS STRING)",
        },
    )
    inout = element(
        {
            "personnel_code": "CASE WHEN o % 10 = 1 THEN person END",
            "reason_name": "'Công tác ngoài'",
            "description_text": "'Bổ sung công'",
        },
        "inoutinfo",
        {"date": day, "time": clock(8), "reason_name": "CASE WHEN j = 1 THEN 'Quên' END"},
    )
    leave = element(
        {
            "personnel_code": "person",
            "reason": "CASE WHEN i = 0 THEN 'Phép năm' ELSE ' ' END",
        },
        "detail",
        {
            "date_start": day,
            "time_start": clock(8),
            "time_end": clock(12),
            "day_number": "CASE WHEN j % 2 = 0 THEN '0.5' WHEN o % 4 != 2 THEN '1' END",
        },
    )
    absence = element(
        {"desc": "'Việc riêng'"},
        "detail",
        {
            "date_start": day,
            "time_start": clock(13, ""),
            "time_end": clock(15, ""),
            "hour_number": "j + 2",
        },
    )
    members = []
    for at, (name, items) in enumerate(
        {"overtime": overtime, "inout": inout, "leave": leave, "absence": absence}.items()
    ):
        # Requests of no kind: some with JSON null where an array would be.
        null = "WHEN o % 5 = 4 AND o % 3 = 2 THEN '\"overtime\":null' " if at == 0 else ""
        members.append(
            f"CASE WHEN o % 5 = {at} THEN concat('\"{name}\":', {items}) {null}"
            f"WHEN o % 2 = 1 THEN '\"{name}\":[]' END"
        )

    own = f"CASE WHEN o % 6 = 0 THEN '{APPROVED}' WHEN o % 6 != 1 THEN status END"
    base = _object(
        {
            "ID": "o",
            "personnel_code": "person",
            "app_approval_status": f"CASE v WHEN 0 THEN {own} ELSE '{PENDING}' END",
            "date_created": _dmy("created"),
            "date_approve": f"CASE WHEN any_status != '{PENDING}' THEN "
            f"{_dmy('date_add(created, 2)')} END",
        }
    )
    document = f"""concat('{{"data":', {_with_members(base, ["arrays"])}, '}}')"""
    error = '\'{"error":true,"message":"Post not found"}\''
    text = f"CASE WHEN v = 0 AND o % 17 = 0 THEN {error} ELSE {document} END"
    shaped = request_columns(orders).selectExpr(
        "*",
        "sequence(0L, o div 5 % 2) AS outers",
        "CASE WHEN o div 10 % 4 > 0 THEN sequence(0L, o div 10 % 4 - 1) "
        "ELSE CAST(array() AS ARRAY<BIGINT>) END AS inners",
    ).selectExpr("*", f"nullif(concat_ws(',', {', '.join(members)}), '') AS arrays")
    versions = {"2024-01-29 00:00:00": None, "2024-01-30 00:00:00": "o % 11 = 0"}
    return _loads(
        shaped, versions, "o AS APPROVAL_ID", f"{text} AS RAW_DATA", "at AS INGEST_TS"
    )


def timekeep_raw(events: DataFrame) -> DataFrame:
    """An attendance record per user and day, some with an earlier load of the day."""
    days = events.selectExpr("user_id AS u", "to_date(ts) AS d", "ts", "event_type")
    days = spread(days, "u", "d").groupBy("u", "d")
    clock = "date_format({0}(ts), 'yyyy-MM-dd HH:mm:ss')"
    days = days.agg(
        *map(
            expr,
            [
                f"{clock.format('min')} AS first_ts",
                f"{clock.format('max')} AS last_ts",
                "count(*) AS n",
                "count_if(event_type = 'error') AS errors",
            ],
        )
    )

    record = _object(
        {
            "ID": "CAST(u * 100 + dayofmonth(d) AS STRING)",
            "personnel_code": "concat(CASE WHEN u % 60 = 59 THEN 'TK' ELSE 'NV' END, u)",
            # Some records of the 10th are dated the day before, as late corrections are.
            "date": "CAST(date_sub(d, CASE WHEN u % 50 = 7 AND dayofmonth(d) = 10 "
            "THEN 1 ELSE 0 END) AS STRING)",
            "job_status": "'Đang làm việc'",
            "checkin": "CASE WHEN n % 3 != 0 THEN first_ts END",
            "checkout": "CASE WHEN n % 3 != 0 THEN last_ts END",
            "is_check_log": "CASE WHEN n % 6 = 3 THEN 'Có' ELSE 'Không' END",
            "late_minute": "CASE v WHEN 0 THEN CAST(errors AS STRING) ELSE '99' END",
            "soon_minute": "CASE WHEN n = 5 THEN 'x' ELSE CAST(n * 2 AS STRING) END",
            "cal_workhour": "CAST(n AS DOUBLE) * 0.5D",
            "cal_workday": "'1'",
            "total_cal_workhour": "CAST(n AS STRING)",
            "is_holiday": "CASE WHEN dayofmonth(d) = 1 THEN '1' ELSE '0' END",
            "day_off": "'0'",
            "shift_code": "'HC'",
            "time_start": "'08:00'",
            "time_end": "'17:30'",
        }
    )
    versions = {"2024-01-30 00:00:00": None, "2024-01-29 00:00:00": "u % 5 = 0"}
    return _loads(
        days, versions, "at AS SYNC_TIME", "CAST(d AS STRING) AS SYNC_DATE", f"{_envelope(record)} AS RAW_DATA"
    )


def hr_sheet(customer: DataFrame) -> DataFrame:
    """Contract rows per employee, two for some and undated for others."""
    rows = customer.selectExpr(
        "c_custkey AS k", "c_name", "c_mktsegment", "explode(sequence(0, CAST(c_custkey % 2 AS INT))) AS i"
    )
    values = {
        "MA_NV": "concat('NV', k)",
        "TEN_NHAN_VIEN": "c_name",
        "PHONG_BAN": "c_mktsegment",
        "HINH_THUC": "concat('HĐ ', i)",
        "NGAY_VAO_NGAY_KY_H_TV": "CASE WHEN k % 3 != 0 OR i = 0 THEN CAST("
        + _day("k % 500 + i * 30", "2019-01-01")
        + " AS STRING) END",
    }
    return rows.selectExpr(
        *[f"{values.get(h, 'CAST(NULL AS STRING)')} AS {h}" for h in HR_MASTER_COLUMNS]
    )


def tracking_sheet(customer: DataFrame) -> DataFrame:
    """Processing states typed in for some cases, with blanks and repeated cases."""
    rows = customer.filter("c_custkey % 2 = 0").selectExpr(
        "c_custkey AS k",
        f"{_day('c_custkey % 30')} AS day",
        "explode(sequence(0, CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END)) AS i",
    )
    return rows.selectExpr(
        "CASE WHEN k % 14 = 0 THEN ' ' ELSE concat('NV', k, '_', date_format(day, 'yyyyMMdd')) END "
        "AS MA_CASE",
        "concat('NV', k) AS MA_NV",
        "CASE WHEN k % 16 = 0 THEN '2024' ELSE CAST(day AS STRING) END AS NGAY",
        "concat('Loại ', i) AS LOAI_NGOAI_LE",
        "CASE WHEN k % 4 = 0 THEN ' ' ELSE 'Đã xử lý' END AS TRANG_THAI_XU_LY",
        "concat('HR ', k % 5) AS NGUOI_XU_LY",
        "CASE WHEN i = 0 THEN 'ghi chú' END AS GHI_CHU",
    )


class StarSources:
    """The landed tables of a table folder, each derived when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._table = lambda name: table(spark, sf_dir, name)

    @cached_property
    def _customer(self) -> DataFrame:
        return spread(self._table("customer"))

    @cached_property
    def _orders(self) -> DataFrame:
        return spread(self._table("orders").select("o_orderkey", "o_custkey", "o_orderstatus"))

    @cached_property
    def profiles(self) -> DataFrame:
        return profiles_raw(self._customer)

    @cached_property
    def approvals(self) -> DataFrame:
        return approvals_raw(self._orders)

    @cached_property
    def details(self) -> DataFrame:
        return details_raw(self._orders)

    @cached_property
    def timekeep(self) -> DataFrame:
        return timekeep_raw(self._table("events"))

    @cached_property
    def hr_master(self) -> DataFrame:
        return hr_sheet(self._customer)

    @cached_property
    def tracking(self) -> DataFrame:
        return tracking_sheet(self._customer)


def sources(spark: SparkSession, sf_dir: str) -> StarSources:
    return StarSources(spark, sf_dir)
