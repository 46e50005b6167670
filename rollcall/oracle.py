"""The same results in DuckDB SQL, from the base tables and without JSON.

``STAR`` holds the typed tables the landed JSON stands for, as CTEs written from
the base tables; each query takes the ones it needs.
"""

from __future__ import annotations

import re

from rollcall.plans.columns import PROFILE_FIELDS

AS_OF = "DATE '2024-01-30'"

# CTE name -> SQL; a query pulls in the ones it names, and theirs in turn.
STAR: dict[str, str] = {}

STAR["people"] = """
SELECT k AS id,
  CASE WHEN k % 101 = 7 THEN NULL WHEN k % 211 = 5 THEN 'NV' || (k - 1) ELSE 'NV' || k END AS code,
  c_name AS name,
  (['Kho Tổng Cửa hàng','Phòng Kinh doanh Cửa hàng','HN_CH 1','Cửa hàng Hà Nội',
    'Phòng Kế hoạch Sản xuất','Kho NPL','Xưởng May','Kho Miền Nam','Văn phòng Công ty',
    'Phòng Kế hoạch','  ',NULL])[CAST(k % 12 AS INTEGER) + 1] AS department_full,
  c_mktsegment AS department_id,
  k % 12 AS department_num_id,
  (['Nam','Nữ',''])[CAST(k % 3 AS INTEGER) + 1] AS gender,
  CASE WHEN k % 9 = 0 THEN ' ' ELSE c_mktsegment END AS position_title,
  CASE WHEN k % 14 <> 0 THEN 'Bậc ' || (k % 4) END AS job_title_name,
  CASE WHEN k % 10 = 0 THEN 'Đã nghỉ việc' WHEN k % 10 = 1 THEN 'Thử việc'
       WHEN k % 10 = 2 THEN 'Thực tập' WHEN k % 50 = 49 THEN '' ELSE 'Đang làm việc' END AS job_status,
  CASE WHEN k % 8 <> 0 THEN 'Khu ' || c_nationkey END AS work_place,
  CASE WHEN k % 40 = 3 OR k % 41 = 5 THEN NULL
       ELSE DATE '1960-01-01' + CAST(k * 37 % 18000 AS INTEGER) END AS birthday,
  CASE WHEN k % 23 <> 0 THEN DATE '2019-01-01' + CAST(k * 37 % 1800 AS INTEGER) END AS job_date_join,
  CASE WHEN k % 10 = 0 THEN DATE '2019-01-01' + CAST(k * 37 % 1800 + k % 700 - 30 AS INTEGER) END
    AS job_date_out,
  c_acctbal AS salary_real,
  CASE WHEN k % 7 <> 0 THEN CAST(k % 7 * 100 AS DOUBLE) END AS salary_total,
  (['Độc thân','Đã kết hôn','',NULL])[CAST(k % 4 AS INTEGER) + 1] AS marital_status,
  'nv' || k || '@example.com' AS email,
  CASE WHEN k % 6 <> 0 THEN 'Quản lý ' || (k % 20) ELSE '' END AS live_manager_id,
  'NV' || (k // 10) AS live_manager_code
FROM (SELECT *, c_custkey AS k FROM customer)
"""

STAR["req"] = """
SELECT o_orderkey AS o, o_custkey AS c,
  CASE WHEN o_orderkey % 53 = 0 THEN '' WHEN o_orderkey % 37 = 0 THEN 'NX' || (o_custkey % 50)
       ELSE 'NV' || o_custkey END AS person,
  'Người ' || (o_custkey % 50) AS person_name,
  CASE o_orderstatus WHEN 'O' THEN 'Chờ duyệt' WHEN 'F' THEN 'Đã duyệt' ELSE 'Không duyệt' END
    AS any_status,
  CASE WHEN o_orderkey % 29 <> 0 THEN
    CASE o_orderstatus WHEN 'O' THEN 'Chờ duyệt' WHEN 'F' THEN 'Đã duyệt' ELSE 'Không duyệt' END
  END AS status,
  DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS created
FROM orders
"""

STAR["snaps"] = """
SELECT o, person, person_name, created, any_status, day, status,
  CASE day WHEN 30 THEN 'Bản cũ' WHEN 28 THEN 'Bản trước'
    ELSE CASE WHEN o % 4 <> 1 THEN 'Lý do ' || (o % 11) END END AS description_text
FROM (
  SELECT o, person, person_name, created, any_status, 29 AS day, status FROM req
  UNION ALL
  SELECT o, person, person_name, created, any_status, 30, 'Chờ duyệt' FROM req WHERE o % 4 = 0
  UNION ALL
  SELECT o, person, person_name, created, any_status, 28, status FROM req WHERE o % 8 = 3
)
"""

STAR["lst"] = """
SELECT o AS id, person, person_name, status, description_text,
  TIMESTAMP '2024-01-01' + to_days(day - 1) AS sync_time,
  (['Đơn công tác','Đơn xin thôi việc','Đơn tăng ca','Đơn xin nghỉ phép','Đơn vắng mặt',
    'Chấm công bù','Đổi ca',NULL,'Photocopy'])[CAST(o % 9 AS INTEGER) + 1] AS sub_object,
  'QL ' || (o % 20) AS approver,
  CASE WHEN o % 31 <> 0 THEN created END AS date_created,
  CASE WHEN o % 19 = 0 THEN '' ELSE lpad(CAST(o * 7 % 24 AS VARCHAR), 2, '0') || ':' ||
    lpad(CAST(o * 13 % 60 AS VARCHAR), 2, '0') END AS time_created,
  CASE WHEN any_status = 'Đã duyệt' THEN created + CAST(o % 4 AS INTEGER) END AS date_approve,
  CASE WHEN any_status = 'Đã duyệt' THEN lpad(CAST(o * 5 % 24 AS VARCHAR), 2, '0') || ':30' END
    AS time_approve,
  CASE WHEN o % 3 <> 0 THEN created + CAST(o % 5 AS INTEGER) END AS date_start,
  'D' || (o % 7) AS department_id,
  CASE WHEN o % 2 = 0 THEN '[Gấp] việc riêng' END AS reason,
  o % 3 AS num_file
FROM (
  SELECT *, row_number() OVER (PARTITION BY o
    ORDER BY (coalesce(status, 'Chờ duyệt') = 'Chờ duyệt') ASC, day DESC) AS rn
  FROM snaps WHERE person <> ''
) WHERE rn = 1
"""

STAR["versions"] = """
SELECT o, person, created, any_status, 29 AS day, o % 17 = 0 AS error,
  CASE WHEN o % 17 = 0 THEN NULL WHEN o % 6 = 0 THEN 'Đã duyệt' WHEN o % 6 <> 1 THEN status END
    AS status FROM req
UNION ALL
SELECT o, person, created, any_status, 30, FALSE, 'Chờ duyệt' FROM req WHERE o % 11 = 0
"""

STAR["docs"] = """
SELECT o AS id, person, status, created,
  CASE WHEN any_status <> 'Chờ duyệt' THEN created + 2 END AS date_approve,
  o % 5 AS kind_no,
  (o % 5 < 4) OR (o % 3 = 2) AS detailed
FROM (
  SELECT *, row_number() OVER (PARTITION BY o
    ORDER BY (coalesce(status, 'Chờ duyệt') = 'Chờ duyệt') ASC, day DESC) AS rn
  FROM versions WHERE NOT error
) WHERE rn = 1
"""

# Elements of a document and their inner rows; j is NULL for an empty inner array.
STAR["cells"] = """
SELECT d.*, i.i, j.j,
  strftime(DATE '2024-01-01' + CAST((d.id + i.i + j.j) % 30 AS INTEGER), '%Y-%m-%d') AS day
FROM docs d
CROSS JOIN LATERAL (SELECT unnest(range(0, CAST(d.id // 5 % 2 + 1 AS BIGINT))) AS i) i
CROSS JOIN LATERAL (SELECT unnest(CASE WHEN d.id // 10 % 4 = 0 THEN [NULL::BIGINT]
  ELSE range(0, CAST(d.id // 10 % 4 AS BIGINT)) END) AS j) j
WHERE d.kind_no < 4
"""

STAR["raw_ev"] = """
SELECT id, status, date_approve, i,
  (['overtime','inout','leave','absence'])[CAST(kind_no AS INTEGER) + 1] AS kind,
  CASE kind_no WHEN 0 THEN CASE WHEN j IS NOT NULL THEN person END ELSE person END AS person,
  CAST(day AS DATE) AS date_record,
  CASE WHEN j IS NULL THEN NULL
    WHEN kind_no = 0 THEN lpad(CAST((i + 17) % 24 AS VARCHAR), 2, '0') || ':' || mm || ':00'
    WHEN kind_no = 3 THEN lpad(CAST((i + 13) % 24 AS VARCHAR), 2, '0') || ':' || mm
    ELSE lpad(CAST((i + 8) % 24 AS VARCHAR), 2, '0') || ':' || mm || ':00' END AS start_time,
  CASE WHEN j IS NULL OR kind_no = 1 THEN NULL
    WHEN kind_no = 0 THEN lpad(CAST((i + 19) % 24 AS VARCHAR), 2, '0') || ':' || mm || ':00'
    WHEN kind_no = 3 THEN lpad(CAST((i + 15) % 24 AS VARCHAR), 2, '0') || ':' || mm
    ELSE lpad(CAST((i + 12) % 24 AS VARCHAR), 2, '0') || ':' || mm || ':00' END AS end_time,
  CASE WHEN kind_no = 0 THEN CAST(j + 1 AS DOUBLE) WHEN kind_no = 2 THEN days * 8
    WHEN kind_no = 3 THEN CAST(j + 2 AS DOUBLE) END AS hours_amount,
  CASE WHEN kind_no = 2 THEN days END AS days_amount,
  CASE WHEN kind_no = 2 THEN CASE WHEN i = 0 THEN 'Phép năm' ELSE ' ' END END AS leave_type,
  CASE WHEN kind_no = 0 THEN CASE id % 7 WHEN 0 THEN 'Ngày thường' WHEN 1 THEN 'Ngày nghỉ'
    WHEN 2 THEN 'Ngày lễ' WHEN 4 THEN '9' ELSE 'Chưa xác định' END END AS ot_type,
  CASE WHEN kind_no = 1 THEN CASE WHEN j = 1 THEN 'Quên' ELSE 'Công tác ngoài' END END
    AS inout_reason,
  CASE kind_no WHEN 0 THEN 'Tăng ca ' || i WHEN 1 THEN 'Bổ sung công' WHEN 3 THEN 'Việc riêng' END
    AS reason
FROM (
  SELECT *, lpad(CAST(id % 60 AS VARCHAR), 2, '0') AS mm,
    CASE WHEN j % 2 = 0 THEN 0.5::DOUBLE WHEN j IS NULL OR id % 4 = 2 THEN NULL ELSE 1.0 END AS days
  FROM cells
)
"""

STAR["ev"] = """
SELECT DISTINCT id, kind, person, date_record, start_time, end_time, hours_amount, days_amount,
  leave_type, ot_type, inout_reason, reason, status, date_approve
FROM raw_ev WHERE kind = 'overtime'
UNION ALL
SELECT id, kind, person, date_record, start_time, end_time, hours_amount, days_amount,
  leave_type, ot_type, inout_reason, reason, status, date_approve
FROM (
  SELECT *, row_number() OVER (PARTITION BY id, kind, date_record ORDER BY
    start_time ASC NULLS FIRST, end_time ASC NULLS FIRST, hours_amount ASC NULLS FIRST,
    days_amount ASC NULLS FIRST, leave_type ASC NULLS FIRST, inout_reason ASC NULLS FIRST,
    reason ASC NULLS FIRST, person ASC NULLS FIRST) AS rn
  FROM raw_ev WHERE kind <> 'overtime'
) WHERE rn = 1
"""

STAR["allev"] = """
SELECT id, person, date_record, start_time, end_time, hours_amount, days_amount, leave_type,
  ot_type, inout_reason, reason, CASE kind WHEN 'overtime' THEN 'Đơn làm thêm'
  WHEN 'inout' THEN 'Đơn checkin/out' WHEN 'leave' THEN 'Đơn nghỉ phép' ELSE 'Đơn vắng' END AS raw_type
FROM ev
UNION ALL
SELECT id, person, coalesce(date_start, date_created), time_created, NULL, NULL, NULL, NULL, NULL,
  NULL, coalesce(description_text, reason, 'Không có lý do'), coalesce(sub_object, 'Đơn khác')
FROM lst WHERE id NOT IN (SELECT id FROM docs WHERE detailed)
"""

STAR["mapp"] = """
SELECT e.id AS approval_id,
  CASE
    WHEN lower(raw_type) LIKE '%thôi việc%' OR lower(raw_type) LIKE '%nghỉ việc%' THEN 'Đơn thôi việc'
    WHEN lower(raw_type) LIKE '%công tác%' THEN 'Đơn công tác'
    WHEN lower(raw_type) LIKE '%làm thêm%' OR lower(raw_type) LIKE '%tăng ca%'
      OR lower(raw_type) LIKE '%ot%' THEN 'Đơn làm thêm'
    WHEN lower(raw_type) LIKE '%checkin%' OR lower(raw_type) LIKE '%inout%'
      OR lower(raw_type) LIKE '%chấm công%' THEN 'Đơn checkin/out'
    WHEN lower(raw_type) LIKE '%vắng%' THEN 'Đơn vắng mặt'
    WHEN lower(raw_type) LIKE '%nghỉ%' OR lower(raw_type) LIKE '%phép%' THEN 'Đơn xin nghỉ'
    ELSE 'Đơn khác' END AS approval_type,
  CASE WHEN d.status <> 'Chờ duyệt' THEN d.status
    ELSE coalesce(l.status, d.status, 'Không xác định') END AS approval_status,
  coalesce(l.date_created, e.date_record) AS date_created,
  l.time_created,
  coalesce(l.date_approve, d.date_approve) AS date_approved,
  l.time_approve AS time_approved,
  l.approver AS approver_name,
  e.person AS personnel_code,
  coalesce(p.name, l.person_name) AS name,
  coalesce(p.department_full, l.department_id) AS department_full,
  CASE WHEN lower(p.department_full) LIKE '%_ch%' OR lower(p.department_full) LIKE '%cửa hàng%'
    THEN 'Khối Cửa hàng' ELSE 'Khối Văn phòng' END AS department_group,
  p.position_title, p.work_place, e.date_record, e.start_time, e.end_time,
  e.hours_amount, e.days_amount,
  coalesce(nullif(trim(e.leave_type), ''), 'Chưa xác định') AS leave_type,
  coalesce(nullif(trim(e.ot_type), ''), 'Chưa xác định') AS ot_type,
  coalesce(nullif(trim(e.inout_reason), ''), 'Chưa xác định') AS inout_reason,
  coalesce(nullif(trim(e.reason), ''), 'Không có lý do') AS reason
FROM allev e LEFT JOIN lst l ON e.id = l.id LEFT JOIN docs d ON e.id = d.id
LEFT JOIN people p ON e.person = p.code
WHERE e.person IS NOT NULL
"""

STAR["tk"] = """
SELECT user_id AS u, d,
  CASE WHEN user_id % 60 = 59 THEN 'TK' || user_id ELSE 'NV' || user_id END AS person,
  CASE WHEN user_id % 50 = 7 AND day(d) = 10 THEN d - 1 ELSE d END AS record_date,
  CASE WHEN n % 3 <> 0 THEN first_ts END AS checkin,
  CASE WHEN n % 3 <> 0 THEN last_ts END AS checkout,
  CASE WHEN n % 6 = 3 THEN 'Có' ELSE 'Không' END AS is_check_log,
  errors AS late_minute,
  CASE WHEN n <> 5 THEN n * 2 END AS soon_minute,
  n * 0.5::DOUBLE AS cal_workhour,
  CAST(n AS DOUBLE) AS total_cal_workhour,
  day(d) = 1 AS is_holiday
FROM (
  SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n,
    count(*) FILTER (WHERE event_type = 'error') AS errors,
    strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts,
    strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts
  FROM events GROUP BY user_id, CAST(ts AS DATE)
)
"""

STAR["extra"] = """
SELECT person AS code, max(person_name) AS name FROM lst
WHERE NOT EXISTS (SELECT 1 FROM people p WHERE p.code = lst.person) GROUP BY person
UNION ALL
SELECT DISTINCT person, 'Chưa xác định' FROM tk
WHERE NOT EXISTS (SELECT 1 FROM people p WHERE p.code = tk.person)
  AND NOT EXISTS (SELECT 1 FROM lst WHERE lst.person = tk.person)
"""

STAR["mprof"] = f"""
SELECT id AS profile_id, code AS personnel_code, name,
  coalesce(nullif(trim(gender), ''), 'Chưa cập nhật') AS gender,
  coalesce(nullif(trim(department_full), ''), 'Chưa phân bổ') AS department,
  CASE
    WHEN lower(department_full) LIKE '%kho tổng cửa hàng%' THEN 'Khối Kho'
    WHEN lower(department_full) LIKE '%kinh doanh cửa hàng%' THEN 'Khối Văn phòng'
    WHEN lower(department_full) LIKE '%!_ch%' ESCAPE '!' OR lower(department_full) LIKE '%cửa hàng%'
      THEN 'Khối Cửa hàng'
    WHEN lower(department_full) LIKE '%kế hoạch sản xuất%'
      OR lower(department_full) LIKE '%kho nguyên phụ liệu%'
      OR lower(department_full) LIKE '%kho npl%' OR lower(department_full) LIKE '%mua hàng%'
      OR lower(department_full) LIKE '%cung ứng%' OR lower(department_full) LIKE '%xưởng%'
      THEN 'Khối Sản xuất'
    WHEN lower(department_full) LIKE '%kho%' THEN 'Khối Kho'
    WHEN lower(department_full) LIKE '%văn phòng%' THEN 'Khối Văn phòng'
    WHEN department_full IS NULL OR trim(department_full) = '' THEN 'Chưa phân bổ'
    ELSE 'Khối Văn phòng' END AS department_group,
  department_id,
  coalesce(nullif(trim(position_title), ''), 'Chưa cập nhật') AS position_title,
  coalesce(nullif(trim(job_title_name), ''), 'Chưa cập nhật') AS job_title,
  coalesce(nullif(trim(job_status), ''), 'Chưa cập nhật') AS job_status,
  coalesce(nullif(trim(work_place), ''), 'Chưa cập nhật') AS work_place,
  job_status IN ('Đang làm việc', 'Thử việc', 'Thực tập') AS is_active,
  birthday, job_date_join,
  CASE WHEN job_date_out < job_date_join THEN NULL ELSE job_date_out END AS job_date_out,
  age,
  CASE WHEN age IS NULL THEN 'Chưa xác định' WHEN age < 18 THEN 'Lỗi dữ liệu'
    WHEN age < 25 THEN '< 25 tuổi' WHEN age <= 30 THEN '25 - 30 tuổi'
    WHEN age <= 40 THEN '31 - 40 tuổi' ELSE '> 40 tuổi' END AS age_group,
  months AS tenure_months,
  CASE WHEN months IS NULL THEN 'Chưa xác định' WHEN months < 6 THEN '< 6 tháng'
    WHEN months <= 12 THEN '6 - 12 tháng' WHEN months <= 36 THEN '1 - 3 năm'
    ELSE '> 3 năm' END AS tenure_group,
  salary_real, salary_total, has_insurance, has_degree, level_name AS highest_degree_level,
  specialization AS highest_degree_specialization,
  coalesce(nullif(trim(marital_status), ''), 'Chưa cập nhật') AS marital_status,
  NULL::VARCHAR AS mobile, email, sync_time, NULL::VARCHAR AS region
FROM (
  SELECT *, date_diff('year', birthday, {AS_OF}) AS age,
    date_diff('month', job_date_join, coalesce(job_date_out, {AS_OF})) AS months
  FROM (
    SELECT id, code, name, gender, department_full, department_id, position_title, job_title_name,
      job_status, work_place, birthday, job_date_join, job_date_out, salary_real,
      coalesce(salary_total, 0) AS salary_total,
      id % 4 IN (2, 3) AS has_insurance, id % 5 IN (2, 3, 4) AS has_degree,
      CASE id % 5 WHEN 2 THEN 'Đại học' WHEN 3 THEN 'Cao đẳng' ELSE 'Không có' END AS level_name,
      CASE id % 5 WHEN 2 THEN 'Kế toán' ELSE 'Không có' END AS specialization,
      marital_status, email, '2024-01-29 00:00:00' AS sync_time
    FROM people
    UNION ALL
    SELECT -1, code, coalesce(nullif(trim(name), ''), 'Chưa xác định'), NULL, 'Chưa phân bổ', NULL,
      'Chưa cập nhật', 'Chưa cập nhật', 'Chưa cập nhật', NULL, NULL, NULL, NULL, 0, 0,
      FALSE, FALSE, 'Không có', 'Không có', NULL, NULL, '2024-01-30 00:00:00'
    FROM extra
  )
)
"""

STAR["office"] = """
SELECT * FROM mprof WHERE department_group IN ('Khối Văn phòng', 'Khối Kho', 'Khối Sản xuất')
"""

STAR["timing"] = f"""
SELECT *,
  gap BETWEEN 0 AND 60 AS flag_xin_nghi_sat_gio,
  gap < 0 AS flag_tao_don_hoi_to,
  approved_datetime IS NOT NULL AND approved_datetime > leave_start_datetime AS flag_duyet_hoi_to,
  approval_status = 'Chờ duyệt' AND {AS_OF} - date_created > 3 AS flag_don_ton_cho_duyet_qua_han
FROM (
  SELECT *,
    date_diff('minute', created_datetime, leave_start_datetime) AS gap,
    date_diff('minute', leave_start_datetime, approved_datetime) AS gap_approved
  FROM (
    SELECT *,
      try_strptime(CAST(date_created AS VARCHAR) || ' ' || tc, '%Y-%m-%d %H:%M') AS created_datetime,
      try_strptime(CAST(date_approved AS VARCHAR) || ' ' || ta, '%Y-%m-%d %H:%M') AS approved_datetime,
      try_strptime(CAST(date_record AS VARCHAR) || ' ' || st, '%Y-%m-%d %H:%M') AS leave_start_datetime
    FROM (
      SELECT a.*, left(coalesce(nullif(a.time_created, ''), '00:00'), 5) AS tc,
        left(coalesce(nullif(a.time_approved, ''), '00:00'), 5) AS ta,
        left(coalesce(nullif(a.start_time, ''), '00:00'), 5) AS st
      FROM mapp a JOIN office o ON a.personnel_code = o.personnel_code
      WHERE a.approval_type IN ('Đơn xin nghỉ', 'Đơn vắng mặt')
        AND a.date_created IS NOT NULL AND a.date_record IS NOT NULL
    )
  )
)
"""

STAR["spine"] = f"""
SELECT personnel_code, department_group, CAST(s AS DATE) AS day,
  dayofweek(s) <> 0 AND (dayofweek(s) <> 6 OR department_group IN ('Khối Kho', 'Khối Sản xuất')
    OR (CAST(date_trunc('week', s) AS DATE) - DATE '2026-08-31') // 7 % 2 = 0) AS is_workweek_day
FROM (
  SELECT o.personnel_code, o.department_group, unnest(generate_series(
    CAST(greatest(o.job_date_join, {AS_OF} - 60) AS TIMESTAMP),
    CAST(least(coalesce(o.job_date_out, {AS_OF}), {AS_OF}) AS TIMESTAMP), INTERVAL 1 DAY)) AS s
  FROM office o LEFT JOIN people p ON o.personnel_code = p.code
  WHERE o.is_active AND o.personnel_code IS NOT NULL AND o.job_date_join IS NOT NULL
)
"""

STAR["leave_day"] = """
SELECT personnel_code, date_record, sum(coalesce(hours_amount, 0)) AS total_leave_hours,
  array_to_string(list_sort(list(DISTINCT CAST(approval_id AS VARCHAR))), ',') AS leave_approval_ids
FROM mapp
WHERE approval_type IN ('Đơn xin nghỉ', 'Đơn vắng mặt') AND date_record IS NOT NULL
GROUP BY personnel_code, date_record
"""

STAR["leave_best"] = """
SELECT personnel_code, date_record, approval_status, approval_type, reason FROM (
  SELECT *, row_number() OVER (PARTITION BY personnel_code, date_record ORDER BY
    CASE approval_status WHEN 'Đã duyệt' THEN 1 WHEN 'Chờ duyệt' THEN 2 WHEN 'Không duyệt' THEN 3
      ELSE 4 END, approval_id, approval_type, reason) AS rn
  FROM mapp
  WHERE approval_type IN ('Đơn xin nghỉ', 'Đơn vắng mặt') AND date_record IS NOT NULL
) WHERE rn = 1
"""

STAR["sched"] = f"""
SELECT *, CASE
    WHEN exception_type IN ('Vắng không phép', 'Nghỉ sai quy định', 'Nghỉ khi chưa được duyệt') THEN 'Cao'
    WHEN exception_type IN ('Nghỉ vượt đơn', 'Có đơn nghỉ cả ngày (đã duyệt) nhưng vẫn chấm công đi làm',
      'Cần kiểm tra (đơn chưa hợp lệ nhưng vẫn chấm công)',
      'Cần kiểm tra (chấm công ngày nghỉ không có đơn OT)') THEN 'Trung bình'
    WHEN exception_type LIKE 'Bình thường%' THEN NULL ELSE 'Thấp' END AS severity_level
FROM (
  SELECT *, CASE
    WHEN is_scheduled_workday AND leave_status = 'Đã duyệt' THEN
      CASE WHEN is_half_day_leave AND has_checkin THEN 'Bình thường (nghỉ nửa ngày hợp lệ)'
           WHEN is_half_day_leave THEN 'Nghỉ vượt đơn'
           WHEN has_checkin THEN 'Có đơn nghỉ cả ngày (đã duyệt) nhưng vẫn chấm công đi làm'
           ELSE 'Bình thường (nghỉ có phép)' END
    WHEN is_scheduled_workday AND leave_status IS NOT NULL AND has_checkin
      THEN 'Cần kiểm tra (đơn chưa hợp lệ nhưng vẫn chấm công)'
    WHEN is_scheduled_workday AND leave_status = 'Chờ duyệt' THEN
      CASE WHEN schedule_date >= {AS_OF} THEN 'Đơn đang chờ duyệt (trong ngày)'
           ELSE 'Nghỉ khi chưa được duyệt' END
    WHEN is_scheduled_workday AND leave_status IS NOT NULL THEN 'Nghỉ sai quy định'
    WHEN is_scheduled_workday THEN CASE WHEN has_checkin THEN 'Bình thường' ELSE 'Vắng không phép' END
    WHEN has_checkin AND has_approved_ot THEN 'Bình thường (OT ngày nghỉ)'
    WHEN has_checkin THEN 'Cần kiểm tra (chấm công ngày nghỉ không có đơn OT)'
    ELSE 'Bình thường' END AS exception_type
  FROM (
    SELECT s.personnel_code, s.day AS schedule_date, s.is_workweek_day,
      h.d IS NOT NULL AS is_company_holiday,
      s.is_workweek_day AND h.d IS NULL AS is_scheduled_workday,
      coalesce(t.checkin IS NOT NULL OR t.is_check_log = 'Có', FALSE) AS has_checkin,
      t.checkin, t.checkout, CASE WHEN t.person IS NOT NULL THEN 'HC' END AS shift_code,
      t.cal_workhour, t.late_minute, t.soon_minute,
      b.approval_status AS leave_status, b.approval_type AS leave_approval_type,
      b.reason AS leave_reason, v.total_leave_hours,
      coalesce(v.total_leave_hours > 0 AND v.total_leave_hours < 8, FALSE) AS is_half_day_leave,
      v.leave_approval_ids,
      EXISTS (SELECT 1 FROM mapp a WHERE a.approval_type = 'Đơn làm thêm'
        AND a.approval_status = 'Đã duyệt' AND a.personnel_code = s.personnel_code
        AND a.date_record = s.day) AS has_approved_ot,
      r.rate AS personnel_checkin_rate_overall,
      coalesce(r.rate, 0) < 0.2 AS is_low_checkin_reliability
    FROM spine s
    LEFT JOIN (SELECT DISTINCT record_date AS d FROM tk WHERE is_holiday) h ON s.day = h.d
    LEFT JOIN tk t ON s.personnel_code = t.person AND s.day = t.record_date
    LEFT JOIN leave_day v ON s.personnel_code = v.personnel_code AND s.day = v.date_record
    LEFT JOIN leave_best b ON s.personnel_code = b.personnel_code AND s.day = b.date_record
    LEFT JOIN (SELECT person, count(checkin) / count(*)::DOUBLE AS rate FROM tk GROUP BY person) r
      ON s.personnel_code = r.person
  )
)
"""

STAR["track"] = """
SELECT case_id, personnel_code, case_date, exception_type_note, processing_status, handled_by, note
FROM (
  SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY case_date DESC NULLS LAST,
    personnel_code NULLS FIRST, exception_type_note NULLS FIRST, processing_status NULLS FIRST,
    handled_by NULLS FIRST, note NULLS FIRST) AS rn
  FROM (
    SELECT 'NV' || k || '_' || strftime(day, '%Y%m%d') AS case_id, 'NV' || k AS personnel_code,
      CASE WHEN k % 16 <> 0 THEN day END AS case_date, 'Loại ' || i AS exception_type_note,
      CASE WHEN k % 4 = 0 THEN 'Chưa xử lý' ELSE 'Đã xử lý' END AS processing_status,
      'HR ' || (k % 5) AS handled_by, CASE WHEN i = 0 THEN 'ghi chú' END AS note
    FROM (
      SELECT c_custkey AS k, DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS day,
        unnest(range(0, CASE WHEN c_custkey % 6 = 0 THEN 2 ELSE 1 END)) AS i
      FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 14 <> 0
    )
  )
) WHERE rn = 1
"""

STAR["exc"] = """
SELECT s.schedule_date AS exception_date, s.personnel_code, p.name, p.department, p.position_title,
  p.manager_name, p.manager_code,
  CASE WHEN s.is_scheduled_workday THEN 'Ngày làm' ELSE 'Ngày nghỉ (cuối tuần/lễ)' END
    AS scheduled_day_label,
  t.approval_id, t.approval_type AS leave_approval_type, t.approval_status AS leave_approval_status,
  t.reason AS leave_reason, t.time_created, t.time_approved,
  t.gap AS minutes_created_to_leave_start, t.gap_approved AS minutes_leave_start_to_approved,
  t.flag_xin_nghi_sat_gio, t.flag_tao_don_hoi_to, t.flag_duyet_hoi_to,
  t.flag_don_ton_cho_duyet_qua_han,
  s.has_checkin, s.checkin, s.checkout, s.shift_code, s.cal_workhour, s.late_minute,
  s.exception_type, s.severity_level, s.severity_level IS NOT NULL AS is_exception,
  s.personnel_checkin_rate_overall, s.is_low_checkin_reliability,
  s.personnel_code || '_' || strftime(s.schedule_date, '%Y%m%d') AS case_id,
  coalesce(k.processing_status, CASE WHEN s.severity_level IS NOT NULL THEN 'Chưa xử lý' END)
    AS processing_status,
  k.handled_by, k.note AS processing_note
FROM sched s
LEFT JOIN (
  SELECT m.personnel_code, m.name, m.department, m.position_title,
    coalesce(nullif(trim(q.live_manager_id), ''), 'Phụ trách ' || m.department) AS manager_name,
    q.live_manager_code AS manager_code
  FROM mprof m LEFT JOIN people q ON m.personnel_code = q.code
) p ON s.personnel_code = p.personnel_code
LEFT JOIN timing t ON s.personnel_code = t.personnel_code AND s.schedule_date = t.date_record
LEFT JOIN track k ON s.personnel_code || '_' || strftime(s.schedule_date, '%Y%m%d') = k.case_id
"""

STAR["heads"] = """
SELECT department, count(DISTINCT personnel_code) AS headcount FROM office WHERE is_active
GROUP BY department
"""

STAR["flat_first"] = """
SELECT id AS approval_id, kind AS detail_type, date_record, start_time, end_time,
  hours_amount AS hours_number, NULL::VARCHAR AS detail_status
FROM raw_ev WHERE i = 0
"""

STATUS_OF_EVENT = """CASE WHEN event_type IN ('view', 'click') THEN 'Chờ duyệt'
  WHEN event_type = 'purchase' THEN 'Đã duyệt' WHEN event_type = 'error' THEN 'Không duyệt' END"""

# Both landed shapes of a request, for the worklists.
STAR["listed"] = """
SELECT o AS id, status, CASE WHEN o % 31 <> 0 THEN created END AS created FROM snaps
"""
STAR["documented"] = """
SELECT o AS id, status, CASE WHEN NOT error THEN created END AS created, error FROM versions
"""
STAR["stale"] = """
SELECT id FROM (
  SELECT id, bool_or(status <> 'Chờ duyệt') AS moved, min(created) AS created
  FROM listed GROUP BY id
) WHERE NOT coalesce(moved, FALSE) AND created < DATE '2024-01-23'
  AND id NOT IN (SELECT id FROM documented WHERE error OR coalesce(status <> 'Chờ duyệt', FALSE))
"""
STAR["in_window"] = f"""
SELECT DISTINCT id FROM listed WHERE created BETWEEN DATE '2024-01-23' AND {AS_OF}
"""


def _needed(sql: str) -> list[str]:
    """Names of the CTEs a statement uses, in an order that resolves."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in STAR:
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text) and name not in found:
                visit(STAR[name])
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def with_star(sql: str) -> str:
    names = _needed(sql)
    if not names:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({STAR[n].strip()})" for n in names)
    return f"WITH {ctes}\n{sql.strip()}"


SQL: dict[str, str] = {}

SQL["envelope_unnest"] = """
SELECT strftime(TIMESTAMP '2024-01-01' + to_days(day - 1), '%Y-%m-%d %H:%M:%S') AS "SYNC_TIME",
  o AS "ID", person AS personnel_code, status AS app_approval_status, description_text,
  o % 3 AS num_file
FROM snaps
"""

SQL["landed_loads"] = """
WITH e AS (SELECT *, event_id // 20 AS e, (event_id // 20) % 12 AS k FROM events),
env AS (SELECT DISTINCT e, k FROM e)
SELECT event_type AS what, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum, count(*) FILTER (k = 8) AS stamped
FROM e WHERE k NOT IN (3, 4, 5, 6, 7, 9) GROUP BY event_type
UNION ALL
SELECT CASE k WHEN 4 THEN 'envelope is not whole JSON' WHEN 5 THEN 'envelope is not whole JSON'
  WHEN 6 THEN 'envelope without a data array' WHEN 7 THEN 'no RAW_DATA' ELSE 'line is not JSON' END,
  count(*), NULL, NULL FROM env WHERE k IN (4, 5, 6, 7, 9) GROUP BY 1
UNION ALL
SELECT 'ledger', count(*) FILTER (k NOT IN (4, 5, 6, 7, 9)), count(*) FILTER (k IN (4, 5, 6, 7, 9)), 2 FROM env
"""

SQL["envelope_pack"] = """
SELECT event_type, count(*) AS records, CAST(sum(event_id) AS BIGINT) AS id_sum,
  max(value) AS max_value, TRUE AS within_size
FROM events GROUP BY event_type
"""

SQL["typed_projection"] = """
SELECT event_id, value AS amount,
  CASE WHEN event_id % 3 <> 0 THEN event_id % 2 END AS safe_mark,
  CASE WHEN event_id % 3 <> 0 THEN event_id % 2 = 1 END AS flag,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS "at",
  strftime(ts, '%Y-%m-%d') AS day,
  props AS props_text, NULL::VARCHAR AS nested_text
FROM events
"""

SQL["load_stamp_default"] = f"""
SELECT CAST(load_day AS VARCHAR) AS load_day, count(*) AS landed FROM (
  SELECT CASE WHEN event_id % 4 <> 0 THEN CAST(ts AS DATE) ELSE {AS_OF} END AS load_day FROM events
) GROUP BY load_day
"""

SQL["two_level_flatten"] = """
SELECT id AS "ID", kind, person AS event_person, CAST(date_record AS VARCHAR) AS date_record,
  start_time, end_time, hours_amount, days_amount, leave_type, ot_type, inout_reason, reason
FROM ev
"""

SQL["latest_by_key"] = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events
) WHERE rn = 1
"""

SQL["latest_nulls_last"] = """
SELECT o_custkey, o_orderkey, CAST(signed AS VARCHAR) AS signed FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY signed DESC NULLS LAST, o_orderkey) AS rn
  FROM (SELECT *, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS signed FROM orders)
) WHERE rn = 1
"""

SQL["forward_status_latest"] = """
SELECT strftime(sync_time, '%Y-%m-%d %H:%M:%S') AS sync_time, id AS "ID", person AS personnel_code,
  status AS app_approval_status, description_text, reason,
  CAST(date_created AS VARCHAR) AS date_created
FROM lst
"""

SQL["dedupe_input_order"] = f"""
SELECT user_id, event_id, status FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY (coalesce(status, '') = 'Chờ duyệt') ASC, event_id) AS rn
  FROM (SELECT *, {STATUS_OF_EVENT} AS status FROM events)
) WHERE rn = 1
"""

SQL["calendar_dim"] = """
SELECT CAST(d AS VARCHAR) AS date, count(*) AS events,
  year(d) AS year, month(d) AS month, day(d) AS day, quarter(d) AS quarter,
  isodow(d) AS day_of_week, strftime(d, '%Y-%m') AS year_month,
  'Tháng ' || month(d) AS month_name,
  CASE WHEN isodow(d) = 7 THEN 'Chủ nhật' ELSE 'Thứ ' || (isodow(d) + 1) END AS day_name,
  isodow(d) < 6 AS is_weekday
FROM (SELECT CAST(ts AS DATE) AS d FROM events
  UNION ALL SELECT CAST(o_orderdate + INTERVAL 28 YEAR AS DATE) FROM orders)
WHERE d BETWEEN DATE '2020-01-01' AND DATE '2030-12-31' GROUP BY d
"""

SQL["date_spine"] = f"""
SELECT department_id, CAST(CAST(s AS DATE) AS VARCHAR) AS day, count(*) AS people,
  count(*) FILTER (WHERE (CAST(date_trunc('week', s) AS DATE) - DATE '2026-08-31') // 7 % 2 = 0)
    AS six_day_people
FROM (
  SELECT department_id, unnest(generate_series(
    CAST(greatest(job_date_join, DATE '2020-01-01') AS TIMESTAMP),
    CAST(coalesce(job_date_out, {AS_OF}) AS TIMESTAMP), INTERVAL 1 DAY)) AS s
  FROM people WHERE job_date_join IS NOT NULL
) GROUP BY department_id, s
"""


def _headcount(source: str, group: str) -> str:
    return f"""
SELECT CAST(m.m AS VARCHAR) AS snapshot_month, {group}, count(p.code) AS total_employees,
  CAST(sum(CASE WHEN p.left_on IS NULL OR date_trunc('month', p.left_on) > m.m THEN 1 ELSE 0 END)
    AS BIGINT) AS active_employees
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2020-01-01', TIMESTAMP '2024-01-01',
  INTERVAL 1 MONTH)) AS DATE) AS m) m
JOIN ({source}) p ON date_trunc('month', p.joined) <= m.m
GROUP BY m.m, {group}
"""


SQL["month_headcount"] = _headcount(
    """SELECT c_mktsegment AS segment, CASE WHEN c_custkey % 17 <> 0 THEN c_custkey END AS code,
    DATE '2018-06-01' + CAST(c_custkey * 31 % 2000 AS INTEGER) AS joined,
    CASE WHEN c_custkey % 3 = 0 THEN DATE '2018-06-01'
      + CAST(c_custkey * 31 % 2000 + c_custkey % 400 - 20 AS INTEGER) END AS left_on
    FROM customer""",
    "segment",
)

SQL["mart_headcount_snapshot"] = _headcount(
    """SELECT department_num_id AS department_id, department_full, position_title, code,
    job_date_join AS joined, job_date_out AS left_on FROM people WHERE job_date_join IS NOT NULL""",
    "department_id, department_full, position_title",
)

SQL["json_not_in_other"] = """
SELECT id AS "ID", coalesce(sub_object, 'Đơn khác') AS approval_type FROM lst
WHERE id NOT IN (SELECT id FROM docs WHERE detailed)
"""

SQL["distinct_branch_union"] = """
SELECT DISTINCT user_id, event_type FROM events WHERE event_type IN ('click', 'error')
UNION ALL
SELECT DISTINCT user_id, event_type FROM events WHERE event_type IN ('view', 'error')
UNION ALL
SELECT DISTINCT user_id, event_type FROM events WHERE event_type = 'signup'
"""

SQL["union_distinct_ids"] = """
SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F'
UNION SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'
UNION SELECT l_orderkey FROM lineitem WHERE l_quantity > 45
"""

SQL["anti_missing_people"] = "SELECT code, name FROM extra"

SQL["left_flag_membership"] = """
SELECT o_orderstatus, by_debtor, count(*) AS orders FROM (
  SELECT o_orderstatus,
    o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AS by_debtor
  FROM orders
) GROUP BY o_orderstatus, by_debtor
"""

SQL["cross_headcount"] = """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(DISTINCT user_id) AS users,
  count(*) AS events, any_value(h.n) AS headcount,
  count(DISTINCT user_id) / CAST(any_value(h.n) AS DOUBLE) AS share
FROM events CROSS JOIN (SELECT count(DISTINCT c_custkey) AS n FROM customer WHERE c_acctbal >= 0) h
GROUP BY CAST(ts AS DATE)
"""

SQL["first_by_rank"] = """
SELECT o_custkey, o_orderstatus, reason, o_orderkey, key_sum FROM (
  SELECT *, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS reason,
    CAST(sum(o_orderkey) OVER (PARTITION BY o_custkey) AS BIGINT) AS key_sum,
    row_number() OVER (PARTITION BY o_custkey ORDER BY
      CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_orderkey) AS rn
  FROM orders
) WHERE rn = 1
"""

SQL["string_agg_distinct"] = """
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
  string_agg(DISTINCT event_type, ',' ORDER BY event_type) FILTER (WHERE event_type <> 'view') AS kinds
FROM events GROUP BY user_id, CAST(ts AS DATE)
"""

SQL["safe_ratio_rank"] = """
SELECT CAST(period AS VARCHAR) AS period, c_nationkey, heads, good / CAST(good + bad AS DOUBLE) AS good_share,
  rate, rank() OVER (PARTITION BY period ORDER BY rate ASC NULLS FIRST) AS place
FROM (
  SELECT *, bad * 100 / CAST(heads AS DOUBLE) AS rate FROM (
    SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS period, c.c_nationkey,
      count(*) FILTER (WHERE o_orderstatus = 'P') AS bad,
      count(*) FILTER (WHERE o_orderstatus <> 'P') AS good
    FROM orders JOIN customer c ON o_custkey = c.c_custkey GROUP BY 1, 2
  ) LEFT JOIN (
    SELECT c_nationkey, count(*) AS heads FROM customer
    WHERE c_acctbal < 0 AND c_nationkey % 5 <> 0 GROUP BY c_nationkey
  ) USING (c_nationkey)
)
"""

SQL["minute_gaps_flags"] = """
SELECT o_orderkey, strftime(created, '%Y-%m-%d %H:%M:%S') AS created_at, gap,
  gap BETWEEN 0 AND 60 AS late_notice, gap < 0 AS after_the_fact,
  created IS NOT NULL AND created > start AS created_after_start
FROM (
  SELECT *, date_diff('minute', created, start) AS gap FROM (
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 8 HOUR AS start,
      CASE WHEN o_orderkey % 11 = 0 THEN
          CAST(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 2 AS INTEGER) AS TIMESTAMP)
        WHEN o_orderkey % 13 = 0 THEN NULL
        ELSE CAST(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 2 AS INTEGER) AS TIMESTAMP)
          + to_minutes(CAST(o_orderkey % 24 * 60 + o_orderkey * 7 % 60 AS INTEGER)) END AS created
    FROM orders
  )
)
"""

SQL["blank_defaults_bands"] = f"""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE 'Chưa cập nhật' END AS name, age,
  CASE WHEN age IS NULL THEN 'Chưa xác định' WHEN age < 18 THEN 'Lỗi dữ liệu'
    WHEN age < 25 THEN '< 25 tuổi' WHEN age BETWEEN 25 AND 30 THEN '25 - 30 tuổi'
    WHEN age BETWEEN 31 AND 40 THEN '31 - 40 tuổi' ELSE '> 40 tuổi' END AS age_group,
  months AS tenure_months,
  CASE WHEN months IS NULL THEN 'Chưa xác định' WHEN months < 6 THEN '< 6 tháng'
    WHEN months <= 12 THEN '6 - 12 tháng' WHEN months <= 36 THEN '1 - 3 năm'
    ELSE '> 3 năm' END AS tenure_group,
  (CAST(date_trunc('week', {AS_OF}) AS DATE) - CAST(date_trunc('week', joined) AS DATE)) // 7 AS weeks
FROM (
  SELECT *, date_diff('year', born, {AS_OF}) AS age, date_diff('month', joined, {AS_OF}) AS months
  FROM (
    SELECT c_custkey, c_mktsegment,
      CASE WHEN c_custkey % 40 <> 3 THEN DATE '1960-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) END
        AS born,
      CASE WHEN c_custkey % 23 <> 0 THEN DATE '2019-01-01' + CAST(c_custkey * 37 % 1800 AS INTEGER) END
        AS joined
    FROM customer
  )
)
"""

SQL["like_rules"] = """
SELECT doc_id,
  CASE WHEN t LIKE '%kho tổng cửa hàng%' THEN 'Khối Kho'
    WHEN t LIKE '%kinh doanh cửa hàng%' THEN 'Khối Văn phòng'
    WHEN t LIKE '%!_ch%' ESCAPE '!' OR t LIKE '%cửa hàng%' THEN 'Khối Cửa hàng'
    WHEN t LIKE '%kế hoạch sản xuất%' OR t LIKE '%kho nguyên phụ liệu%' OR t LIKE '%kho npl%'
      OR t LIKE '%mua hàng%' OR t LIKE '%cung ứng%' OR t LIKE '%xưởng%' THEN 'Khối Sản xuất'
    WHEN t LIKE '%kho%' THEN 'Khối Kho'
    WHEN trim(t) = '' THEN 'Chưa phân bổ' ELSE 'Khối Văn phòng' END AS block,
  CASE WHEN t LIKE '%_ch%' OR t LIKE '%cửa hàng%' THEN 'Khối Cửa hàng' ELSE 'Khối Văn phòng' END
    AS request_block,
  CASE WHEN t LIKE '%thôi việc%' OR t LIKE '%nghỉ việc%' THEN 'Đơn thôi việc'
    WHEN t LIKE '%công tác%' THEN 'Đơn công tác'
    WHEN t LIKE '%làm thêm%' OR t LIKE '%tăng ca%' OR t LIKE '%ot%' THEN 'Đơn làm thêm'
    WHEN t LIKE '%checkin%' OR t LIKE '%inout%' OR t LIKE '%chấm công%' THEN 'Đơn checkin/out'
    WHEN t LIKE '%vắng%' THEN 'Đơn vắng mặt'
    WHEN t LIKE '%nghỉ%' OR t LIKE '%phép%' THEN 'Đơn xin nghỉ' ELSE 'Đơn khác' END AS request_type
FROM (SELECT doc_id, lower(concat_ws(' ', source, lang, text)) AS t FROM documents)
"""

SQL["safe_dates"] = """
SELECT c_custkey,
  CASE WHEN s IN (0, 1) THEN d END AS dmy,
  CASE WHEN s IN (3, 4) THEN d END AS ymd,
  CASE WHEN s IN (0, 1, 2) THEN d END AS loader,
  CASE WHEN s IN (3, 4) THEN d END AS cast_date,
  CASE WHEN s = 7 THEN CAST(2024 AS BIGINT) END AS number
FROM (SELECT c_custkey, c_custkey % 8 AS s,
  CAST(DATE '2024-01-01' + CAST(c_custkey % 366 AS INTEGER) AS VARCHAR) AS d FROM customer)
"""

SQL["redact_text"] = r"""
SELECT doc_id, replace(regexp_replace(
  text || ' https://api/x?access_token=AB' || doc_id || '&Secret=z' || doc_id ||
    '''; token= none; key supersecret-' || source,
  '((?:access_token|secret|token)=)[^&\s''"]+', '\1***', 'gi'), 'supersecret', '***') AS line
FROM documents
"""

SQL["scrape_text"] = r"""
SELECT page_id,
  regexp_extract(log, '(?m)^Done\. PASS=\d+ WARN=\d+ ERROR=\d+ SKIP=\d+.*TOTAL=\d+') AS summary,
  array_to_string(regexp_extract_all(log, '(?m)^Failure in test \S+.*$'), chr(10)) AS failures
FROM (
  SELECT page_id, html
    || CASE WHEN page_id % 3 <> 0
         THEN chr(10) || 'Failure in test unique_' || page_id || ' (models/marts.yml)' ELSE '' END
    || CASE WHEN page_id % 2 = 0
         THEN chr(10) || 'Failure in test not_null_' || page_id || ' (models/marts.yml)' ELSE '' END
    || CASE WHEN page_id % 5 <> 0
         THEN chr(10) || 'Done. PASS=' || page_id || ' WARN=0 ERROR=1 SKIP=0 NO-OP=0 TOTAL=' || (page_id + 1)
         ELSE chr(10) || 'not Done. PASS=1 WARN=0 ERROR=0 SKIP=0 TOTAL=1' END
    || chr(10) || 'end' AS log
  FROM pages
)
"""

SQL["full_replace"] = "SELECT event_type, count(*) AS landed FROM events GROUP BY event_type"

SQL["window_replace"] = """
SELECT CAST(d AS VARCHAR) AS "SYNC_DATE", CASE WHEN d < DATE '2024-01-20' THEN 'old' ELSE 'new' END AS load,
  count(*) AS landed
FROM (SELECT CAST(ts AS DATE) AS d FROM events) WHERE d <> DATE '2024-01-25' GROUP BY d
"""

SQL["append_then_latest"] = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Đã duyệt' ELSE 'Chờ duyệt' END AS status,
  CAST(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS BIGINT) AS load
FROM orders
"""

SQL["rewrite_with_add"] = """
SELECT event_type, 'old' AS load, count(*) AS landed FROM events GROUP BY event_type
UNION ALL
SELECT event_type, 'new', count(*) FROM events WHERE event_type = 'error' GROUP BY event_type
"""

SQL["upsert_changed"] = """
SELECT "APPROVAL_ID", status, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY "APPROVAL_ID"
    ORDER BY (coalesce(status, '') = 'Chờ duyệt') ASC, seq) AS rn
  FROM (
    SELECT CASE WHEN o_orderkey % 1000 <> 999 THEN o_orderkey END AS "APPROVAL_ID",
      CASE WHEN i = 1 THEN 'Chờ duyệt' WHEN o_orderstatus = 'O' THEN 'Chờ duyệt'
        WHEN o_orderstatus = 'F' THEN 'Đã duyệt' END AS status,
      o_orderkey * 2 + 1 - i AS seq
    FROM (SELECT *, unnest(range(0, CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END)) AS i FROM orders)
    WHERE o_orderkey % 7 <> 0 OR o_orderkey % 1000 = 999
    UNION ALL
    SELECT o_orderkey, 'Không duyệt', (SELECT max(o_orderkey) FROM orders) * 2 + 2 + o_orderkey
    FROM orders WHERE o_orderkey % 7 = 0
  )
) WHERE rn = 1
"""

SQL["clustered_mart"] = """
SELECT CAST(d AS VARCHAR) AS event_date, count(*) AS records, CAST(sum(late_minute) AS BIGINT) AS late
FROM tk LEFT JOIN people p ON tk.person = p.code WHERE d >= DATE '2024-01-15' GROUP BY d
"""

SQL["verified_rewrite"] = """
SELECT o_orderstatus, count(*) AS kept FROM orders GROUP BY o_orderstatus
"""

SQL["recover_rewrite"] = """
SELECT o_orderstatus, count(*) AS kept, 'clean,dropped,restored' AS said FROM orders GROUP BY o_orderstatus
"""

SQL["expiring_tables"] = f"""
SELECT 'RAW_' || c_name AS table_name,
  strftime({AS_OF} + CAST(c_custkey % 90 AS INTEGER), '%Y-%m-%d %H:%M:%S') AS expires
FROM customer
WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 90 <= 30
"""

SQL["id_tail"] = """
SELECT o_orderkey AS id FROM orders, (SELECT max(o_orderkey) AS top FROM orders) t
WHERE o_orderkey > top - 150 AND o_orderkey < top - 40
  AND top - o_orderkey NOT BETWEEN 40 AND 42 AND o_orderkey % 7 <> 3
"""

SQL["pending_worklist"] = f"""
SELECT id FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY
    CASE WHEN status <> 'Chờ duyệt' THEN 0 ELSE 1 END, created DESC NULLS LAST,
    status DESC NULLS LAST) AS rn
  FROM (SELECT id, status, created FROM documented UNION ALL SELECT id, status, created FROM listed)
) WHERE rn = 1 AND status = 'Chờ duyệt' AND created >= {AS_OF} - 20
ORDER BY id DESC LIMIT 50
"""

SQL["status_changes"] = """
SELECT d.id, d.status FROM documented d JOIN lst l ON d.id = l.id
WHERE l.status = 'Chờ duyệt' AND d.status <> 'Chờ duyệt' AND d.status <> ''
"""

SQL["stale_pending"] = "SELECT id FROM stale"
SQL["window_ids"] = "SELECT id FROM in_window"
SQL["refresh_worklist"] = "SELECT id FROM in_window UNION SELECT id FROM stale"

SQL["missing_after_fetch"] = """
SELECT id FROM in_window WHERE id NOT IN (SELECT id FROM documented WHERE NOT error)
"""
SQL["first_failures"] = SQL["missing_after_fetch"] + " ORDER BY id LIMIT 20"

SQL["page_cut"] = """
SELECT o_orderkey, (29 - o_orderkey % 30) * 4 + o_orderkey // 30 % 4 + 1 AS page_no,
  strftime(DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER), '%d/%m/%Y') || ' 08:00' AS created
FROM orders
WHERE (29 - o_orderkey % 30) * 4 + o_orderkey // 30 % 4 + 1 <= (
  WITH pages_seen AS (
    SELECT (29 - o_orderkey % 30) * 4 + o_orderkey // 30 % 4 + 1 AS p, min(o_orderkey % 30) AS oldest
    FROM orders GROUP BY 1
  )
  SELECT least(
    (SELECT min(p) FROM pages_seen WHERE oldest < 17),
    (SELECT count(*) FROM (SELECT p, row_number() OVER (ORDER BY p) AS rn FROM pages_seen)
      WHERE p = rn))
)
"""

SQL["page_completeness"] = """
SELECT CAST(d AS VARCHAR) AS day, collected, announced, n AS pages,
  CASE WHEN collected >= announced THEN 'ok' WHEN n >= 50 THEN 'overflow' ELSE 'short' END AS status
FROM (
  SELECT d, CAST(sum(size) AS BIGINT) AS collected,
    CAST(CASE WHEN day(d) < 10 THEN 1 ELSE 100000000 END AS BIGINT) AS announced, count(*) AS n
  FROM (SELECT CAST(ts AS DATE) AS d, user_id % 60 AS page, count(*) AS size FROM events GROUP BY 1, 2)
  WHERE day(d) < 20 OR page < 40
  GROUP BY d
)
"""

SQL["reload_days"] = """
SELECT CAST(start_day AS VARCHAR) AS start_day, CAST(CAST(s AS DATE) AS VARCHAR) AS day,
  count(*) AS asked
FROM (
  SELECT start_day, unnest(generate_series(CAST(start_day AS TIMESTAMP), CAST(today AS TIMESTAMP),
    INTERVAL 1 DAY)) AS s
  FROM (SELECT CAST(ts + INTERVAL 7 HOUR AS DATE) - 3 AS start_day, CAST(ts AS DATE) AS today FROM events)
) GROUP BY start_day, s
"""

SQL["stream_upsert"] = f"""
SELECT user_id, status, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY (coalesce(status, '') = 'Chờ duyệt') ASC, event_id) AS rn
  FROM (SELECT *, {STATUS_OF_EVENT} AS status FROM events)
) WHERE rn = 1
"""

SQL["stream_folded"] = f"""
SELECT user_id, status, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY (coalesce(status, '') = 'Chờ duyệt') ASC, event_id % 3, event_id) AS rn
  FROM (SELECT *, {STATUS_OF_EVENT} AS status FROM events)
) WHERE rn = 1
"""


def _history(checked: list[str], later: dict[str, str]) -> str:
    """Two loads; ``later`` gives the second load's value of a changed column."""
    old = ", ".join(f'p."{c}" AS "o_{c}"' for c in checked)
    new = ", ".join(f'{later.get(c, f"p.{c}")} AS "n_{c}"' for c in checked)
    differ = " OR ".join(f'"o_{c}" IS DISTINCT FROM "n_{c}"' for c in checked)
    keep = lambda side: ", ".join(f'"{side}_{c}" AS "{c}"' for c in checked)
    one, two = "'2024-01-01 00:00:00'", "'2024-01-30 00:00:00'"
    source = f"""(SELECT p.id, {old}, {new}, p.id % 15 <> 7 AS had, p.id % 15 <> 4 AS got
      FROM staff p)"""
    return f"""
WITH staff AS (SELECT *, NULL::VARCHAR AS position_id, NULL::VARCHAR AS job_title FROM people),
both_loads AS (SELECT *, ({differ}) AS differs FROM {source})
SELECT id AS "ID", {keep("o")}, {one} AS valid_from,
  CASE WHEN got AND differs THEN {two} END AS valid_to FROM both_loads WHERE had
UNION ALL
SELECT id AS "ID", {keep("n")}, {two}, NULL FROM both_loads WHERE got AND (NOT had OR differs)
"""


_LATER = {
    "position_title": "CASE WHEN p.id % 6 = 0 THEN 'Trưởng nhóm' ELSE p.position_title END",
    "department_full": "CASE WHEN p.id % 12 = 11 THEN 'Phòng mới' ELSE p.department_full END",
}
def _three_loads(checked: list[str], other: list[str], later: dict[str, str]) -> str:
    """The second load as in ``_history``; the third is the first again, whole, with longer names."""
    row = lambda of: ", ".join(f'"{c}": {of(c)}' for c in (*other, *checked))
    one = row(lambda c: f'p."{c}"')
    two = row(lambda c: later.get(c, f'p."{c}"'))
    three = row(lambda c: "p.name || ' *'" if c == "name" else f'p."{c}"')
    differ = lambda a, b: " OR ".join(f"{a}.{c} IS DISTINCT FROM {b}.{c}" for c in checked)
    out = lambda r: ", ".join(f"{r}.{c} AS {c}" for c in (*other, *checked))
    day = lambda d: f"'2024-01-{d:02d} 00:00:00'"
    return f"""
WITH loads AS (SELECT p.id, p.id % 15 <> 7 AS had, p.id % 15 <> 4 AS got,
  {{{one}}} AS a, {{{two}}} AS b, {{{three}}} AS c FROM people p),
steps AS (SELECT *, got AND (NOT had OR {differ("a", "b")}) AS opens FROM loads),
ends AS (SELECT *, CASE WHEN opens THEN ({differ("b", "c")}) ELSE ({differ("a", "c")}) END AS again FROM steps)
SELECT id AS "ID", {out("a")}, {day(1)} AS valid_from,
  CASE WHEN opens THEN {day(15)} WHEN again THEN {day(30)} END AS valid_to FROM ends WHERE had
UNION ALL
SELECT id, {out("b")}, {day(15)}, CASE WHEN again THEN {day(30)} END FROM ends WHERE opens
UNION ALL
SELECT id, {out("c")}, {day(30)}, NULL FROM ends WHERE again
"""


SQL["scd2_history"] = _history(
    ["department_full", "position_title", "job_status", "salary_real"],
    {**_LATER, "salary_real": "CASE WHEN p.id % 9 = 2 THEN p.salary_real + 1 ELSE p.salary_real END"},
)
SQL["history_table"] = _three_loads(
    ["department_full", "position_title", "job_status", "salary_real"],
    ["name", "code", "work_place"],
    {
        **_LATER,
        "salary_real": "CASE WHEN p.id % 9 = 2 THEN p.salary_real + 1 ELSE p.salary_real END",
        "work_place": "CASE WHEN p.id % 9 <> 2 THEN p.work_place END",
    },
)
SQL["scd2_placement"] = _history(
    [
        "department_id", "department_full", "position_id", "position_title", "job_status",
        "job_title", "work_place",
    ],
    {**_LATER, "work_place": "CASE WHEN p.id % 9 <> 2 THEN p.work_place END"},
)


def _checks() -> str:
    """Check results, one SELECT per declared check of the checked models."""
    nulls = {
        "stg_profiles": ("people", {"ID": "id", "code": "code", "name": "name"}),
        "stg_approvals": ("lst", {"ID": "id", "personnel_code": "person"}),
        "stg_approval_details": ("docs", {"ID": "id", "personnel_code": "person"}),
        "stg_timekeep": ("tk", {"personnel_code": "person", "attendance_date": "d"}),
        "mart_profiles": (
            "mprof",
            {c: c for c in ("personnel_code", "name", "is_active", "department_group")},
        ),
        "mart_approvals": (
            "mapp",
            {c: c for c in ("approval_id", "approval_type", "personnel_code", "approval_status")},
        ),
        "mart_attendance_events": ("tk", {"personnel_code": "person", "event_date": "d"}),
    }
    parts = [
        f"SELECT '{model}' AS model, '{name}' AS column_name, 'not_null' AS \"check\", "
        f"count(*) FILTER (WHERE {col} IS NULL) AS failures FROM {cte}"
        for model, (cte, names) in nulls.items()
        for name, col in names.items()
    ]
    for name in ("personnel_code", "event_type", "event_date"):
        missing = "personnel_code IS NULL" if name == "personnel_code" else "FALSE"
        parts.append(
            f"SELECT 'mart_employee_events', '{name}', 'not_null', "
            f"coalesce(sum(CASE WHEN {missing} THEN (job_date_join IS NOT NULL)::BIGINT "
            f"+ (job_date_out IS NOT NULL)::BIGINT ELSE 0 END), 0) FROM mprof"
        )
    for name in ("snapshot_month", "total_employees", "active_employees"):
        parts.append(f"SELECT 'mart_headcount_snapshot', '{name}', 'not_null', 0")
    for model, name, cte, col in [
        ("stg_profiles", "ID", "people", "id"),
        ("stg_approvals", "ID", "lst", "id"),
        ("stg_approval_details", "ID", "docs", "id"),
        ("mart_profiles", "personnel_code", "mprof", "personnel_code"),
    ]:
        parts.append(
            f"SELECT '{model}', '{name}', 'unique', count(*) FROM (SELECT {col} FROM {cte} "
            f"WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)"
        )
    for model, name, cte, col, values in [
        ("stg_approvals", "app_approval_status", "lst", "status",
         "'Đã duyệt','Chờ duyệt','Từ chối','Đã hủy','Chưa duyệt','Không duyệt'"),
        ("mart_profiles", "is_active", "mprof", "is_active", "TRUE, FALSE"),
        ("mart_profiles", "department_group", "mprof", "department_group",
         "'Khối Cửa hàng','Khối Kho','Khối Sản xuất','Khối Văn phòng','Chưa phân bổ'"),
        ("mart_approvals", "approval_type", "mapp", "approval_type",
         "'Đơn làm thêm','Đơn checkin/out','Đơn xin nghỉ','Đơn vắng mặt','Đơn công tác',"
         "'Đơn thôi việc','Đơn khác'"),
    ]:
        parts.append(
            f"SELECT '{model}', '{name}', 'accepted_values', count(DISTINCT {col}) "
            f"FROM {cte} WHERE {col} NOT IN ({values})"
        )
    parts.append("SELECT 'mart_employee_events', 'event_type', 'accepted_values', 0")
    return "\nUNION ALL ".join(parts)


_RESULTS = f"""
SELECT model, column_name, "check", CAST(failures AS BIGINT) AS failures,
  CASE WHEN failures = 0 THEN 'PASS' ELSE 'ERROR' END AS status
FROM ({_checks()})
"""
SQL["dq_results"] = _RESULTS
SQL["dq_summary"] = f"""
SELECT count(*) FILTER (WHERE status = 'PASS') AS "PASS", CAST(0 AS BIGINT) AS "WARN",
  count(*) FILTER (WHERE status = 'ERROR') AS "ERROR", CAST(0 AS BIGINT) AS "SKIP", count(*) AS "TOTAL"
FROM ({_RESULTS})
"""

SQL["source_freshness"] = """
SELECT 'profiles' AS source, '2024-01-29 00:00:00' AS max_loaded_at, 'ERROR' AS status
WHERE (SELECT count(*) FROM customer) > 0
UNION ALL
SELECT 'approvals', strftime(TIMESTAMP '2024-01-01' + to_days(max(day) - 1), '%Y-%m-%d %H:%M:%S'),
  'WARN' FROM snaps
UNION ALL
SELECT 'timekeep', '2024-01-30 00:00:00', 'PASS' WHERE (SELECT count(*) FROM events) > 0
"""


def _all_profile_columns() -> str:
    known = {
        "ID": "id", "mobile": None, "job_title_name": "job_title_name",
        "birthday": "CAST(birthday AS VARCHAR)",
        "job_date_join": "CAST(job_date_join AS VARCHAR)",
        "job_date_out": "CAST(job_date_out AS VARCHAR)",
        "salary_total": "salary_total",
        "jobs": "CASE WHEN id % 3 = 0 THEN '[1]' END",
        "json_insurance": "([NULL, '[]', '[{\"code\":\"BH\"}]', 'null'])[CAST(id % 4 AS INTEGER) + 1]",
        "json_degrees": (
            "([NULL, '[]', '[{\"level_name\":\"Đại học\",\"specialization\":\"Kế toán\"}]', "
            "'[{\"level_name\":\"Cao đẳng\"},{\"level_name\":\"Khác\"}]', "
            "'{\"level_name\":\"Khác\"}'])[CAST(id % 5 AS INTEGER) + 1]"
        ),
    }
    plain = (
        "code name department_full department_id department_num_id gender position_title job_status "
        "work_place salary_real marital_status email live_manager_id live_manager_code"
    )
    known.update({c: c for c in plain.split()})
    types = {"int": "BIGINT", "float": "DOUBLE"}
    return ", ".join(
        f'{known.get(f.name) or f"NULL::{types.get(f.kind, "VARCHAR")}"} AS "{f.name}"'
        for f in PROFILE_FIELDS
    )


SQL["stg_profiles"] = f"""
SELECT '2024-01-29 00:00:00' AS sync_time, {_all_profile_columns()} FROM people
"""

_TEXT = lambda names: ", ".join(f"NULL::VARCHAR AS {n}" for n in names.split())

SQL["stg_approvals"] = f"""
SELECT strftime(sync_time, '%Y-%m-%d %H:%M:%S') AS sync_time, id AS "ID",
  approver AS app_approval_current_id, status AS app_approval_status, sub_object AS app_sub_object,
  NULL::BIGINT AS app_sub_object_id, CAST(date_approve AS VARCHAR) AS date_approve,
  CAST(date_created AS VARCHAR) AS date_created, CAST(date_start AS VARCHAR) AS date_start,
  department_id, description_text, num_file, person AS personnel_code,
  person_name AS personnel_name, reason, time_approve, time_created,
  {_TEXT("api_app_approval_ids app_approval_current_node_deadline app_approval_ids "
         "app_approval_status_step app_approval_version_id comment_approved company_id created_by_id "
         "date_end date_subobject job_title last_comments position_id project_code project_rel "
         "tag_ids user_id")}
FROM lst
"""

SQL["stg_approval_details"] = f"""
SELECT '2024-01-30 00:00:00' AS sync_time, id AS "ID", id AS approval_id_check,
  status AS app_approval_status, NULL::BIGINT AS app_approval_version_id,
  NULL::BIGINT AS app_sub_object_id, NULL::BIGINT AS num_file, person AS personnel_code,
  CAST(date_approve AS VARCHAR) AS date_approve, CAST(created AS VARCHAR) AS date_created,
  CASE WHEN kind_no = 0 THEN id // 5 % 2 + 1 WHEN kind_no = 4 AND id % 3 = 2 THEN NULL
    WHEN id % 2 = 1 THEN 0 END AS overtime_items,
  CASE WHEN kind_no = 1 THEN id // 5 % 2 + 1 WHEN id % 2 = 1 THEN 0 END AS inout_items,
  CASE WHEN kind_no = 2 THEN id // 5 % 2 + 1 WHEN id % 2 = 1 THEN 0 END AS leave_data_items,
  CASE WHEN kind_no = 3 THEN id // 5 % 2 + 1 WHEN id % 2 = 1 THEN 0 END AS absence_items,
  kind_no = 0 OR (kind_no = 4 AND id % 3 = 2) OR id % 2 = 1 AS overtime_present,
  kind_no = 1 OR id % 2 = 1 AS inout_present,
  kind_no = 2 OR id % 2 = 1 AS leave_data_present,
  kind_no = 3 OR id % 2 = 1 AS absence_present,
  {_TEXT("app_approval_current_id app_approval_current_node_deadline app_approval_ids "
         "app_sub_object comment_approved created_by_id date_end date_start department_id files "
         "job_title personnel_name position_id reason tag_ids time_approve user_id")}
FROM docs
"""

_NO_NUMBERS = "total_cal_workday fine_late fine_soon leave_p leave_co leave_ts leave_dh leave_nvsc "\
    "leave_nkl workhour_overtime ot_normal_light ot_normal_night ot_dayoff_light ot_holiday_light"
_NULL_NUMBERS = ", ".join(f"NULL::DOUBLE AS {n}" for n in _NO_NUMBERS.split())

SQL["stg_timekeep"] = f"""
SELECT CAST(d AS VARCHAR) AS attendance_date, CAST(u * 100 + day(d) AS VARCHAR) AS timekeep_id,
  person AS personnel_code, CAST(record_date AS VARCHAR) AS record_date,
  'Đang làm việc' AS job_status, CAST(1 AS DOUBLE) AS cal_workday, cal_workhour, total_cal_workhour,
  late_minute, soon_minute, {_NULL_NUMBERS}, NULL::DOUBLE AS workday,
  '08:00' AS time_start, '17:30' AS time_end, checkin, checkout, is_check_log, 'HC' AS shift_code,
  is_holiday, FALSE AS is_day_off, '2024-01-30 00:00:00' AS "SYNC_TIME",
  {_TEXT("status department_id check_first check_end")}
FROM tk
"""

SQL["sheet_staging"] = f"""
SELECT 'NV' || k AS personnel_code, c_name AS name, c_mktsegment AS department,
  'HĐ ' || i AS contract_type, CAST(date_join AS VARCHAR) AS date_join,
  {_TEXT("department_block job_level job_title status date_end_probation date_sign_contract_1 "
         "date_end_contract_1 date_sign_contract_2 date_end_contract_2 date_resign tenure_months "
         "birth_month age_group gender has_id_card has_residence_proof has_degree_copy has_resume "
         "has_birth_certificate has_health_certificate")}
FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY date_join DESC NULLS LAST, i) AS rn
  FROM (
    SELECT *, CASE WHEN k % 3 <> 0 OR i = 0
      THEN DATE '2019-01-01' + CAST(k % 500 + i * 30 AS INTEGER) END AS date_join
    FROM (SELECT c_custkey AS k, c_name, c_mktsegment,
      unnest(range(0, CAST(c_custkey % 2 + 1 AS BIGINT))) AS i FROM customer)
  )
) WHERE rn = 1
"""

SQL["exception_status_staging"] = """
SELECT case_id, personnel_code, CAST(case_date AS VARCHAR) AS case_date, exception_type_note,
  processing_status, handled_by, note FROM track
"""

SQL["mart_profiles"] = """
SELECT * REPLACE (CAST(birthday AS VARCHAR) AS birthday,
  CAST(job_date_join AS VARCHAR) AS job_date_join, CAST(job_date_out AS VARCHAR) AS job_date_out)
FROM mprof
"""

SQL["mart_approvals"] = """
SELECT * REPLACE (CAST(date_created AS VARCHAR) AS date_created,
  CAST(date_approved AS VARCHAR) AS date_approved, CAST(date_record AS VARCHAR) AS date_record)
FROM mapp
"""

SQL["approvals_incremental"] = SQL["mart_approvals"]

SQL["int_details_flat"] = """
SELECT * REPLACE (CAST(date_record AS VARCHAR) AS date_record) FROM flat_first
"""

SQL["first_element_flatten"] = """
SELECT detail_type, CAST(date_record AS VARCHAR) AS date_record, count(*) AS events,
  sum(hours_number) AS hours, min(start_time) AS first_start
FROM flat_first GROUP BY detail_type, date_record
"""

SQL["mart_attendance_events"] = f"""
SELECT CAST(tk.d AS VARCHAR) AS event_date, person AS personnel_code,
  coalesce(p.name, 'Chưa xác định') AS name,
  coalesce(nullif(trim(p.department_full), ''), 'Chưa phân bổ') AS department_full,
  coalesce(nullif(trim(p.position_title), ''), 'Chưa cập nhật') AS position_title,
  CAST(1 AS DOUBLE) AS cal_workday, cal_workhour, total_cal_workhour, late_minute, soon_minute,
  {_NULL_NUMBERS}, 'Timekeep' AS event_category, 'Đang làm việc' AS event_status,
  '08:00' AS start_time, '17:30' AS end_time, total_cal_workhour AS hours_amount
FROM tk LEFT JOIN people p ON tk.person = p.code
"""

SQL["landed_run"] = SQL["mart_attendance_events"]

SQL["mart_employee_events"] = """
SELECT profile_id, personnel_code, name, department, department_group, position_title,
  CAST(job_date_join AS VARCHAR) AS event_date, 'Tuyển mới' AS event_type
FROM mprof WHERE job_date_join IS NOT NULL
UNION ALL
SELECT profile_id, personnel_code, name, department, department_group, position_title,
  CAST(job_date_out AS VARCHAR), 'Nghỉ việc'
FROM mprof WHERE job_date_out IS NOT NULL
"""

SQL["compliance_approval_timing"] = """
SELECT approval_id, personnel_code, name, approval_type, approval_status,
  CAST(date_created AS VARCHAR) AS date_created, time_created,
  CAST(date_approved AS VARCHAR) AS date_approved, time_approved,
  CAST(date_record AS VARCHAR) AS date_record, start_time, reason,
  tc AS time_created_norm, ta AS time_approved_norm, st AS start_time_norm,
  strftime(created_datetime, '%Y-%m-%d %H:%M:%S') AS created_datetime,
  strftime(approved_datetime, '%Y-%m-%d %H:%M:%S') AS approved_datetime,
  strftime(leave_start_datetime, '%Y-%m-%d %H:%M:%S') AS leave_start_datetime,
  gap AS minutes_created_to_leave_start, gap_approved AS minutes_leave_start_to_approved,
  flag_xin_nghi_sat_gio, flag_tao_don_hoi_to, flag_duyet_hoi_to, flag_don_ton_cho_duyet_qua_han
FROM timing
"""

SQL["compliance_schedule_daily"] = """
SELECT * REPLACE (CAST(schedule_date AS VARCHAR) AS schedule_date) FROM sched
"""

SQL["compliance_exception_detail"] = """
SELECT * REPLACE (CAST(exception_date AS VARCHAR) AS exception_date) FROM exc
"""

SQL["compliance_kpi_overview"] = """
SELECT CAST(e.exception_date AS VARCHAR) AS exception_date,
  (SELECT count(DISTINCT personnel_code) FROM office WHERE is_active) AS total_headcount,
  e.total_personnel_with_record, e.total_luot_nghi, e.total_ngoai_le, e.total_hop_le,
  e.total_hop_le / CAST(e.total_hop_le + e.total_ngoai_le AS DOUBLE) AS ty_le_nghi_hop_le,
  e.case_vang_khong_phep, e.case_don_chua_duyet_da_nghi, e.case_nghi_sai_quy_dinh,
  e.case_nghi_vuot_don, e.case_chua_xu_ly,
  coalesce(t.a, 0) AS so_don_duyet_hoi_to, coalesce(t.b, 0) AS so_don_tao_hoi_to,
  coalesce(t.c, 0) AS so_don_ton_qua_han
FROM (
  SELECT exception_date, count(DISTINCT personnel_code) AS total_personnel_with_record,
    count(*) FILTER (WHERE exception_type NOT LIKE 'Bình thường%') AS total_ngoai_le,
    count(*) FILTER (WHERE exception_type LIKE 'Bình thường%') AS total_hop_le,
    count(*) FILTER (WHERE exception_type = 'Vắng không phép') AS case_vang_khong_phep,
    count(*) FILTER (WHERE exception_type = 'Nghỉ khi chưa được duyệt') AS case_don_chua_duyet_da_nghi,
    count(*) FILTER (WHERE exception_type = 'Nghỉ sai quy định') AS case_nghi_sai_quy_dinh,
    count(*) FILTER (WHERE exception_type = 'Nghỉ vượt đơn') AS case_nghi_vuot_don,
    count(*) FILTER (WHERE processing_status = 'Chưa xử lý' AND is_exception) AS case_chua_xu_ly,
    count(leave_approval_status) AS total_luot_nghi
  FROM exc GROUP BY exception_date
) e LEFT JOIN (
  SELECT date_record, count(*) FILTER (WHERE flag_duyet_hoi_to) AS a,
    count(*) FILTER (WHERE flag_tao_don_hoi_to) AS b,
    count(*) FILTER (WHERE flag_don_ton_cho_duyet_qua_han) AS c
  FROM timing GROUP BY date_record
) t ON e.exception_date = t.date_record
"""

SQL["compliance_kpi_by_dept"] = """
SELECT *, rank() OVER (PARTITION BY period_month ORDER BY ngoai_le_tren_100_nhan_su ASC NULLS FIRST)
  AS xep_hang_tuan_thu
FROM (
  SELECT CAST(CAST(m AS DATE) AS VARCHAR) AS period_month, d.department, h.headcount, total_luot_nghi,
    total_ngoai_le, total_hop_le,
    total_hop_le / CAST(total_hop_le + total_ngoai_le AS DOUBLE) AS ty_le_tuan_thu,
    total_ngoai_le * 100 / CAST(h.headcount AS DOUBLE) AS ngoai_le_tren_100_nhan_su,
    so_don_duyet_hoi_to
  FROM (
    SELECT date_trunc('month', exception_date) AS m, department,
      count(leave_approval_status) AS total_luot_nghi,
      count(*) FILTER (WHERE exception_type NOT LIKE 'Bình thường%') AS total_ngoai_le,
      count(*) FILTER (WHERE exception_type LIKE 'Bình thường%') AS total_hop_le,
      count(*) FILTER (WHERE flag_duyet_hoi_to) AS so_don_duyet_hoi_to
    FROM exc GROUP BY 1, 2
  ) d LEFT JOIN heads h ON d.department = h.department
)
"""


def statements() -> dict[str, str]:
    return {name: _joined(sql) for name, sql in SQL.items()}


def _joined(sql: str) -> str:
    """Put the shared CTEs in front, merging with a statement's own ``WITH``."""
    body = sql.strip()
    names = _needed(body)
    if not names or not body.startswith("WITH "):
        return with_star(body)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({STAR[n].strip()})" for n in names)
    return f"WITH {ctes},\n{body[len('WITH '):]}"


def _watched() -> str:
    """The checks of ``dq_results``, those of the other models, and one row a model for its minimum."""
    whole = {
        "stg_hr_master_data": ("sheet_staging", ["personnel_code"]),
        "int_approval_details_flat": ("int_details_flat", ["approval_id", "detail_type"]),
        "mart_compliance_schedule_daily": (
            "compliance_schedule_daily", ["personnel_code", "schedule_date", "exception_type"],
        ),
        "mart_compliance_approval_timing": ("compliance_approval_timing", ["approval_id", "personnel_code"]),
        "mart_compliance_exception_detail": (
            "compliance_exception_detail", ["personnel_code", "exception_date", "case_id"],
        ),
    }
    parts = [_checks()]
    for model, (query, names) in whole.items():
        for name in names:
            parts.append(
                f"SELECT '{model}', '{name}', 'not_null', count(*) FILTER (WHERE \"{name}\" IS NULL) FROM ({SQL[query]})"
            )
    for model, query, name, values in [
        ("int_approval_details_flat", "int_details_flat", "detail_type", "'overtime','inout','absence','leave'"),
        ("mart_compliance_schedule_daily", "compliance_schedule_daily", "severity_level", "'Cao','Trung bình','Thấp'"),
    ]:
        parts.append(
            f"SELECT '{model}', '{name}', 'accepted_values', count(DISTINCT {name}) "
            f"FROM ({SQL[query]}) WHERE {name} NOT IN ({values})"
        )
    parts.append(
        "SELECT 'stg_hr_master_data', 'personnel_code', 'unique', count(*) FROM "
        f"(SELECT personnel_code FROM ({SQL['sheet_staging']}) WHERE personnel_code IS NOT NULL "
        "GROUP BY personnel_code HAVING count(*) > 1)"
    )
    # Every day once, by construction.
    for name, check in (("date", "not_null"), ("year", "not_null"), ("is_weekday", "not_null"), ("date", "unique")):
        parts.append(f"SELECT 'dim_date', '{name}', '{check}', 0")
    models = [
        "stg_profiles", "stg_approvals", "stg_approval_details", "stg_timekeep", "mart_profiles", "mart_approvals",
        "mart_attendance_events", "mart_employee_events", "mart_headcount_snapshot", *whole, "dim_date",
    ]
    parts += [f"SELECT '{model}', '*', 'minimum_rows', 0" for model in models]
    return "\nUNION ALL ".join(parts)


SQL["dq_watched"] = f"""
SELECT model, column_name, "check", CAST(failures AS BIGINT) AS failures,
  CASE WHEN failures = 0 THEN 'PASS' ELSE 'ERROR' END AS status
FROM ({_watched()})
"""
