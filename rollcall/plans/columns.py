"""Column specifications of the staging models.

A specification lists output columns with the JSON key they come from and how
the text is read. One ``select`` is built from it, and a caller that needs a few
columns parses only those keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import jsonx, safe

# How text becomes a value, as SQL around the text ``{0}``. Plain names fail the
# job on bad text; the ``safe_`` ones, dates and flags give NULL instead.
READERS: dict[str, str] = {
    "text": "{0}",
    "int": "CAST({0} AS BIGINT)",
    "float": "CAST({0} AS DOUBLE)",
    "timestamp": "CAST({0} AS TIMESTAMP)",
    "safe_int": "try_cast({0} AS BIGINT)",
    "safe_float": "try_cast({0} AS DOUBLE)",
    "safe_timestamp": safe.TIMESTAMP_SQL,
    "date": safe.DATE_DMY_SQL,
    "flag": "try_cast({0} AS BIGINT) = 1",
}
# The readers that fail on bad text.
STRICT_KINDS = ("int", "float", "timestamp")


@dataclass(frozen=True)
class Field:
    name: str
    key: str
    kind: str = "text"


def project(
    df: DataFrame,
    fields: Sequence[Field],
    record: str,
    keep: Sequence[str],
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Typed columns of ``record`` after the SQL columns ``keep``.

    ``only`` limits the typed columns by output name; other keys are not parsed.
    JSON columns are of kind ``json``, or ``array`` where the order of keys in the
    text does not matter and most values are arrays. The columns go to Spark as SQL text, one call for all of them.
    """
    if only is not None:
        fields = [f for f in fields if f.name in set(only)]
    documents = [f.key for f in fields if f.kind == "json"]
    scalars = list(dict.fromkeys(f.key for f in fields if f.kind != "json"))
    parsed = df.withColumn("_j", jsonx.record_struct(F.col(record), scalars, documents))

    def read(f: Field) -> str:
        if f.kind == "json":
            return f"to_json(_j.`{f.key}`) AS `{f.name}`"
        if f.kind == "array":
            return f"{jsonx.array_sql('_j', f.key, record)} AS `{f.name}`"
        return f"{READERS[f.kind].format(jsonx.scalar_sql('_j', f.key, record))} AS `{f.name}`"

    return parsed.selectExpr(*keep, *[read(f) for f in fields])


def _table(text: str) -> list[Field]:
    """Fields from lines of output column, key and kind."""
    return [Field(*line.split()) for line in text.strip().splitlines()]


# Columns of an employee record.
PROFILE_FIELDS = _table("""
    ID ID int
    allow_1 allow_1 int
    allow_10 allow_10 int
    allow_13 allow_13 int
    allow_14 allow_14 text
    allow_19 allow_19 text
    allow_2 allow_2 text
    allow_20 allow_20 int
    allow_4 allow_4 int
    allow_7 allow_7 int
    allow_9 allow_9 int
    allow_salary allow_salary int
    allow_salary_details allow_salary_details text
    api_position_id api_position_id int
    attendace_code attendace_code text
    bank_info bank_info text
    birth_times birth_times int
    birthday birthday date
    birthday_current birthday_current date
    birthday_now birthday_now date
    blood_group blood_group text
    blood_pressure blood_pressure text
    branch_address branch_address text
    branch_code branch_code text
    branch_name branch_name text
    candidate_id candidate_id text
    certificate certificate text
    certificate_status certificate_status text
    certificates_code certificates_code text
    certificates_count_released certificates_count_released text
    certificates_date_apply certificates_date_apply date
    certificates_date_end certificates_date_end date
    certificates_document certificates_document text
    certificates_type certificates_type text
    certificates_version certificates_version text
    code code text
    code_contract code_contract text
    code_storage code_storage text
    coefficient coefficient int
    company_address company_address text
    company_code company_code text
    company_name company_name text
    company_tax company_tax text
    concurrent_depart_ids concurrent_depart_ids text
    concurrent_position_ids concurrent_position_ids text
    cost_center cost_center text
    created_by_id created_by_id text
    current_address current_address text
    date_change_salary date_change_salary date
    date_created date_created date
    date_created_certificate date_created_certificate date
    date_finish_contract date_finish_contract date
    date_join_now date_join_now date
    date_leave_from date_leave_from date
    date_leave_to date_leave_to date
    date_of_resignation date_of_resignation date
    date_start_contract date_start_contract date
    date_trigger_user date_trigger_user date
    date_updated date_updated date
    day_job day_job int
    degree_place degree_place text
    degree_specialization degree_specialization text
    degrees degrees text
    department_api department_api int
    department_business department_business text
    department_code department_code text
    department_full department_full text
    department_full_all department_full_all text
    department_id department_id text
    department_main department_main text
    department_management_unit department_management_unit text
    department_num_id department_num_id int
    department_parent department_parent text
    department_type_id department_type_id text
    description_text desc text
    designation designation text
    document_status document_status text
    due_date due_date date
    email email text
    family_all family_all text
    family_birthday family_birthday date
    family_dependent family_dependent text
    family_dependent_from_date family_dependent_from_date date
    family_dependent_tax family_dependent_tax text
    family_dependent_to_date family_dependent_to_date date
    family_desc family_desc text
    family_gender family_gender text
    family_name family_name text
    family_phone family_phone text
    family_relative_id family_relative_id text
    gender gender text
    gps_location_ids gps_location_ids text
    heart_beat heart_beat text
    height height text
    home_address home_address text
    image_private_back image_private_back text
    image_private_front image_private_front text
    is_econtract is_econtract text
    job_bank_account job_bank_account text
    job_bank_account_name job_bank_account_name text
    job_bank_desc job_bank_desc text
    job_bank_id job_bank_id text
    job_contract job_contract text
    job_date_end_review job_date_end_review date
    job_date_join job_date_join date
    job_date_out job_date_out date
    job_out_reason job_out_reason text
    job_reldate_join job_reldate_join date
    job_status job_status text
    job_tax job_tax text
    job_title job_title text
    job_title_api job_title_api int
    job_title_desc job_title_desc text
    job_title_name job_title_name text
    jobout_1 jobout_1 text
    jobout_2 jobout_2 text
    jobout_3 jobout_3 text
    jobout_4 jobout_4 text
    jobout_5 jobout_5 text
    jobout_6 jobout_6 text
    jobout_date_1 jobout_date_1 date
    jobout_date_2 jobout_date_2 date
    jobout_date_3 jobout_date_3 date
    jobout_date_4 jobout_date_4 date
    jobout_date_5 jobout_date_5 date
    jobout_date_6 jobout_date_6 date
    jobs jobs text
    json_add_concurrent json_add_concurrent json
    json_bankInfo json_bankInfo json
    json_communist json_communist json
    json_degrees json_degrees json
    json_experience json_experience json
    json_family json_family json
    json_insurance json_insurance json
    json_solves json_solves json
    json_visa json_visa json
    json_workPermit json_workPermit json
    labor_group labor_group text
    level_academic level_academic text
    level_education_type level_education_type text
    level_id level_id text
    level_num_id level_num_id int
    level_school level_school text
    live_manager_code live_manager_code text
    live_manager_id live_manager_id text
    marital_status marital_status text
    military_service military_service text
    mobile mobile text
    name name text
    nationality nationality text
    num_file num_file int
    number_dependent number_dependent int
    origin_state origin_state text
    passport_code passport_code text
    passport_code_place passport_code_place text
    passport_date_expire passport_date_expire date
    passport_date_from passport_date_from date
    passport_image_front passport_image_front text
    passport_type passport_type text
    people people text
    photo photo text
    place_current place_current text
    place_current_district_title place_current_district_title text
    place_current_province_title place_current_province_title text
    place_current_title place_current_title text
    place_home place_home text
    place_home_code place_home_code text
    place_home_district_title place_home_district_title text
    place_home_province_title place_home_province_title text
    place_home_title place_home_title text
    place_of_birthday place_of_birthday text
    position_api position_api int
    position_id position_id text
    position_parent_id position_parent_id text
    position_title position_title text
    premium_code premium_code text
    premium_number premium_number text
    premium_personnel premium_personnel text
    premium_place premium_place text
    premium_place_code premium_place_code text
    private_code private_code text
    private_code_back private_code_back text
    private_code_date private_code_date date
    private_code_front private_code_front text
    private_code_place private_code_place text
    raw_user_id raw_user_id int
    receive_16 receive_16 text
    receive_2 receive_2 text
    receive_22 receive_22 text
    receive_23 receive_23 text
    receive_24 receive_24 text
    receive_3 receive_3 text
    receive_4 receive_4 text
    receive_5 receive_5 text
    receive_7 receive_7 text
    receive_8 receive_8 text
    receive_date_16 receive_date_16 date
    receive_date_2 receive_date_2 date
    receive_date_22 receive_date_22 date
    receive_date_23 receive_date_23 date
    receive_date_24 receive_date_24 date
    receive_date_3 receive_date_3 date
    receive_date_4 receive_date_4 date
    receive_date_5 receive_date_5 date
    receive_date_7 receive_date_7 date
    receive_date_8 receive_date_8 date
    religious religious text
    salaries salaries text
    salary_10 salary_10 float
    salary_11 salary_11 float
    salary_12 salary_12 float
    salary_13 salary_13 float
    salary_14 salary_14 float
    salary_15 salary_15 float
    salary_16 salary_16 float
    salary_17 salary_17 float
    salary_3 salary_3 float
    salary_4 salary_4 float
    salary_6 salary_6 float
    salary_7 salary_7 float
    salary_8 salary_8 float
    salary_9 salary_9 float
    salary_area_id salary_area_id text
    salary_min_area salary_min_area float
    salary_premium_base salary_premium_base text
    salary_real salary_real float
    salary_total salary_total float
    specialization specialization text
    state_code state_code text
    state_name state_name text
    type_contract type_contract text
    updated_by_id updated_by_id text
    user_id user_id text
    weight weight text
    welfares_date_force welfares_date_force date
    welfares_money welfares_money text
    welfares_reason welfares_reason text
    welfares_type welfares_type text
    work_place work_place text
    work_place_address work_place_address text
    work_type work_type text
    year_join year_join float
    year_work_experience year_work_experience int
    year_work_experience_now year_work_experience_now float
""")

# Columns of a request in the list.
APPROVAL_FIELDS = _table("""
    ID ID int
    api_app_approval_ids api_app_approval_ids text
    app_approval_current_id app_approval_current_id text
    app_approval_current_node_deadline app_approval_current_node_deadline text
    app_approval_ids app_approval_ids text
    app_approval_status app_approval_status text
    app_approval_status_step app_approval_status_step text
    app_approval_version_id app_approval_version_id text
    app_sub_object app_sub_object text
    app_sub_object_id app_sub_object_id int
    comment_approved comment_approved text
    company_id company_id text
    created_by_id created_by_id text
    date_approve date_approve date
    date_created date_created date
    date_end date_end date
    date_start date_start date
    date_subobject date_subobject date
    department_id department_id text
    description_text desc text
    job_title job_title text
    last_comments last_comments text
    num_file num_file int
    personnel_code personnel_code text
    personnel_name personnel_name text
    position_id position_id text
    project_code project_code text
    project_rel project_rel text
    reason reason text
    tag_ids tag_ids text
    time_approve time_approve text
    time_created time_created text
    user_id user_id text
""")

# Columns of a request document.
DETAIL_FIELDS = _table("""
    approval_id_check ID int
    app_approval_current_id app_approval_current_id text
    app_approval_current_node_deadline app_approval_current_node_deadline text
    app_approval_ids app_approval_ids text
    app_approval_status app_approval_status text
    app_approval_version_id app_approval_version_id int
    app_sub_object app_sub_object text
    app_sub_object_id app_sub_object_id int
    comment_approved comment_approved text
    created_by_id created_by_id text
    date_approve date_approve date
    date_created date_created date
    date_end date_end date
    date_start date_start date
    department_id department_id text
    files files json
    inout inout json
    overtime overtime json
    absence absence json
    leave_data leave json
    job_title job_title text
    num_file num_file int
    personnel_code personnel_code text
    personnel_name personnel_name text
    position_id position_id text
    reason reason text
    tag_ids tag_ids text
    time_approve time_approve text
    user_id user_id text
""")

# Columns of a person's attendance day.
TIMEKEEP_FIELDS = _table("""
    timekeep_id ID text
    personnel_code personnel_code text
    record_date date text
    job_status job_status text
    cal_workday cal_workday safe_float
    cal_workhour cal_workhour safe_float
    total_cal_workhour total_cal_workhour safe_float
    total_cal_workday total_cal_workday safe_float
    late_minute late_minute safe_int
    soon_minute soon_minute safe_int
    fine_late cal_fine_late safe_float
    fine_soon cal_fine_soon safe_float
    leave_p leave_type_p safe_float
    leave_co leave_type_co safe_float
    leave_ts leave_type_ts safe_float
    leave_dh leave_type_dh safe_float
    leave_nvsc leave_type_nvsc safe_float
    leave_nkl leave_type_nkl safe_float
    workhour_overtime workhour_overtime safe_float
    ot_normal_light overtime_normal_light safe_float
    ot_normal_night overtime_normal_night safe_float
    ot_dayoff_light overtime_dayoff_light safe_float
    ot_holiday_light overtime_holiday_light safe_float
    time_start time_start text
    time_end time_end text
    status status text
    department_id department_id text
    checkin checkin safe_timestamp
    checkout checkout safe_timestamp
    check_first check_first safe_timestamp
    check_end check_end safe_timestamp
    is_check_log is_check_log text
    shift_code shift_code text
    is_holiday is_holiday flag
    is_day_off day_off flag
    workday workday safe_float
""")
