"""Time the headline queries and print one JSON line.

The landed tables are derived and written once, timed as ``landing``; the models
then start from landed files, as they do in production. Every query is timed
from building its plan to writing out all its rows.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from rollcall import prepare_session
from rollcall.plans.pipeline import Pipeline
from rollcall.queries import QUERIES
from rollcall.settings import shared_dir
from rollcall.sources import star
from rollcall.sources.raw import Sources

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MODELS = {
    "stg_profiles": (),
    "stg_approvals": (),
    "stg_approval_details": (),
    "stg_timekeep": (),
    "int_approval_details_flat": (),
    "mart_profiles": (),
    "mart_approvals": ("stg_approval_details",),
    "mart_attendance_events": (),
    "mart_employee_events": (),
    "mart_headcount_snapshot": (),
}
COMPLIANCE = [
    "mart_compliance_approval_timing",
    "mart_compliance_schedule_daily",
    "mart_compliance_exception_detail",
    "mart_compliance_kpi_overview",
    "mart_compliance_kpi_by_dept",
]
OPERATORS = [
    "latest_by_key",
    "latest_nulls_last",
    "dedupe_input_order",
    "distinct_branch_union",
    "union_distinct_ids",
    "first_by_rank",
    "string_agg_distinct",
    "month_headcount",
    "safe_ratio_rank",
    "minute_gaps_flags",
    "like_rules",
    "redact_text",
    "scrape_text",
    "envelope_pack",
    "window_replace",
    "upsert_changed",
    "append_then_latest",
    "stream_upsert",
    "id_tail",
    "page_cut",
    "pending_worklist",
    "stale_pending",
    "scd2_history",
]


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("rollcall-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rollcall-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def land(spark: SparkSession) -> Sources:
    source = star.sources(spark, SF_DIR)
    folder = f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}"
    landed = {}
    for name in ("profiles", "approvals", "details", "timekeep", "hr_master", "tracking"):
        df = getattr(source, name)
        df.write.parquet(f"{folder}/{name}")
        landed[name] = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    return Sources(**landed)


def main() -> None:
    spark = session()
    times: dict[str, float] = {}

    def timed(name: str, work) -> object:
        start = time.perf_counter()
        result = work()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
        return result

    landed = timed("landing", lambda: land(spark))
    for name, keep in MODELS.items():
        timed(name, lambda: drain(Pipeline(spark, landed, star.SETTINGS, keep).model(name)))

    # One run of the compliance suite: shared models are built once, inside the
    # first model that needs them.
    shared = (
        "stg_profiles", "stg_approvals", "stg_approval_details", "stg_timekeep",
        "mart_profiles", "mart_approvals", *COMPLIANCE[:3],
    )
    suite = Pipeline(spark, landed, star.SETTINGS, keep=shared)
    for name in COMPLIANCE:
        timed(name, lambda: drain(suite.model(name)))
    for name in OPERATORS:
        timed(name, lambda: drain(QUERIES[name](spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
