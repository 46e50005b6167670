"""The model graph: which model reads which, and what a run writes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rollcall.operators import quality, spine, watch
from rollcall.plans import compliance, marts, staging
from rollcall.settings import Settings, shared_dir
from rollcall.sources import tables, versions
from rollcall.sources.raw import Sources

# Models that wait for the HR sheet, and the daily partitioned marts.
NEEDS_HR_SHEET = ["stg_hr_master_data", "mart_profiles", "mart_employee_events"]
PARTITIONED = {
    "mart_approvals": "date_created",
    "mart_attendance_events": "event_date",
    "mart_compliance_schedule_daily": "schedule_date",
    "mart_compliance_exception_detail": "exception_date",
}
MARTS = [
    "dim_date",
    "mart_profiles",
    "mart_approvals",
    "mart_attendance_events",
    "mart_employee_events",
    "mart_headcount_snapshot",
    "mart_compliance_approval_timing",
    "mart_compliance_schedule_daily",
    "mart_compliance_exception_detail",
    "mart_compliance_kpi_overview",
    "mart_compliance_kpi_by_dept",
]


class Pipeline:
    """Models by name, each built once.

    ``keep`` names models that more than one other model reads; they are written
    to the shared folder on first use and read back, so their input is parsed
    and shuffled once, and a lost executor costs no lineage beyond the written
    table. ``narrow`` stages only the columns the marts read.
    """

    def __init__(
        self,
        spark: SparkSession,
        sources: Sources,
        cfg: Settings,
        keep: Sequence[str] = (),
        folder: str | None = None,
        narrow: bool = True,
    ):
        self.spark, self.sources, self.cfg = spark, sources, cfg
        self.keep, self.narrow = set(keep), narrow
        self._folder = folder
        self._built: dict[str, DataFrame] = {}
        self._seen: dict[str, Observation] = {}

    @property
    def folder(self) -> str:
        if self._folder is None:
            self._folder = f"{shared_dir(self.spark)}/models-{uuid.uuid4().hex}"
        return self._folder

    def model(self, name: str) -> DataFrame:
        if name not in self._built:
            df = self._builders()[name]()
            if name in self.keep:
                path = f"{self.folder}/{name}"
                watched, self._seen[name] = watch.watch(df, name, quality.SUITES.get(name, []))
                watched.write.mode("overwrite").parquet(path)
                df = self.spark.read.schema(df.schema).parquet(path)
            self._built[name] = df
        return self._built[name]

    def checked(self, name: str, minimum: int = 1) -> DataFrame:
        """The declared checks of a kept model, counted while it was written."""
        written = self.model(name)
        return watch.results(written, name, quality.SUITES.get(name, []), self._seen[name], minimum)

    def use(self, name: str, written: DataFrame) -> None:
        """Let later models read a table that holds the model's rows."""
        self._built[name] = written

    def close(self) -> None:
        """Drop the written models; frames built on them cannot be read any more."""
        if self._folder is not None:
            tables.drop(self.spark, self._folder)
        self._built.clear()

    def _only(self, columns: Sequence[str]) -> Sequence[str] | None:
        return list(columns) if self.narrow else None

    def _tracking(self) -> DataFrame:
        if self.sources.tracking is not None:
            return staging.stg_exception_status(self.sources.tracking)
        schema = "case_id string, processing_status string, handled_by string, note string"
        return self.spark.createDataFrame([], schema)

    def _schedule(self, with_staff: bool = False) -> DataFrame:
        names = ("mart_profiles", "stg_profiles", "stg_timekeep", "mart_approvals")
        return compliance.schedule_daily(*map(self.model, names), self.cfg, with_staff)

    def _schedule_with_staff(self) -> DataFrame:
        """The written schedule where there is one; else its rows with the employee's columns,
        which are then joined once a person instead of once a day."""
        name = "mart_compliance_schedule_daily"
        return self.model(name) if name in self.keep or name in self._built else self._schedule(with_staff=True)

    def _builders(self) -> dict[str, Callable[[], DataFrame]]:
        src, cfg, get = self.sources, self.cfg, self.model
        timekeep_input = list(dict.fromkeys(marts.ATTENDANCE_INPUT + compliance.TIMEKEEP_INPUT))
        return {
            "stg_profiles": lambda: staging.stg_profiles(
                src.profiles, self._only(marts.PROFILE_INPUT)
            ),
            "stg_approvals": lambda: staging.stg_approvals(
                src.approvals, self._only(marts.APPROVAL_INPUT)
            ),
            "stg_approval_details": lambda: staging.stg_approval_details(
                src.details, cfg, self._only(marts.DETAIL_INPUT)
            ),
            "stg_timekeep": lambda: staging.stg_timekeep(
                src.timekeep, self._only(timekeep_input)
            ),
            "stg_hr_master_data": lambda: staging.stg_hr_master_data(src.hr_master),
            "stg_exception_status": self._tracking,
            "int_approval_details_flat": lambda: marts.int_approval_details_flat(
                get("stg_approval_details")
            ),
            "dim_date": lambda: spine.dim_date(self.spark, cfg),
            "mart_profiles": lambda: marts.mart_profiles(
                get("stg_profiles"), get("stg_approvals"), get("stg_timekeep"), cfg
            ),
            "mart_approvals": lambda: marts.mart_approvals(
                get("stg_approval_details"), get("stg_approvals"), get("stg_profiles")
            ),
            "mart_attendance_events": lambda: marts.mart_attendance_events(
                get("stg_timekeep"), get("stg_profiles")
            ),
            "mart_employee_events": lambda: marts.mart_employee_events(get("mart_profiles")),
            "mart_headcount_snapshot": lambda: marts.mart_headcount_snapshot(
                get("stg_profiles"), cfg
            ),
            "mart_compliance_approval_timing": lambda: compliance.approval_timing(
                get("mart_approvals"), get("mart_profiles"), cfg
            ),
            "mart_compliance_schedule_daily": self._schedule,
            "mart_compliance_exception_detail": lambda: compliance.exception_detail(
                self._schedule_with_staff(),
                get("mart_profiles"),
                get("stg_profiles"),
                get("mart_compliance_approval_timing"),
                get("stg_exception_status"),
            ),
            "mart_compliance_kpi_overview": lambda: compliance.kpi_overview(
                get("mart_compliance_exception_detail"),
                get("mart_compliance_approval_timing"),
                get("mart_profiles"),
                cfg,
            ),
            "mart_compliance_kpi_by_dept": lambda: compliance.kpi_by_dept(
                get("mart_compliance_exception_detail"), get("mart_profiles"), cfg
            ),
        }


def skipped_models(has_hr_sheet: bool) -> list[str]:
    """Models a run leaves as they are while the HR sheet is missing."""
    return [] if has_hr_sheet else list(NEEDS_HR_SHEET)


def run(
    spark: SparkSession, sources: Sources, cfg: Settings, root: str, models: Sequence[str] = MARTS
) -> dict[str, str]:
    """Publish the marts under ``root``; returns the data folder of each version published.

    A mart is a table of versions (``versions``): readers keep the one they hold, a run that
    dies leaves all marts readable, and ``versions.read`` finds the newest. Later models read
    what was published, so a plain mart is written once; a daily one is written to the staging
    folder first, since its layout samples it. A mart skipped for want of the HR sheet keeps its
    versions; other marts that need it build on a fresh one in the staging folder.
    """
    skipped = set(skipped_models(sources.hr_master is not None))
    folder = tables.layer_path(root, uuid.uuid4().hex, "STG")
    chosen = [m for m in MARTS if m in models and m not in skipped]
    shared = ["stg_profiles", "stg_approvals", "stg_approval_details", "stg_timekeep"]
    shared += [m for m in MARTS if m not in chosen or m in PARTITIONED]
    pipeline = Pipeline(spark, sources, cfg, keep=shared, folder=folder)
    written = {}
    try:
        for name in chosen:
            path = tables.layer_path(root, name, "MART")
            versions.recover(spark, path)
            df = pipeline.model(name)
            if name in PARTITIONED:
                day = PARTITIONED[name]
                versions.publish(tables.daily_layout(df, day, "personnel_code"), path, day)
            else:
                versions.publish(df, path)
            versions.expire(spark, path)
            written[name] = versions.current(spark, path)
            pipeline.use(name, spark.read.schema(df.schema).parquet(written[name]).select(*df.columns))
    finally:
        pipeline.close()
    return written


def check_all(pipeline: Pipeline, models: Sequence[str]) -> DataFrame:
    """Declared checks of the given models, as one result table."""
    parts = [
        quality.run_checks(pipeline.model(m), m, quality.SUITES[m])
        for m in models
        if m in quality.SUITES
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.orderBy(F.col("model"), F.col("column_name"), F.col("check"))
