"""A load as one run: landed files, RAW tables, marts, histories, checks.

Every step may be run again after it died: files are entered in a ledger once, attendance
days are exchanged as partitions, marts and histories are published by one small write.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import safe
from rollcall.operators import history, quality
from rollcall.plans import staging
from rollcall.plans.pipeline import MARTS, run
from rollcall.settings import Settings, shared_dir
from rollcall.sources import histories, landing, layouts, raw
from rollcall.sources.tables import drop, exists

TABLES = ("profiles", "approvals", "details", "timekeep")
DAY = "SYNC_DATE"
HISTORIES = {"staff": history.STAFF_HISTORY_COLUMNS, "placement": history.PLACEMENT_HISTORY_COLUMNS}


@dataclass
class Report:
    """What a run did: new files by table, days that vanished, mart folders, checks of the marts."""

    files: dict[str, int]
    gone_days: list[str]
    marts: dict[str, str]
    checks: DataFrame | None


def window_start(spark: SparkSession, at: dt.datetime, days_back: int) -> str:
    """First day a reload at ``at`` covers, as text."""
    start = safe.window_start(F.lit(at).cast("timestamp"), days_back)
    return spark.range(1).select(F.date_format(start, "yyyy-MM-dd")).first()[0]


def place_days(spark: SparkSession, root: str, days_back: int) -> list[str]:
    """Bring attendance loads into the table by days, oldest load first; the days that vanished.

    A load replaces every day from the start of its window on. Which loads are in is
    entered after each, and a load brought in twice in a row gives the same table.
    """
    path, done = f"{root}/DAYS/timekeep", f"{root}/LEDGER/timekeep_days"
    placed = {r[0] for r in spark.read.schema("load string").parquet(done).collect()} if exists(spark, done) else set()
    # One row a load.
    loads = landing.ledger(spark, root, "timekeep").groupBy(landing.LOAD).agg(F.min("loaded_at").alias("at"))
    gone = []
    for load, at in sorted(loads.filter(~F.col(landing.LOAD).isin(sorted(placed))).collect(), key=lambda r: (r[1], r[0])):
        rows = landing.read_raw(spark, root, "timekeep").filter(F.col(landing.LOAD) == load).drop("file", landing.LOAD)
        if exists(spark, path):
            gone += layouts.replace_days(rows, path, DAY, window_start(spark, at, days_back))
        else:
            layouts.write_days(rows, path, DAY)
        spark.createDataFrame([(load,)], "load string").coalesce(1).write.mode("append").parquet(done)
    return gone


def sources(spark: SparkSession, root: str, hr_master: DataFrame | None = None, tracking: DataFrame | None = None) -> raw.Sources:
    """The RAW tables of a root as sources of the models."""
    path, schema = f"{root}/DAYS/timekeep", raw.TIMEKEEP_SCHEMA
    days = spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
    landed = [landing.read_raw(spark, root, t).drop("file", landing.LOAD) for t in TABLES[:3]]
    return raw.Sources(*landed, days, hr_master, tracking)


def load(
    spark: SparkSession,
    landed: str,
    root: str,
    cfg: Settings,
    at: dt.datetime,
    hr_master: DataFrame | None = None,
    tracking: DataFrame | None = None,
    models: Sequence[str] = MARTS,
    days_back: int = 3,
) -> Report:
    """Take what has landed below ``landed/<table>`` since the last run and bring ``root`` up to date.

    Profiles, requests and documents are appended (staging picks the newest); new documents
    also go to the request list; attendance days are replaced from the window's start on. Then
    the marts are published, the two histories take the newest profiles, and the declared
    checks of the marts are made. ``at`` stamps rows that carry no time of their own.
    """
    files = {}
    for table in TABLES:
        folder = f"{landed}/{table}"
        files[table] = landing.load_new(spark, folder, table, root, at, table != "details") if exists(spark, folder) else 0
    landing.list_documents(spark, root, at)
    gone = place_days(spark, root, days_back)
    source = sources(spark, root, hr_master, tracking)
    marts = run(spark, source, cfg, root, models)
    if files["profiles"]:
        load_histories(spark, staging.stg_profiles(source.profiles, columns_of_histories()), root, at)
    checks = [quality.run_checks(spark.read.parquet(p), m, quality.SUITES[m]) for m, p in marts.items() if m in quality.SUITES]
    result = checks[0] if checks else None
    for more in checks[1:]:
        result = result.unionByName(more)
    return Report(files, gone, marts, result)


def load_histories(spark: SparkSession, people: DataFrame, root: str, at: dt.datetime) -> None:
    """Bring both histories up to date. The profiles are written first, so they are parsed and picked once."""
    key, side = history.STAFF_HISTORY_KEY, f"{shared_dir(spark)}/people-{uuid.uuid4().hex}"
    try:
        people.write.parquet(side)
        written = spark.read.schema(people.schema).parquet(side)
        for name, check in HISTORIES.items():
            histories.load(written.select(key, *check), f"{root}/HISTORY/{name}", key, check, at)
    finally:
        drop(spark, side)


def columns_of_histories() -> list[str]:
    return list(dict.fromkeys([history.STAFF_HISTORY_KEY, *(c for check in HISTORIES.values() for c in check)]))
