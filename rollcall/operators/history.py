"""Type-2 history with the check strategy."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What each kept history watches.
STAFF_HISTORY_KEY = "ID"
STAFF_HISTORY_COLUMNS = ["department_full", "position_title", "job_status", "salary_real"]
PLACEMENT_HISTORY_COLUMNS = [
    "department_id",
    "department_full",
    "position_id",
    "position_title",
    "job_status",
    "job_title",
    "work_place",
]


def open_history(batch: DataFrame, ts: dt.datetime) -> DataFrame:
    """First load: every row becomes an open version."""
    return batch.withColumns(
        {"valid_from": F.lit(ts), "valid_to": F.lit(None).cast("timestamp")}
    )


def scd2_check(
    history: DataFrame, batch: DataFrame, key: str, check: Sequence[str], ts: dt.datetime
) -> DataFrame:
    """Merge a batch (one row per key) into a history.

    A version opens when any checked column differs, NULL being equal to NULL;
    the version it replaces closes at ``ts``. Keys absent from the batch stay
    open. Closed versions pass through untouched; only open ones are joined.
    """
    data = [c for c in history.columns if c not in ("valid_from", "valid_to")]
    now = F.lit(ts)
    closed = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull())

    old = current.select(
        F.col(key).alias("_ok"), F.struct(*data).alias("_old"), "valid_from"
    )
    new = batch.select(F.col(key).alias("_nk"), F.struct(*data).alias("_new"))
    both = old.join(new, F.col("_ok") == F.col("_nk"), "full_outer")

    same = F.lit(True)
    for c in check:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    had, got = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    changed = had & got & ~same

    version = lambda row, start, end: F.struct(
        F.col(row).alias("row"),
        start.cast("timestamp").alias("valid_from"),
        end.cast("timestamp").alias("valid_to"),
    )
    versions = F.array(
        F.when(had, version("_old", F.col("valid_from"), F.when(changed, now))),
        F.when(got & (~had | changed), version("_new", now, F.lit(None))),
    )
    merged = (
        both.select(F.explode(versions).alias("v"))
        .filter(F.col("v").isNotNull())
        .select("v.row.*", "v.valid_from", "v.valid_to")
    )
    return closed.select(*merged.columns).unionByName(merged)
