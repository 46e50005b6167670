"""Type-2 histories as tables: open versions in one partition, closed ones by the load that closed them.

A load reads the open versions only. Its result is one dynamic partition overwrite: the
partition of open versions is exchanged, the versions that the load closes make a new
partition, and partitions of earlier loads keep their files. So the cost of a load follows
the number of keys and not the length of the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators import history
from rollcall.sources.tables import exists

STATE = "version_state"
OPEN = "open"


def _closed_by(ts: dt.datetime) -> str:
    return ts.strftime("closed-%Y%m%dT%H%M%S%f")


def load(batch: DataFrame, path: str, key: str, check: Sequence[str], ts: dt.datetime) -> None:
    """Bring a batch (one row per key, all columns kept) into the history at ``path``.

    The first load opens a version of every row. Later a version opens when a checked
    column differs (NULL equals NULL) or the key has no open one; a key that a batch lacks
    stays open, so a key that comes back unchanged goes on with its version. A row whose
    other columns alone changed keeps the version as it was opened. A load repeated with
    the same batch changes no version.
    """
    spark = batch.sparkSession
    if not exists(spark, path):
        merged = history.open_history(batch, ts)
    else:
        opened = spark.read.parquet(path).filter(F.col(STATE) == OPEN).drop(STATE)
        merged = history.scd2_check(opened, batch.select(*_data(opened)), key, check, ts)
    state = F.when(F.col("valid_to").isNull(), OPEN).otherwise(_closed_by(ts))
    (
        merged.withColumn(STATE, state)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(STATE)
        .parquet(path)
    )


def _data(opened: DataFrame) -> list[str]:
    return [c for c in opened.columns if c not in ("valid_from", "valid_to")]


def read(spark: SparkSession, path: str, as_of: dt.datetime | None = None) -> DataFrame:
    """All versions, or those that held at a moment (``valid_from <= as_of < valid_to``)."""
    rows = spark.read.parquet(path).drop(STATE)
    if as_of is None:
        return rows
    ended = F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(as_of))
    return rows.filter((F.col("valid_from") <= F.lit(as_of)) & ended)
