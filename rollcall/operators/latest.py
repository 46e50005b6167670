"""Keeping one row per key.

Each is a ``row_number() = 1`` filter. Spark prunes such a window to one row per
key inside every map task before the shuffle, so a key that owns a third of all
rows still sends only one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.settings import PENDING


def first_by(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``order``; the order should be total."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def is_pending(status: Column) -> Column:
    """Pending, with a missing status counted as pending."""
    return F.coalesce(status, F.lit(PENDING)) == PENDING


def forward_latest(
    df: DataFrame, key: str, status: str, order: Sequence[Column]
) -> DataFrame:
    """Latest row per key where any settled status beats a pending one."""
    return first_by(df, [key], [is_pending(F.col(status)).asc(), *order])


def forward_first(df: DataFrame, key: str, status: str, seq: Sequence[Column]) -> DataFrame:
    """First settled row in input order, else the first row.

    Unlike :func:`forward_latest` a missing status counts as settled here.
    """
    pending = F.coalesce(F.col(status), F.lit("")) == PENDING
    return first_by(df, [key], [pending.asc(), *seq])


def settled_first(df: DataFrame, key: str, status: str, tie: Sequence[Column]) -> DataFrame:
    """One row per key, settled status first; a missing status ranks with pending."""
    rank = F.when(F.col(status) != PENDING, 0).otherwise(1)
    return first_by(df, [key], [rank.asc(), *tie])
