"""Table writes: replace, append, window replace, keyed upsert, verified rewrite.

Tables are Parquet folders. A write that derives from the table it replaces goes
to a side folder first and is swapped in by rename, so a lost executor or a
killed job never leaves a half-written table; :func:`recover` finishes or drops
an interrupted swap.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.latest import forward_first

# Naming of landed tables and of their side copies.
SIDE_SUFFIX = "__renew"
LANDED_PREFIX = "RAW_"
RENEW_DAYS = 30


def layer_path(root: str, model: str, layer: str | None = None, default: str = "main") -> str:
    """A layer name is used as given; without one the default layer applies."""
    return f"{root}/{layer.strip() if layer is not None else default}/{model}"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def drop(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, p = _fs(spark, src)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(dst)):
        raise OSError(f"cannot move {src} to {dst}")


def _swap_in(spark: SparkSession, path: str) -> None:
    drop(spark, path)
    _rename(spark, path + SIDE_SUFFIX, path)


def replace(df: DataFrame, path: str) -> None:
    """Write the whole table; ``df`` may read the table it replaces."""
    df.write.mode("overwrite").parquet(path + SIDE_SUFFIX)
    _swap_in(df.sparkSession, path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def window_rows(old: DataFrame, new: DataFrame, day: str, start: str) -> DataFrame:
    """Old rows before ``start`` and the newly landed days.

    Old days on or after ``start`` go even when the new pull lacks them.
    """
    return old.filter(F.col(day) < start).unionByName(new)


def upsert_rows(
    old: DataFrame, changed: DataFrame, key: str, status: str, seq: str
) -> DataFrame:
    """Drop old rows of changed keys, add the changed ones, keep one per key.

    Rows with a NULL key never match a changed key and stay in the contest for
    the single NULL-key row. Rows carry ``seq``, their input order.
    """
    kept = old.join(changed.select(key).distinct(), key, "left_anti")
    return forward_first(kept.unionByName(changed), key, status, [F.col(seq).asc()])


FILE_ROWS = 5_000_000


def daily_layout(df: DataFrame, day: str, person: str) -> DataFrame:
    """The same rows, those of a day and person close together.

    Range partitioning on day, person and a row hash splits a day, or a person
    within a day, that holds a large share of the rows over several tasks. It
    samples ``df`` first, so pass a written table rather than a long plan.
    """
    spread = F.xxhash64(*df.columns)
    return df.repartitionByRange(F.col(day), F.col(person), spread).sortWithinPartitions(day, person)


def write_mart(df: DataFrame, path: str, day: str, person: str, file_rows: int = FILE_ROWS) -> None:
    """Daily partitions in the layout of :func:`daily_layout`."""
    (
        daily_layout(df, day, person)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", file_rows)
        .partitionBy(day)
        .parquet(path + SIDE_SUFFIX)
    )
    _swap_in(df.sparkSession, path)


def verified_rewrite(spark: SparkSession, path: str) -> bool:
    """Rewrite a table through a side copy; keep the original when counts differ."""
    side = path + SIDE_SUFFIX
    spark.read.parquet(path).write.mode("overwrite").parquet(side)
    return swap_if_equal(spark, path)


def swap_if_equal(spark: SparkSession, path: str) -> bool:
    """Swap the side copy in if it has as many rows as the original, else drop it."""
    side = path + SIDE_SUFFIX
    if spark.read.parquet(path).count() != spark.read.parquet(side).count():
        drop(spark, side)
        return False
    _swap_in(spark, path)
    return True


def recover(spark: SparkSession, path: str) -> str:
    """Clear up after an interrupted rewrite: ``clean``, ``dropped`` or ``restored``."""
    side = path + SIDE_SUFFIX
    if not exists(spark, side):
        return "clean"
    if exists(spark, path):
        drop(spark, side)
        return "dropped"
    _rename(spark, side, path)
    return "restored"


def expiring(tables: DataFrame, name: str, expires: str, now: dt.datetime, days: int = RENEW_DAYS):
    """Landed tables, side copies aside, that expire within ``days``."""
    deadline = F.lit(now + dt.timedelta(days=days)).cast("timestamp")
    return tables.filter(
        F.col(name).startswith(LANDED_PREFIX)
        & ~F.col(name).endswith(SIDE_SUFFIX)
        & (F.col(expires) <= deadline)
    )
