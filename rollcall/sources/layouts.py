"""Tables of which a load rewrites a part: day partitions and key buckets.

Both writes are dynamic partition overwrites: the rows go to a staging folder first
and their partitions are exchanged when the job commits, so a partition that holds
none of the rows keeps its files. A job that dies before leaves the table as it was,
and a load that is run again gives the same table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.latest import forward_first
from rollcall.settings import shared_dir
from rollcall.sources.tables import _fs, drop, exists

BUCKET = "_bucket"
#: A NULL partition value, as Spark names its folder.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_files(spark: SparkSession, path: str, column: str) -> dict[str, set[str]]:
    """File names by value of the partition column; one listing a partition, no data read."""
    if not exists(spark, path):
        return {}
    fs, root = _fs(spark, path)
    found = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{column}="):
            files = {f.getPath().getName() for f in fs.listStatus(status.getPath())}
            found[unquote(name.partition("=")[2])] = files
    return found


def _overwrite(df: DataFrame, path: str, column: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def write_days(df: DataFrame, path: str, day: str) -> None:
    """The first load of a table by days; an existing one is replaced as a whole."""
    df.write.mode("overwrite").partitionBy(day).parquet(path)


def replace_days(new: DataFrame, path: str, day: str, start: str) -> list[str]:
    """Replace all days from ``start`` on by the rows of ``new``; the days that vanish are returned.

    Days before ``start`` keep their files, unless ``new`` holds such a day too (it is
    replaced then). A day on or after ``start`` goes when the new pull lacks it, and so
    do rows without a day. Days compare as text (``yyyy-mm-dd``). Rows of one day may
    come from any number of tasks, so a large day is no single task's work.
    """
    spark = new.sparkSession
    before = partition_files(spark, path, day)
    _overwrite(new, path, day)
    after = partition_files(spark, path, day)
    # Files get new names in every write: where all the old ones are left, the pull had nothing.
    stale = [d for d, files in before.items() if files and files <= after.get(d, set())]
    gone = sorted(d for d in stale if d == NO_VALUE or d >= start)
    for value in gone:
        drop(spark, f"{path}/{day}={value}")
    return gone


def latest_day(spark: SparkSession, path: str, day: str) -> str | None:
    """The greatest day a table holds, from the names of its partitions; no data are read."""
    days = [d for d, files in partition_files(spark, path, day).items() if files and d != NO_VALUE]
    return max(days, default=None)


def _clustered(df: DataFrame, day: str) -> DataFrame:
    """Rows of a day close together, a large day over several tasks."""
    return df.repartitionByRange(F.col(day), F.xxhash64(*df.columns))


def refresh_days(build: Callable[[str | None], DataFrame], path: str, day: str, spark: SparkSession) -> str | None:
    """One incremental run of a daily table; the day from which it was built.

    ``build`` gets the greatest day the table holds (None for the first run) and returns
    all rows from that day on. These days are exchanged, so rows that came late on the
    greatest day are neither lost nor doubled; earlier days and rows without a day keep
    their files. The rows are written to the shared folder first: range partitioning reads
    them twice, to sample and to place them, and would build them twice.
    """
    since = latest_day(spark, path, day)
    built, side = build(since), f"{shared_dir(spark)}/days-{uuid.uuid4().hex}"
    try:
        built.write.parquet(side)
        rows = _clustered(spark.read.schema(built.schema).parquet(side), day)
        if since is None:
            write_days(rows, path, day)
        else:
            _overwrite(rows, path, day)
    finally:
        drop(spark, side)
    return since


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key; NULL keys share one."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: str, status: str, seq: str, buckets: int) -> None:
    """Lay a table out by key, one row per key: settled before pending, then input order."""
    once = forward_first(df, key, status, [F.col(seq).asc()])
    placed = once.withColumn(BUCKET, bucket_of(key, buckets))
    placed.write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def upsert_buckets(changed: DataFrame, path: str, key: str, status: str, seq: str, buckets: int) -> list[int]:
    """Bring changed rows into a table laid out by ``write_buckets``; the buckets written are returned.

    Only buckets that hold a changed key are read and written. Old rows of changed keys
    give way to the new ones, whatever their status; a NULL key equals no changed key,
    so old and new rows without a key compete by status and input order. ``buckets``
    must be the number the table was laid out with.
    """
    spark = changed.sparkSession
    new = changed.withColumn(BUCKET, bucket_of(key, buckets))
    # At most ``buckets`` numbers, whatever the load.
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
    if not touched:
        return []
    old = spark.read.parquet(path).filter(F.col(BUCKET).isin(touched)).select(*new.columns)
    kept = old.join(new.select(key).distinct(), key, "left_anti").select(*new.columns)
    once = forward_first(kept.unionByName(new), key, status, [F.col(seq).asc()])
    _overwrite(once.select(*new.columns), path, BUCKET)
    return touched
