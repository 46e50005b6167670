"""Request changes as a stream of landed files, folded forward-only.

Each micro-batch is written to its own ``batch_id`` folder of a change log, so a
replayed batch overwrites itself and the log holds every change exactly once.

The current state is the forward-only pick over the log. :func:`fold` writes that pick
as a snapshot that names the last batch it holds; from then on readers take the
snapshot and the batches after it, so a read costs the state and the tail and not the
whole log. The pick is a least row by (settled, batch, sequence), so picking again
over a snapshot and later batches gives what the whole log would give. :func:`compact`
writes a state as a plain table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from rollcall.operators.latest import forward_first
from rollcall.sources import tables

BATCH, UPTO = "batch_id", "upto"
SNAPSHOTS = "snapshots"


def landed_files(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    fmt: str = "parquet",
    glob: str = "*",
    files: int = 1000,
) -> DataFrame:
    """New files of a landing folder as a stream, ``files`` at most in a batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    reader = reader.option("maxFilesPerTrigger", files)
    return reader.format(fmt).load(folder)


def log_changes(changes: DataFrame, log: str, checkpoint: str) -> None:
    """Drain what has landed so far into the change log, then stop."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/{BATCH}={batch_id}")

    query = (
        changes.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _numbers(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the complete ``name=<number>`` folders; a write that died has no success file."""
    if not tables.exists(spark, folder):
        return []
    found = []
    for status in tables._fs(spark, folder)[0].listStatus(tables._fs(spark, folder)[1]):
        key, _, number = status.getPath().getName().partition("=")
        if key == name and number.isdigit() and tables.exists(spark, f"{folder}/{key}={number}/_SUCCESS"):
            found.append(int(number))
    return sorted(found)


def _pick(
    spark: SparkSession, log: str, schema: StructType, order: tuple[str, str, str], snapshot: int | None, batches: list[int]
) -> DataFrame:
    """The forward-only pick over a snapshot and some batches, with the batch each row came in."""
    key, status, seq = order
    whole = StructType([*schema.fields]).add(BATCH, LongType())
    rows = spark.createDataFrame([], whole)
    if batches:
        paths = [f"{log}/{BATCH}={n}" for n in batches]
        rows = spark.read.schema(whole).option("basePath", log).parquet(*paths)
    if snapshot is not None:
        rows = rows.unionByName(spark.read.schema(whole).parquet(f"{log}/{SNAPSHOTS}/{UPTO}={snapshot}"))
    return forward_first(rows, key, status, [F.col(BATCH).asc(), F.col(seq).asc()])


def _parts(spark: SparkSession, log: str) -> tuple[list[int], list[int]]:
    """Snapshots, and the batches after the newest of them."""
    snapshots = _numbers(spark, f"{log}/{SNAPSHOTS}", UPTO)
    last = snapshots[-1] if snapshots else -1
    return snapshots, [n for n in _numbers(spark, log, BATCH) if n > last]


def current_state(
    spark: SparkSession, log: str, schema: StructType, key: str, status: str, seq: str
) -> DataFrame:
    """One row per key: first settled change, else the first change. Reads the newest snapshot and later batches."""
    snapshots, tail = _parts(spark, log)
    return _pick(spark, log, schema, (key, status, seq), snapshots[-1] if snapshots else None, tail).drop(BATCH)


def fold(spark: SparkSession, log: str, schema: StructType, key: str, status: str, seq: str) -> int:
    """Fold the batches that have come since into a new snapshot; the last batch it holds, -1 for an empty log.

    Batches of the snapshot before, and snapshots older than it, are dropped: a reader
    that began before this fold keeps what it reads until the next one. A folded batch
    that the stream replays is written again and read by nobody. Run it between drains.
    """
    snapshots, tail = _parts(spark, log)
    last = snapshots[-1] if snapshots else None
    if not tail:
        return -1 if last is None else last
    state = _pick(spark, log, schema, (key, status, seq), last, tail)
    state.write.mode("overwrite").parquet(f"{log}/{SNAPSHOTS}/{UPTO}={tail[-1]}")
    if last is not None:
        for number in _numbers(spark, log, BATCH):
            if number <= last:
                tables.drop(spark, f"{log}/{BATCH}={number}")
    for number in snapshots[:-1]:
        tables.drop(spark, f"{log}/{SNAPSHOTS}/{UPTO}={number}")
    return tail[-1]


def compact(state: DataFrame, path: str) -> None:
    """Write the current state as a plain table."""
    tables.replace(state, path)
