"""Pieces the operators share: lineage cuts, blocks of hot buckets, Arrow text as bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.settings import shared_dir

#: Bytes of text handled at once inside a task. A longer text is handled alone, whole.
SLICE_BYTES = 500_000


#: Rows handed to a Python worker at once: texts are long, and memory has to hold a batch several times.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> DataFrame:
    """The same frame; its session hands out batches of ``BATCH_ROWS`` rows at most from here on."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH)) <= BATCH_ROWS:
        conf.set(_BATCH, str(BATCH_ROWS))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder that ``spark.checkpoint.dir`` names."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Forget the placement by key, so that a join on a hot key is dealt anew and can be split."""
    return df.hint("rebalance")


#: Rows of a few numbers each that may be broadcast (some ten MB in memory); counted first.
BROADCAST_ROWS = 200_000


def measured(df: DataFrame) -> DataFrame:
    """A written table of short rows, broadcast if it has few of them, else to be dealt by key."""
    written = checkpointed(df)
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else spread(written)


def sampled_texts(df: DataFrame, id_col: str, text_col: str, sample: int) -> list[str]:
    """``sample`` texts at most: those whose id has the least hash, ties by the text's hash; repeated rows once.

    The last place of the sample is found over hashes alone, so no more than the
    sample's own texts leave their partitions. Null texts take no part.
    """
    text = col(text_col).cast("string")
    rows = df.select(F.xxhash64(col(id_col)).alias("_hash"), F.xxhash64(text).alias("_code"), text.alias("_text"))
    rows = rows.where(F.col("_text").isNotNull())
    places = rows.select(F.struct("_hash", "_code").alias("_place"))
    last = places.orderBy("_place").limit(sample).agg(F.max("_place")).first()[0]
    if last is None:
        return []
    chosen = rows.where((F.col("_hash") < last["_hash"]) | ((F.col("_hash") == last["_hash"]) & (F.col("_code") <= last["_code"])))
    return [r["_text"] for r in sorted(chosen.distinct().collect())]


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, alias: str = "_row") -> DataFrame:
    """The whole row as one struct, so that added columns cannot clash with its names."""
    return small_batches(df).select(F.struct(*[col(c).alias(c) for c in df.columns]).alias(alias))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets_in_blocks(postings: DataFrame, payload: DataFrame, bucket: str, ident: str, cap: int) -> DataFrame:
    """Rows of buckets with at least two rows, cut into blocks of about ``2 * cap`` rows.

    ``postings`` are short rows of ``bucket`` and ``ident``; the columns of ``payload``
    are joined to those that are left by ``ident``.

    A bucket of ``n`` rows is dealt into ``c = ceil(n / cap)`` chunks by a hash of
    ``ident``; every pair of chunks is a block (``lo <= hi``), so any two rows of the
    bucket meet: rows of one chunk in the block ``lo = hi``, others in one mixed
    block. No bucket is dropped or cut short, and none is gathered in one task.
    """
    sizes = postings.groupBy(bucket).agg(F.count("*").alias("_n")).where("_n > 1")
    chunks = F.ceil(F.col("_n") / F.lit(cap)).cast("int")
    cut = (
        postings.join(spread(sizes), bucket)
        .withColumn("_chunks", chunks)
        .withColumn("chunk", F.pmod(F.xxhash64(F.lit(17), ident), F.col("_chunks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
        .withColumn("lo", F.least("chunk", "_other"))
        .withColumn("hi", F.greatest("chunk", "_other"))
        .drop("_n", "_chunks", "_other")
        .join(payload, ident)
    )
    return cut.repartition(partitions(postings.sparkSession), bucket, "lo", "hi").sortWithinPartitions(
        bucket, "lo", "hi", ident
    )


def whole_blocks(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Re-cut sorted batches so that rows with equal (integer) keys never span two tables."""
    carry: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        if carry is not None:
            now = pa.concat_tables([carry, now])
        if not now.num_rows:
            continue
        same = np.ones(now.num_rows, bool)
        for key in keys:
            values = now.column(key).to_numpy()
            same &= values == values[-1]
        last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if last:
            yield now.slice(0, last).combine_chunks()
        carry = now.slice(last).combine_chunks()
    if carry is not None and carry.num_rows:
        yield carry


def block_numbers(rows: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    """0, 1, 2, … per run of equal keys."""
    change = np.zeros(rows.num_rows, bool)
    for key in keys:
        values = rows.column(key).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.cumsum(change)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    cuts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[cuts[0] : cuts[-1]], cuts - cuts[0]


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each, at least one row long."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(seed: int, count: int) -> np.ndarray:
    """Odd 64-bit multipliers, the same on every machine."""
    start = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(start + mix(np.array([seed], np.uint64))) | np.uint64(1)
