"""Near-duplicate vectors by random-hyperplane signs, exact cosine and components (operator 4).

Equal vectors form one class. A class is posted under the sign pattern of ``BITS``
random hyperplanes in each of ``TABLES`` tables; classes that share a pattern meet
in a block of bounded size and their cosine is computed in double precision. A
pair is counted only in the first table where it meets, so links per vector are
sums, and a block hands on a spanning forest of its links instead of all pairs.

Two vectors of cosine 0.9 agree on one hyperplane with probability 0.856, and miss
each other in all 48 tables of 14 with probability 0.003; of cosine 0.95, 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import block_numbers, buckets_in_blocks, checkpointed, col, spread, whole_blocks
from rollcall.llm.components import components

COSINE = 0.9
TABLES = 48
BITS = 14
BLOCK = 1024

_KEYS = ("_bucket", "lo", "hi")


def usable(vector) -> object:
    """Not null, not empty, every component finite, not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~odd & F.exists(vector, lambda x: x != 0)


def _matrix(lists: pa.Array) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, against overflow."""
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    values = values / np.abs(values).max(1, keepdims=True)
    return values / np.sqrt((values * values).sum(1, keepdims=True))


def planes(size: int) -> np.ndarray:
    return np.random.default_rng([size, 4]).standard_normal((size, TABLES * BITS))


def _signs(unit: np.ndarray) -> np.ndarray:
    bits = (unit @ planes(unit.shape[1]) >= 0).reshape(len(unit), TABLES, BITS)
    return (bits @ (1 << np.arange(BITS))).astype(np.int16 if BITS < 16 else np.int32)


def _signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = np.asarray(batch.column("_vector").value_lengths())
        for width in np.unique(size):
            rows = batch.take(pa.array(np.flatnonzero(size == width)))
            signs = _signs(_matrix(rows.column("_vector")))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(signs.ravel()), TABLES).cast(pa.list_(pa.int16()))
            yield pa.RecordBatch.from_arrays([*rows.columns, lists], [*rows.schema.names, "_sign"])


def _roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least row number of each row's group."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _by_width(rows: pa.Table) -> Iterator[pa.Table]:
    """The rows whose vectors have the same length, in their order."""
    size = rows.column("_vector").combine_chunks().value_lengths().to_numpy()
    widths = np.unique(size)
    for width in widths:
        yield rows.take(pa.array(np.flatnonzero(size == width))) if len(widths) > 1 else rows


def _linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row of a block: how many vectors it links to there, and the root of its links."""
    for rows in (part for whole in whole_blocks(batches, _KEYS) for part in _by_width(whole)):
        block, lists = block_numbers(rows, _KEYS), rows.column("_vector").combine_chunks()
        unit = _matrix(lists)
        signs = rows.column("_sign").combine_chunks().flatten().to_numpy().reshape(len(unit), TABLES)
        table, copies = rows.column("_table").to_numpy(), rows.column("_copies").to_numpy()
        chunk = rows.column("chunk").to_numpy()
        mixed = rows.column("lo").to_numpy() != rows.column("hi").to_numpy()
        keys = rows.column("_key").to_numpy()
        links, ends = np.zeros(len(unit), np.int64), ([], [])
        i, lag = np.arange(len(unit)), 0
        while len(i):
            lag += 1
            i = i[i + lag < len(unit)]
            i = i[block[i] == block[i + lag]]
            a = i[~mixed[i] | (chunk[i] != chunk[i + lag])]
            b = a + lag
            near = np.einsum("ij,ij->i", unit[a], unit[b]) >= COSINE
            a, b = a[near], b[near]
            same = signs[a] == signs[b]
            first = same.argmax(1) == table[a]  # met in no earlier table
            a, b = a[first], b[first]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            ends[0].append(a)
            ends[1].append(b)
        root = _roots(len(unit), *(np.concatenate(x) if x else np.zeros(0, np.int64) for x in ends))
        some = np.flatnonzero(links)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[some]), pa.array(links[some]), pa.array(keys[root[some]])], ["_key", "_links", "_root"]
            )


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per distinct (id, vector).

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing: no links, their own id as component, kept. Vectors of different
    length never link. Rows that repeat id and vector count once; an id with
    several vectors gives a row for each. Null ids take no part and give a row each
    with a null component. An empty table gives no rows.
    """
    rows = vectors.select(col(id_col).cast("long").alias("_id"), col(vector_col).alias("_vector"))
    good = F.col("_id").isNotNull() & usable(F.col("_vector"))
    rows = checkpointed(rows.withColumn("_good", F.coalesce(good, F.lit(False))).distinct())
    used = rows.where("_good")
    classes = checkpointed(
        used.groupBy("_vector")
        .agg(F.min("_id").alias("_rep"), F.count("*").alias("_copies"))
        .withColumn("_key", F.xxhash64("_vector"))
    )
    schema = T.StructType([*classes.schema.fields, T.StructField("_sign", T.ArrayType(T.ShortType()))])
    signed = checkpointed(classes.mapInArrow(_signed, schema))
    postings = signed.select("_key", "_vector", F.posexplode("_sign").alias("_table", "_code")).select(
        F.xxhash64(F.size("_vector"), "_table", "_code").alias("_bucket"), "_key", "_table"
    )
    blocks = buckets_in_blocks(postings, signed.drop("_rep"), "_bucket", "_key", BLOCK)
    linked = checkpointed(blocks.mapInArrow(_linked, "_key bigint, _links bigint, _root bigint"))
    joined = components(linked, "_key", "_root")
    counts = linked.groupBy("_key").agg(F.sum("_links").alias("_links"))
    labelled = (
        classes.join(spread(counts), "_key", "left")
        .join(spread(joined.withColumnRenamed("node", "_key")), "_key", "left")
        .withColumn("_component", F.coalesce("component", "_key"))
    )
    heads = labelled.groupBy("_component").agg(F.min("_rep").alias("component_id"))
    named = labelled.join(spread(heads), "_component").select(
        "_vector", (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("n_links"), "component_id"
    )
    within = used.join(spread(named), "_vector").select(F.col("_id").alias("vec_id"), "n_links", "component_id")
    alone = rows.where("not _good").select(
        F.col("_id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id")
    )
    return within.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
