"""Envelope and nested-array unnesting, and the way back into envelopes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import jsonx


def unnest_envelope(df: DataFrame, raw: str, keep: Sequence[str], out: str = "rec") -> DataFrame:
    """One row per record of ``{"data": [...]}``; empty or absent arrays drop the row.

    ``keep`` lists SQL columns that every record of an envelope carries.
    """
    return df.selectExpr(*keep, f"explode(from_json({raw}, 'data array<string>').data) AS {out}")


def two_level(
    df: DataFrame,
    kinds: dict[str, str],
    outer_scalars: Sequence[str],
    inner_keys: Sequence[str],
    inner_scalars: Sequence[str],
    keep_parent: bool = False,
) -> DataFrame:
    """Unnest ``kind[] -> element -> detail[]`` for all kinds in one pass.

    ``kinds`` maps a kind name to the column with its array as JSON text.
    ``inner_keys`` are the keys under which an element may hold its inner array.
    Adds ``kind``, ``outer_rec``, ``outer_j``, ``inner_rec`` and ``inner_j``;
    elements without an inner array are dropped, empty inner arrays keep a row
    with NULL ``inner_rec``. With ``keep_parent`` every input row also yields one
    row of its own, with NULL ``kind``.
    """
    pairs = [F.struct(F.lit(k).alias("kind"), F.col(c).alias("items")) for k, c in kinds.items()]
    if keep_parent:
        nothing = F.lit(None).cast("string")
        pairs.append(F.struct(nothing.alias("kind"), nothing.alias("items")))
    parent = F.col("kind").isNull()
    rest = [c for c in df.columns if c not in kinds.values()]
    outer = df.select(*rest, F.explode(F.array(*pairs)).alias("_p")).select(
        *rest, "_p.kind", "_p.items"
    )
    outer = outer.filter(parent | jsonx.has_items(F.col("items")))
    outer = outer.select(
        *rest, "kind", F.explode_outer(jsonx.elements(F.col("items"))).alias("outer_rec")
    )
    outer = outer.withColumn(
        "outer_j", jsonx.record_struct(F.col("outer_rec"), outer_scalars, arrays=inner_keys)
    )
    # NULL drops the element and an empty array keeps it, in one generator: a
    # filter in between would parse the element a second time.
    alone = F.array(F.lit(None).cast("string"))
    items = F.when(parent, alone).otherwise(jsonx.present_or_null(inner_array(inner_keys)))
    inner = outer.select("*", F.explode(items).alias("inner_rec"))
    return inner.withColumn("inner_j", jsonx.record_struct(F.col("inner_rec"), inner_scalars))


def inner_array(inner_keys: Sequence[str], kind: str = "kind") -> Column:
    """Elements of the inner array that belongs to the row's kind.

    Only check-in corrections use ``inoutinfo``; every other kind uses ``detail``.
    """
    by_key = {k: F.col(f"outer_j.{k}") for k in inner_keys}
    return F.when(F.col(kind) == "inout", by_key["inoutinfo"]).otherwise(by_key["detail"])


def pack_envelopes(df: DataFrame, size: int, record: str = "rec") -> DataFrame:
    """Pack records (JSON text) into envelopes of at most ``size``.

    Runs inside each partition over Arrow batches: no shuffle, no group that
    could grow beyond ``size`` records, and the union of all envelopes is
    exactly the input.
    """

    def envelope(rows: list[str]) -> str:
        return '{"data":[' + ",".join(rows) + '],"error":false}'

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[str] = []
        for batch in batches:
            waiting.extend(batch[record])
            full = len(waiting) // size * size
            if full:
                out = [envelope(waiting[i : i + size]) for i in range(0, full, size)]
                yield pd.DataFrame({"RAW_DATA": out})
                waiting = waiting[full:]
        if waiting:
            yield pd.DataFrame({"RAW_DATA": [envelope(waiting)]})

    return df.select(record).filter(F.col(record).isNotNull()).mapInPandas(
        pack, "RAW_DATA string"
    )
