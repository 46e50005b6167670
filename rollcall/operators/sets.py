"""Set operations with SQL's NULL rules."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def presence(ids: DataFrame, key: str) -> tuple[Column, Column]:
    """Whether there are any rows, and whether a key among them is NULL, from one pass."""
    facts = F.struct((F.count("*") > 0).alias("any"), (F.count_if(F.col(key).isNull()) > 0).alias("unknown"))
    seen = ids.agg(facts.alias("seen")).select("seen").scalar()
    return seen.getField("any"), seen.getField("unknown")


def not_in(df: DataFrame, key: str, ids: DataFrame, id_key: str) -> DataFrame:
    """``key NOT IN (SELECT id_key ...)``.

    An anti join on the key, plus the two NULL cases: a NULL among the ids rules
    every row out, and a row with NULL key is in only when there are no ids.
    Unlike the SQL form, no side has to fit in one executor.
    """
    some_id, some_null = presence(ids, id_key)
    found = ids.select(F.col(id_key).alias("_id"))
    rest = df.join(found, F.col(key) == F.col("_id"), "left_anti")
    return rest.filter(~some_null & (F.col(key).isNotNull() | ~some_id))


def union_distinct_ids(*ids: DataFrame) -> DataFrame:
    """Distinct ids of several one-column frames, each reduced before the union."""
    parts = [d.toDF("id").distinct() for d in ids]
    return functools.reduce(DataFrame.union, parts).distinct()


def union_of_distinct(*branches: DataFrame) -> DataFrame:
    """Every branch without its own repeats; rows of different branches stay."""
    return functools.reduce(DataFrame.unionByName, [b.distinct() for b in branches])


def flag_members(df: DataFrame, key: str, members: DataFrame, member: str, flag: str) -> DataFrame:
    """Mark rows whose key is among ``members``, without changing their number."""
    listed = members.select(F.col(member).alias("_m")).distinct()
    return (
        df.join(listed, F.col(key) == F.col("_m"), "left")
        .withColumn(flag, F.col("_m").isNotNull())
        .drop("_m")
    )


def first_by_rank(values: list[str], *order: str | Column) -> Column:
    """Aggregate: ``values`` of the lowest row under ``order``, NULL values kept."""
    return F.min_by(F.struct(*values), F.struct(*order))


def text_set(value: Column, separator: str = ",") -> Column:
    """Aggregate: distinct values joined in text order, NULL when there are none."""
    found = F.array_sort(F.collect_set(value.cast("string")))
    return F.when(F.size(found) > 0, F.array_join(found, separator))
