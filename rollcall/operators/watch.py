"""Declared checks taken from a table while it is written.

Null counts, unexpected values and the number of rows are observed on the rows as they pass
into the write, so they cost no scan. Only ``unique`` groups the written table, and a column
with unexpected values is read once more to count the different ones.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rollcall.operators.quality import Check

ROWS = "minimum_rows"


def _failing(check: Check) -> Column | None:
    """Whether a row fails a check; None where one row cannot tell."""
    value = F.col(check.column)
    if check.kind == "not_null":
        failing = value.isNull()
    elif check.kind == "accepted_values":
        failing = value.isNotNull() & ~value.isin(*check.values)
    else:
        return None
    return failing & F.coalesce(F.expr(check.where), F.lit(False)) if check.where else failing


def watch(df: DataFrame, name: str, checks: Sequence[Check]) -> tuple[DataFrame, Observation]:
    """The same rows, to be written as they are, and what is observed on them.

    Write the frame without a further shuffle: then each row is counted by the task that
    writes it, and a task that is run again does not count twice.
    """
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    counts = [F.count(F.lit(1)).alias(ROWS)]
    for number, check in enumerate(checks):
        failing = _failing(check)
        if failing is not None:
            counts.append(F.count_if(failing).alias(f"c{number}"))
    return df.observe(seen, *counts), seen


def results(written: DataFrame, model: str, checks: Sequence[Check], seen: Observation, minimum: int = 1) -> DataFrame:
    """One row per check, as ``quality.run_checks`` gives them, and one for the number of rows.

    The failure of the last is how many rows are missing from ``minimum``. Waits for the
    write that ``seen`` belongs to.
    """
    # A frame that Spark knows to be empty is not observed.
    found = seen.get or {}
    short = max(0, minimum - found.get(ROWS, 0))
    known, counted = [("*", ROWS, short)], []
    for number, check in enumerate(checks):
        failing = found.get(f"c{number}", 0)
        if check.kind == "not_null" or (check.kind == "accepted_values" and not failing):
            known.append((check.column, check.kind, failing))
            continue
        rows = written.filter(check.where) if check.where else written
        values = rows.filter(F.col(check.column).isNotNull()).groupBy(check.column).count()
        bad = F.col("count") > 1 if check.kind == "unique" else ~F.col(check.column).isin(*check.values)
        lines = values.agg(F.count_if(bad).alias("failures"))
        counted.append(lines.select(F.lit(check.column).alias("column_name"), F.lit(check.kind).alias("check"), "failures"))
    first = written.sparkSession.createDataFrame(known, "column_name string, check string, failures bigint")
    return functools.reduce(DataFrame.unionByName, counted, first).select(
        F.lit(model).alias("model"),
        "column_name",
        "check",
        "failures",
        F.when(F.col("failures") == 0, "PASS").otherwise("ERROR").alias("status"),
    )
