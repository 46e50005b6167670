"""Calendar, per-person day spine and month running counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.functions import safe
from rollcall.settings import Settings

# Calendar names, January and Sunday first.
MONTH_NAMES = [f"Tháng {n}" for n in range(1, 13)]
DAY_NAMES = ["Chủ nhật", "Thứ 2", "Thứ 3", "Thứ 4", "Thứ 5", "Thứ 6", "Thứ 7"]


def calendar_columns(day: Column) -> list[Column]:
    """Calendar attributes of a date column."""
    sunday_first = F.dayofweek(day)
    names = lambda values, at: F.element_at(F.array(*map(F.lit, values)), at)
    return [
        F.year(day).cast("long").alias("year"),
        F.month(day).cast("long").alias("month"),
        F.dayofmonth(day).cast("long").alias("day"),
        F.quarter(day).cast("long").alias("quarter"),
        F.when(sunday_first == 1, 7).otherwise(sunday_first - 1).cast("long").alias("day_of_week"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        names(MONTH_NAMES, F.month(day)).alias("month_name"),
        names(DAY_NAMES, sunday_first).alias("day_name"),
        (~sunday_first.isin(1, 7)).alias("is_weekday"),
    ]


def dim_date(spark: SparkSession, cfg: Settings) -> DataFrame:
    """One row per day of the configured calendar."""
    days = F.sequence(F.lit(cfg.calendar_start), F.lit(cfg.calendar_end))
    base = spark.range(1).select(F.explode(days).alias("date"))
    return base.select("date", *calendar_columns(F.col("date")))


def day_spine(df: DataFrame, start: str, end: str, cfg: Settings, out: str) -> DataFrame:
    """One row per day from ``start`` to ``end``, inside the calendar.

    The row generates its own days, so no range join is needed.
    """
    first = F.greatest(F.col(start), F.lit(cfg.calendar_start))
    last = F.least(F.col(end), F.lit(cfg.calendar_end))
    return (
        df.filter(F.col(start).isNotNull() & F.col(end).isNotNull() & (first <= last))
        .withColumn(out, F.explode(F.sequence(first, last)))
    )


def month_headcount(
    people: DataFrame, group: list[str], code: str, joined: str, left: str, cfg: Settings
) -> DataFrame:
    """People ever joined, and still active, per group and month.

    A person adds one from the join month on and stops being active from the
    leave month on. Those steps are summed per month (partial sums before the
    shuffle, whatever a group's size), then run up over the months of a group,
    of which there are as many as the calendar has. No month is compared with
    any person.
    """
    floor = F.lit(cfg.headcount_start.replace(day=1))
    last = F.lit(cfg.as_of.replace(day=1))
    enter = F.greatest(F.trunc(joined, "month"), floor)
    leave = F.greatest(enter, F.trunc(left, "month"))
    known = F.col(code).isNotNull().cast("long")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    steps = F.array(
        F.struct(enter.alias("m"), known.alias("total"), one.alias("active")),
        F.struct(
            F.when(F.col(left).isNotNull(), leave).alias("m"),
            none.alias("total"),
            (-one).alias("active"),
        ),
    )
    monthly = (
        people.filter(F.col(joined).isNotNull())
        .select(*group, F.explode(steps).alias("s"))
        .select(*group, "s.*")
        .filter(F.col("m") <= last)
        .groupBy(*group, "m")
        .agg(F.sum("total").alias("total"), F.sum("active").alias("active"))
    )
    in_group = Window.partitionBy(*group).orderBy("m")
    run = in_group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.add_months(F.lead("m").over(in_group), -1), last)
    return (
        monthly.select(
            *group,
            "m",
            F.sum("total").over(run).alias("total_employees"),
            F.sum("active").over(run).alias("active_employees"),
            until.alias("until"),
        )
        .withColumn(
            "snapshot_month", F.explode(F.expr("sequence(m, until, interval 1 month)"))
        )
        .select("snapshot_month", *group, "total_employees", "active_employees")
    )


def is_six_day_week(day: Column, cfg: Settings) -> Column:
    """Weeks an even count away from the anchor week include Saturday."""
    return safe.weeks_between(day, F.lit(cfg.six_day_anchor_monday)) % 2 == 0
