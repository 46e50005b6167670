"""Parsing that yields NULL on bad input, and calendar arithmetic by boundaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# What Unicode counts as white space. Spark's own trim knows the
# blank only, while cells and form fields also carry tabs and no-break spaces.
WHITESPACE = (
    "\t\n\u000b\f\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)

# SQL around a text ``{0}``, for column lists that are built as SQL.
DATE_DMY_SQL = f"try_to_date(btrim({{0}}, '{WHITESPACE}'), 'd/M/yyyy')"
TIMESTAMP_SQL = (
    "CASE WHEN trim({0}) RLIKE r'^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}([ Tt]\\d{{1,2}}:\\d{{1,2}}:\\d{{1,2}}"
    "([.]\\d+)?( ?(Z|UTC|[+-]\\d{{1,2}}(:\\d{{2}})?))?)?$' "
    "THEN try_cast(trim({0}) AS TIMESTAMP) END"
)


def strip(text: Column) -> Column:
    """Text without white space, of any kind, at either end."""
    return F.btrim(text, F.lit(WHITESPACE))


def date_dmy(text: Column) -> Column:
    """``8/1/2026`` or ``08/01/2026``; anything after the date makes it NULL."""
    return F.try_to_date(strip(text), "d/M/yyyy")


def date_ymd(text: Column) -> Column:
    return F.try_to_date(strip(text), "yyyy-M-d")


def loader_date(text: Column) -> Column:
    """First ten characters as day/month/year, so a trailing clock is fine."""
    return F.try_to_date(F.substring(text, 1, 10), "d/M/yyyy")


def cast_date(text: Column) -> Column:
    """Tolerant cast of year-month-day text; Spark alone would take ``2026`` too."""
    t = F.trim(text.cast("string"))
    return F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), t.try_cast("date"))


def minute_stamp(day: Column, clock: Column) -> Column:
    """Timestamp from a date and an ``HH:MM`` text; NULL when either is bad."""
    return F.try_to_timestamp(
        F.concat(day.cast("string"), F.lit(" "), clock), F.lit("yyyy-MM-dd H:m")
    )


def clock_minutes(text: Column) -> Column:
    """``HH:MM[:SS]`` cut to minutes; an empty clock means the start of the day."""
    return F.substring(F.coalesce(F.nullif(text, F.lit("")), F.lit("00:00")), 1, 5)


def blank_to(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(strip(text), F.lit("")), F.lit(default))


def years_between(later: Column, earlier: Column) -> Column:
    """New-year boundaries crossed, not elapsed years."""
    return (F.year(later) - F.year(earlier)).cast("long")


def months_between(later: Column, earlier: Column) -> Column:
    """Month boundaries crossed."""
    return (
        (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
    ).cast("long")


def weeks_between(later: Column, earlier: Column) -> Column:
    """Mondays crossed."""
    days = F.datediff(F.trunc(later, "week"), F.trunc(earlier, "week"))
    return (days / 7).cast("long")


def minutes_between(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("MINUTE", earlier, later)


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient as double, NULL on a zero divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def local_today(utc_ts: Column, offset_hours: int = 7) -> Column:
    """Calendar day at a fixed offset from UTC."""
    return F.to_date(utc_ts + F.expr(f"INTERVAL {offset_hours} HOURS"))


def window_start(utc_ts: Column, days_back: int, offset_hours: int = 7) -> Column:
    """First day a reload covers: the local day minus ``days_back``."""
    return F.date_sub(local_today(utc_ts, offset_hours), days_back)


def window_days(utc_ts: Column, days_back: int, offset_hours: int = 7) -> Column:
    """Every day from the window start to the UTC day of ``utc_ts``.

    The array has at most ``days_back + 1`` days and is empty when the window
    would start in the future.
    """
    start = window_start(utc_ts, days_back, offset_hours)
    end = F.to_date(utc_ts)
    return F.when(start <= end, F.sequence(start, end)).otherwise(
        F.array().cast("array<date>")
    )
