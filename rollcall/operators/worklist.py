"""What to fetch or refresh next, from landed data only."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import jsonx, safe
from rollcall.operators.flatten import unnest_envelope
from rollcall.operators.latest import settled_first
from rollcall.settings import PENDING

# Limits of one poll and of one list reload.
MISSES_TO_STOP = 3
PENDING_DAYS = 30
PENDING_LIMIT = 50
MAX_DAY_PAGES = 50
FAILED_SHOWN = 20
NOT_FOUND_MESSAGE = "Post not found"


def _first_absent(numbers: DataFrame, start: DataFrame, name: str) -> DataFrame:
    """The least number after ``start`` that is not among ``numbers``, as one row."""
    following = numbers.select((F.col(name) + 1).alias(name)).unionByName(start)
    return following.join(numbers.select(name), name, "left_anti").agg(F.min(name).alias(name))


def id_tail(known: DataFrame, probes: DataFrame, known_id: str, probe_id: str, outcome: str):
    """New ids found right after the highest known one.

    ``outcome`` is ``hit``, ``miss`` or ``error``. All landed probes count. The tail
    ends at the first error, at the first id that was not probed, or after three
    misses in a row.
    """
    top = known.agg(F.coalesce(F.max(known_id), F.lit(0)).cast("long").alias("id"))
    start = top.scalar()
    tail = probes.select(F.col(probe_id).cast("long").alias("id"), F.col(outcome).alias("outcome"))
    tail = tail.filter(F.col("id") > start)
    run_ends = (
        tail.filter(F.col("outcome") == "miss")
        .select(F.explode(F.sequence("id", F.col("id") + MISSES_TO_STOP - 1)).alias("id"))
        .groupBy("id")
        .count()
        .filter(F.col("count") == MISSES_TO_STOP)
        .select("id")
    )
    errors = tail.filter(F.col("outcome") == "error").select("id")
    gap = _first_absent(tail.select("id"), top.select((F.col("id") + 1).alias("id")), "id")
    stop = run_ends.unionByName(errors).unionByName(gap).agg(F.min("id").alias("stop")).scalar()
    return tail.filter((F.col("outcome") == "hit") & (F.col("id") < stop)).select("id")


def list_states(approvals_raw: DataFrame) -> DataFrame:
    """id, status and creation date of every landed list record."""
    records = unnest_envelope(approvals_raw, "RAW_DATA", [])
    keys = ["ID", "app_approval_status", "date_created"]
    parsed = jsonx.parse_once(records, jsonx.record_struct(F.col("rec"), keys), "j")
    return parsed.select(
        jsonx.scalar("j", "ID", "rec").cast("long").alias("id"),
        jsonx.scalar("j", "app_approval_status", "rec").alias("status"),
        safe.date_dmy(jsonx.scalar("j", "date_created", "rec")).alias("created"),
    )


def detail_states(details_raw: DataFrame) -> DataFrame:
    """id, status, creation date and API message of every landed detail document."""
    doc = jsonx.parse_once(details_raw, F.from_json("RAW_DATA", "message string, data string"), "d")
    doc = doc.withColumn("data", F.col("d.data"))
    keys = ["app_approval_status", "date_created"]
    parsed = jsonx.parse_once(doc, jsonx.record_struct(F.col("data"), keys), "j")
    return parsed.select(
        F.col("APPROVAL_ID").alias("id"),
        jsonx.scalar("j", "app_approval_status", "data").alias("status"),
        safe.date_dmy(jsonx.scalar("j", "date_created", "data")).alias("created"),
        jsonx.scalar("d", "message", "RAW_DATA").alias("message"),
        F.col("RAW_DATA").isNotNull().alias("landed"),
    )


def pending_worklist(
    details_raw: DataFrame,
    approvals_raw: DataFrame,
    as_of: dt.date,
    days_back: int = PENDING_DAYS,
    limit: int = PENDING_LIMIT,
) -> DataFrame:
    """Newest requests still pending everywhere, created in the look-back window."""
    seen = (
        detail_states(details_raw)
        .filter("landed")
        .select("id", "status", "created")
        .unionByName(list_states(approvals_raw))
        .filter(F.col("id").isNotNull())
    )
    one = settled_first(seen, "id", "status", [F.col("created").desc(), F.col("status").desc()])
    recent = F.col("created") >= F.date_sub(F.lit(as_of), days_back)
    return (
        one.filter((F.col("status") == PENDING) & recent)
        .select("id")
        .orderBy(F.col("id").desc())
        .limit(limit)
    )


def status_changes(pending: DataFrame, landed: DataFrame, status: str = "status") -> DataFrame:
    """Landed rows of pending ids whose status has moved on."""
    moved = F.col(status).isNotNull() & (F.col(status) != "") & (F.col(status) != PENDING)
    return landed.filter(moved).join(pending.select("id"), "id", "inner")


def stale_pending(approvals_raw: DataFrame, details_raw: DataFrame, from_date: dt.date):
    """Requests older than the reload window that nothing has settled yet."""
    listed = (
        list_states(approvals_raw)
        .filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(
            F.bool_or(F.col("status") != PENDING).alias("moved_on"),
            F.min("created").alias("created"),
        )
        .filter(~F.coalesce("moved_on", F.lit(False)) & (F.col("created") < F.lit(from_date)))
    )
    settled = detail_states(details_raw).filter(
        (F.col("message") == NOT_FOUND_MESSAGE)
        | F.coalesce(F.col("status") != PENDING, F.lit(False))
    )
    return listed.join(settled.select("id"), "id", "left_anti").select("id")


def window_ids(approvals_raw: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Distinct ids created from ``start`` to ``end``, both included."""
    rows = list_states(approvals_raw).filter(
        F.col("id").isNotNull() & F.col("created").between(F.lit(start), F.lit(end))
    )
    return rows.select("id").distinct()


def refresh_worklist(
    approvals_raw: DataFrame, details_raw: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """Ids of the window together with the stale pending ones."""
    stale = stale_pending(approvals_raw, details_raw, start)
    return window_ids(approvals_raw, start, end).union(stale).distinct()


def missing_after_fetch(asked: DataFrame, landed: DataFrame) -> DataFrame:
    """Asked ids that did not land.

    Both sides are dealt by id, by hint: Spark judges what is cut out of JSON by the size of
    the files it came from, and would send every landed id to the driver for a broadcast.
    """
    return asked.select("id").distinct().join(landed.select("id").hint("merge"), "id", "left_anti")


def first_failures(missing: DataFrame, shown: int = FAILED_SHOWN) -> DataFrame:
    """The lowest failing ids, for the run report."""
    return missing.orderBy("id").limit(shown)


def page_cut(items: DataFrame, page: str, created_text: str, as_of: dt.date, days_back: int):
    """Items of a newest-first listing, up to the page that crosses the cutoff.

    Pages past the first gap do not count. Fails when page 1 holds only items older
    than the cutoff, which means the order was ignored.
    """
    cutoff = F.date_sub(F.lit(as_of), days_back)
    created = safe.loader_date(F.col(created_text))
    pages = (
        items.filter(F.col(page) >= 1)
        .groupBy(F.col(page).cast("long").alias("p"))
        .agg(F.min(created).alias("oldest"), F.max(created).alias("newest"))
    )
    crossed = F.min(F.when(F.col("oldest") < cutoff, F.col("p")))
    unsorted = F.bool_or((F.col("p") == 1) & (F.col("newest") < cutoff))
    bad_order = F.raise_error(F.lit("listing is not newest first: page 1 is older than the cutoff"))
    one = items.sparkSession.range(1, 2).toDF("p")
    unbroken = _first_absent(pages.select("p"), one, "p").select(F.col("p") - 1).scalar()
    last = pages.agg(crossed.alias("crossed"), unsorted.alias("unsorted")).select(
        F.when(F.col("unsorted"), bad_order)
        .otherwise(F.least("crossed", unbroken))
        .cast("long")
        .alias("last")
    )
    return items.filter(F.col(page).between(F.lit(1), last.scalar()))


def page_completeness(
    pages: DataFrame, day: str, size: str, total: str, max_pages: int = MAX_DAY_PAGES
) -> DataFrame:
    """Landed records against the announced total, per day.

    A short day is an ``overflow`` if it has as many pages as a loader fetches.
    """
    got, want, n = F.sum(size), F.max(total), F.count("*")
    status = (
        F.when(got >= want, "ok").when(n >= max_pages, "overflow").otherwise("short")
    )
    return pages.groupBy(day).agg(
        got.cast("long").alias("collected"),
        want.cast("long").alias("announced"),
        n.alias("pages"),
        status.alias("status"),
    )
