"""Registered queries: every operator and model over the star-schema tables.

A query takes the session and a table folder and returns a frame. Dates and
times come out as text so that results compare across engines.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.functions import jsonx, safe, text
from rollcall.operators import flatten, history, latest, quality, sets, spine, worklist
from rollcall.plans import columns, loads, marts, staging
from rollcall.plans.pipeline import Pipeline, check_all
from rollcall.settings import APPROVED, PENDING, REFUSED, prepare_session, shared_dir
from rollcall.sources import histories, landing, layouts, raw, star, tables, versions
from rollcall.streaming import changes

Query = Callable[[SparkSession, str], DataFrame]
CFG = star.SETTINGS
QUERIES: dict[str, Query] = {}


def as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, other columns as they are."""
    kinds = ("date", "timestamp", "timestamp_ntz")
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if f.dataType.typeName() in kinds
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return as_text(fn(prepare_session(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return run


def work_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def models(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = (), narrow: bool = True):
    return Pipeline(spark, star.sources(spark, sf_dir), CFG, keep=keep, narrow=narrow)


def day_of(ts: str) -> Column:
    return F.to_date(ts)


# --- envelopes and projections -------------------------------------------------


@query
def envelope_unnest(spark, sf_dir):
    records = flatten.unnest_envelope(
        star.sources(spark, sf_dir).approvals, "RAW_DATA", ["SYNC_TIME"]
    )
    names = ["ID", "personnel_code", "app_approval_status", "description_text", "num_file"]
    return columns.project(records, columns.APPROVAL_FIELDS, "rec", ["SYNC_TIME"], names)


def landed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines: envelopes of up to 20 events, some empty, cut off or no JSON at all."""
    events = star.table(spark, sf_dir, "events")
    e = F.floor(F.col("event_id") / 20)
    record = F.struct("event_id", F.to_json(F.struct("event_id", "event_type", "value")).alias("rec"))
    packed = events.groupBy(e.alias("e")).agg(F.array_join(F.sort_array(F.collect_list(record)).rec, ",").alias("recs"))
    kind = F.col("e") % 12
    whole = F.concat(F.lit('{"data":['), F.when(kind != 3, F.col("recs")).otherwise(""), F.lit('],"error":false}'))
    text = (
        F.when(kind == 4, "oops")
        .when(kind == 5, F.expr("left(whole, length(whole) - 30)"))
        .when(kind == 6, '{"error":true}')
        .when(kind != 7, F.col("whole"))
    )
    stamp = F.when(kind != 8, "2024-01-02T03:04:05Z")
    line = F.to_json(F.struct(stamp.alias("SYNC_TIME"), text.alias("RAW_DATA")))
    broken = F.when(kind == 9, F.expr("left(line, 20)")).otherwise(F.col("line"))
    return packed.withColumn("whole", whole).withColumn("line", line).select("e", broken.alias("line"))


@query
def landed_loads(spark, sf_dir):
    """Four loads of landed files, two of which find nothing new."""
    folder, root = work_folder(spark, "landing"), work_folder(spark, "loads")
    lines = landed_envelopes(spark, sf_dir)
    first = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    for part in (0, 1):
        lines.filter(F.col("e") % 2 == part).select("line").write.text(f"{folder}/day={part}")
        for _ in range(2):
            landing.load_new(spark, folder, "approvals", root, first + dt.timedelta(days=part))
    kept = landing.read_raw(spark, root, "approvals")
    records = flatten.unnest_envelope(kept, "RAW_DATA", ["SYNC_TIME", "load"]).select(
        F.from_json("rec", "event_id bigint, event_type string, value double").alias("r"),
        (F.col("SYNC_TIME") >= F.lit(first)).alias("stamped"),
    )
    good = records.groupBy(F.col("r.event_type").alias("what")).agg(
        F.count("*").alias("n"), F.sum("r.event_id").alias("id_sum"), F.count_if("stamped").alias("stamped")
    )
    none = F.lit(None).cast("bigint")
    bad = landing.read_quarantine(spark, root, "approvals").groupBy(F.col("problem").alias("what")).agg(F.count("*").alias("n"))
    entered = landing.ledger(spark, root, "approvals").agg(
        F.lit("ledger").alias("what"), F.sum("rows").alias("n"), F.sum("bad_rows").alias("id_sum"), F.countDistinct("load").alias("stamped")
    )
    return good.unionByName(bad.withColumns({"id_sum": none, "stamped": none})).unionByName(entered)


@query
def envelope_pack(spark, sf_dir):
    events = star.table(spark, sf_dir, "events")
    records = events.select(F.to_json(F.struct("event_id", "event_type", "value")).alias("rec"))
    packed = flatten.pack_envelopes(records, 500).withColumn(
        "size", raw.landed_records(F.col("RAW_DATA"))
    )
    back = flatten.unnest_envelope(packed, "RAW_DATA", ["size"]).select(
        "size", F.from_json("rec", "event_id bigint, event_type string, value double").alias("r")
    )
    return back.groupBy(F.col("r.event_type").alias("event_type")).agg(
        F.count("*").alias("records"),
        F.sum("r.event_id").alias("id_sum"),
        F.max("r.value").alias("max_value"),
        (F.max("size") <= 500).alias("within_size"),
    )


@query
def typed_projection(spark, sf_dir):
    events = star.table(spark, sf_dir, "events")
    record = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.col("value").cast("string").alias("amount"),
            F.when(F.col("event_id") % 3 == 0, "x")
            .otherwise((F.col("event_id") % 2).cast("string"))
            .alias("mark"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"),
            F.date_format("ts", "d/M/yyyy").alias("day"),
            F.col("props"),
            F.from_json("props", "k bigint").alias("nested"),
        )
    )
    fields = [
        columns.Field("event_id", "id", "int"),
        columns.Field("amount", "amount", "float"),
        columns.Field("safe_mark", "mark", "safe_int"),
        columns.Field("flag", "mark", "flag"),
        columns.Field("at", "at", "safe_timestamp"),
        columns.Field("day", "day", "date"),
        columns.Field("props_text", "props"),
        columns.Field("nested_text", "nested"),
    ]
    return columns.project(events.select(record.alias("rec")), fields, "rec", [])


@query
def load_stamp_default(spark, sf_dir):
    events = star.table(spark, sf_dir, "events")
    stamp = F.when(F.col("event_id") % 4 != 0, F.col("ts").cast("timestamp"))
    day = F.to_date(raw.load_stamp(stamp, CFG.as_of_ts))
    return events.groupBy(day.alias("load_day")).agg(F.count("*").alias("landed"))


# --- flattening ------------------------------------------------------------------


@query
def two_level_flatten(spark, sf_dir):
    details = models(spark, sf_dir).model("stg_approval_details")
    return marts.detail_events(details).drop("raw_type")


@query
def first_element_flatten(spark, sf_dir):
    flat = models(spark, sf_dir).model("int_approval_details_flat")
    return flat.groupBy("detail_type", "date_record").agg(
        F.count("*").alias("events"),
        F.sum("hours_number").alias("hours"),
        F.min("start_time").alias("first_start"),
    )


@query
def int_details_flat(spark, sf_dir):
    return models(spark, sf_dir).model("int_approval_details_flat")


# --- one row per key ---------------------------------------------------------------


@query
def latest_by_key(spark, sf_dir):
    events = star.table(spark, sf_dir, "events")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    return latest.first_by(events, ["user_id"], order).select(
        "user_id", "event_id", "event_type", "value"
    )


@query
def latest_nulls_last(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders").withColumn(
        "signed", F.when(F.col("o_orderkey") % 4 != 0, F.to_date("o_orderdate"))
    )
    order = [F.col("signed").desc_nulls_last(), F.col("o_orderkey").asc()]
    return latest.first_by(orders, ["o_custkey"], order).select("o_custkey", "o_orderkey", "signed")


@query
def forward_status_latest(spark, sf_dir):
    names = [
        "sync_time",
        "ID",
        "personnel_code",
        "app_approval_status",
        "description_text",
        "reason",
        "date_created",
    ]
    return staging.stg_approvals(star.sources(spark, sf_dir).approvals, names)


def event_status() -> Column:
    """Request-like status of an event: pending, settled or none."""
    kind = F.col("event_type")
    return (
        F.when(kind.isin("view", "click"), PENDING)
        .when(kind == "purchase", APPROVED)
        .when(kind == "error", REFUSED)
    )


@query
def dedupe_input_order(spark, sf_dir):
    events = star.table(spark, sf_dir, "events").withColumn("status", event_status())
    return latest.forward_first(events, "user_id", "status", [F.col("event_id").asc()]).select(
        "user_id", "event_id", "status"
    )


# --- calendar and spines -------------------------------------------------------------


@query
def calendar_dim(spark, sf_dir):
    # Order dates 28 years on: the same weekdays and leap days, from 2020.
    days = star.table(spark, sf_dir, "events").select(day_of("ts").alias("date"))
    days = days.unionAll(
        star.table(spark, sf_dir, "orders").select(F.add_months("o_orderdate", 28 * 12).alias("date"))
    )
    daily = days.groupBy("date").agg(F.count("*").alias("events"))
    # The calendar has a fixed number of days, so it is the side to broadcast.
    return daily.join(F.broadcast(spine.dim_date(spark, CFG)), "date", "inner")


@query
def date_spine(spark, sf_dir):
    profiles = models(spark, sf_dir).model("stg_profiles")
    ranges = profiles.select(
        "department_id",
        F.col("job_date_join").alias("start"),
        F.coalesce("job_date_out", F.lit(CFG.as_of)).alias("end"),
    )
    days = spine.day_spine(ranges, "start", "end", CFG, "day")
    return days.groupBy("department_id", "day").agg(
        F.count("*").alias("people"),
        F.count_if(spine.is_six_day_week(F.col("day"), CFG)).alias("six_day_people"),
    )


@query
def month_headcount(spark, sf_dir):
    k = F.col("c_custkey")
    people = star.table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("segment"),
        F.when(k % 17 != 0, k).alias("code"),
        F.date_add(F.lit(dt.date(2018, 6, 1)), (k * 31 % 2000).cast("int")).alias("joined"),
        F.when(
            k % 3 == 0,
            F.date_add(F.lit(dt.date(2018, 6, 1)), (k * 31 % 2000 + k % 400 - 20).cast("int")),
        ).alias("left"),
    )
    return spine.month_headcount(people, ["segment"], "code", "joined", "left", CFG)


# --- sets, joins and aggregates ---------------------------------------------------------


@query
def json_not_in_other(spark, sf_dir):
    source = star.sources(spark, sf_dir)
    staged = staging.stg_approvals(source.approvals, ["ID", "app_sub_object"])
    details = staging.stg_approval_details(source.details, CFG, marts.DETAIL_INPUT)
    has_detail = F.lit(False)
    for name in marts.DETAIL_KINDS.values():
        has_detail = has_detail | jsonx.has_items(F.col(name))
    ids = details.filter(has_detail).select(F.col("ID").alias("approval_id"))
    return sets.not_in(staged, "ID", ids, "approval_id").select(
        "ID", F.coalesce("app_sub_object", F.lit("Đơn khác")).alias("approval_type")
    )


@query
def distinct_branch_union(spark, sf_dir):
    events = star.table(spark, sf_dir, "events").select("user_id", "event_type")
    seen = lambda *kinds: events.filter(F.col("event_type").isin(*kinds))
    return sets.union_of_distinct(seen("click", "error"), seen("view", "error"), seen("signup"))


@query
def union_distinct_ids(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders")
    lines = star.table(spark, sf_dir, "lineitem")
    return sets.union_distinct_ids(
        orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey"),
        lines.filter(F.col("l_returnflag") == "R").select("l_orderkey"),
        lines.filter(F.col("l_quantity") > 45).select("l_orderkey"),
    )


@query
def anti_missing_people(spark, sf_dir):
    p = models(spark, sf_dir)
    return marts.missing_people(
        p.model("stg_profiles"), p.model("stg_approvals"), p.model("stg_timekeep")
    )


@query
def left_flag_membership(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders")
    debtors = star.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0)
    flagged = sets.flag_members(orders, "o_custkey", debtors, "c_custkey", "by_debtor")
    return flagged.groupBy("o_orderstatus", "by_debtor").agg(F.count("*").alias("orders"))


@query
def cross_headcount(spark, sf_dir):
    events = star.table(spark, sf_dir, "events")
    customers = star.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0)
    headcount = customers.agg(F.countDistinct("c_custkey")).scalar()
    daily = events.groupBy(day_of("ts").alias("day")).agg(
        F.countDistinct("user_id").alias("users"), F.count("*").alias("events")
    )
    return daily.select(
        "day",
        "users",
        "events",
        headcount.alias("headcount"),
        safe.ratio(F.col("users"), headcount).alias("share"),
    )


@query
def first_by_rank(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders")
    rank = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
    reason = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
    best = sets.first_by_rank(
        ["o_orderstatus", "reason", "o_orderkey"], rank.otherwise(3), "o_orderkey"
    )
    return (
        orders.withColumn("reason", reason)
        .groupBy("o_custkey")
        .agg(best.alias("b"), F.sum(F.coalesce("o_orderkey", F.lit(0))).alias("key_sum"))
        .select("o_custkey", "b.*", "key_sum")
    )


@query
def string_agg_distinct(spark, sf_dir):
    events = star.table(spark, sf_dir, "events")
    kinds = sets.text_set(F.when(F.col("event_type") != "view", F.col("event_type")))
    return events.groupBy("user_id", day_of("ts").alias("day")).agg(kinds.alias("kinds"))


@query
def safe_ratio_rank(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders")
    customers = star.table(spark, sf_dir, "customer")
    placed = orders.join(
        customers.select("c_custkey", "c_nationkey"),
        F.col("o_custkey") == F.col("c_custkey"),
        "inner",
    )
    monthly = placed.groupBy(F.trunc("o_orderdate", "year").alias("period"), "c_nationkey").agg(
        F.count_if(F.col("o_orderstatus") == "P").alias("bad"),
        F.count_if(F.col("o_orderstatus") != "P").alias("good"),
    )
    debtors = (
        customers.filter((F.col("c_acctbal") < 0) & (F.col("c_nationkey") % 5 != 0))
        .groupBy("c_nationkey")
        .agg(F.count("*").alias("heads"))
    )
    rated = monthly.join(debtors, "c_nationkey", "left").select(
        "period",
        "c_nationkey",
        "heads",
        safe.ratio(F.col("good"), F.col("good") + F.col("bad")).alias("good_share"),
        safe.ratio(F.col("bad") * 100, F.col("heads")).alias("rate"),
    )
    place = F.rank().over(Window.partitionBy("period").orderBy(F.col("rate").asc()))
    return rated.withColumn("place", place.cast("long"))


# --- scalar rules --------------------------------------------------------------------


@query
def minute_gaps_flags(spark, sf_dir):
    o = F.col("o_orderkey")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    day = F.to_date("o_orderdate")
    clock = F.when(o % 11 == 0, "").when(o % 13 == 0, "25:00").otherwise(
        F.concat(two(o % 24), F.lit(":"), two(o * 7 % 60), F.lit(":30"))
    )
    start = safe.minute_stamp(day, F.lit("08:00"))
    created = safe.minute_stamp(F.date_sub(day, (o % 2).cast("int")), safe.clock_minutes(clock))
    gap = safe.minutes_between(start, created)
    return star.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"),
        created.alias("created_at"),
        gap.alias("gap"),
        gap.between(0, CFG.late_notice_minutes).alias("late_notice"),
        (gap < 0).alias("after_the_fact"),
        (created.isNotNull() & (created > start)).alias("created_after_start"),
    )


@query
def blank_defaults_bands(spark, sf_dir):
    k = F.col("c_custkey")
    born = F.when(k % 40 != 3, F.date_add(F.lit(dt.date(1960, 1, 1)), (k * 37 % 18000).cast("int")))
    joined = F.when(
        k % 23 != 0, F.date_add(F.lit(dt.date(2019, 1, 1)), (k * 37 % 1800).cast("int"))
    )
    today = F.lit(CFG.as_of)
    age, months = safe.years_between(today, born), safe.months_between(today, joined)
    name = F.when(k % 3 == 0, " ").when(k % 3 == 1, F.concat(F.lit(" "), F.col("c_mktsegment")))
    return star.table(spark, sf_dir, "customer").select(
        "c_custkey",
        safe.blank_to(name, "Chưa cập nhật").alias("name"),
        age.alias("age"),
        marts.age_band(age).alias("age_group"),
        months.alias("tenure_months"),
        marts.tenure_band(months).alias("tenure_group"),
        safe.weeks_between(today, joined).alias("weeks"),
    )


@query
def like_rules(spark, sf_dir):
    label = F.concat_ws(" ", F.col("source"), F.col("lang"), F.col("text"))
    docs = star.table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        marts.department_block(label).alias("block"),
        marts.request_block(label).alias("request_block"),
        marts.request_type(label).alias("request_type"),
    )


@query
def safe_dates(spark, sf_dir):
    k = F.col("c_custkey")
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (k % 366).cast("int"))
    shapes = F.array(
        F.date_format(day, "dd/MM/yyyy"),
        F.date_format(day, "d/M/yyyy"),
        F.concat(F.date_format(day, "dd/MM/yyyy"), F.lit(" 11:19")),
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "yyyy-M-d"),
        F.lit("31/02/2024"),
        F.lit(""),
        F.date_format(day, "yyyy"),
    )
    shape = F.get(shapes, (k % 8).cast("int"))
    customers = star.table(spark, sf_dir, "customer").select(k, shape.alias("shape"))
    value = F.col("shape")
    return customers.select(
        "c_custkey",
        safe.date_dmy(value).alias("dmy"),
        safe.date_ymd(value).alias("ymd"),
        safe.loader_date(value).alias("loader"),
        safe.cast_date(value).alias("cast_date"),
        value.try_cast("long").alias("number"),
    )


@query
def redact_text(spark, sf_dir):
    docs = star.table(spark, sf_dir, "documents")
    line = F.concat(
        F.col("text"),
        F.lit(" https://api/x?access_token=AB"),
        F.col("doc_id"),
        F.lit("&Secret=z"),
        F.col("doc_id"),
        F.lit("'; token= none; key supersecret-"),
        F.col("source"),
    )
    rows = docs.select("doc_id", line.alias("line"))
    return text.redact_columns(rows, ["line"], ["supersecret", "short"])


@query
def scrape_text(spark, sf_dir):
    pages = star.table(spark, sf_dir, "pages")
    p = F.col("page_id")
    failure = lambda n: F.concat(
        F.lit(f"\nFailure in test {n}_"), p, F.lit(" (models/marts.yml)")
    )
    log = F.concat(
        F.col("html"),
        F.when(p % 3 != 0, failure("unique")).otherwise(""),
        F.when(p % 2 == 0, failure("not_null")).otherwise(""),
        F.when(
            p % 5 != 0,
            F.concat(
                F.lit("\nDone. PASS="), p, F.lit(" WARN=0 ERROR=1 SKIP=0 NO-OP=0 TOTAL="), p + 1
            ),
        ).otherwise("\nnot Done. PASS=1 WARN=0 ERROR=0 SKIP=0 TOTAL=1"),
        F.lit("\nend"),
    )
    rows = pages.select("page_id", log.alias("log"))
    return rows.select(
        "page_id",
        text.run_summary(F.col("log")).alias("summary"),
        text.run_failures(F.col("log")).alias("failures"),
    )


# --- table writes -----------------------------------------------------------------------


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star.table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        day_of("ts").cast("string").alias("SYNC_DATE"),
        "event_type",
        F.lit("old").alias("load"),
    )


@query
def full_replace(spark, sf_dir):
    path = work_folder(spark, "replace")
    days = event_days(spark, sf_dir)
    versions.publish(days.filter(F.col("event_type") == "click"), path)
    versions.publish(days, path)
    back = versions.read(spark, path, days.schema)
    return back.groupBy("event_type").agg(F.count("*").alias("landed"))


@query
def window_replace(spark, sf_dir):
    path = work_folder(spark, "window")
    old = event_days(spark, sf_dir)
    layouts.write_days(old, path, "SYNC_DATE")
    # The new pull lacks one of the days it covers; that day has to vanish.
    landed = old.filter(
        (F.col("SYNC_DATE") >= "2024-01-20") & (F.col("SYNC_DATE") != "2024-01-25")
    ).withColumn("load", F.lit("new"))
    layouts.replace_days(landed, path, "SYNC_DATE", "2024-01-20")
    back = spark.read.schema(old.schema).parquet(path)
    return back.groupBy("SYNC_DATE", "load").agg(F.count("*").alias("landed"))


@query
def append_then_latest(spark, sf_dir):
    path = work_folder(spark, "append")
    orders = star.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    first = orders.withColumns({"status": F.lit(PENDING), "load": F.lit(1).cast("long")})
    second = orders.filter(F.col("o_orderstatus") != "O").withColumns(
        {
            "status": F.when(F.col("o_orderstatus") == "F", APPROVED).otherwise(PENDING),
            "load": F.lit(2).cast("long"),
        }
    )
    tables.replace(first, path)
    tables.append(second, path)
    log = spark.read.schema(first.schema).parquet(path)
    return latest.forward_latest(log, "o_orderkey", "status", [F.col("load").desc()]).select(
        "o_orderkey", "status", "load"
    )


@query
def rewrite_with_add(spark, sf_dir):
    path = work_folder(spark, "add")
    old = event_days(spark, sf_dir)
    tables.replace(old, path)
    kept = spark.read.schema(old.schema).parquet(path)
    again = old.filter(F.col("event_type") == "error").withColumn("load", F.lit("new"))
    tables.replace(kept.unionByName(again), path)
    back = spark.read.schema(old.schema).parquet(path)
    return back.groupBy("event_type", "load").agg(F.count("*").alias("landed"))


UPSERT_BUCKETS = 8


@query
def upsert_changed(spark, sf_dir):
    path = work_folder(spark, "upsert")
    o = F.col("o_orderkey")
    orders = star.table(spark, sf_dir, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "O", PENDING)
        .when(F.col("o_orderstatus") == "F", APPROVED)
        .otherwise(F.lit(None))
    )
    # Two rows for some ids, and ids missing for a few.
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.when(o % 5 == 0, 1).otherwise(0)))
    old = orders.select(o, copies.alias("i"), status.alias("state")).select(
        F.when(o % 1000 != 999, o).alias("APPROVAL_ID"),
        F.when(F.col("i") == 1, PENDING).otherwise(F.col("state")).alias("status"),
        (o * 2 + 1 - F.col("i")).alias("seq"),
    )
    layouts.write_buckets(old, path, "APPROVAL_ID", "status", "seq", UPSERT_BUCKETS)
    top = orders.agg(F.max("o_orderkey")).scalar()
    changed = orders.filter(o % 7 == 0).select(
        o.alias("APPROVAL_ID"), F.lit(REFUSED).alias("status"), (top * 2 + 2 + o).alias("seq")
    )
    layouts.upsert_buckets(changed, path, "APPROVAL_ID", "status", "seq", UPSERT_BUCKETS)
    return layouts.read_buckets(spark, path).select(*old.columns)


@query
def clustered_mart(spark, sf_dir):
    path = work_folder(spark, "mart")
    mart = models(spark, sf_dir, keep=("mart_attendance_events",)).model("mart_attendance_events")
    tables.write_mart(mart, path, "event_date", "personnel_code")
    back = spark.read.parquet(path).filter(F.col("event_date") >= "2024-01-15")
    return back.groupBy("event_date").agg(
        F.count("*").alias("records"), F.sum("late_minute").alias("late")
    )


@query
def verified_rewrite(spark, sf_dir):
    path = work_folder(spark, "rewrite")
    orders = star.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    versions.publish(orders, path)
    versions.verified_rewrite(spark, path)
    # A copy that is one status short must not become the table.
    short = versions.read(spark, path).filter(F.col("o_orderstatus") != "P")
    versions.publish_if_equal(spark, path, versions.stage(short, path))
    back = versions.read(spark, path, orders.schema)
    return back.groupBy("o_orderstatus").agg(F.count("*").alias("kept"))


@query
def recover_rewrite(spark, sf_dir):
    """Two interrupted rewrites: one left data behind, the other a pointer to half a version."""
    path = work_folder(spark, "recover")
    orders = star.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    versions.publish(orders, path)
    said = [versions.recover(spark, path)]
    versions.stage(orders.filter(F.col("o_orderstatus") == "F"), path)
    said.append(versions.recover(spark, path))
    versions.publish(orders.filter(F.col("o_orderstatus") == "O"), path)
    known = versions.versions(spark, path)
    tables.drop(spark, f"{known[max(known)]}/_SUCCESS")
    said.append(versions.recover(spark, path))
    back = versions.read(spark, path, orders.schema)
    return back.groupBy("o_orderstatus").agg(F.count("*").alias("kept")).withColumn("said", F.lit(",".join(said)))


@query
def expiring_tables(spark, sf_dir):
    k = F.col("c_custkey")
    prefix = F.when(k % 5 == 0, "TMP_").otherwise("RAW_")
    suffix = F.when(k % 7 == 0, tables.SIDE_SUFFIX).otherwise("")
    expires = F.to_timestamp(F.date_add(F.lit(CFG.as_of), (k % 90).cast("int")))
    listing = star.table(spark, sf_dir, "customer").select(
        F.concat(prefix, F.col("c_name"), suffix).alias("table_name"),
        F.when(k % 11 != 0, expires).alias("expires"),
    )
    return tables.expiring(listing, "table_name", "expires", CFG.as_of_ts)


# --- worklists --------------------------------------------------------------------------


def request_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    source = star.sources(spark, sf_dir)
    return source.approvals, source.details


@query
def id_tail(spark, sf_dir):
    o = F.col("o_orderkey")
    orders = star.table(spark, sf_dir, "orders")
    top = orders.agg(F.max("o_orderkey")).scalar()
    known = orders.filter(o <= top - 150)
    outcome = (
        F.when((top - o).between(40, 42), "miss").when(o % 7 == 3, "miss").otherwise("hit")
    )
    probes = orders.filter(o > top - 150).select(o, outcome.alias("outcome"))
    return worklist.id_tail(known, probes, "o_orderkey", "o_orderkey", "outcome")


@query
def pending_worklist(spark, sf_dir):
    approvals, details = request_sources(spark, sf_dir)
    return worklist.pending_worklist(details, approvals, CFG.as_of, days_back=20)


@query
def status_changes(spark, sf_dir):
    approvals, details = request_sources(spark, sf_dir)
    listed = staging.stg_approvals(approvals, ["ID", "app_approval_status"])
    pending = listed.filter(F.col("app_approval_status") == PENDING).select(F.col("ID").alias("id"))
    landed = worklist.detail_states(details).select("id", "status")
    return worklist.status_changes(pending, landed)


@query
def stale_pending(spark, sf_dir):
    approvals, details = request_sources(spark, sf_dir)
    return worklist.stale_pending(approvals, details, dt.date(2024, 1, 23))


@query
def window_ids(spark, sf_dir):
    approvals, _ = request_sources(spark, sf_dir)
    return worklist.window_ids(approvals, dt.date(2024, 1, 23), CFG.as_of)


@query
def refresh_worklist(spark, sf_dir):
    approvals, details = request_sources(spark, sf_dir)
    return worklist.refresh_worklist(approvals, details, dt.date(2024, 1, 23), CFG.as_of)


@query
def missing_after_fetch(spark, sf_dir):
    approvals, details = request_sources(spark, sf_dir)
    asked = worklist.window_ids(approvals, dt.date(2024, 1, 23), CFG.as_of)
    landed = worklist.detail_states(details).filter(F.col("message").isNull())
    return worklist.missing_after_fetch(asked, landed)


@query
def first_failures(spark, sf_dir):
    return worklist.first_failures(missing_after_fetch(spark, sf_dir))


@query
def page_cut(spark, sf_dir):
    o = F.col("o_orderkey")
    created = F.date_add(F.lit(dt.date(2024, 1, 1)), (o % 30).cast("int"))
    items = star.table(spark, sf_dir, "orders").select(
        o,
        ((29 - o % 30) * 4 + F.floor(o / 30) % 4 + 1).alias("page_no"),
        F.concat(F.date_format(created, "dd/MM/yyyy"), F.lit(" 08:00")).alias("created"),
    )
    return worklist.page_cut(items, "page_no", "created", CFG.as_of, 12)


@query
def page_completeness(spark, sf_dir):
    events = star.table(spark, sf_dir, "events")
    pages = events.groupBy(day_of("ts").alias("day"), (F.col("user_id") % 60).alias("page")).agg(
        F.count("*").alias("size")
    )
    # Later days announce more records per page than have landed.
    announced = F.when(F.dayofmonth("day") < 10, 1).otherwise(100_000_000)
    keep = (F.dayofmonth("day") < 20) | (F.col("page") < 40)
    pages = pages.filter(keep).withColumn("total_item", announced.cast("long"))
    return worklist.page_completeness(pages, "day", "size", "total_item")


@query
def reload_days(spark, sf_dir):
    events = star.table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    asked = events.select(
        safe.window_start(ts, 3).alias("start_day"), F.explode(raw.reload_days(ts, 3)).alias("day")
    )
    return asked.groupBy("start_day", "day").agg(F.count("*").alias("asked"))


# --- stream, history, checks ----------------------------------------------------------------


@query
def stream_upsert(spark, sf_dir):
    folder = work_folder(spark, "stream")
    schema = star.table(spark, sf_dir, "events").schema
    # A glob, so that the table may be one file as well as a folder of files.
    landed = changes.landed_files(spark, f"{sf_dir}/events.parque[t]", schema, glob="*.parquet")
    rows = landed.select("user_id", event_status().alias("status"), "event_id", "value")
    changes.log_changes(rows, f"{folder}/log", f"{folder}/checkpoint")
    return changes.current_state(
        spark, f"{folder}/log", rows.schema, "user_id", "status", "event_id"
    )


@query
def stream_folded(spark, sf_dir):
    """Three drains of a stream, its log folded after the first two; the third part is read from the tail."""
    folder = work_folder(spark, "stream")
    events = star.table(spark, sf_dir, "events").select("user_id", event_status().alias("status"), "event_id", "value")
    state = (f"{folder}/log", events.schema, "user_id", "status", "event_id")
    for part in range(3):
        events.filter(F.col("event_id") % 3 == part).write.parquet(f"{folder}/in/part={part}")
        landed = changes.landed_files(spark, f"{folder}/in/part=*", events.schema, glob="*.parquet", files=1_000_000)
        changes.log_changes(landed.select(*events.columns), state[0], f"{folder}/checkpoint")
        if part < 2:
            changes.fold(spark, *state)
    return changes.current_state(spark, *state)


@query
def landed_run(spark, sf_dir):
    """Two whole loads of landed files, the second of which replaces attendance days; the attendance mart."""
    landed, root = work_folder(spark, "landed"), work_folder(spark, "run")
    source = star.sources(spark, sf_dir)

    def land(df: DataFrame, table: str, part: str) -> None:
        df.select(F.to_json(F.struct(*df.columns))).write.text(f"{landed}/{table}/{part}")

    # Written once, since it is landed in three parts.
    source.timekeep.write.parquet(f"{landed}-timekeep")
    timekeep = raw.read_table(spark, f"{landed}-timekeep", "timekeep")
    day = F.col("SYNC_DATE")
    cut = "2024-01-20"
    wrong = timekeep.filter(day >= cut).withColumn("SYNC_DATE", F.concat(F.lit("2024-02-"), F.substring(day, 9, 2)))
    land(source.profiles, "profiles", "1")
    land(timekeep.filter(day < cut).unionByName(wrong), "timekeep", "1")
    at = dt.datetime(2024, 1, 23, tzinfo=dt.timezone.utc)
    models = ("mart_attendance_events",)
    loads.load(spark, landed, root, CFG, at, models=models)
    land(timekeep.filter(day >= cut), "timekeep", "2")
    done = loads.load(spark, landed, root, CFG, at + dt.timedelta(hours=1), models=models)
    return spark.read.parquet(done.marts["mart_attendance_events"])


def staff_batches(spark: SparkSession, sf_dir: str, names: list[str]):
    """Staged employees, and the same a month later with some changes."""
    source = star.sources(spark, sf_dir)
    first = staging.stg_profiles(source.profiles, names)
    k = F.col("ID")
    later = first.filter(k % 15 != 4).withColumns(
        {
            "position_title": F.when(k % 6 == 0, "Trưởng nhóm").otherwise(F.col("position_title")),
            "department_full": F.when(k % 12 == 11, "Phòng mới").otherwise(F.col("department_full")),
        }
    )
    if "salary_real" in names:
        raised = F.when(k % 9 == 2, F.col("salary_real") + 1).otherwise(F.col("salary_real"))
        later = later.withColumn("salary_real", raised)
    if "work_place" in names:
        moved = F.when(k % 9 == 2, F.lit(None)).otherwise(F.col("work_place"))
        later = later.withColumn("work_place", moved)
    return first.filter(k % 15 != 7), later


def two_loads(spark, sf_dir, check: list[str]) -> DataFrame:
    key = history.STAFF_HISTORY_KEY
    first, later = staff_batches(spark, sf_dir, [key, *check])
    utc = dt.timezone.utc
    opened = history.open_history(first, dt.datetime(2024, 1, 1, tzinfo=utc))
    return history.scd2_check(opened, later, key, check, dt.datetime(2024, 1, 30, tzinfo=utc))


@query
def scd2_history(spark, sf_dir):
    return two_loads(spark, sf_dir, history.STAFF_HISTORY_COLUMNS)


@query
def scd2_placement(spark, sf_dir):
    return two_loads(spark, sf_dir, history.PLACEMENT_HISTORY_COLUMNS)


@query
def history_table(spark, sf_dir):
    """Three loads of whole rows: keys vanish and return, some columns are not watched."""
    path = work_folder(spark, "history")
    key, check = history.STAFF_HISTORY_KEY, history.STAFF_HISTORY_COLUMNS
    names = [key, "name", "code", "work_place", *check]
    first, later = staff_batches(spark, sf_dir, names)
    whole = staging.stg_profiles(star.sources(spark, sf_dir).profiles, names)
    third = whole.withColumn("name", F.concat("name", F.lit(" *")))
    for day, batch in ((1, first), (15, later), (30, third)):
        histories.load(batch, path, key, check, dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc))
    return histories.read(spark, path).select(*names, "valid_from", "valid_to")


@query
def approvals_incremental(spark, sf_dir):
    """Two runs of the daily request mart, the second from the greatest day on."""
    path = work_folder(spark, "approvals")
    built = models(spark, sf_dir, keep=("stg_approval_details", "stg_approvals", "stg_profiles"))
    names = ("stg_approval_details", "stg_approvals", "stg_profiles")

    def rows(since: str | None) -> DataFrame:
        day = None if since is None else dt.date.fromisoformat(since)
        return marts.mart_approvals(*(built.model(n) for n in names), incremental_since=day)

    # The first run ends within a day: half of the requests of that day come later.
    cut, half = F.lit("2024-01-12").cast("date"), F.col("approval_id") % 2 == 0
    early = F.col("date_created").isNull() | (F.col("date_created") < cut) | ((F.col("date_created") == cut) & half)
    layouts.refresh_days(lambda since: rows(since).filter(early), path, "date_created", spark)
    layouts.refresh_days(rows, path, "date_created", spark)
    schema = rows(None).schema
    return spark.read.schema(schema).parquet(path).select(*schema.names)


CHECKED = [
    "stg_profiles",
    "stg_approvals",
    "stg_approval_details",
    "stg_timekeep",
    "mart_profiles",
    "mart_approvals",
    "mart_attendance_events",
    "mart_employee_events",
    "mart_headcount_snapshot",
]
SHARED = ("stg_profiles", "stg_approvals", "stg_approval_details", "stg_timekeep")


def check_results(spark, sf_dir) -> DataFrame:
    keep = (*SHARED, "mart_profiles", "mart_approvals")
    return check_all(models(spark, sf_dir, keep=keep), CHECKED)


@query
def dq_results(spark, sf_dir):
    return check_results(spark, sf_dir)


@query
def dq_summary(spark, sf_dir):
    return quality.summary(check_results(spark, sf_dir))


@query
def dq_watched(spark, sf_dir):
    """All declared checks and the row minimum of each model, taken while the models are written."""
    built = models(spark, sf_dir, keep=tuple(quality.SUITES))
    parts = [built.checked(name) for name in quality.SUITES]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def source_freshness(spark, sf_dir):
    source = star.sources(spark, sf_dir)
    at = CFG.as_of_ts + dt.timedelta(hours=26)
    parts = [
        quality.freshness(source.profiles, "profiles", "SYNC_TIME", at),
        quality.freshness(source.approvals, "approvals", "SYNC_TIME", at),
        quality.freshness(source.timekeep, "timekeep", "SYNC_TIME", at - dt.timedelta(hours=2)),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- models ---------------------------------------------------------------------------------


@query
def stg_profiles(spark, sf_dir):
    return models(spark, sf_dir, narrow=False).model("stg_profiles")


@query
def stg_approvals(spark, sf_dir):
    return models(spark, sf_dir, narrow=False).model("stg_approvals")


@query
def stg_approval_details(spark, sf_dir):
    df = models(spark, sf_dir, narrow=False).model("stg_approval_details")
    arrays = ["inout", "overtime", "absence", "leave_data"]
    # Arrays are compared by size; JSON null counts as present without elements.
    sizes = {f"{c}_items": F.size(jsonx.elements(F.col(c))).cast("long") for c in arrays}
    present = {f"{c}_present": F.col(c).isNotNull() for c in arrays}
    return df.withColumns({**sizes, **present}).drop(*arrays)


@query
def stg_timekeep(spark, sf_dir):
    return models(spark, sf_dir, narrow=False).model("stg_timekeep")


@query
def sheet_staging(spark, sf_dir):
    return models(spark, sf_dir).model("stg_hr_master_data")


@query
def exception_status_staging(spark, sf_dir):
    return models(spark, sf_dir).model("stg_exception_status")


@query
def mart_profiles(spark, sf_dir):
    return models(spark, sf_dir).model("mart_profiles")


@query
def mart_approvals(spark, sf_dir):
    return models(spark, sf_dir, keep=("stg_approval_details",)).model("mart_approvals")


@query
def mart_attendance_events(spark, sf_dir):
    return models(spark, sf_dir).model("mart_attendance_events")


@query
def mart_employee_events(spark, sf_dir):
    return models(spark, sf_dir).model("mart_employee_events")


@query
def mart_headcount_snapshot(spark, sf_dir):
    return models(spark, sf_dir).model("mart_headcount_snapshot")


COMPLIANCE_SHARED = (*SHARED, "mart_profiles", "mart_approvals")


def compliance_model(name: str, *more: str) -> Query:
    def build(spark, sf_dir):
        keep = (*COMPLIANCE_SHARED, *more)
        return models(spark, sf_dir, keep=keep).model(f"mart_{name}")

    build.__name__ = name
    return query(build)


compliance_approval_timing = compliance_model("compliance_approval_timing")
compliance_schedule_daily = compliance_model("compliance_schedule_daily")
TIMING = "mart_compliance_approval_timing"
compliance_exception_detail = compliance_model("compliance_exception_detail")
compliance_kpi_overview = compliance_model("compliance_kpi_overview", TIMING)
compliance_kpi_by_dept = compliance_model("compliance_kpi_by_dept")
