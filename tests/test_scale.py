"""What must not grow with the tables: width of sorted rows, rows of a task, repeated work."""

import datetime as dt
import json

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rollcall.functions import jsonx
from rollcall.operators import flatten, worklist
from rollcall.plans import loads, marts, staging
from rollcall.settings import prepare_session
from rollcall.sources import layouts, star

OLD, NEW = "2026-10-01 00:00:00", "2026-10-02 00:00:00"


def window_width(df) -> int:
    """Columns of the rows that the one window of a plan sorts."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Window":
        node = node.children().head()
    return node.output().size()


def test_profiles_are_picked_as_text(envelopes):
    df = envelopes([(NEW, [{"ID": 1, "name": "new"}]), (OLD, [{"ID": 1, "name": "old"}, {"ID": 2}, {"name": "x"}])])
    staged = staging.stg_profiles(df)
    assert window_width(staged) <= 6
    assert rows(staged, "ID", "name") == [(None, "x"), (1, "new"), (2, None)]
    assert rows(staging.stg_profiles(df, ["name"])) == [(None,), ("new",), ("x",)]


def test_bad_text_in_a_profile_that_loses_still_fails(envelopes):
    df = envelopes([(NEW, [{"ID": 1}]), (OLD, [{"ID": 1, "salary_real": "x"}])])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_profiles(df).collect()
    assert staging.stg_profiles(df, ["ID", "name"]).count() == 1


def test_landed_rows_are_spread_over_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(star, "TASK_ROWS", 10)
    orders = spark.range(95).selectExpr("id AS o_orderkey", "id % 9 AS o_custkey", "'F' AS o_orderstatus")
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(25).selectExpr(
        "id AS event_id", "timestamp '2024-01-01 08:00:00' AS ts", "id AS user_id", "'view' AS event_type"
    ).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    source = star.sources(spark, str(tmp_path))
    assert source.details.rdd.getNumPartitions() == source.approvals.rdd.getNumPartitions() == 10
    assert source.timekeep.rdd.getNumPartitions() == 3
    assert rows(source.approvals) == rows(star.approvals_raw(orders))


def documents_of(spark, elements):
    columns = "ID bigint, personnel_code string, overtime string, inout string, leave_data string, absence string"
    return spark.createDataFrame([(1, "NV1", None, None, json.dumps(elements, ensure_ascii=False), None)], columns)


def test_inner_rows_are_cut_out_as_text(spark):
    """Writing a variant out as text makes a JSON factory a string."""
    inner = [{"date_start": "2026-10-01", "note": "a\\\"[b"}, {"date_start": 5}]
    elements = [
        {"reason": "r0", "detail": inner},
        {"reason": "none"},
        {"reason": "null", "detail": None},
        {"reason": "text", "detail": "[1]"},
        {"reason": "object", "detail": {"a": [1]}},
        {"reason": "empty", "detail": []},
        {"reason": "other key", "detail": inner[:1], "inoutinfo": "x"},
    ]
    flat = flatten.two_level(
        documents_of(spark, elements), marts.DETAIL_KINDS, marts.OUTER_SCALARS, ["detail", "inoutinfo"], marts.INNER_SCALARS
    )
    assert "variant" not in flat._jdf.queryExecution().optimizedPlan().toString()
    found = flat.select("outer_j.reason", F.from_json("inner_rec", "date_start string, note string").alias("i"))
    assert rows(found, "reason", "i.date_start", "i.note") == [
        ("empty", None, None),
        ("other key", "2026-10-01", "a\\\"[b"),
        ("r0", "2026-10-01", "a\\\"[b"),
        ("r0", "5", None),
    ]


@pytest.mark.parametrize(
    "element, events",
    [({"detail": [{"date_start": "2026-10-01"}]}, 1), ({"detail": []}, 1), ({"detail": None}, 1), ({"detail": "x"}, 1),
     ({"detail": {"a": 1}}, 1), ({}, 0), ({"detail": [{}, {}]}, 2)],
)
def test_first_element_keeps_values_that_are_no_array(spark, element, events):
    assert marts.int_approval_details_flat(documents_of(spark, [element])).count() == events


def test_a_string_that_opens_like_an_array_is_not_read_again(spark):
    df = spark.createDataFrame([("[Gấp] việc riêng",)], "a string").select(F.struct("a").alias("j"))
    assert df.select(jsonx.scalar("j", "a", "raise_error('read again')")).first()[0] == "[Gấp] việc riêng"


def test_refresh_builds_its_rows_once(spark, tmp_path):
    built = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(v):
        built.add(1)
        return v

    days = spark.createDataFrame([("2026-10-01", "a"), ("2026-10-02", "b"), (None, "c")], "d string, v string")
    path = str(tmp_path / "t")
    layouts.refresh_days(lambda since: days.select("d", seen("v").alias("v")), path, "d", spark)
    assert built.value == 3
    assert rows(spark.read.schema("v string, d string").parquet(path).select("d", "v")) == rows(days)


def test_fused_code_stays_within_what_the_jvm_compiles(spark):
    """The JVM interprets methods of over 8,000 bytes for good."""
    assert int(prepare_session(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_code_of_a_landed_record_is_there_once(spark):
    orders = spark.range(9).selectExpr("id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus")
    days = spark.range(1).selectExpr("timestamp '2024-01-01 08:00:00' AS ts", "id AS user_id", "'view' AS event_type")
    for df in (star.approvals_raw(orders), star.timekeep_raw(days)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("StructsToJsonEvaluator") == 1
    record = F.get_json_object("RAW_DATA", "$.data[0]")
    found = star.approvals_raw(orders).select(
        F.get_json_object(record, "$.ID").alias("id"), F.date_format("SYNC_TIME", "d").alias("day"),
        F.get_json_object(record, "$.app_approval_status").alias("status"), F.get_json_object(record, "$.desc").alias("desc"),
    )
    assert [r for r in rows(found) if r[0] in ("3", "4")] == [
        ("3", "28", "Đã duyệt", "Bản trước"),
        ("3", "29", "Đã duyệt", "Lý do 3"),
        ("4", "29", "Đã duyệt", "Lý do 4"),
        ("4", "30", "Chờ duyệt", "Bản cũ"),
    ]


def test_both_histories_parse_the_profiles_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def parsed(v):
        seen.add(1)
        return v

    names = loads.columns_of_histories()
    people = staging.stg_profiles(spark.createDataFrame([], "SYNC_TIME timestamp, RAW_DATA string"), names)
    kind = people.schema[loads.history.STAFF_HISTORY_KEY].dataType
    none = lambda f: F.lit(None).cast(f.dataType).alias(f.name)
    key = parsed(F.col("id").cast("string")).cast(kind).alias(loads.history.STAFF_HISTORY_KEY)
    once = spark.range(4).select(*[key if f.name == loads.history.STAFF_HISTORY_KEY else none(f) for f in people.schema])
    loads.load_histories(spark, once, str(tmp_path), dt.datetime(2026, 10, 1, tzinfo=dt.timezone.utc))
    assert seen.value == 4
    for name in loads.HISTORIES:
        assert spark.read.parquet(f"{tmp_path}/HISTORY/{name}").count() == 4


def test_landed_ids_are_not_broadcast(spark):
    """Spark takes ids cut out of JSON for as small as the files they came from."""
    asked, landed = spark.createDataFrame([(4,), (5,), (5,), (None,)], "id int"), spark.createDataFrame([(4,), (None,)], "id int")
    missing = worklist.missing_after_fetch(asked, landed)
    assert rows(missing) == [(None,), (5,)]
    for df in (missing, worklist.first_failures(missing)):
        df.collect()
        assert "Broadcast" not in plan(df)


def test_empty_arrays_are_not_parsed_for_their_first_element(spark, monkeypatch):
    monkeypatch.setattr(marts.jsonx, "elements", lambda c: F.when(c == "[]", F.raise_error("parsed")).otherwise(F.from_json(c, "array<string>")))
    flat = marts.int_approval_details_flat(documents_of(spark, []).withColumn("inout", F.lit('[{"inoutinfo":[{"time":"8"}]}]')))
    assert rows(flat, "detail_type", "start_time") == [("inout", "8")]
