import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rollcall import queries
from rollcall.operators import history, quality, worklist
from rollcall.plans import pipeline
from rollcall.settings import Settings, shared_dir
from rollcall.sources import tables
from rollcall.streaming import changes

UTC = dt.timezone.utc


def frame(spark, values, schema):
    return spark.createDataFrame(values, schema)


def test_replace_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(5), path)
    tables.replace(spark.read.parquet(path).filter("id > 2"), path)
    tables.append(spark.range(1), path)
    assert rows(spark.read.parquet(path)) == [(0,), (3,), (4,)]
    assert not tables.exists(spark, path + tables.SIDE_SUFFIX)


def test_window_replace_drops_days_missing_from_the_pull(spark):
    old = frame(spark, [("2026-09-30", "o"), ("2026-10-01", "o"), ("2026-10-02", "o")], "d string, v string")
    new = frame(spark, [("2026-10-02", "n")], "d string, v string")
    assert rows(tables.window_rows(old, new, "d", "2026-10-01")) == [("2026-09-30", "o"), ("2026-10-02", "n")]


def test_upsert_keeps_forward_status_and_null_ids(spark):
    schema = "id int, status string, seq int"
    old = frame(
        spark,
        [(1, "Chờ duyệt", 1), (2, "Chờ duyệt", 2), (2, "Đã duyệt", 3), (3, None, 4), (3, "Đã duyệt", 5),
         (None, "Chờ duyệt", 6)],
        schema,
    )
    changed = frame(spark, [(1, "Không duyệt", 10), (9, "Chờ duyệt", 11)], schema)
    got = tables.upsert_rows(old, changed, "id", "status", "seq")
    assert rows(got, "id", "seq") == [(None, 6), (1, 10), (2, 3), (3, 4), (9, 11)]


def test_verified_rewrite_and_recovery(spark, tmp_path):
    path = str(tmp_path / "t")
    side = path + tables.SIDE_SUFFIX
    tables.replace(spark.range(5), path)
    assert tables.verified_rewrite(spark, path) and spark.read.parquet(path).count() == 5
    spark.range(4).write.parquet(side)
    assert not tables.swap_if_equal(spark, path)
    assert spark.read.parquet(path).count() == 5 and not tables.exists(spark, side)
    assert tables.recover(spark, path) == "clean"
    spark.range(5).write.parquet(side)
    assert tables.recover(spark, path) == "dropped" and not tables.exists(spark, side)
    spark.range(5).write.parquet(side)
    tables.drop(spark, path)
    assert tables.recover(spark, path) == "restored"
    assert spark.read.parquet(path).count() == 5 and not tables.exists(spark, side)


def test_expiring_choice(spark):
    now = dt.datetime(2026, 10, 9, tzinfo=UTC)
    later = lambda n: now + dt.timedelta(days=n)
    listing = frame(
        spark,
        [("RAW_A", later(10)), ("RAW_B", later(55)), ("MART_C", later(1)), ("RAW_D__renew", later(1)),
         ("RAW_E", None), ("RAW_F", later(30))],
        "name string, expires timestamp",
    )
    assert rows(tables.expiring(listing, "name", "expires", now), "name") == [("RAW_A",), ("RAW_F",)]


def test_mart_layout_splits_a_hot_day(spark, tmp_path):
    path = str(tmp_path / "m")
    day = F.when(F.col("id") % 3 == 0, F.lit("2026-10-01")).otherwise(F.concat(F.lit("2026-10-1"), F.col("id") % 7))
    df = spark.range(0, 9000, 1, 4).select("id", day.cast("date").alias("d"), F.lit("hot").alias("p"))
    # Small partitions would be merged again here, which large ones are not.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tables.write_mart(df, path, "d", "p")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(path)
    assert back.count() == 9000
    hot = back.filter("d = '2026-10-01'").select(F.input_file_name()).distinct().count()
    assert hot > 1
    assert tables.layer_path("/r", "m", " MART ") == "/r/MART/m"
    assert tables.layer_path("/r", "m") == "/r/main/m"


def test_id_tail_against_a_loop(spark):
    rnd = random.Random(3)
    for _ in range(6):
        probes = [(100 + n, rnd.choices(["hit", "miss", "error"], [5, 5, 0.1])[0]) for n in range(1, 260)]
        probes = [p for p in probes if p[0] != rnd.randrange(101, 500)]
        want, misses = [], 0
        for at, (i, outcome) in enumerate(probes):
            if outcome == "error" or i != 101 + at:
                break
            misses = 0 if outcome == "hit" else misses + 1
            if outcome == "hit":
                want.append(i)
            if misses == 3:
                break
        known = frame(spark, [(100,), (7,)], "id int")
        landed = frame(spark, probes, "id int, outcome string")
        got = worklist.id_tail(known, landed, "id", "id", "outcome")
        assert sorted(r[0] for r in got.collect()) == want


def test_id_tail_has_no_budget_and_ends_at_a_gap(spark):
    known = frame(spark, [(1,)], "id int")
    hits = frame(spark, [(n, "hit") for n in range(2, 502)], "id int, outcome string")
    assert worklist.id_tail(known, hits, "id", "id", "outcome").count() == 500
    gap = frame(spark, [(2, "hit"), (3, "miss"), (6, "hit")], "id int, outcome string")
    assert rows(worklist.id_tail(known, gap, "id", "id", "outcome")) == [(2,)]
    none = frame(spark, [(6, "hit")], "id int, outcome string")
    assert worklist.id_tail(known, none, "id", "id", "outcome").count() == 0


def test_page_cut_takes_every_page(spark):
    df = frame(spark, [(n // 10 + 1, "09/10/2026 11:19") for n in range(1200)], "page int, created string")
    assert worklist.page_cut(df, "page", "created", dt.date(2026, 10, 9), 30).count() == 1200


@pytest.mark.parametrize(
    "pages, taken",
    [
        ([["09/10", "20/09"], ["15/09", "05/09"], ["01/09"]], 4),
        ([["09/10", "08/10"]], 2),
        ([["09/10", "08/10"], None, ["07/10"]], 2),
        ([["09/10", "xx"], ["07/10"]], 3),
    ],
)
def test_page_cut(spark, pages, taken):
    items = [(n, f"{d}/2026 11:19") for n, page in enumerate(pages, 1) for d in page or []]
    df = frame(spark, items, "page int, created string")
    assert worklist.page_cut(df, "page", "created", dt.date(2026, 10, 9), 30).count() == taken


def test_page_cut_rejects_an_unsorted_listing(spark):
    df = frame(spark, [(1, "01/02/2023"), (1, "05/02/2023")], "page int, created string")
    with pytest.raises(Exception, match="not newest first"):
        worklist.page_cut(df, "page", "created", dt.date(2026, 10, 9), 30).collect()


def test_missing_after_fetch(spark):
    asked, landed = frame(spark, [(4,), (5,), (5,)], "id int"), frame(spark, [(4,)], "id int")
    missing = worklist.missing_after_fetch(asked, landed)
    assert rows(missing) == [(5,)]
    many = spark.range(100, 0, -1)
    assert [r[0] for r in worklist.first_failures(many).collect()] == list(range(1, 21))


def test_pending_and_stale_lists(spark, envelopes, documents):
    def item(i, status, created="01/10/2026"):
        return {"ID": i, "app_approval_status": status, "date_created": created}

    listed = envelopes([(None, [item(1, "Chờ duyệt"), item(2, "Chờ duyệt"), item(2, "Đã duyệt"),
                                item(3, "Chờ duyệt", "01/01/2026"), item(4, None, "01/01/2026"),
                                item(5, "Chờ duyệt", "01/01/2026"), item(6, "Chờ duyệt", "02/01/2026"),
                                item(7, "Chờ duyệt"), item(None, "Chờ duyệt")])])
    docs = documents(
        [(1, {"data": item(1, "Chờ duyệt")}, None), (5, {"error": True, "message": "Post not found"}, None),
         (6, {"data": item(6, "Không duyệt")}, None), (7, {"data": item(7, "Đã duyệt")}, None),
         (8, {"data": item(8, "Chờ duyệt")}, None)]
    )
    as_of = dt.date(2026, 10, 9)
    pending = worklist.pending_worklist(docs, listed, as_of)
    assert [r[0] for r in pending.collect()] == [8, 1]
    assert [r[0] for r in worklist.pending_worklist(docs, listed, as_of, limit=1).collect()] == [8]
    stale = worklist.stale_pending(listed, docs, dt.date(2026, 9, 1))
    assert rows(stale) == [(3,), (4,)]
    window = worklist.window_ids(listed, dt.date(2026, 10, 1), dt.date(2026, 10, 1))
    assert rows(window) == [(1,), (2,), (7,)]
    refresh = worklist.refresh_worklist(listed, docs, dt.date(2026, 9, 1), as_of)
    assert rows(refresh) == [(1,), (2,), (3,), (4,), (7,)]
    moved = frame(spark, [(1, "Đã duyệt"), (8, ""), (8, None), (9, "Đã duyệt")], "id bigint, status string")
    assert rows(worklist.status_changes(pending, moved), "id", "status") == [(1, "Đã duyệt")]


def test_page_completeness(spark):
    pages = frame(
        spark, [("a", 90, 100), ("a", 10, 100), ("b", 90, 100)] + [("c", 1, 100)] * 50,
        "day string, size int, total int",
    )
    got = rows(worklist.page_completeness(pages, "day", "size", "total"), "day", "status")
    assert got == [("a", "ok"), ("b", "short"), ("c", "overflow")]


def test_history_versions(spark):
    schema = "ID int, a string, b int, other int"
    one, two, three = (dt.datetime(2026, 1, d, tzinfo=UTC) for d in (1, 2, 3))
    first = frame(spark, [(1, "x", 1, 0), (2, "x", None, 0), (3, "x", 1, 0), (4, None, 1, 0)], schema)
    second = frame(spark, [(1, "x", 1, 9), (2, "x", 5, 0), (4, None, 1, 0), (5, "n", 1, 0)], schema)
    opened = history.open_history(first, one)
    merged = history.scd2_check(opened, second, "ID", ["a", "b"], two)
    again = history.scd2_check(merged, second.filter("ID != 5"), "ID", ["a", "b"], three)
    day = lambda c: F.dayofmonth(c)
    got = rows(again.select("ID", "b", "other", day("valid_from"), day("valid_to")))
    assert got == [
        (1, 1, 0, 1, None), (2, None, 0, 1, 2), (2, 5, 0, 2, None), (3, 1, 0, 1, None),
        (4, 1, 0, 1, None), (5, 1, 0, 2, None),
    ]


def test_quality_checks(spark):
    df = frame(spark, [(1, "a", True), (1, "b", None), (None, "z", False), (None, None, True)], "id int, v string, f boolean")
    checks = (
        quality.not_null("id", "v") + quality.unique("id") + quality.accepted("v", ["a", "b"])
        + quality.accepted("f", [True, False]) + quality.accepted("v", ["a"], "id is not null")
    )
    got = quality.run_checks(df, "m", checks)
    assert [tuple(r)[1:] for r in got.collect()] == [
        ("id", "not_null", 2, "ERROR"), ("v", "not_null", 1, "ERROR"), ("id", "unique", 1, "ERROR"),
        ("v", "accepted_values", 1, "ERROR"), ("f", "accepted_values", 0, "PASS"),
        ("v", "accepted_values", 1, "ERROR"),
    ]
    assert tuple(quality.summary(got).first()) == (1, 0, 5, 0, 6)
    assert quality.require_rows(df, 4, "m") == 4
    with pytest.raises(ValueError, match="4 < 5"):
        quality.require_rows(df, 5, "m")


@pytest.mark.parametrize("hours, status", [(25, "PASS"), (26, "WARN"), (49, "WARN"), (50, "ERROR")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2026, 10, 9, tzinfo=UTC)
    df = frame(spark, [(now - dt.timedelta(hours=hours),), (None,)], "t timestamp")
    assert quality.freshness(df, "s", "t", now).first().status == status
    assert quality.freshness(df.limit(0), "s", "t", now).first().status == "ERROR"


def test_stream_is_replayable_and_forward_only(spark, tmp_path):
    schema = "id bigint, status string, seq bigint"
    landing, log, mark = (str(tmp_path / n) for n in ("in", "log", "mark"))
    typed = frame(spark, [(1, "Chờ duyệt", 1), (2, "Chờ duyệt", 2)], schema)
    typed.coalesce(1).write.parquet(landing)
    changes.log_changes(changes.landed_files(spark, landing, typed.schema, glob="*.parquet"), log, mark)
    frame(spark, [(1, "Đã duyệt", 3), (2, "Chờ duyệt", 4), (1, "Chờ duyệt", 5)], schema).coalesce(1).write.mode(
        "append"
    ).parquet(landing)
    changes.log_changes(changes.landed_files(spark, landing, typed.schema, glob="*.parquet"), log, mark)
    # Nothing new: a third drain adds nothing.
    changes.log_changes(changes.landed_files(spark, landing, typed.schema, glob="*.parquet"), log, mark)
    state = changes.current_state(spark, log, typed.schema, "id", "status", "seq")
    assert rows(state) == [(1, "Đã duyệt", 3), (2, "Chờ duyệt", 2)]
    changes.compact(state, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2


def test_run_writes_marts_and_skips_without_the_sheet(spark, tmp_path):
    from rollcall.sources import star
    from rollcall.sources.raw import Sources

    src = star.sources(spark, "/root/testdata/sf0.001")
    landed = Sources(src.profiles, src.approvals, src.details, src.timekeep)
    names = ["dim_date", "mart_profiles", "mart_approvals", "mart_headcount_snapshot"]
    written = pipeline.run(spark, landed, star.SETTINGS, str(tmp_path), names)
    assert sorted(written) == ["dim_date", "mart_approvals", "mart_headcount_snapshot"]
    mart = spark.read.parquet(written["mart_approvals"])
    assert mart.count() == pipeline.Pipeline(spark, landed, star.SETTINGS).model("mart_approvals").count()
    assert pipeline.skipped_models(True) == []
    assert list((tmp_path / "STG").glob("*/*")) == []


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert Settings(as_of=dt.date(2026, 1, 1)).as_of_ts.tzinfo is UTC


def test_stream_reads_a_table_of_many_files(spark, tmp_path):
    one = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    one.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    got = queries.QUERIES["stream_upsert"](spark, str(tmp_path))
    want = queries.QUERIES["stream_upsert"](spark, "/root/testdata/sf0.001")
    assert rows(got) == rows(want) and got.count() > 0


def test_calendar_must_reach_today():
    with pytest.raises(ValueError, match="calendar ends"):
        Settings(as_of=dt.date(2031, 1, 1))
