import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rollcall.functions import jsonx, safe, text
from rollcall.operators import spine
from rollcall.settings import Settings
from rollcall.sources import raw

D = dt.date


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "record, expected",
    [
        ('{"a":"x"}', "x"),
        ('{"a":1.0}', "1.0"),
        ('{"a":7}', "7"),
        ('{"a":true}', "true"),
        ('{"a":null}', None),
        ("{}", None),
        ('{"a":{"b":1}}', None),
        ('{"a":[1]}', None),
        ('{"a":"[Gấp] xin nghỉ"}', "[Gấp] xin nghỉ"),
        ('{"a":"[1]"}', "[1]"),
        ('{"a":"{\\"b\\":1}"}', '{"b":1}'),
        ('{"a":""}', ""),
    ],
)
def test_scalar_reads_scalars_only(spark, record, expected):
    df = spark.createDataFrame([(record,)], "rec string")
    df = df.withColumn("j", jsonx.record_struct(F.col("rec"), ["a"]))
    assert df.select(jsonx.scalar("j", "a", "rec")).first()[0] == expected


@pytest.mark.parametrize(
    "record, as_text, has_items, elements",
    [
        ("{}", None, False, None),
        ('{"a":null}', "null", True, None),
        ('{"a":[]}', "[]", False, []),
        ('{"a":[{}]}', "[{}]", True, ["{}"]),
        ('{"a":{"b":1}}', '{"b":1}', True, None),
        ('{"a":"[1]"}', '"[1]"', True, None),
    ],
)
def test_documents_tell_null_from_missing(spark, record, as_text, has_items, elements):
    df = spark.createDataFrame([(record,)], "rec string")
    df = df.select(jsonx.record_struct(F.col("rec"), [], ["a"]).alias("j"))
    df = df.withColumn("t", jsonx.document(F.col("j.a")))
    got = df.select("t", jsonx.has_items(F.col("t")), jsonx.elements(F.col("t"))).first()
    assert tuple(got) == (as_text, has_items, elements)
    assert df.select(jsonx.variant_elements(F.col("j.a"))).first()[0] == elements


@pytest.mark.parametrize(
    "value, dmy, loader, ymd, cast",
    [
        ("8/1/2026", D(2026, 1, 8), D(2026, 1, 8), None, None),
        ("08/10/2026 11:19", None, D(2026, 10, 8), None, None),
        ("31/02/2026", None, None, None, None),
        ("", None, None, None, None),
        ("abc", None, None, None, None),
        (None, None, None, None, None),
        ("2026-9-1", None, None, D(2026, 9, 1), D(2026, 9, 1)),
        ("2026-09-01 10:00:00", None, None, None, None),
        ("2026", None, None, None, None),
    ],
)
def test_dates(spark, value, dmy, loader, ymd, cast):
    df = spark.createDataFrame([(value,)], "v string")
    v = F.col("v")
    parsers = [safe.date_dmy, safe.loader_date, safe.date_ymd, safe.cast_date]
    assert tuple(df.select(*[p(v) for p in parsers]).first()) == (dmy, loader, ymd, cast)


@pytest.mark.parametrize(
    "utc, days, start",
    [
        ("2026-10-01 03:00:00", 3, D(2026, 9, 28)),
        ("2026-09-30 22:00:00", 3, D(2026, 9, 28)),
        ("2026-10-01 03:00:00", 7, D(2026, 9, 24)),
    ],
)
def test_window_start_is_a_local_day(spark, utc, days, start):
    ts = F.lit(utc).cast("timestamp")
    assert one(spark, safe.window_start(ts, days)) == start


def test_window_days_cross_the_month(spark):
    ts = F.lit("2026-10-01 03:00:00").cast("timestamp")
    days = one(spark, raw.reload_days(ts, 3))
    assert days == ["2026-09-28", "2026-09-29", "2026-09-30", "2026-10-01"]


def test_window_days_never_count_down(spark):
    ts = F.lit("2026-09-30 22:00:00").cast("timestamp")
    assert one(spark, raw.reload_days(ts, 0)) == []


def test_boundaries_not_elapsed_units(spark):
    a, b = F.lit(D(2026, 1, 1)), F.lit(D(2000, 12, 31))
    assert one(spark, safe.years_between(a, b)) == 26
    assert one(spark, safe.months_between(F.lit(D(2026, 2, 1)), F.lit(D(2026, 1, 31)))) == 1
    assert one(spark, safe.weeks_between(F.lit(D(2026, 9, 7)), F.lit(D(2026, 9, 6)))) == 1
    assert one(spark, safe.weeks_between(F.lit(D(2026, 8, 30)), F.lit(D(2026, 8, 31)))) == -1


@pytest.mark.parametrize("clock, minutes", [("08:05", "08:05"), ("08:05:59", "08:05"), ("", "00:00"), (None, "00:00")])
def test_clock_minutes(spark, clock, minutes):
    df = spark.createDataFrame([(clock,)], "c string")
    assert df.select(safe.clock_minutes(F.col("c"))).first()[0] == minutes


def test_ratio_and_bad_clock(spark):
    assert one(spark, safe.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, safe.ratio(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, safe.minute_stamp(F.lit(D(2026, 1, 1)), F.lit("25:00"))) is None


def test_white_space_of_any_kind_is_blank(spark):
    for blank in ("", " ", "\t\n", "\u00a0\u3000 "):
        assert one(spark, safe.blank_to(F.lit(blank), "d")) == "d"
    assert one(spark, safe.blank_to(F.lit("\u00a0x y\t"), "d")) == "x y"
    assert one(spark, safe.date_dmy(F.lit("\t8/1/2026\u00a0"))) == D(2026, 1, 8)
    assert one(spark, F.expr(safe.DATE_DMY_SQL.format("'\u00a08/1/2026 '"))) == D(2026, 1, 8)


def test_calendar(spark):
    cfg = Settings(as_of=D(2024, 1, 30))
    dim = spine.dim_date(spark, cfg)
    assert dim.count() == 4018
    sunday = dim.filter("date = '2026-09-06'").first()
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekday) == (7, "Chủ nhật", False)
    monday = dim.filter("date = '2026-08-31'").first()
    assert (monday.day_of_week, monday.day_name, monday.month_name) == (1, "Thứ 2", "Tháng 8")


def test_redact(spark):
    line = "url?Access_Token=abc123&x=1 secret='q' token=zz\"t SuperSecretValue short"
    got = one(spark, text.redact(F.lit(line), ["SuperSecretValue", "short", " "]))
    assert got == "url?Access_Token=***&x=1 secret='q' token=***\"t *** short"
    assert one(spark, text.redact(F.lit("token=ab\u00a0cd"))) == "token=***\u00a0cd"


def test_scrape(spark):
    log = "x\nFailure in test a_b (m.yml)\n Failure in test no\nDone. PASS=24 WARN=0 ERROR=1 SKIP=0 TOTAL=25\n"
    assert one(spark, text.run_summary(F.lit(log))) == "Done. PASS=24 WARN=0 ERROR=1 SKIP=0 TOTAL=25"
    assert one(spark, text.run_failures(F.lit(log))) == "Failure in test a_b (m.yml)"
    assert one(spark, text.run_summary(F.lit("nothing"))) == ""
    # A carriage return or line separator does not end a line.
    odd = "x\rFailure in test a\nFailure in test b\u2028c"
    assert one(spark, text.run_failures(F.lit(odd))) == "Failure in test b\u2028c"


def test_landed_json_and_sheet(spark, tmp_path):
    path = tmp_path / "landed.json"
    path.write_text(
        '{"SYNC_DATE":"2026-10-01","RAW_DATA":{"data":[{"ID":1},{"ID":2}]}}\n'
        '{"SYNC_TIME":"2026-10-02T00:00:00Z","SYNC_DATE":"2026-10-02","RAW_DATA":{"data":[]}}\n'
    )
    batch = dt.datetime(2026, 10, 5, tzinfo=dt.timezone.utc)
    df = raw.read_landed_json(spark, str(path), "timekeep", batch)
    got = rows(df.select(F.col("SYNC_TIME").cast("string"), raw.landed_records(F.col("RAW_DATA"))))
    assert got == [("2026-10-02 00:00:00", 0), ("2026-10-05 00:00:00", 2)]

    sheet = tmp_path / "sheet.csv"
    sheet.write_text(",".join(raw.TRACKING_COLUMNS) + "\nA_20261001,A,2026-10-01,x,,HR,\n")
    tracked = raw.read_sheet(spark, str(sheet), raw.TRACKING_COLUMNS)
    assert tracked.first().TRANG_THAI_XU_LY is None
