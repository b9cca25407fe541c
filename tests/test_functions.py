"""Arithmetic, calendar and text helpers on the values that are easy to get wrong."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from frames import frame, ts
from pyspark.sql import functions as F

from statledger.functions import numeric as n
from statledger.functions import text as x
from statledger.functions import timeparts as tp


def one(spark, expr, schema="a INT", *row):
    df = frame(spark, schema, row or (1,))
    return df.select(expr.alias("v")).first()["v"]


def test_integer_division_truncates_toward_zero_and_guards(spark):
    df = frame(spark, "a BIGINT, b BIGINT", (7, 2), (-7, 2), (7, -2), (5, 0), (None, 3))
    rows = df.select(n.int_div("a", "b").alias("d"), n.guarded_div("a", "b").alias("g")).collect()
    assert [r["d"] for r in rows] == [3, -3, -3, None, None]
    assert [r["g"] for r in rows] == [3, -3, -3, 0, None]


def test_integer_mean_is_truncated_and_ignores_nulls(spark):
    df = frame(spark, "a INT", *[(100,)] * 8, (101,), (None,))
    assert df.agg(n.int_avg("a").alias("m")).first()["m"] == 100


def test_percentage_is_cut_at_six_digits_first(spark):
    v = one(spark, n.pct_trunc("a", "b"), "a BIGINT, b BIGINT", 12344996, 100000000)
    assert v == Decimal("12.34")
    assert one(spark, n.pct_trunc("a", "b"), "a BIGINT, b BIGINT", 1, 0) is None
    assert one(spark, n.pct_trunc("a", "b"), "a BIGINT, b BIGINT", 2, 3) == Decimal("66.67")


def test_ratio_and_truncating_cast(spark):
    assert one(spark, n.ratio3("a", "b"), "a BIGINT, b BIGINT", 2, 3) == Decimal("0.667")
    assert one(spark, n.ratio3("a", "b"), "a BIGINT, b BIGINT", 2, 0) is None
    assert one(spark, n.trunc_int("a"), "a DECIMAL(9,2)", Decimal("2.70")) == 2
    assert one(spark, n.trunc_int("a"), "a DECIMAL(9,2)", Decimal("-2.70")) == -2


def test_units(spark):
    assert one(spark, n.pages_to_mb("a"), "a BIGINT", 12801) == 100
    assert one(spark, n.bytes_to_mb("a"), "a BIGINT", 3 * 1024 * 1024 - 1) == 2
    assert one(spark, n.micros_to_millis("a"), "a BIGINT", 1999) == 1


def us_week(day: date) -> int:
    """Count Sundays: week 1 starts on January 1, each Sunday starts the next one."""
    week, d = 1, date(day.year, 1, 1)
    while d < day:
        d += timedelta(days=1)
        if d.weekday() == 6:
            week += 1
    return week


def test_year_week_day_by_day(spark):
    days = [date(y, 1, 1) + timedelta(days=i) for y in (1995, 2000, 2011, 2016, 2023, 2024) for i in range(366)]
    df = spark.createDataFrame([(datetime(d.year, d.month, d.day, 23, 59),) for d in days], "d TIMESTAMP_NTZ")
    got = [r["v"] for r in df.select(tp.year_week("d").alias("v")).collect()]
    assert got == [f"{d.year}.{us_week(d):02d}" for d in days]


def test_week_53_and_year_edges(spark):
    for text, want in {
        "2022-12-31": "2022.53", "2023-01-01": "2023.01", "2016-12-31": "2016.53", "2017-01-01": "2017.01",
        "2028-12-31": "2028.54",
    }.items():
        assert one(spark, tp.year_week("a"), "a TIMESTAMP_NTZ", ts(text)) == want


@pytest.mark.parametrize("unit, start, end, want", [
    ("minute", "2024-01-01 00:00:59", "2024-01-01 00:01:00", 1),
    ("minute", "2024-01-01 00:01:00", "2024-01-01 00:01:59", 0),
    ("day", "2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
    ("hour", "2024-01-01 10:59:00", "2024-01-01 09:01:00", -1),
    ("second", "1969-12-31 23:59:59.900", "1970-01-01 00:00:00.100", 1),
    ("minute", "1969-12-31 23:59:59", "1970-01-01 00:00:00", 1),
])
def test_boundaries_crossed(spark, unit, start, end, want):
    got = one(spark, tp.boundary_diff(unit, "a", "b"), "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ", ts(start), ts(end))
    assert got == want


def test_time_results_do_not_depend_on_the_session_zone(spark):
    df = frame(spark, "a TIMESTAMP_NTZ", (ts("2024-03-31 02:30:00"),))
    picked = df.select(
        tp.wall_seconds("a").alias("s"), tp.midnight("a").alias("m"), tp.year_week("a").alias("w"),
        (F.col("a") > tp.ts_lit("2024-03-31 02:29:59")).alias("later"),
    )
    before = picked.first()
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert df.select(*[tp.wall_seconds("a").alias("s"), tp.midnight("a").alias("m"), tp.year_week("a").alias("w"),
                           (F.col("a") > tp.ts_lit("2024-03-31 02:29:59")).alias("later")]).first() == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_packed_values(spark):
    schema = "d INT, t INT"
    assert one(spark, tp.packed_datetime("d", "t"), schema, 20240131, 90507) == datetime(2024, 1, 31, 9, 5, 7)
    assert one(spark, tp.packed_datetime("d", "t"), schema, 20240131, 5) == datetime(2024, 1, 31, 0, 0, 5)
    assert one(spark, tp.packed_datetime("d", "t"), schema, 20241331, 0) is None
    assert one(spark, tp.packed_seconds("a"), "a INT", 235959) == 86399
    assert one(spark, tp.packed_seconds("a"), "a INT", 1000000) == 360000


def test_ticks_and_fractional_days(spark):
    at = tp.tick_time("2024-01-31 00:00:00", 10_000, "a")
    assert one(spark, at, "a BIGINT", 8_500) == datetime(2024, 1, 30, 23, 59, 58, 500000)
    assert tp.days_before("2024-01-31 00:00:00", 6.9) == datetime(2024, 1, 24, 2, 24)
    assert tp.days_before("2024-01-31 00:00:00", 2 / 24) == datetime(2024, 1, 30, 22)


def test_text_helpers(spark):
    assert one(spark, x.quotename("a"), "a STRING", "odd]name") == "[odd]]name]"
    assert one(spark, x.clean_text("a"), "a STRING", "  a\tb\r\nc ") == "abc"
    assert one(spark, x.message_tail("a"), "a STRING", "The job failed.  " + "z" * 60) == " " + "z" * 44
    assert one(spark, x.rebuild_index_command("t", "i"), "t STRING, i STRING", "T", None) is None
    assert one(spark, x.optimize_command("d", "t", "i", online=False), "d STRING, t STRING, i STRING", "D", "T", "I") == (
        "EXECUTE [master].[dbo].[IndexOptimize] @Databases = [D], @Indexes = 'D.dbo.T.[I]',@PageCountLevel=8,"
        "@TimeLimit = 900, @MaxDOP = '2',@FragmentationMedium = 'INDEX_REBUILD_OFFLINE,INDEX_REORGANIZE', "
        "@FragmentationHigh = 'INDEX_REBUILD_OFFLINE,INDEX_REORGANIZE', @LogToTable = 'Y'"
    )


def test_statement_slice(spark):
    schema = "t STRING, s INT, e INT"
    cut = x.statement_slice("t", "s", "e")
    assert one(spark, cut, schema, "select 1; select 2", 20, -1) == " select "  # begins and ends one character early
    assert one(spark, cut, schema, "abcdef", 0, -1) == "abcde"  # a start of 0 costs one character
    assert one(spark, cut, schema, "abcdef", 2, 6) == "ab"
    assert one(spark, cut, schema, "abcdef", 4, 8) == "bc"
    whole = x.statement_slice("t", "s", "e", as_written=False)
    assert one(spark, whole, schema, "select 1; select 2", 20, -1) == "select 2"
    assert one(spark, whole, schema, "select 1; select 2", 0, 14) == "select 1"
    assert one(spark, whole, schema, "abcdef", 0, -1) == "abcdef"
