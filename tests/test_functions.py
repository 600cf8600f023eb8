import datetime as dt

import pytest
from pyspark.sql import functions as F

from labwh import functions as lf
from tests.helpers import day, rows, ts


def one(spark, *cols):
    return spark.range(1).select(*cols).collect()[0]


def test_proportion_handles_zero_null_and_text(spark):
    df = spark.createDataFrame(
        [(1, 3), (0, 5), (2, 0), (None, 4), (3, None), (5, 5)], "n int, d int"
    )
    got = rows(df.select("n", "d", lf.proportion("n", "d").alias("p"), lf.proportion("n", "d", True).alias("t")))
    assert (1, 3, 33.33, "33.33%") in got
    assert (0, 5, 0.0, "0.0%") in got
    assert (2, 0, None, None) in got
    assert (None, 4, None, None) in got
    assert (3, None, None, None) in got
    assert (5, 5, 100.0, "100.0%") in got


def test_scaling_cuts_off(spark):
    got = one(spark, lf.in_ten_thousands(F.lit(19999.99)).alias("a"), lf.in_ten_thousands(F.lit(-19999)).alias("b"))
    assert (got.a, got.b) == (1, -1)


def test_magnitude_cell_is_monotone(spark):
    values = [-1e9, -5.0, -0.5, 0.0, 0.1, 1.0, 1.5, 2.0, 1000.0, 1001.0, 1e12]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.c for r in df.orderBy("v").select(lf.magnitude_cell("v").alias("c")).collect()]
    assert got == sorted(got)


def test_text_key_separates_month_and_day(spark):
    df = spark.createDataFrame([(7, 1, 11), (7, 11, 1)], "p int, m int, d int")
    assert rows(df.select(lf.text_key("p", "m", "d").alias("k"))) == [("70111",), ("71101",)]


def test_filled_compares_numbers_as_text(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "s string").withColumn("n", F.lit(5))
    got = rows(df.select("s", lf.filled("s").alias("f"), lf.any_filled("s", F.lit(None).cast("string")).alias("g"), lf.filled("n").alias("h")))
    assert got == [(None, False, False, True), ("", False, False, True), ("x", True, True, True)]


@pytest.mark.parametrize(
    "start, months, want",
    [("2020-03-31", -1, "2020-02-29"), ("2021-03-31", -1, "2021-02-28"), ("2020-01-31", 3, "2020-04-30"), ("2020-01-15", -1, "2019-12-15")],
)
def test_add_months_clips_to_month_end(spark, start, months, want):
    assert lf.add_months(day(start), months) == day(want)
    got = one(spark, F.add_months(F.lit(day(start)), months).alias("d")).d
    assert got == day(want)


def test_windows_are_half_open(spark):
    df = spark.createDataFrame(
        [(ts("2020-02-29 23:59:59"),), (ts("2020-03-01 00:00:00"),), (ts("2020-03-31 23:59:59"),), (ts("2020-04-01 00:00:00"),)],
        "t timestamp_ntz",
    )
    assert df.where(lf.in_unit("t", day("2020-03-15"), "month")).count() == 2
    assert df.where(lf.in_unit("t", day("2020-02-29"), "day")).count() == 1
    assert df.where(lf.in_unit("t", day("2020-01-01"), "year")).count() == 4
    assert df.where(lf.in_previous_month("t", day("2020-04-30"))).count() == 2
    assert df.where(lf.months_window("t", day("2020-04-30"), -1, 0)).count() == 2
    assert df.where(lf.months_window("t", day("2020-04-30"), 0)).count() == 1
    with pytest.raises(ValueError):
        lf.unit_range(day("2020-01-01"), "week")


@pytest.mark.parametrize(
    "as_of, pay_day, want",
    [
        # Due on the 15th (1 + 10 + 4).
        ("2020-06-14", 10, "2020-04-01"),
        ("2020-06-15", 10, "2020-04-01"),
        ("2020-06-16", 10, "2020-05-01"),
        # The due day falls into the next month: two months back, whatever the day.
        ("2020-06-30", 28, "2020-04-01"),
        ("2020-01-20", 3, "2019-12-01"),
    ],
)
def test_grace_month(spark, as_of, pay_day, want):
    df = spark.createDataFrame([(pay_day,)], "p int")
    assert df.select(lf.grace_month("p", day(as_of))).collect()[0][0] == day(want)


def test_text_timestamps(spark):
    df = spark.createDataFrame([("2019-11-30 10:14:09",), ("broken",)], "t string")
    got = rows(df.select(lf.compact_timestamp("t").alias("c")).select("c", lf.day_of_compact("c"), lf.hour_of_compact("c")))
    assert got == [("19700101000000", "19700101", "00"), ("20191130101409", "20191130", "10")]
    assert rows(df.select(lf.epoch_millis("t")))[0] == (0,)


def test_calendar_parts(spark):
    df = spark.createDataFrame([(ts("2020-05-06 07:08:09"),)], "t timestamp_ntz")
    got = df.select(*[c.alias(n) for n, c in lf.calendar_parts("t", "record").items()]).collect()[0]
    assert got.asDict() == {
        "record_year": 2020, "record_month": 5, "record_day": 6, "record_hour": 7, "record_minute": 8,
    }
    assert isinstance(lf.month_start(dt.date(2020, 5, 6), -5), dt.date)
