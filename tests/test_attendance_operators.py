from pyspark.sql import functions as F

from labwh.operators import active_by_window, pair_in_out, within_validity
from tests.helpers import day, plan_text, rows, ts

SCHEMA = "who string, t timestamp_ntz, d int, sn string"
SWIPES = [
    ("both", ts("2020-05-01 08:00:00"), 1, "A"),
    ("both", ts("2020-05-01 07:30:00"), 1, "B"),
    ("both", ts("2020-05-01 17:00:00"), 2, "C"),
    ("both", ts("2020-05-01 12:00:00"), 2, "D"),
    ("in_only", ts("2020-05-01 08:00:00"), 1, "A"),
    ("out_only", ts("2020-05-01 08:00:00"), 2, "A"),
    ("reversed", ts("2020-05-01 18:00:00"), 1, "A"),
    ("reversed", ts("2020-05-01 08:00:00"), 2, "B"),
    ("midnight", ts("2020-05-01 22:00:00"), 1, "A"),
    ("midnight", ts("2020-05-02 06:00:00"), 2, "A"),
    ("tie", ts("2020-05-01 08:00:00"), 1, "Z"),
    ("tie", ts("2020-05-01 08:00:00"), 1, "Y"),
    ("tie", ts("2020-05-01 08:00:00"), 2, "X"),
    ("other", ts("2020-05-01 08:00:00"), 3, "X"),
]


def pairs(spark, **variant):
    df = spark.createDataFrame(SWIPES, SCHEMA)
    return pair_in_out(
        df, ["who"], "t", F.col("d") == 1, F.col("d") == 2,
        {"in_sn": F.col("sn")}, {"out_sn": F.col("sn")}, ["sn"], **variant,
    )


def test_pairs(spark):
    got = {(r.who, str(r.record_date)): r for r in pairs(spark).collect()}
    assert len(got) == 7
    both = got["both", "2020-05-01"]
    assert (both.in_sn, both.out_sn, both.sn, both.worktime, both.attendance_status) == ("B", "C", "B", 9.5, 0)
    only = got["in_only", "2020-05-01"]
    assert (only.out_sn, only.worktime, only.attendance_status) == (None, None, 1)
    out = got["out_only", "2020-05-01"]
    assert (out.in_sn, out.sn, out.worktime, out.attendance_status) == (None, "A", None, 1)
    back = got["reversed", "2020-05-01"]
    assert (back.worktime, back.attendance_status) == (-10.0, 1)
    # Work across midnight is two halves.
    assert got["midnight", "2020-05-01"].out_sn is None
    assert got["midnight", "2020-05-02"].in_sn is None
    tie = got["tie", "2020-05-01"]
    assert (tie.in_sn, tie.worktime, tie.attendance_status) == ("Y", 0.0, 0)


def test_strict_variant(spark):
    got = {(r.who, str(r.record_date)): r for r in pairs(spark, missing_worktime=0, status_ok=1).collect()}
    assert (got["in_only", "2020-05-01"].worktime, got["in_only", "2020-05-01"].attendance_status) == (0.0, 0)
    assert got["both", "2020-05-01"].attendance_status == 1


def test_pairs_scan_once_without_join(spark, tmp_path):
    path = str(tmp_path / "swipes")
    spark.createDataFrame(SWIPES, SCHEMA).write.parquet(path)
    df = spark.read.parquet(path)
    plan = plan_text(pair_in_out(df, ["who"], "t", F.col("d") == 1, F.col("d") == 2))
    assert plan.count("FileScan") == 1 and "Join" not in plan and plan.count("Exchange") == 1
    assert "SortAggregate" not in plan


def test_validity_is_day_strict(spark):
    assets = spark.createDataFrame(
        [("gone", day("2020-05-01"), day("2020-05-10"), "Y"), ("live", day("2020-05-01"), day("2020-05-02"), "N"),
         ("unknown", day("2020-05-01"), day("2020-05-03"), None)],
        "sn string, installed date, removed date, deleted string",
    )
    events = spark.createDataFrame(
        [(sn, ts(f"2020-05-{d:02d} 12:00:00")) for sn in ("gone", "live", "unknown", "none") for d in (1, 2, 9, 10, 11)],
        "sn string, t timestamp_ntz",
    )
    got = within_validity(events, assets, "sn", "t", "installed", "removed", F.col("deleted") == "N")
    days = sorted((r.sn, r.t.day) for r in got.collect())
    assert days == [("gone", 2), ("gone", 9), ("live", 2), ("live", 9), ("live", 10), ("live", 11), ("unknown", 2)]


def test_activity_windows(spark):
    events = spark.createDataFrame(
        [("a", ts("2020-01-31 10:00:00")), ("b", ts("2020-01-01 10:00:00")), ("c", ts("2020-02-01 00:00:00")), ("d", ts("2019-12-31 10:00:00"))],
        "sn string, t timestamp_ntz",
    )
    names = {"day": "d", "month": "m", "year": "y"}
    got = active_by_window(events, "sn", "t", day("2020-02-01"), names)
    assert rows(got, "sn", "d", "m", "y") == [("a", 1, 1, 1), ("b", 0, 1, 1), ("c", 0, 0, 1)]
