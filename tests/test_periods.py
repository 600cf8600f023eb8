import datetime as dt
import random

from pyspark.sql import functions as F

from labwh.functions import add_months
from labwh.operators import (
    active_in_period,
    active_months,
    cumulative_distinct,
    cumulative_sums,
    latest_up_to,
    month_shift,
    period_series,
    with_month_shift,
)
from tests.helpers import day, plan_text, rows, ts

M = [day("2020-01-01"), day("2020-02-01"), day("2020-03-01")]


def test_month_shift_labels(spark):
    df = spark.createDataFrame(
        [("a", 2020, 3, 5), ("a", 2020, 3, 6), ("a", 2020, 2, 7), ("b", 2019, 12, 4), ("b", 2019, 9, 9)],
        "cid string, year int, month int, amt int",
    )
    shifts = month_shift(df, "cid", "year", "month", "amt", day("2020-03-31"), "p")
    base = spark.createDataFrame([("a",), ("b",), ("c",)], "cid string")
    got = with_month_shift(base, shifts, "cid", "p")
    assert rows(got, "cid", "p_this_month", "p_last_month", "p_latest", "p_latest_label") == [
        ("a", 11, 7, 11, "2020年3月"), ("b", 0, 0, 4, "2019年12月"), ("c", 0, 0, 0, "--"),
    ]


def test_period_series_keeps_idle_entities(spark):
    entities = spark.createDataFrame([(1,), (2,)], "pid int")
    facts = spark.createDataFrame(
        [(1, ts("2020-01-01 00:00:00"), 3), (1, ts("2020-01-31 23:59:59"), 4), (1, ts("2020-04-01 00:00:00"), 9), (3, ts("2020-02-02 00:00:00"), 8)],
        "pid int, t timestamp_ntz, amt int",
    )
    got = period_series(entities, facts, "pid", "t", M, {"amt": F.sum("amt")})
    assert rows(got, "pid", "cur_date", "amt") == [
        (1, M[0], 7), (1, M[1], 0), (1, M[2], 0), (2, M[0], 0), (2, M[1], 0), (2, M[2], 0),
    ]


def test_cumulative_metrics_against_brute_force(spark, tmp_path):
    rnd = random.Random(3)
    as_of = day("2020-03-31")
    data = [(rnd.randrange(40), rnd.randrange(5), dt.date(2019, 1, 1) + dt.timedelta(days=rnd.randrange(500)), rnd.randrange(100)) for _ in range(800)]
    data += [(99, 1, as_of, 50), (98, None, day("2020-02-29"), 1), (97, 2, add_months(as_of, -1), 1)]
    path = str(tmp_path / "facts")
    spark.createDataFrame(data, "a int, b int, d date, v int").write.parquet(path)
    facts = spark.read.parquet(path)
    cutoffs = [add_months(as_of, -k) for k in range(12)]
    sums = {r.cutoff: r.s for r in cumulative_sums(facts, "d", cutoffs, {"s": "v"}).collect()}
    distinct = cumulative_distinct(facts, "d", cutoffs, {"x": "a", "y": "b"})
    seen = {r.cutoff: (r.x, r.y) for r in distinct.collect()}
    for c in cutoffs:
        past = [r for r in data if r[2] < c]
        assert sums[c] == sum(r[3] for r in past)
        assert seen[c] == (len({r[0] for r in past}), len({r[1] for r in past} - {None}))
    assert plan_text(distinct).count("FileScan") == 1


def test_latest_up_to(spark):
    entities = spark.createDataFrame([(1,), (2,)], "pid int")
    facts = spark.createDataFrame(
        [(1, ts("2019-12-05 00:00:00"), "a"), (1, ts("2020-02-01 00:00:00"), "b"), (1, ts("2020-02-01 00:00:01"), "c")],
        "pid int, t timestamp_ntz, v string",
    )
    got = latest_up_to(entities, facts, "pid", "t", M, ["v"])
    assert rows(got, "pid", "cur_date", "v") == [
        (1, M[0], "a"), (1, M[1], "b"), (1, M[2], "c"), (2, M[0], None), (2, M[1], None), (2, M[2], None),
    ]


INTERVALS = [
    ("inside", "2020-02-10", "2020-02-20"), ("on_edge", "2020-01-31", "2020-02-01"), ("open", "2020-02-15", "2999-01-01"),
    ("reversed", "2020-03-10", "2020-02-20"), ("reversed_far", "2020-06-10", "2019-02-20"), ("before", "2019-01-01", "2019-12-31"),
    ("after", "2020-04-01", "2020-05-01"), ("long", "2001-01-01", "2020-12-31"), ("null_end", "2020-01-01", None),
    ("month_end", "2020-01-31", "2020-03-30"),
]


def test_active_months_equals_range_test(spark):
    data = [(n, day(a), day(b) if b else None) for n, a, b in INTERVALS]
    df = spark.createDataFrame(data, "id string, s date, e date")
    got = sorted((r.id, r.cur_date) for r in active_months(df, "s", "e", M).collect())
    want = sorted(
        (n, m) for n, s, e in data for m in M
        if e is not None and s <= e and e >= m and s < add_months(m, 1)
    )
    reversed_same_month = [x for x in got if x[0].startswith("reversed")]
    assert reversed_same_month == [] and got == want
    gaps = [M[0], M[2]]
    got = {r.cur_date for r in active_months(df, "s", "e", gaps).collect()}
    assert got == set(gaps)


def test_active_in_period_counts_people_once(spark):
    data = [("p", "x", day("2020-01-05"), day("2020-01-09")), ("p", "x", day("2020-01-20"), day("2020-02-09")), ("p", None, day("2020-01-20"), day("2020-02-09")), ("q", "y", day("2020-03-01"), day("2999-01-01"))]
    df = spark.createDataFrame(data, "g string, id string, s date, e date")
    got = active_in_period(df, ["g"], "id", "s", "e", M, "n")
    assert rows(got, "g", "cur_date", "n") == [("p", M[0], 1), ("p", M[1], 1), ("q", M[2], 1)]
