import random

import pytest
from pyspark.sql import functions as F

from labwh.operators import dense_rank_within, latest_per_key, latest_values, rank_within, sum_once
from tests.helpers import plan_text, rows


def test_latest_per_key_breaks_ties_and_keeps_single_rows(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 5, 11), ("a", 5, 12), ("b", None, 13), ("c", None, 14), ("c", 2, 15)],
        "k string, o int, v int",
    )
    got = latest_per_key(df, ["k"], [F.col("o").desc(), F.col("v").desc()])
    assert rows(got) == [("a", 5, 12), ("b", None, 13), ("c", 2, 15)]
    two = latest_per_key(df, ["k"], [F.col("o").desc(), F.col("v").desc()], keep=2)
    assert two.count() == 5
    assert "WindowGroupLimit" in plan_text(got)


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="nope"):
        latest_per_key(spark.range(3), ["nope"], [F.col("id")])


def test_latest_values_from_one_pass(spark):
    df = spark.createDataFrame(
        [(1, "in", 3, "x"), (1, "in", 5, "y"), (1, "out", 4, "z"), (2, "out", 1, "w")],
        "k int, d string, t int, v string",
    )
    got = latest_values(
        df, ["k"], {"i": (F.col("d") == "in", ["t", "v"]), "o": (F.col("d") == "out", ["t", "v"])}
    )
    assert rows(got.select("k", "i.v", "o.v")) == [(1, "y", "z"), (2, None, "w")]


@pytest.mark.parametrize("keys", [["k"], []])
def test_split_ranking_equals_plain_window(spark, keys):
    rnd = random.Random(7)
    # One key holds most of the rows; NULL is a key and a value.
    data = [
        (rnd.choice(["hot"] * 8 + ["b", None]), rnd.choice([None, *range(40)]), i) for i in range(3000)
    ]
    df = spark.createDataFrame(data, "k string, v int, id int")
    order = [F.col("v").asc_nulls_first(), F.col("id")]
    split = F.floor(F.col("v") / 5)
    got = rank_within(df, keys, order, "r", split)
    assert got.columns == ["k", "v", "id", "r"]
    want = {}
    for k, v, i in sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        group = k if keys else "all"
        want.setdefault(group, []).append(i)
    expect = {i: n for ids in want.values() for n, i in enumerate(ids, 1)}
    assert {r.id: r.r for r in got.collect()} == expect


def test_hot_key_is_numbered_by_many_tasks(spark):
    # 90% of the rows have one key; no task may hold more than a few cells of it.
    df = spark.range(20000).selectExpr("CASE WHEN id % 10 = 0 THEN id ELSE -1 END AS k", "id AS v")
    ranked = rank_within(df, ["k"], [F.col("v")], "r", F.floor(F.col("v") / 100))
    tasks = ranked.withColumn("task", F.spark_partition_id()).where("k = -1")
    assert tasks.select("task").distinct().count() > 1
    assert tasks.agg(F.max("r"), F.countDistinct("r")).collect()[0] == (18000, 18000)


def test_global_ranking_needs_a_split(spark):
    with pytest.raises(ValueError, match="split"):
        rank_within(spark.range(3), [], [F.col("id")], "r")


def test_dense_rank(spark):
    df = spark.createDataFrame(
        [("p", 1, 2020, 5), ("p", 1, 2020, 5), ("p", 1, 2020, 4), ("p", 6, 2021, 1), ("q", 6, 2019, 1), (None, 1, 1, 1)],
        "k string, s int, y int, m int",
    )
    got = dense_rank_within(df, ["k"], ["s", "y", "m"], [F.col("s").asc(), F.col("y").desc(), F.col("m").desc()], "r")
    assert rows(got, "k", "s", "y", "m", "r") == [
        (None, 1, 1, 1, 1), ("p", 1, 2020, 4, 2), ("p", 1, 2020, 5, 1), ("p", 1, 2020, 5, 1),
        ("p", 6, 2021, 1, 3), ("q", 6, 2019, 1, 1),
    ]


def test_sum_once_counts_an_owner_on_its_first_row(spark):
    df = spark.createDataFrame(
        [("x", 1, "c1", 10), ("x", 2, "c1", 10), ("y", 3, "c1", 10), ("x", 4, "c2", 5), ("z", 5, None, 7), ("z", 6, None, 7), ("w", 0, "c2", 5)],
        "g string, pid int, owner string, amt int",
    )
    got = sum_once(df, ["g"], ["owner"], "amt", [F.col("pid").desc()], "s")
    # c1 counts in y, c2 in x, rows without an owner once, w has no first row.
    assert rows(got) == [("w", 0), ("x", 5), ("y", 10), ("z", 7)]
