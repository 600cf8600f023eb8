import pytest

from labwh.operators import merge_latest, outer_merge, upsert_rows
from tests.helpers import plan_text, rows


def frames(spark):
    a = spark.createDataFrame([("1", 1), ("12", 2), ("123", 3), (None, 4)], "k string, a int")
    b = spark.createDataFrame([("2", 5), ("12", 6), ("23", 7), ("123", 8), (None, 9)], "k string, b int")
    c = spark.createDataFrame([("3", 10), ("23", 11), ("123", 12)], "k string, c int")
    return a, b, c


def test_one_row_per_key(spark):
    got = outer_merge(["k"], *frames(spark))
    assert rows(got) == [
        (None, 4, 9, 0), ("1", 1, 0, 0), ("12", 2, 6, 0), ("123", 3, 8, 12), ("2", 0, 5, 0),
        ("23", 0, 7, 11), ("3", 0, 0, 10),
    ]


def test_null_keys_apart_and_no_fill(spark):
    got = outer_merge(["k"], *frames(spark), fill=None, null_keys="apart")
    assert [r for r in rows(got) if r[0] is None] == [(None, None, 9, None), (None, 4, None, None)]
    with pytest.raises(ValueError):
        outer_merge(["k"], *frames(spark), null_keys="never")
    a, _, _ = frames(spark)
    with pytest.raises(ValueError, match="two inputs"):
        outer_merge(["k"], a, a)


def test_aggregates_are_not_shuffled_again(spark):
    facts = spark.range(1000).selectExpr("id % 7 AS k", "id AS v")
    merged = outer_merge(
        ["k"],
        facts.groupBy("k").agg({"v": "sum"}).withColumnRenamed("sum(v)", "s"),
        facts.groupBy("k").agg({"v": "max"}).withColumnRenamed("max(v)", "m"),
    )
    assert plan_text(merged).count("Exchange hashpartitioning") == 2


def test_merge_latest(spark):
    stored = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "id int, x string, y int")
    fresh = spark.createDataFrame([(2, None, 20), (4, "d", 4)], "id int, x string, y int")
    assert rows(merge_latest(stored, fresh, ["id"])) == [(1, "a", 1), (2, "b", 20), (3, "c", 3), (4, "d", 4)]


def test_upsert_rows_replaces_all_columns(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, x string, y int")
    source = spark.createDataFrame([(2, None, 20), (3, "c", 3)], "id int, x string, y int")
    assert rows(upsert_rows(target, source, ["id"])) == [(1, "a", 1), (2, None, 20), (3, "c", 3)]


def test_null_keys_are_equal_when_merging(spark):
    schema = "k string, m int, v int"
    stored = spark.createDataFrame([(None, 1, 5), ("a", None, 6), ("b", 1, 7)], schema)
    assert rows(merge_latest(stored, stored, ["k", "m"])) == rows(stored)
    assert rows(upsert_rows(stored, stored, ["k", "m"])) == rows(stored)
