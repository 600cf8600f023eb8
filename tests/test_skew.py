"""One key holds most rows: results stay whole and no task gets the key alone."""

import random

import pytest
from pyspark.sql import functions as F

from labwh.operators import add_flags, add_measures, flag_exists, spread_join
from tests.helpers import rows


def skewed(spark, n=4000):
    rnd = random.Random(5)
    data = [(rnd.choice(["hot"] * 6 + ["b", "c", None, "lonely"]), i) for i in range(n)]
    return data, spark.createDataFrame(data, "k string, id int")


@pytest.mark.parametrize("hot_rows", [1, 300, 10**6])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_on_the_left(spark, how, hot_rows):
    data, df = skewed(spark)
    per_key = spark.createDataFrame([("hot", 1), ("b", 2), ("c", 3), ("d", 4), (None, 5)], "k string, v int")
    got = spread_join(df, per_key, ["k"], how, hot_rows=hot_rows)
    want = df.join(per_key, ["k"], how)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("hot_rows", [1, 300, 10**6])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_on_the_right(spark, how, hot_rows):
    _, df = skewed(spark)
    people = spark.createDataFrame([("hot", 1), ("hot", 7), ("b", 2), ("none", 3), (None, 5)], "k string, v int")
    got = spread_join(people, df, ["k"], how, skewed="right", hot_rows=hot_rows)
    want = people.join(df, ["k"], how)
    assert rows(got, *want.columns) == rows(want)


def test_hot_key_meets_its_match_in_many_tasks(spark):
    _, df = skewed(spark)
    per_key = df.where("k IS NOT NULL").groupBy("k").agg(F.max("id").alias("m"))
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = spread_join(df, per_key, ["k"], "left", hot_rows=100)
        tasks = got.withColumn("task", F.spark_partition_id()).where("k = 'hot'").select("task")
        assert tasks.distinct().count() > 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_impossible_spreads_are_refused(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        spread_join(df, df, ["id"], "full")
    with pytest.raises(ValueError):
        spread_join(df, df, ["id"], "left_semi", skewed="right")


def test_flags_and_measures_spread(spark):
    data, df = skewed(spark, 500)
    other = spark.createDataFrame([("hot",), ("b",), ("b",)], "k string")
    plain = add_flags(df, "k", [(other, "k", {"f": F.lit(True)})])
    assert rows(add_flags(df, "k", [(other, "k", {"f": F.lit(True)})], spread=True)) == rows(plain)
    assert rows(flag_exists(df, other, ["k"], "f", spread=True)) == rows(plain)
    sums = other.groupBy("k").agg(F.count("*").alias("n"))
    assert rows(add_measures(df, "k", sums, spread=True)) == rows(add_measures(df, "k", sums))
