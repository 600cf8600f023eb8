import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from labwh.functions import null_bucket
from labwh.operators import (
    attach_totals,
    band_columns,
    conditional_measures,
    label_list,
    running_total,
    split_amounts,
    unpivot_metrics,
    with_shares,
)
from tests.helpers import plan_text, rows


def test_conditional_measures_give_zero(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "y", None)], "g string, t string, v int")
    got = conditional_measures(
        df, ["g"], {"n": (F.col("t") == "x", None), "s": (F.col("t") == "x", "v"), "all": (F.lit(True), "v")}
    )
    assert rows(got, "g", "n", "s", "all") == [("a", 1, 1, 3), ("b", 0, 0, 0)]


def test_bands(spark):
    df = spark.createDataFrame([(v,) for v in (14, 15, 19, 20, 49, 50, 99, None)], "age int")
    cols = band_columns("age", [15, 20, 50], "a")
    got = df.agg(*[c.alias(n) for n, c in cols.items()]).collect()[0].asDict()
    assert got == {"a_15_20": 2, "a_20_50": 2, "a_50_up": 2}


def test_split_amounts_and_shares(spark):
    df = spark.createDataFrame([(1, 10), (2, 30), (None, 60)], "kind int, amt int")
    sums = df.agg(F.sum("amt").alias("total"), *split_amounts("amt", "kind", {1: "one", 2: "two", 3: "three"}))
    got = with_shares(sums, {"p": "two"}, "total", as_text=True).collect()[0]
    assert (got.one, got.two, got.three, got.p) == (10, 30, 0, "30.0%")


def test_null_bucket_groups_with_the_real_label(spark):
    df = spark.createDataFrame([(None,), ("其他",), ("x",)], "g string")
    assert rows(df.groupBy(null_bucket("g").alias("g")).count()) == [("x", 1), ("其他", 2)]


def test_attach_totals(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    total = df.agg(F.sum("v").alias("t"), F.max("k").alias("m"))
    empty = df.where("v > 9").agg(F.sum("v").alias("none"))
    got = attach_totals(df, total, empty)
    assert rows(got) == [("a", 1, 4, "b", None), ("b", 3, 4, "b", None)]
    plan = plan_text(got)
    assert "Join" not in plan and "Window" not in plan
    with pytest.raises(Py4JJavaError, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        attach_totals(df, df.select(F.col("v").alias("x"))).collect()


def test_running_total(spark):
    df = spark.createDataFrame([(2020, 2, 5), (2019, 12, 1), (2020, 1, 3)], "y int, m int, v int")
    got = running_total(df, ["y", "m"], "v", "r")
    assert rows(got, "y", "m", "r") == [(2019, 12, 1), (2020, 1, 4), (2020, 2, 9)]


def test_unpivot(spark):
    df = spark.createDataFrame([(2020, 1, 2)], "y int, a int, b int")
    assert rows(unpivot_metrics(df, ["y"], {1: "a", 6: "b"}, "type", "amount")) == [(2020, 1, 1), (2020, 6, 2)]


def test_label_list(spark):
    df = spark.createDataFrame(
        [("p", 1, "b"), ("p", 1, "a"), ("p", 1, "b"), ("p", 0, "c"), ("q", 1, None), ("r", 0, "z")],
        "k string, ok int, label string",
    )
    got = df.groupBy("k").agg(*label_list({"yes": (F.col("ok") == 1, "label")}, "&"))
    assert rows(got) == [("p", "a&b"), ("q", ""), ("r", "")]
