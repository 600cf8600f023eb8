import pytest
from pyspark.sql import functions as F

from labwh.operators import (
    add_flags,
    flag_exists,
    in_any,
    keyed_join,
    lookup_levels,
    membership,
    not_in,
    scaffold,
    split_by_membership,
    with_children,
)
from tests.helpers import plan_text, rows


def test_flags_never_multiply_rows(spark, tmp_path):
    base = spark.createDataFrame([(1,), (2,), (3,), (None,)], "pid int")
    many = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a")], "pid int, kind string")
    other = spark.createDataFrame([(2,), (2,)], "source_pid int")
    got = add_flags(
        base,
        "pid",
        [
            (many, "pid", {"is_a": F.col("kind") == "a", "is_b": F.col("kind") == "b", "is_c": F.col("kind") == "c"}),
            (other, "source_pid", {"has": F.lit(True)}),
        ],
    )
    assert rows(got, "pid", "is_a", "is_b", "is_c", "has") == [
        (None, 0, 0, 0, 0), (1, 1, 1, 0, 0), (2, 0, 0, 0, 1), (3, 0, 0, 0, 0),
    ]
    assert plan_text(got).count("Join ") == 1
    with pytest.raises(ValueError, match="unique"):
        add_flags(base, "pid", [(many, "pid", {"x": F.lit(True)}), (other, "source_pid", {"x": F.lit(True)})])


def test_flag_exists_on_two_keys(spark):
    base = spark.createDataFrame([(1, "x"), (1, "y"), (2, None)], "a int, b string")
    other = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    assert rows(flag_exists(base, other, ["a", "b"], "f"), "a", "b", "f") == [(1, "x", 1), (1, "y", 0), (2, None, 0)]


AREAS = [("33", "P", 1, "0"), ("3303", "C", 2, "33"), ("330302", "L", 3, "3303"), ("330302", "L again", 3, "3303"), ("33", "wrong level", 2, "0")]


def test_lookup_levels_keeps_rows(spark):
    areas = spark.createDataFrame(AREAS, "code string, name string, level int, parent_code string")
    df = spark.createDataFrame([(1, "33", "330302"), (2, "99", None)], "id int, p string, c string")
    got = lookup_levels(df, areas, {"province": ("p", 1), "county": ("c", 3)})
    assert rows(got, "id", "province", "county") == [(1, "P", "L"), (2, None, None)]


def test_with_children(spark):
    parents = spark.createDataFrame([(1,), (2,)], "pid int")
    children = spark.createDataFrame([(10, 1), (10, 1), (11, 2), (12, 9)], "pid int, source_pid int")
    got = with_children(parents, "pid", children, "pid", "source_pid")
    assert rows(got) == [(1, 1), (1, 10), (2, 11), (2, 2)]


def test_scaffold(spark):
    dim = spark.createDataFrame([("a",), ("b",)], "code string")
    measures = spark.createDataFrame([("a", 5), ("zz", 7)], "county string, n int")
    assert rows(scaffold(dim, measures, [("code", "county")])) == [("a", 5), ("b", 0)]
    assert rows(scaffold(dim, measures, [("code", "county")], fill=None)) == [("a", 5), ("b", None)]


def test_membership_and_split(spark):
    df = spark.createDataFrame(
        [("g", "in", 1), ("g", "in", 1), ("g", "out", 2), ("g", "", 3), ("g", None, 4), ("h", "out", 5), ("h", "in", None)],
        "g string, code string, cid int",
    )
    members = spark.createDataFrame([("in",), ("in",), (None,)], "code string")
    sides = membership(df, "code", members, "code", "side")
    assert sides.count() == 7
    got = split_by_membership(df, ["g"], "code", members, "code", "cid", {"local": "l", "outside": "o", "unknown": "u"})
    assert rows(got, "g", "l", "o", "u") == [("g", 1, 1, 2), ("h", 0, 1, 0)]
    total = split_by_membership(df, [], "code", members, "code", "cid", {"local": "l", "outside": "o"})
    assert rows(total) == [(1, 2)]


def test_in_and_not_in(spark):
    df = spark.createDataFrame([(1, 9), (2, 1), (3, None), (None, 8)], "a int, b int")
    ids = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert rows(in_any(df, [("a", ids, "id"), ("b", ids, "id")])) == [(1, 9), (2, 1)]
    assert rows(not_in(df, "a", ids, "id")) == [(2, 1), (3, None)]


def test_keyed_join_rejects_ambiguous_names(spark):
    left = spark.createDataFrame([(1, 2)], "a int, v int")
    right = spark.createDataFrame([(1, 3)], "b int, v int")
    with pytest.raises(ValueError, match="both sides"):
        keyed_join(left, right, [("a", "b")])
