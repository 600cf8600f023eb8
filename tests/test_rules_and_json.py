from pyspark.sql import functions as F

from labwh.operators import counts_by_field, covered_status, extract_json, met_if, score_rules
from tests.helpers import rows


def test_scores(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, None, 1), (4, 0, 0)], "id int, a int, b int")
    got = score_rules(
        df, {"sa": met_if(F.col("a") == 1), "sb": met_if(F.col("b") == 1)}, {"all": ["sa", "sb"]}
    )
    assert rows(got, "id", "sa", "sb", "all") == [(1, 3, 3, 3), (2, 3, 1, 1), (3, 1, 3, 1), (4, 1, 1, 1)]


def test_partly_met_does_not_make_a_composite(spark):
    df = spark.createDataFrame([(4, 3), (3, 3)], "x int, y int")
    assert rows(score_rules(df, {}, {"z": ["x", "y"]}), "x", "z") == [(3, 3), (4, 1)]


def test_covered_status(spark):
    df = spark.createDataFrame([(0, 3), (1, 3), (3, 3), (4, 3), (1, 0), (None, 1)], "d int, n int")
    got = rows(df.select("d", "n", covered_status(F.col("d"), F.col("n")).alias("s")))
    assert got == [(None, 1, 1), (0, 3, 1), (1, 0, 3), (1, 3, 4), (3, 3, 3), (4, 3, 3)]


LOG = [
    ('[{"a": 1, "proj": {"pid": "p"}}]',),
    ('[{"a": 2, "old": {"pid": "q"}}]',),
    ('{"a": 3}',),
    ('[{"a": 4, "proj": {"pid": null}, "old": {"pid": "r"}}]',),
    ('[{"a": 5',),
    ("[]",),
    ("no json",),
    (None,),
    ('[{\\"a\\": 6}]',),
]


def test_extract_json(spark):
    df = spark.createDataFrame(LOG, "data string")
    fields = {"a": ["$.a"], "pid": ["$.proj.pid", "$.old.pid"]}
    got = extract_json(df, "data", fields)
    assert rows(got.where("a IS NOT NULL OR pid IS NOT NULL"), "a", "pid") == [
        ("1", "p"), ("2", "q"), ("3", None), ("4", "r"),
    ]
    escaped = extract_json(df, "data", {"a": ["$.a"]}, unescape=True).where("a = '6'")
    assert escaped.count() == 1


def test_counts_by_field_count_missing_ids(spark):
    df = spark.createDataFrame([("x", "1"), ("x", None), (None, "1")], "who string, pid string")
    got = counts_by_field(df, {"who": 1, "pid": 2}, "type", "id", "count")
    assert rows(got, "type", "id", "count") == [(1, None, 1), (1, "x", 2), (2, None, 1), (2, "1", 2)]
