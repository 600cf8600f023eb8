"""A run of reports: rows are dealt once, and what a step needed on disk goes when the step is over."""

import os
import random
import re
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from labwh.demo.roles import AS_OF_REPORTS, OUR_CITY, Roles
from labwh.demo.tables import Tables
from labwh.operators import By, join_ranked, numbered_rows
from labwh.plans import labourers, salary
from labwh.plans.details import REPORTS, run_reports
from labwh.sources.staging import ALL_KEYS, FREED, Run, passing, settings, shared_dir, staged
from tests.helpers import day, plan_text, rows, ts

AS_OF = day("2020-06-20")
HOUSE = "房屋建设工程"


def tables_in(spark):
    folder = shared_dir(spark).removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_a_run_leaves_its_reports_only(spark):
    roles = Roles(Tables(spark, "/root/testdata/sf0.001"))
    before, shuffled = tables_in(spark), shuffle_files(spark)
    made, most = {}, []

    def write(name, df):
        made[name] = df.collect() and len(df.columns)
        most.append(len([p for p in tables_in(spark) - before if not p.startswith("reports-")]))

    names = ["salary_detail", "labourer_history", "resumes", "salary_total", "labourer_totals"]
    assert run_reports(spark, roles, AS_OF_REPORTS, OUR_CITY, write, names) == 3
    assert set(made) == set(names)
    assert tables_in(spark) == before and most == [0] * 5
    until = time.time() + 20  # Spark removes the files aside
    while (left := shuffle_files(spark) - shuffled) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(FREED, None) in (None, "false")


def test_a_detail_goes_behind_the_last_report_that_reads_it(spark):
    roles = Roles(Tables(spark, "/root/testdata/sf0.001"))
    before, stored, order = tables_in(spark), {}, []

    def write(name, df):
        df.count()
        order.append(name)
        (run,) = tables_in(spark) - before
        stored[name] = len(os.listdir(f"{shared_dir(spark).removeprefix('file:')}/{run}"))

    names = ["salary_snapshot", "company_project_types", "bank_area_month", "salary_area_totals", "company_totals"]
    assert run_reports(spark, roles, AS_OF_REPORTS, OUR_CITY, write, names) == 4
    assert order == ["salary_snapshot", "bank_area_month", "salary_area_totals", "company_project_types", "company_totals"]
    assert [stored[n] for n in order] == [1, 2, 3, 1, 1]
    assert all(callable(r) for r in REPORTS.values())


def test_a_step_that_fails_removes_its_tables_and_restores_settings(spark):
    before = tables_in(spark)
    spark.conf.set(FREED, "false")
    try:
        with pytest.raises(ValueError, match="no"):
            with Run(spark, "r") as run:
                run.detail("d", lambda: staged(spark.range(3), "inside") and (_ for _ in ()).throw(ValueError("no")))
        assert tables_in(spark) == before and spark.conf.get(FREED) == "false"
    finally:
        spark.conf.unset(FREED)
    with passing(spark):
        outside = staged(spark.range(3), "inside").count()
    assert outside == 3 and tables_in(spark) == before


@pytest.fixture
def uncombined(spark):
    with settings(spark, {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                          "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        yield


def test_ranked_join_equals_ranking_and_join(spark, uncombined):
    rnd = random.Random(7)
    data = [(rnd.choice([1] * 8 + [2, 3, 4, None]), rnd.choice([None, *range(20)]), i) for i in range(6000)]
    df = spark.createDataFrame(data, "k int, v int, id int")
    people = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (5, "d"), (None, "e")], "k int, name string")
    order = [By("v", descending=True), By("id")]
    w = Window.partitionBy("k").orderBy(*[by.sort for by in order])
    want = people.join(df.withColumn("r", F.row_number().over(w).cast("long")), "k", "left")
    stored = numbered_rows(df, "_row")
    got = join_ranked(people, stored, ["k"], order, "r", row="_row")
    assert got.columns == ["k", "name", "v", "id", "r"] and rows(got) == rows(want)
    per_task = got.where("k = 1").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 6
    none = join_ranked(people, stored.limit(0), ["k"], order, "r", row="_row")
    assert rows(none, "name", "r") == [(n, None) for n in "abcde"]


def above(text, marker):
    """Names of the nodes above the first one that matches ``marker``, the nearest first."""
    nodes = [(len(x) - len(x.lstrip(" :+-")), x.lstrip(" :+-")) for x in text.splitlines()]
    at = next(i for i, (_, x) in enumerate(nodes) if re.search(marker, x))
    depth, found = nodes[at][0], []
    for d, x in reversed(nodes[:at]):
        if d < depth:
            depth = d
            found.append(x.split(" ")[0])
    return found


def test_jobs_are_shuffled_once_for_number_and_join(spark):
    t = Roles(Tables(spark, "/root/testdata/sf0.001"))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        history = labourers.labourer_history(t.labourers, t.employments, t.arrears_amounts, t.areas, AS_OF_REPORTS)
        nodes = above(plan_text(history.drop("area_county_name")), r"Window \[row_number.*\(lid#\w+, _cell")
    joins = [i for i, x in enumerate(nodes) if x == "SortMergeJoin"]
    assert joins and "Exchange" not in nodes[: joins[0]]


def line_tables(spark, lines, payroll, batches):
    projects = [(p, 1, f"P{p}", HOUSE, 1, 3, 1, "x") for p in (1, 2, 3)]
    subs = [(10, 1, 1, "S", 1, "x"), (10, 2, 1, "S", 1, "x")]
    return (
        spark.createDataFrame(batches, "batch_no string, cid int, pid int, bkid int, status int, amt int, real_amt int, number int, year int, month int, year_month date, create_time timestamp_ntz, is_deleted int"),
        spark.createDataFrame(lines, "batch_no string, real_name string, id_card_no string, real_amt int, total_amt int, status int, is_deleted int"),
        spark.createDataFrame(payroll, "batch_no string, id_card_no string, worktype_name string, group_name string"),
        spark.createDataFrame(projects, "pid int, cid int, project_name string, project_type string, project_condition int, status int, is_deleted int, county_code string"),
        spark.createDataFrame(subs, "pid int, source_pid int, cid int, project_name string, is_deleted int, county_code string"),
        spark.createDataFrame([(1, "C", 2, 1)], "cid int, company_name string, company_type int, is_deleted int"),
        spark.createDataFrame([(1, "K")], "bkid int, bank_name string"),
        spark.createDataFrame([("x", "X", 3)], "code string, name string, level int"),
        AS_OF,
    )


@pytest.mark.parametrize("hot", [0, 4000])
def test_lines_of_small_and_large_batches_are_numbered(spark, uncombined, hot):
    rnd = random.Random(5)
    # Batch 0 may hold most of the lines; batches of sub-project 10 belong to two projects.
    batches = [(f"B{i}" if i != 7 else None, 1 if i % 3 else None, rnd.choice([1, 2, 3, 10]), i % 2, 1 + i % 2, 5, i, 4, 2019 + i % 2, 1 + i % 4,
                day("2020-01-01"), ts("2020-01-01 00:00:00"), 1) for i in range(300)]
    batches[0] = ("B0", 1, 10, *batches[0][3:])
    # Batches without any line give their project no month.
    names = ["B0"] * hot + [rnd.choice([None, *(f"B{i}" for i in range(200))]) for _ in range(2000)]
    lines = [(b, f"n{i}", rnd.choice([None, *(f"ID{j}" for j in range(300))]), i, i, 1, 1 if i % 9 else 2) for i, b in enumerate(names)]
    payroll = sorted({(b, c, f"T{len(c)}", "g") for b, _, c, *_ in lines if b and c and c[-1] in "123"})
    tables = line_tables(spark, lines, payroll, batches)
    plain = salary.salary_lines(*tables)
    order = Window.partitionBy("batch_no").orderBy(*[by.sort for by in salary.LINE_ORDER])
    months = Window.partitionBy("source_pid").orderBy(F.col("batch_status").asc(), F.col("year").desc(), F.col("month").desc())
    want = plain.withColumns({"batch_top": F.row_number().over(order).cast("long"), "salary_top": F.dense_rank().over(months).cast("long")})
    got = salary.salary_detail(*tables)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert got.count() > 2000 and rows(got) == rows(want)
    with Run(spark, "r") as run:
        assert rows(run.detail("lines", lambda: salary.salary_detail(*tables), dealt=True)) == rows(want)


def test_lines_stay_where_their_batch_was_dealt(spark):
    lines = [(f"B{i % 5}", "n", f"ID{i}", i, i, 1, 1) for i in range(20)]
    batches = [(f"B{i}", 1, 1, 1, 1, 5, 5, 5, 2020, 1, day("2020-01-01"), ts("2020-01-01 00:00:00"), 1) for i in range(5)]
    with settings(spark, {ALL_KEYS: "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan_text(salary.salary_detail(*line_tables(spark, lines, [("B1", "ID1", "T", "g")], batches)))
    # Wage lines, payroll, sites and months: one shuffle each, all by batch, and none behind a join.
    assert text.count("REPARTITION_BY_COL") == 4
    assert "Exchange" not in above(text, "REPARTITION_BY_COL")
