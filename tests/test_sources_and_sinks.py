import datetime as dt
import sqlite3

import pytest
from pyspark.sql import functions as F

from labwh.sources import readers, sinks
from tests.helpers import day, plan_text, rows, ts


def orders(spark):
    return spark.createDataFrame(
        [(i, ts(f"2020-{m:02d}-15 10:00:00"), float(i)) for i, m in enumerate([1, 1, 2, 2, 3, 3])],
        "id int, t timestamp_ntz, amt double",
    )


def test_partition_publish_is_idempotent_and_touches_one_month(spark, tmp_path):
    path = str(tmp_path / "t")
    cols = ["date_year", "date_month"]
    sinks.publish_partitions(sinks.month_partition_columns(orders(spark), "t"), path, cols)
    march = sinks.month_partition_columns(orders(spark).where("id = 5"), "t")
    for _ in range(2):
        sinks.publish_partitions(march, path, cols)
    back = spark.read.parquet(path)
    assert rows(back, "id") == [(0,), (1,), (2,), (3,), (5,)]
    one = readers.partition_months(back, [day("2020-02-01")])
    assert rows(one, "id") == [(2,), (3,)]
    text = plan_text(one)
    assert "PartitionFilters: [" in text and "date_month" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_publish_writes_few_files_and_reads_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 4000, 1, 16).selectExpr("id", "CAST(id % 3 AS INT) AS m")
    sinks.publish_partitions(df, path, ["m"])
    assert len(list((tmp_path / "t").glob("m=*/*.parquet"))) == 3
    source = df.where("m = 1 AND id < 50")
    old = spark.read.schema(df.schema).parquet(path).where(sinks.same_partitions(source, ["m"]))
    text = plan_text(old)
    assert "m#" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert {f.split("/")[-2] for f in old.inputFiles()} >= {"m=1"}
    assert old.select("m").distinct().collect()[0].m == 1


def test_upsert_writes_a_new_table_and_keeps_the_old(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    sinks.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), old)
    source = spark.createDataFrame([(2, None), (3, "c")], "id int, v string")
    assert rows(sinks.upsert(old, source, ["id"], new)) == [(1, "a"), (2, None), (3, "c")]
    assert rows(spark.read.parquet(old)) == [(1, "a"), (2, "b")]
    again = sinks.upsert(new, source, ["id"], str(tmp_path / "again"))
    assert rows(again) == [(1, "a"), (2, None), (3, "c")]
    twice = spark.createDataFrame([(3, "x"), (3, "y")], "id int, v string")
    with pytest.raises(ValueError, match="duplicate key"):
        sinks.upsert(old, twice, ["id"], str(tmp_path / "bad"))


def test_upsert_partitions_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (1, "c", 2)], "id int, v string, m int")
    sinks.publish_partitions(table, path, ["m"])
    source = spark.createDataFrame([(2, "B", 1), (9, "n", 3)], "id int, v string, m int")
    sinks.upsert_partitions(path, source, ["id", "m"], ["m"])
    assert rows(spark.read.parquet(path), "id", "v", "m") == [(1, "a", 1), (1, "c", 2), (2, "B", 1), (9, "n", 3)]
    with pytest.raises(ValueError, match="part of the key"):
        sinks.upsert_partitions(path, source, ["id"], ["m"])


def test_merge_stored(spark, tmp_path):
    old = str(tmp_path / "old")
    sinks.overwrite(spark.createDataFrame([(1, 1, 1), (2, 2, 2)], "id int, a int, b int"), old)
    fresh = spark.createDataFrame([(2, None, 20), (3, 3, 3)], "id int, a int, b int")
    got = sinks.merge_stored(old, fresh, ["id"], str(tmp_path / "new"))
    assert rows(got) == [(1, 1, 1), (2, 2, 20), (3, 3, 3)]


def test_catalog_table_inserts(spark):
    spark.sql("DROP TABLE IF EXISTS wages_p")
    spark.sql("CREATE TABLE wages_p (name STRING, num INT, y INT, m INT) USING parquet PARTITIONED BY (y, m)")
    a = spark.createDataFrame([(1, "a", 2020, 1), (2, "b", 2020, 2)], "num int, name string, y int, m int")
    sinks.insert_overwrite(a, "wages_p")
    sinks.insert_overwrite(a.where("m = 2").withColumn("num", F.lit(9)), "wages_p")
    assert rows(readers.read_table(spark, "wages_p"), "name", "num", "m") == [("a", 1, 1), ("b", 9, 2)]
    extra = spark.createDataFrame([("x", 5)], "name string, num int")
    sinks.insert_partition(extra, "wages_p", {"y": 2020, "m": 1})
    assert readers.read_table(spark, "wages_p", "m = 1").count() == 2
    sinks.insert_partition(extra, "wages_p", {"y": 2020, "m": 1}, replace=True)
    assert rows(readers.read_table(spark, "wages_p", F.col("m") == 1), "name") == [("x",)]
    spark.sql("DROP TABLE wages_p")


def test_point_table_moves_readers_to_the_finished_copy(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    sinks.overwrite(spark.range(1), one)
    sinks.overwrite(spark.range(3), two)
    spark.sql("DROP TABLE IF EXISTS pointed")
    spark.sql(f"CREATE TABLE pointed (id BIGINT) USING parquet LOCATION '{one}'")
    assert spark.table("pointed").count() == 1
    sinks.point_table(spark, "pointed", two)
    assert spark.table("pointed").count() == 3
    spark.sql("DROP TABLE pointed")


def test_publish_both_and_snapshots(spark, tmp_path):
    history, current, shots = (str(tmp_path / x) for x in ("h", "c", "s"))
    report = spark.createDataFrame([(1, 5, 2020)], "id int, v int, y int")
    sinks.publish_both(report, history, ["y"], current, drop=["y"])
    assert rows(spark.read.parquet(history), "id", "v", "y") == [(1, 5, 2020)]
    assert spark.read.parquet(current).columns == ["id", "v"]
    for _ in range(2):
        sinks.append_snapshot(report, shots)
    assert spark.read.parquet(shots).count() == 2


def test_failure_is_audited_and_raised(spark, tmp_path):
    audit = str(tmp_path / "audit")

    def job():
        raise RuntimeError("disk full")

    with pytest.raises(RuntimeError, match="disk full"):
        sinks.run_audited(spark, "daily", job, audit, dt.datetime(2020, 1, 1))
    assert rows(spark.read.parquet(audit), "class_name", "message") == [("daily", "disk full")]
    assert sinks.run_audited(spark, "daily", lambda: 7, audit) == 7
    assert spark.read.parquet(audit).count() == 1


def test_database_upsert(spark, tmp_path):
    # An in-process file database; every task opens its own connection.
    file = str(tmp_path / "db.sqlite")
    with sqlite3.connect(file) as db:
        db.execute("CREATE TABLE t (id INTEGER PRIMARY KEY, name TEXT, age INTEGER)")
        db.execute("INSERT INTO t VALUES (1, 'old', 1), (99, 'kept', 9)")
    df = spark.range(50).selectExpr("CAST(id AS INT) id", "CASE WHEN id % 2 = 0 THEN 'n' END name", "CAST(id * 2 AS INT) age")
    for _ in range(2):
        sinks.upsert_database(df.coalesce(1), lambda: sqlite3.connect(file, timeout=30), "t", ["id"], batch_size=7)
    with sqlite3.connect(file) as db:
        got = db.execute("SELECT count(*), sum(age), count(name) FROM t").fetchone()
        assert got == (51, sum(2 * i for i in range(50)) + 9, 26)
        assert db.execute("SELECT name, age FROM t WHERE id = 1").fetchone() == (None, 2)


def test_incremental_and_format_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    orders(spark).write.format("orc").save(path)
    df = readers.read_path(spark, path, "orc", where="amt > 0")
    assert rows(readers.since(df, "t", ts("2020-02-15 10:00:00")), "id") == [(4,), (5,)]
    assert rows(readers.since(df, "t", ts("2020-02-15 10:00:00"), inclusive=True), "id") == [(2,), (3,), (4,), (5,)]
    assert "PushedFilters: [IsNotNull" in plan_text(readers.since(df, "t", ts("2020-02-15 10:00:00")))
    text = tmp_path / "a.txt"
    text.write_text("one\ntwo\n")
    assert rows(readers.read_text(spark, str(text))) == [("one",), ("two",)]


def test_parameters_views_and_generated_rows(spark):
    spark.conf.set("spark.project.dateMaps", "2020-01-01,2020-02-01 00:00:00")
    assert readers.parameter_dates(spark) == [day("2020-01-01"), day("2020-02-01")]
    assert readers.parameter(spark, "nothing", "x") == "x"
    assert readers.number_rows(spark, 5, 10).count() == 5
    assert readers.number_rows(spark, 0, 100, 2).rdd.getNumPartitions() == 2
    readers.register({"numbers": readers.number_rows(spark, 0, 10)})
    got = readers.bound_sql(spark, "SELECT count(*) AS n FROM numbers WHERE id > :lo", lo=6)
    assert rows(got) == [(3,)]


def test_jdbc_reader_checks_its_partitioning(spark):
    with pytest.raises(ValueError, match="bounds"):
        readers.read_jdbc(spark, {"url": "jdbc:none:"}, "t", partition_column="id")


def test_shared_dir_comes_from_the_session(spark):
    assert sinks.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert sinks.fresh_path(spark, "x") != sinks.fresh_path(spark, "x")
