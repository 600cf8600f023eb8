"""Published versions, kept marks, shared details and bitmap states."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from labwh.operators import day_bitmaps, dense_ids, distinct_by_unit, merge_states
from labwh.plans.details import REPORTS, Details, run_reports
from labwh.sources.staging import Run, fresh_path, shared_dir, staged
from labwh.sources.store import Conflict, Store, add_states, publish_together, take_new_rows, upsert_files
from tests.helpers import plan_text, rows


@pytest.fixture
def store(spark):
    return Store(spark, fresh_path(spark, "store"))


def fill(store, df, table="t", **how):
    return store.publish(store.latest(), {table: store.write(df, table, **how)})


def test_upsert_rewrites_only_files_that_hold_a_key(spark, store):
    base = spark.range(8000).selectExpr("id AS k", "'old' AS v").repartitionByRange(8, "k")
    before = fill(store, base).tables["t"].files
    assert len(before) == 8
    source = spark.createDataFrame([(5, "new"), (900, "new"), (-3, "added"), (None, "none")], "k long, v string")
    done = upsert_files(store, "t", source, ["k"])
    after = done.version.tables["t"].files
    assert set(done.kept) == set(before) & set(after) and len(done.touched) in (1, 2)
    assert len(done.kept) == 8 - len(done.touched)
    got = {r.k: r.v for r in store.read("t").collect()}
    assert len(got) == 8002 and got[5] == got[900] == "new" and got[-3] == "added" and got[None] == "none" and got[6] == "old"
    again = upsert_files(store, "t", source.where("k IS NULL"), ["k"])
    assert len(again.touched) == 1 and store.read("t").count() == 8002
    with pytest.raises(ValueError, match="duplicate key"):
        upsert_files(store, "t", spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string"), ["k"])
    assert store.read("t").count() == 8002


def test_upsert_computes_its_source_once(spark, store):
    fill(store, spark.range(100).selectExpr("id AS k", "0.0D AS v"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    source = spark.range(10).selectExpr("id AS k", "1.0D AS v").coalesce(1).mapInArrow(count, "k long, v double")
    upsert_files(store, "t", source, ["k"])
    assert seen.value == 10 and store.read("t").where("v = 1").count() == 10


def test_two_targets_change_together_or_not_at_all(spark, store, monkeypatch):
    first = spark.createDataFrame([(2024, 1, "a"), (2024, 2, "b")], "y int, m int, v string")
    second = spark.createDataFrame([(2024, 2, "c")], "y int, m int, v string")
    publish_together(store, first, "history", ["y", "m"], "current", drop=["y"])
    with monkeypatch.context() as patch:
        def stop(*_):
            raise KeyboardInterrupt

        patch.setattr(Store, "publish", stop)  # the writer stops between the files and the manifest
        with pytest.raises(KeyboardInterrupt):
            publish_together(store, second, "history", ["y", "m"], "current", drop=["y"])
    assert rows(store.read("history")) == rows(first) and rows(store.read("current"), "m", "v") == [(1, "a"), (2, "b")]
    publish_together(store, second, "history", ["y", "m"], "current", drop=["y"])
    assert rows(store.read("history")) == [(2024, 1, "a"), (2024, 2, "c")]
    assert rows(store.read("current"), "m", "v") == [(2, "c")]
    assert store.clean() >= 3 and store.read("history").count() == 2


def test_an_incomplete_manifest_is_not_read(spark, store):
    fill(store, spark.range(3))
    half = store._fs.create(store._path(f"{store.root}/_manifests/{2:012d}.json"), False)
    half.write(bytearray(b'{"number": 2, "tab'))
    half.close()
    assert store.latest().number == 1 and store.read("t").count() == 3
    fill(store, spark.range(4))
    assert store.latest().number == 3 and store.read("t").count() == 4


def test_the_slower_of_two_writers_is_refused(spark, store):
    base = store.latest()
    store.publish(base, {"t": store.write(spark.range(1), "t")})
    with pytest.raises(Conflict):
        store.publish(base, {"t": store.write(spark.range(2), "t")})
    assert store.read("t").count() == 1


def at(text):
    return dt.datetime.fromisoformat(text)


def test_kept_mark_takes_late_rows_once(spark, store):
    rnd = random.Random(1)
    start = at("2024-01-01")
    events = [(i, start + dt.timedelta(hours=i), rnd.random()) for i in range(200)]
    df = spark.createDataFrame(events + events[:50], "id int, ts timestamp_ntz, v double")
    late = F.col("id").isin(90, 95)
    take_new_rows(store, "e", df.where(F.col("id") < 100).where(~late), "ts", ["id"], overlap="12 hours")
    assert store.read("e").count() == 98
    before = store.latest()
    take_new_rows(store, "e", df, "ts", ["id"], overlap="12 hours")
    assert rows(store.read("e"), "id") == [(i,) for i in sorted(range(200), key=str)]
    assert store.latest().marks["e.ts"] > before.marks["e.ts"]
    same = take_new_rows(store, "e", df, "ts", ["id"], overlap="12 hours")
    assert same.number == store.latest().number == before.number + 1
    assert take_new_rows(store, "none", df.where("id < 0"), "ts", ["id"]).number == same.number


def test_the_mark_moves_only_with_the_rows(spark, store, monkeypatch):
    df = spark.createDataFrame([(1, at("2024-01-01"))], "id int, ts timestamp_ntz")
    with monkeypatch.context() as patch:
        patch.setattr(Store, "publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            take_new_rows(store, "e", df, "ts", ["id"])
    assert store.latest().marks == {}
    take_new_rows(store, "e", df, "ts", ["id"])
    assert store.read("e").count() == 1


def test_states_read_new_partitions_only_and_equal_one_run(spark, store):
    rnd = random.Random(2)
    facts = [(dt.date(2024, rnd.randrange(1, 5), rnd.randrange(1, 28)), rnd.randrange(20), rnd.randrange(100)) for _ in range(400)]
    path = fresh_path(spark, "facts")
    spark.createDataFrame(facts, "day date, who int, amt int").coalesce(1).write.partitionBy("day").parquet(path)
    df = spark.read.parquet(path)
    seen = []

    def sums(part):
        seen.append({r[0] for r in part.select(F.input_file_name()).distinct().collect()})
        plan = plan_text(part)
        assert "PartitionFilters: [isnotnull(day" in plan and "DataFilters: []" in plan
        return part.groupBy(F.trunc("day", "MM").alias("month")).agg(F.sum("amt").alias("amt"))

    for until in ("2024-02-10", "2024-03-01", "2024-05-01"):
        add_states(store, {"sums": sums}, df, "day", until, "facts")
    assert not seen[0] & seen[1] and not seen[1] & seen[2] and len(set().union(*seen)) == len({d for d, *_ in facts})
    got = {r.month: r.amt for r in store.read("sums").groupBy("month").agg(F.sum("amt").alias("amt")).collect()}
    want = {}
    for d, _, a in facts:
        want[d.replace(day=1)] = want.get(d.replace(day=1), 0) + a
    assert got == want
    with pytest.raises(ValueError, match="already taken"):
        add_states(store, {"sums": sums}, df, "day", "2024-01-01", "facts")


def test_bitmap_states_of_several_runs_count_exactly(spark):
    rnd = random.Random(3)
    facts = [(rnd.choice(["a", "b", None]), dt.date(2023 + i % 2, rnd.randrange(1, 4), rnd.randrange(1, 6)), f"id{rnd.randrange(300)}") for i in range(3000)]
    df = spark.createDataFrame(facts, "g string, day date, who string")
    first = staged(dense_ids(df.where("day < '2024-01-01'"), "who", "n"), "ids")
    ids = staged(dense_ids(df, "who", "n", known=first), "ids")
    assert ids.count() == ids.select("n").distinct().count() == len({w for *_, w in facts})
    assert first.join(ids, ["who", "n"]).count() == first.count()
    numbered = df.join(ids, "who")
    parts = [numbered.where("day < '2024-01-01'"), numbered.where("day >= '2024-01-01'")]
    states = [day_bitmaps(p, ["g"], "day", "n") for p in parts]
    state = merge_states(states[0].unionByName(states[1]).unionByName(states[1]), ["g"])
    got = {(r.g, r.unit, r.period): r.c for r in distinct_by_unit(state, ["g"], "c").collect()}
    want = {}
    for g, d, w in facts:
        for unit, p in (("day", d), ("month", d.replace(day=1)), ("year", d.replace(month=1, day=1))):
            want.setdefault((g, unit, p), set()).add(w)
    assert got == {k: len(v) for k, v in want.items()}


def test_bitmap_rows_are_as_narrow_as_facts(spark):
    day = dt.date(2024, 5, 1)
    ids = [0, 63, 64, 1 << 33, (1 << 33) + 1, (1 << 40) + 63, (1 << 33) + 1, None]
    facts = spark.createDataFrame([(g, day, i) for g in ("a", None) for i in ids], "g string, day date, n long")
    state = day_bitmaps(facts, ["g"], "day", "n")
    assert state.schema["bits"].dataType.typeName() == "long" and state.count() == 8
    assert {(r.g, r.unit, r.c) for r in distinct_by_unit(state, ["g"], "c").collect()} == {
        (g, u, 6) for g in ("a", None) for u in ("day", "month", "year")}


def test_details_are_stored_once_and_removed_by_the_run(spark):
    made = []

    def base():
        made.append("base")
        return spark.range(5)

    with Run(spark, "r") as run:
        folder = run.path
        double = lambda: run.detail("base", base).selectExpr("id * 2 AS id")
        assert run.detail("double", double).count() == 5
        assert run.detail("double", double).count() == run.detail("base", base).count() == 5
        assert made == ["base"] and len(run) == 2
        with pytest.raises(ValueError, match="depends on itself"):
            run.detail("loop", lambda: run.detail("loop", base))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.schema("id long").parquet(f"{folder}/*").count()


def test_a_run_of_reports_shares_details_and_cleans_up(spark):
    from labwh.demo.roles import AS_OF_REPORTS, OUR_CITY, Roles
    from labwh.demo.tables import Tables

    roles = Roles(Tables(spark, "/root/testdata/sf0.001"))
    done = {}
    names = ["salary_snapshot", "bank_area_month", "salary_area_totals"]
    stored = run_reports(spark, roles, AS_OF_REPORTS, OUR_CITY, lambda n, df: done.update({n: df.count()}), names)
    assert set(done) == set(names) and stored == 3  # batches, bank months, area months
    with pytest.raises(ValueError, match="unknown reports"):
        run_reports(spark, roles, AS_OF_REPORTS, OUR_CITY, lambda *_: None, ["nope"])
    assert callable(REPORTS["status_day"]) and Details.resumes
    assert shared_dir(spark)


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, name, default=None):
            return self.values.get(name, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_dir(Session(spark_master="spark://host:7077"))
    assert shared_dir(Session(**{"spark_master": "yarn", "spark_checkpoint_dir": "/shared/"})) == "/shared"
