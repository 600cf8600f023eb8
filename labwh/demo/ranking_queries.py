"""Latest row per key and rankings on ``orders`` and ``lineitem``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwh.demo.registry import money, query
from labwh.demo.tables import AS_OF_ORDERS, Tables
from labwh.functions import add_months, in_range, month_start
from labwh.functions import money as as_money
from labwh.operators import (
    By,
    dense_rank_within,
    latest_per_key,
    latest_up_to,
    latest_values,
    numbered_rows,
    rank_by_ranges,
    rank_within,
    sum_once,
)


@query(oracle="""
    SELECT o_custkey, o_orderkey, order_date, o_totalprice FROM (
      SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1
""")
def latest_order_per_customer(t: Tables) -> DataFrame:
    """Latest order by date; among equal dates the larger key."""
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    top = latest_per_key(
        rows, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    )
    return top.withColumn("order_date", F.col("o_orderdate").cast("date")).drop("o_orderdate")


@query(oracle="""
    SELECT o_custkey, o_orderkey,
           row_number() OVER (PARTITION BY o_custkey
             ORDER BY o_orderstatus DESC, o_orderpriority ASC,
                      CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END ASC NULLS LAST,
                      o_orderkey ASC) AS top
    FROM orders
""")
def customer_order_history_rank(t: Tables) -> DataFrame:
    """Full history rank by three keys, unknown dates last. A customer with a large part of all
    orders is numbered by many tasks."""
    known = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderdate"))
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", known.alias("known_date"))
    order = [
        By("o_orderstatus", descending=True),
        By("o_orderpriority"),
        By("known_date", nulls_first=False),
        By("o_orderkey"),
    ]
    return rank_by_ranges(rows, ["o_custkey"], order, "top").select(
        "o_custkey", "o_orderkey", "top"
    )


@query(oracle=f"""
    SELECT l_suppkey AS bank, CAST(real_amt AS DOUBLE) AS real_amt, real_number, project_total,
           row_number() OVER (ORDER BY real_amt DESC, real_number DESC, project_total DESC, l_suppkey)
             AS rank
    FROM (SELECT l_suppkey, sum({money('l_extendedprice')}) AS real_amt, count(*) AS real_number,
                 count(DISTINCT l_orderkey) AS project_total
          FROM lineitem WHERE year(l_shipdate) = 1998 GROUP BY l_suppkey)
""")
def bank_rank(t: Tables) -> DataFrame:
    """League table of banks for one year; ranges of it are ranked in parallel."""
    order = [By("real_amt", True), By("real_number", True), By("project_total", True), By("l_suppkey")]
    ranked = rank_by_ranges(bank_sums(t), [], order, "rank")
    return ranked.select(
        F.col("l_suppkey").alias("bank"),
        F.col("real_amt").cast("double").alias("real_amt"),
        "real_number",
        "project_total",
        "rank",
    )


def bank_sums(t: Tables) -> DataFrame:
    """Amount, people and projects per bank in one year."""
    year = t.lineitem.where(in_range("l_shipdate", (dt.date(1998, 1, 1), dt.date(1999, 1, 1))))
    per_project = year.groupBy("l_suppkey", "l_orderkey").agg(
        F.sum(as_money("l_extendedprice")).alias("amt"), F.count("*").alias("n")
    )
    return per_project.groupBy("l_suppkey").agg(
        F.sum("amt").alias("real_amt"),
        F.sum("n").alias("real_number"),
        F.count("*").alias("project_total"),
    )


@query(oracle=f"""
    SELECT l_orderkey, l_suppkey, CAST(sum({money('l_extendedprice')}) AS DOUBLE) AS amt_total,
           count(*) AS person_total,
           row_number() OVER (PARTITION BY l_orderkey
             ORDER BY sum({money('l_extendedprice')}) DESC, l_suppkey) AS rank
    FROM lineitem GROUP BY l_orderkey, l_suppkey
""")
def project_bank_rank(t: Tables) -> DataFrame:
    """Banks of a project ranked by amount; a project has few banks."""
    sums = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(
        F.sum(as_money("l_extendedprice")).alias("amt_total"), F.count("*").alias("person_total")
    )
    order = [F.col("amt_total").desc(), F.col("l_suppkey")]
    ranked = rank_within(sums, ["l_orderkey"], order, "rank")
    return ranked.withColumn("amt_total", F.col("amt_total").cast("double"))


@query(oracle="""
    WITH job AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY l_partkey
                 ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_linestatus DESC) AS rn
        FROM lineitem) WHERE rn = 1),
    black AS (
      SELECT l_partkey, max(l_shipdate) AS bad_date FROM lineitem WHERE l_returnflag = 'R'
      GROUP BY l_partkey),
    bank AS (
      SELECT * FROM (
        SELECT l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey
                 ORDER BY l_shipdate DESC, l_suppkey DESC) AS rn
        FROM lineitem WHERE l_discount >= 0.09) WHERE rn = 1),
    projects AS (
      SELECT l_partkey, count(DISTINCT l_orderkey) AS project_count FROM lineitem GROUP BY l_partkey)
    SELECT p.p_partkey, job.l_orderkey AS job_orderkey, CAST(job.l_shipdate AS DATE) AS job_date,
           CASE WHEN job.l_linestatus IS NULL THEN 99 WHEN job.l_linestatus = 'O' THEN 1 ELSE 0 END
             AS is_job,
           CAST(black.bad_date AS DATE) AS bad_date, bank.l_suppkey AS bank_no,
           coalesce(projects.project_count, 0) AS project_count
    FROM part p
    LEFT JOIN job ON job.l_partkey = p.p_partkey
    LEFT JOIN black ON black.l_partkey = p.p_partkey
    LEFT JOIN bank ON bank.l_partkey = p.p_partkey
    LEFT JOIN projects ON projects.l_partkey = p.p_partkey
    WHERE p.p_size >= 5
""")
def resume_detail(t: Tables) -> DataFrame:
    """Worker with latest job, latest blacklist entry, latest bank and project count, from one
    pass over the lines."""
    job = ["l_shipdate", "l_orderkey", "l_linenumber", "l_linestatus"]
    picks = {
        "job": (F.lit(True), job),
        "black": (F.col("l_returnflag") == "R", ["l_shipdate"]),
        "bank": (F.col("l_discount") >= 0.09, ["l_shipdate", "l_suppkey"]),
    }
    per_project = latest_values(t.lineitem, ["l_partkey", "l_orderkey"], picks)
    resume = per_project.groupBy("l_partkey").agg(
        *[F.max(n).alias(n) for n in picks], F.count("*").alias("project_count")
    )
    workers = t.part.where(F.col("p_size") >= 5).select("p_partkey")
    joined = workers.join(resume, F.col("p_partkey") == F.col("l_partkey"), "left")
    is_job = F.when(F.col("job.l_linestatus").isNull(), 99).when(
        F.col("job.l_linestatus") == "O", 1
    )
    return joined.select(
        "p_partkey",
        F.col("job.l_orderkey").alias("job_orderkey"),
        F.col("job.l_shipdate").cast("date").alias("job_date"),
        is_job.otherwise(0).alias("is_job"),
        F.col("black.l_shipdate").cast("date").alias("bad_date"),
        F.col("bank.l_suppkey").alias("bank_no"),
        F.coalesce("project_count", F.lit(0)).alias("project_count"),
    )


@query(oracle="""
    SELECT o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_linestatus,
           year(l_shipdate) AS year, month(l_shipdate) AS month,
           row_number() OVER (PARTITION BY l_orderkey
             ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS batch_top,
           dense_rank() OVER (PARTITION BY o_custkey
             ORDER BY l_linestatus, year(l_shipdate) DESC, month(l_shipdate) DESC) AS salary_top,
           12 * (2001 - year(l_shipdate)) + (6 - month(l_shipdate)) AS months_old
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def salary_detail_rank(t: Tables) -> DataFrame:
    """Wage lines with ordinal in the batch and dense rank of the months of a company."""
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_linestatus",
        F.year("l_shipdate").cast("long").alias("year"),
        F.month("l_shipdate").cast("long").alias("month"),
        F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("year_month"),
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    owner = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = numbered_rows(lines.join(owner, "l_orderkey"), "_row", "wage-lines")
    numbered = rank_by_ranges(lines, ["l_orderkey"], [By(c) for c in order], "batch_top", row="_row")
    ranked = dense_rank_within(
        numbered,
        ["o_custkey"],
        ["l_linestatus", "year", "month"],
        [F.col("l_linestatus"), F.col("year").desc(), F.col("month").desc()],
        "salary_top",
        among=lines,
    )
    months = F.months_between(F.lit(month_start(AS_OF_ORDERS)), "year_month")
    return ranked.withColumn("months_old", months.cast("long")).drop("year_month")


@query(oracle="""
    SELECT o_custkey, year, month, o_orderkey, o_totalprice FROM (
      SELECT o_custkey, year(o_orderdate) AS year, month(o_orderdate) AS month, o_orderkey, o_totalprice,
             row_number() OVER (PARTITION BY o_custkey, year(o_orderdate), month(o_orderdate)
                                ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1
""")
def monthly_latest(t: Tables) -> DataFrame:
    """Latest order per customer and month."""
    rows = t.orders.withColumns(
        {
            "year": F.year("o_orderdate").cast("long"),
            "month": F.month("o_orderdate").cast("long"),
        }
    )
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    top = latest_per_key(rows, ["o_custkey", "year", "month"], order)
    return top.select("o_custkey", "year", "month", "o_orderkey", "o_totalprice")


@query(oracle="""
    WITH cutoffs AS (
      SELECT CAST(date_trunc('month', DATE '2001-06-15') - to_months(CAST(k AS INTEGER)) AS DATE) AS cur_date
      FROM range(0, 6) r(k))
    SELECT c.c_custkey AS o_custkey, m.cur_date, CAST(x.o_orderdate AS DATE) AS up_date, x.o_orderkey,
           CASE WHEN x.o_orderkey IS NULL THEN 1 ELSE 3 END AS status
    FROM customer c CROSS JOIN cutoffs m
    LEFT JOIN LATERAL (
      SELECT o_orderdate, o_orderkey FROM orders o
      WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P' AND o.o_orderdate <= m.cur_date
      ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) x ON true
""")
def latest_up_to_month(t: Tables) -> DataFrame:
    """Latest completed order of each customer as of each month start."""
    cutoffs = [month_start(AS_OF_ORDERS, -k) for k in range(6)]
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    done = t.orders.where(F.col("o_orderstatus") == "P")
    out = latest_up_to(customers, done, "o_custkey", "o_orderdate", cutoffs, ["o_orderkey"])
    return out.select(
        "o_custkey",
        "cur_date",
        F.col("o_orderdate").cast("date").alias("up_date"),
        "o_orderkey",
        F.when(F.col("o_orderkey").isNull(), 1).otherwise(3).alias("status"),
    )


@query(oracle=f"""
    SELECT n.n_name AS county_name, o_orderstatus AS state,
           CAST(sum(CASE WHEN top = 1 THEN {money('c_acctbal')} ELSE 0 END) AS DOUBLE) AS bail_amt
    FROM (SELECT o.*, c.*, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey DESC) AS top
          FROM orders o JOIN customer c ON c_custkey = o_custkey) x
    JOIN nation n ON n_nationkey = c_nationkey
    GROUP BY 1, 2
""")
def sum_once_per_owner(t: Tables) -> DataFrame:
    """Deposits by area and state; each customer counts once, on the largest order key."""
    rows = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("state")).join(
        t.customer.select(
            F.col("c_custkey").alias("o_custkey"), "c_nationkey", as_money("c_acctbal").alias("amt")
        ),
        "o_custkey",
    )
    nation = t.nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("county_name")
    )
    out = sum_once(
        rows.join(nation, "c_nationkey"),
        ["county_name", "state"],
        ["o_custkey"],
        "amt",
        [F.col("o_orderkey").desc()],
        "bail_amt",
    )
    return out.withColumn("bail_amt", F.col("bail_amt").cast("double"))


@query(oracle="""
    WITH names AS (
      SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) ELSE c_name END AS id_card_no
      FROM customer),
    paid AS (
      SELECT * FROM (
        SELECT upper('Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')) AS id_card_no, o_orderkey,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-15 00:00:00') WHERE rn = 1)
    SELECT n.c_custkey, n.id_card_no, p.o_orderkey, CASE WHEN p.o_orderkey IS NULL THEN 0 ELSE 1 END
             AS salary_status
    FROM names n LEFT JOIN paid p ON upper(n.id_card_no) = upper(p.id_card_no)
""")
def case_insensitive_join(t: Tables) -> DataFrame:
    """Workers and their latest payment after a date, matched regardless of letter case."""
    name = F.when(F.col("c_custkey") % 2 == 0, F.lower("c_name")).otherwise(F.col("c_name"))
    people = t.customer.select("c_custkey", name.alias("id_card_no"))
    paid = t.orders.where(F.col("o_orderdate") > F.lit(AS_OF_ORDERS)).select(
        F.upper(F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))).alias("who"),
        "o_orderkey",
        "o_orderdate",
    )
    latest = latest_per_key(
        paid, ["who"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    )
    joined = people.join(latest, F.upper("id_card_no") == F.upper("who"), "left")
    return joined.select(
        "c_custkey",
        "id_card_no",
        "o_orderkey",
        F.when(F.col("o_orderkey").isNull(), 0).otherwise(1).alias("salary_status"),
    )


CUTOFFS = [add_months(AS_OF_ORDERS, -k) for k in range(12)]
