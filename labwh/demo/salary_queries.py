"""Wage and month reports on ``orders`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwh.demo.ranking_queries import CUTOFFS
from labwh.demo.registry import money, query, share, share_text
from labwh.demo.tables import AS_OF_ORDERS, SEGMENTS, Tables
from labwh.functions import (
    add_months,
    in_previous_month,
    in_ten_thousands,
    in_unit,
    month_of,
    month_start,
    months_window,
    previous_day,
    proportion,
)
from labwh.functions import money as as_money
from labwh.operators import (
    active_in_period,
    attach_totals,
    band_columns,
    conditional_measures,
    count_if,
    cumulative_distinct,
    cumulative_sums,
    merge_latest,
    met_if,
    period_series,
    running_total,
    scaffold,
    split_amounts,
    sum_if,
    unpivot_metrics,
    with_children,
    with_shares,
)


def calendar_columns(ts: str) -> dict:
    return {"year": F.year(ts).cast("long"), "month": F.month(ts).cast("long")}


def doubles(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@query(oracle=f"""
    SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, n_name AS county_name,
           l_suppkey AS bank, CAST(sum({money('l_extendedprice')}) AS DOUBLE) AS real_amt,
           count(*) AS real_number, count(DISTINCT l_orderkey) AS project_total
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    GROUP BY 1, 2, 3, 4
""")
def bank_area_month(t: Tables) -> DataFrame:
    """Month × area × bank: amount, people, distinct projects.

    Lines are first reduced per project, month and bank, so the distinct count needs no
    expansion of the rows and the joins carry fewer of them.
    """
    per_project = (
        t.lineitem.withColumns(calendar_columns("l_shipdate"))
        .groupBy("l_orderkey", "l_suppkey", "year", "month")
        .agg(F.sum(as_money("l_extendedprice")).alias("amt"), F.count("*").alias("n"))
    )
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    owner = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    located = per_project.join(orders, "l_orderkey").join(owner, "o_custkey")
    sums = located.groupBy("year", "month", "c_nationkey", F.col("l_suppkey").alias("bank")).agg(
        F.sum("amt").cast("double").alias("real_amt"),
        F.sum("n").alias("real_number"),
        F.count("*").alias("project_total"),
    )
    names = t.nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("county_name")
    )
    return sums.join(names, "c_nationkey").drop("c_nationkey")


AMOUNTS = {s: f"{n}_amt_total" for s, n in SEGMENTS.items()}
AMOUNT_SUMS = ", ".join(
    f"sum(CASE WHEN c_mktsegment = '{s}' THEN {money('o_totalprice')} ELSE 0 END) AS {n}"
    for s, n in AMOUNTS.items()
)
AREA_MONTH_CTE = f"""
    area_month AS (
      SELECT n_name AS county_name, year(o_orderdate) AS year, month(o_orderdate) AS month,
             sum({money('o_totalprice')}) AS real_amt_total, count(*) AS batch_total,
             count(DISTINCT c_custkey) AS company_total, {AMOUNT_SUMS}
      FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
      WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2, 3)
"""


def salary_by_area(t: Tables) -> DataFrame:
    """Month × area: amount, batches, companies, amount per company type."""
    paid = t.orders.where(F.col("o_orderstatus").isin("F", "O"))
    per_company = (
        paid.withColumns(calendar_columns("o_orderdate"))
        .groupBy("o_custkey", "year", "month")
        .agg(F.sum(as_money("o_totalprice")).alias("amt"), F.count("*").alias("n"))
    )
    owner = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    names = t.nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("county_name")
    )
    rows = per_company.join(owner, "o_custkey").join(names, "c_nationkey")
    return rows.groupBy("county_name", "year", "month").agg(
        F.sum("amt").alias("real_amt_total"),
        F.sum("n").alias("batch_total"),
        F.count("*").alias("company_total"),
        *split_amounts("amt", "c_mktsegment", AMOUNTS),
    )


def amount_shares(cols: dict[str, str], total: str, prefix: str = "") -> dict[str, str]:
    return {f"{prefix}{c.replace('_amt_total', '_proportion')}": f"{prefix}{c}" for c in cols.values()}


@query(oracle=f"""
    WITH {AREA_MONTH_CTE}
    SELECT county_name, year, month, CAST(real_amt_total AS DOUBLE) AS real_amt_total, batch_total,
           company_total,
           {', '.join(f"CAST({c} AS DOUBLE) AS {c}, {share_text(c, 'real_amt_total')} AS {c.replace('_amt_total', '_proportion')}"
                      for c in AMOUNTS.values())}
    FROM area_month
""")
def salary_area_month(t: Tables) -> DataFrame:
    """Month × area amounts by company type with shares."""
    rows = with_shares(salary_by_area(t), amount_shares(AMOUNTS, ""), "real_amt_total", True)
    return doubles(rows, "real_amt_total", *AMOUNTS.values())


TOTALS = ["real_amt_total", "batch_total", *AMOUNTS.values()]


@query(oracle=f"""
    WITH {AREA_MONTH_CTE},
    all_time AS (
      SELECT county_name, {', '.join(f'sum({c}) AS {c}' for c in TOTALS)}
      FROM area_month GROUP BY county_name),
    last_month AS (SELECT * FROM area_month WHERE year = 2001 AND month = 5)
    SELECT n.n_name AS county_name,
           CAST(a.real_amt_total AS DOUBLE) AS real_amt_total, CAST(a.batch_total AS BIGINT) AS batch_total,
           CAST(m.real_amt_total AS DOUBLE) AS lastmonth_real_amt_total,
           m.batch_total AS lastmonth_batch_total,
           {', '.join(f"CAST(a.{c} AS DOUBLE) AS {c}, {share_text(f'a.{c}', 'a.real_amt_total')} AS {c.replace('_amt_total', '_proportion')}"
                      for c in AMOUNTS.values())},
           {', '.join(f"CAST(m.{c} AS DOUBLE) AS lastmonth_{c}, {share_text(f'm.{c}', 'm.real_amt_total')} AS lastmonth_{c.replace('_amt_total', '_proportion')}"
                      for c in AMOUNTS.values())}
    FROM nation n LEFT JOIN all_time a ON a.county_name = n.n_name
    LEFT JOIN last_month m ON m.county_name = n.n_name
""")
def salary_area_vs_last_month(t: Tables) -> DataFrame:
    """Every area: all-time amounts beside last month's; each month's shares are of that
    month's total. One aggregation of the monthly report yields both."""
    last = month_start(AS_OF_ORDERS, -1)
    is_last = (F.col("year") == last.year) & (F.col("month") == last.month)
    sums = (
        salary_by_area(t)
        .groupBy("county_name")
        .agg(
            *[F.sum(c).alias(c) for c in TOTALS],
            *[F.sum(F.when(is_last, F.col(c))).alias(f"lastmonth_{c}") for c in TOTALS],
        )
    )
    areas = t.nation.select(F.col("n_name").alias("county_name"))
    full = scaffold(areas, sums, [("county_name", "county_name")], fill=None)
    full = with_shares(full, amount_shares(AMOUNTS, ""), "real_amt_total", True)
    full = with_shares(
        full, amount_shares(AMOUNTS, "", "lastmonth_"), "lastmonth_real_amt_total", True
    )
    amounts = ["real_amt_total", *AMOUNTS.values()]
    return doubles(full, *amounts, *[f"lastmonth_{c}" for c in amounts])


@query(oracle=f"""
    WITH paid AS (SELECT * FROM orders JOIN customer ON c_custkey = o_custkey
                  WHERE o_orderstatus IN ('F', 'O')),
    lab AS (
      SELECT sum({money('o_totalprice')}) AS amt, count(o_orderkey) AS batch_total,
             sum(CASE WHEN c_mktsegment = 'BUILDING' THEN {money('o_totalprice')} ELSE 0 END) AS building
      FROM paid),
    pro AS (
      SELECT count(*) AS project_total,
             sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS build_project_total
      FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM paid))
    SELECT CAST(amt AS DOUBLE) AS real_amt_total, batch_total,
           CAST(building AS DOUBLE) AS building_amt_total,
           {share_text('building', 'amt')} AS building_amt_proportion, project_total,
           CAST(build_project_total AS BIGINT) AS build_project_total,
           {share_text('build_project_total', 'project_total')} AS build_project_proportion
    FROM lab CROSS JOIN pro
""")
def salary_grand_total(t: Tables) -> DataFrame:
    """One row: wages by company type, and distinct company × state counts, from one pass."""
    paid = t.orders.where(F.col("o_orderstatus").isin("F", "O"))
    per_company = paid.groupBy("o_custkey", "o_orderstatus").agg(
        F.sum(as_money("o_totalprice")).alias("amt"), F.count("o_orderkey").alias("n")
    )
    # One row per company and state, so the rows are the distinct pairs.
    kinds = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    row = per_company.join(kinds, "o_custkey", "left").agg(
        F.sum("amt").alias("real_amt_total"),
        F.sum("n").alias("batch_total"),
        sum_if(F.col("c_mktsegment") == "BUILDING", "amt").alias("building_amt_total"),
        F.count("*").alias("project_total"),
        count_if(F.col("o_orderstatus") == "F").alias("build_project_total"),
    )
    row = with_shares(row, {"building_amt_proportion": "building_amt_total"}, "real_amt_total", True)
    row = with_shares(row, {"build_project_proportion": "build_project_total"}, "project_total", True)
    return doubles(row, "real_amt_total", "building_amt_total")


@query(oracle=f"""
    SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, x.l_partkey,
           CAST(x.real_amt AS DOUBLE) AS real_amt
    FROM orders o JOIN (
      SELECT l_orderkey, l_partkey, sum({money('l_extendedprice')}) AS real_amt
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey, l_partkey) x
      ON x.l_orderkey = o.o_orderkey
    WHERE o.o_orderstatus IN ('O', 'P')
""")
def arrears_detail(t: Tables) -> DataFrame:
    """Arrears case × worker amount; amounts are added up before the join."""
    owed = (
        t.lineitem.where(F.col("l_returnflag") == "R")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
        .agg(F.sum(as_money("l_extendedprice")).cast("double").alias("real_amt"))
    )
    cases = t.orders.where(F.col("o_orderstatus").isin("O", "P"))
    cases = cases.select("o_orderkey", "o_custkey", "o_orderpriority")
    return cases.join(owed, "o_orderkey")


SERIES = [month_start(AS_OF_ORDERS, -k) for k in range(6)]
MONTHS_CTE = """
    months AS (
      SELECT CAST(date_trunc('month', DATE '2001-06-15') - to_months(CAST(k AS INTEGER)) AS DATE) AS cur_date
      FROM range(0, 6) r(k))
"""


@query(oracle=f"""
    WITH {MONTHS_CTE}
    SELECT c.c_custkey AS pid, m.cur_date,
           CAST(coalesce(sum({money('o.o_totalprice')}), 0) AS DOUBLE) AS amt,
           CASE WHEN sum({money('o.o_totalprice')}) > 0 THEN 3 ELSE 1 END AS status
    FROM customer c CROSS JOIN months m
    LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F'
      AND year(o.o_orderdate) = year(m.cur_date) AND month(o.o_orderdate) = month(m.cur_date)
    GROUP BY 1, 2
""")
def project_month_income(t: Tables) -> DataFrame:
    """Entity × month list: income, 0 when none, status 3 when there is some."""
    paid = t.orders.where(F.col("o_orderstatus") == "F").withColumnRenamed("o_custkey", "pid")
    out = period_series(
        t.customer.select(F.col("c_custkey").alias("pid")),
        paid,
        "pid",
        "o_orderdate",
        SERIES,
        {"amt": F.sum(as_money("o_totalprice"))},
    )
    return doubles(out.withColumn("status", met_if(F.col("amt") > 0)), "amt")


@query(oracle=f"""
    SELECT o_custkey AS pid, year(o_orderdate) AS year, month(o_orderdate) AS month,
           CASE WHEN sum({money('o_totalprice')}) > 0 THEN 3 ELSE 1 END AS status,
           CAST(sum({money('o_totalprice')}) AS DOUBLE) AS amt
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2, 3
""")
def proxy_pay_month(t: Tables) -> DataFrame:
    """Paid amount and status per entity and month."""
    paid = t.orders.where(F.col("o_orderstatus") == "F").withColumns(calendar_columns("o_orderdate"))
    sums = paid.groupBy(F.col("o_custkey").alias("pid"), "year", "month").agg(
        F.sum(as_money("o_totalprice")).alias("amt")
    )
    return doubles(sums.withColumn("status", met_if(F.col("amt") > 0)), "amt")


DEPOSIT_CTE = f"""
    deposits AS (
      SELECT year(o_orderdate) AS year, month(o_orderdate) AS month,
             sum({money('o_totalprice')}) AS amt
      FROM orders GROUP BY 1, 2),
    running AS (
      SELECT year, month, amt, sum(amt) OVER (ORDER BY year, month) AS running_amt FROM deposits)
"""


def deposits_by_month(t: Tables) -> DataFrame:
    monthly = (
        t.orders.withColumns(calendar_columns("o_orderdate"))
        .groupBy("year", "month")
        .agg(F.sum(as_money("o_totalprice")).alias("amt"))
    )
    return running_total(monthly, ["year", "month"], "amt", "running_amt")


@query(oracle=f"""
    WITH {DEPOSIT_CTE}
    SELECT year, month, CAST(amt AS DOUBLE) AS amt, CAST(running_amt AS DOUBLE) AS running_amt
    FROM running
""")
def deposit_running_total(t: Tables) -> DataFrame:
    """Running sum by month; the window sees one row per month."""
    return doubles(deposits_by_month(t), "amt", "running_amt")


@query(oracle=f"""
    WITH {DEPOSIT_CTE},
    cutoffs AS (
      SELECT CAST(DATE '2001-06-15' - to_months(CAST(k AS INTEGER)) AS DATE) AS c FROM range(0, 12) r(k)),
    wide AS (
      SELECT year(c) AS year, month(c) AS month,
        (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderdate < c) AS customers,
        (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_shipdate < c) AS suppliers,
        (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_shipdate < c) AS orders_seen,
        (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_shipdate < c) AS parts,
        (SELECT CAST(trunc(sum({money('l_extendedprice')}) / 10000) AS BIGINT) FROM lineitem
         WHERE l_shipdate < c) AS amount
      FROM cutoffs)
    SELECT year, month, customers AS amount, 1 AS type FROM wide
    UNION SELECT year, month, CAST(trunc(running_amt) AS BIGINT), 2 FROM running
    UNION SELECT year, month, suppliers, 3 FROM wide
    UNION SELECT year, month, orders_seen, 4 FROM wide
    UNION SELECT year, month, parts, 5 FROM wide
    UNION SELECT year, month, amount, 6 FROM wide
""")
def cumulative_metrics_12m(t: Tables) -> DataFrame:
    """Six cumulative metrics in long form. Twelve cutoffs cost one pass over the lines for
    the sums and one for all distinct counts."""
    customers = cumulative_distinct(t.orders, "o_orderdate", CUTOFFS, {"customers": "o_custkey"})
    ids = {"suppliers": "l_suppkey", "orders_seen": "l_orderkey", "parts": "l_partkey"}
    seen = cumulative_distinct(t.lineitem, "l_shipdate", CUTOFFS, ids)
    sums = cumulative_sums(
        t.lineitem, "l_shipdate", CUTOFFS, {"amount_sum": as_money("l_extendedprice")}
    )
    wide = customers.join(seen, "cutoff").join(sums, "cutoff")
    wide = wide.withColumns(calendar_columns("cutoff"))
    wide = wide.withColumn("amount_units", in_ten_thousands("amount_sum"))
    metrics = {1: "customers", 3: "suppliers", 4: "orders_seen", 5: "parts", 6: "amount_units"}
    long = unpivot_metrics(wide, ["year", "month"], metrics, "type", "amount")
    running = deposits_by_month(t).select(
        "year", "month", F.lit(2).alias("type"), F.col("running_amt").cast("long").alias("amount")
    )
    return long.unionByName(running).select("year", "month", "amount", "type")


CACHE_KEYS = ["county_name", "year", "month"]
CACHE_SQL = f"""
    SELECT n_name AS county_name, year(o_orderdate) AS year, month(o_orderdate) AS month,
           CAST(sum({money('o_totalprice')}) AS DOUBLE) AS salary_amt, count(*) AS batch_count,
           CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN {money('o_totalprice')} END) AS DOUBLE)
             AS urgent_amt
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
"""


def month_cache(t: Tables, orders: DataFrame) -> DataFrame:
    owner = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    names = t.nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("county_name")
    )
    rows = orders.withColumns(calendar_columns("o_orderdate")).join(owner, "o_custkey")
    amt = as_money("o_totalprice")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", amt)
    return (
        rows.join(names, "c_nationkey")
        .groupBy(*CACHE_KEYS)
        .agg(
            F.sum(amt).cast("double").alias("salary_amt"),
            F.count("*").alias("batch_count"),
            F.sum(urgent).cast("double").alias("urgent_amt"),
        )
    )


@query(oracle=f"""
    WITH stored AS ({CACHE_SQL} WHERE o_orderdate < TIMESTAMP '2001-06-01 00:00:00' GROUP BY 1, 2, 3),
    fresh AS ({CACHE_SQL} WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2001-04-01 00:00:00'
              AND o_orderdate < TIMESTAMP '2001-07-01 00:00:00' GROUP BY 1, 2, 3)
    SELECT coalesce(f.county_name, s.county_name) AS county_name, coalesce(f.year, s.year) AS year,
           coalesce(f.month, s.month) AS month, coalesce(f.salary_amt, s.salary_amt) AS salary_amt,
           coalesce(f.batch_count, s.batch_count) AS batch_count,
           coalesce(f.urgent_amt, s.urgent_amt) AS urgent_amt
    FROM stored s FULL OUTER JOIN fresh f
      ON f.county_name = s.county_name AND f.year = s.year AND f.month = s.month
""")
def month_cache_merge(t: Tables) -> DataFrame:
    """Stored month report with the last three months recomputed on top; a fresh NULL does not
    erase a stored value."""
    closed = t.orders.where(F.col("o_orderdate") < F.lit(month_start(AS_OF_ORDERS)))
    recent = t.orders.where(
        (F.col("o_orderstatus") == "F") & months_window("o_orderdate", AS_OF_ORDERS, -2, 1)
    )
    return merge_latest(month_cache(t, closed), month_cache(t, recent), CACHE_KEYS)


@query(oracle="""
    SELECT l_suppkey AS source_pid, count(*) AS pay_count
    FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) GROUP BY l_suppkey
""")
def distinct_pairs_count(t: Tables) -> DataFrame:
    """People paid per project: count over distinct pairs."""
    pairs = t.lineitem.select(F.col("l_suppkey").alias("source_pid"), "l_partkey").distinct()
    return pairs.groupBy("source_pid").agg(F.count("*").alias("pay_count"))


@query(oracle="""
    WITH spans AS (
      SELECT o_orderkey, o_custkey, c_nationkey, o_orderdate AS starttime, max(l_shipdate) AS endtime
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
      GROUP BY 1, 2, 3, 4),
    months AS (
      SELECT CAST(date_trunc('month', DATE '2001-06-15') - to_months(CAST(k AS INTEGER)) AS DATE) AS cur_date
      FROM range(1, 13) r(k))
    SELECT c_nationkey AS county_code, cur_date, count(DISTINCT o_custkey) AS real_count
    FROM spans JOIN months ON endtime >= cur_date AND starttime < cur_date + INTERVAL 1 MONTH
      AND starttime <= endtime
    GROUP BY 1, 2
""")
def active_headcount_month(t: Tables) -> DataFrame:
    """Distinct companies per area whose order interval overlaps the month. A reversed interval
    is no interval."""
    last = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("endtime")
    )
    owner = t.customer.select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("county_code")
    )
    spans = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("starttime"))
    spans = spans.join(last, "o_orderkey").where(F.col("starttime") <= F.col("endtime"))
    months = [month_start(AS_OF_ORDERS, -k) for k in range(1, 13)]
    return active_in_period(
        spans.join(owner, "o_custkey"),
        ["county_code"],
        "o_custkey",
        "starttime",
        "endtime",
        months,
        "real_count",
    )


@query(oracle="""
    SELECT count(p_partkey) AS labourer_total,
           CAST(sum(CASE WHEN p_retailprice >= 1000 THEN 1 ELSE 0 END) AS BIGINT) AS is_job_total,
           CAST(sum(CASE WHEN p_size >= 0 AND p_size < 5 THEN 1 ELSE 0 END) AS BIGINT) AS size_0_5,
           CAST(sum(CASE WHEN p_size >= 5 AND p_size < 10 THEN 1 ELSE 0 END) AS BIGINT) AS size_5_10,
           CAST(sum(CASE WHEN p_size >= 10 AND p_size < 25 THEN 1 ELSE 0 END) AS BIGINT) AS size_10_25,
           CAST(sum(CASE WHEN p_size >= 25 AND p_size < 45 THEN 1 ELSE 0 END) AS BIGINT) AS size_25_45,
           CAST(sum(CASE WHEN p_size >= 45 THEN 1 ELSE 0 END) AS BIGINT) AS size_45_up,
           (SELECT count(*) FROM customer WHERE c_acctbal >= 0 AND c_acctbal < 1000) AS balance_0_1000,
           (SELECT count(*) FROM customer WHERE c_acctbal >= 1000 AND c_acctbal < 5000)
             AS balance_1000_5000,
           (SELECT count(*) FROM customer WHERE c_acctbal >= 5000) AS balance_5000_up
    FROM part
""")
def labourer_bands(t: Tables) -> DataFrame:
    """One row: workers by size band and companies by balance band; half-open bands, the last
    one open above, nothing below the first edge."""
    sizes = band_columns("p_size", [0, 5, 10, 25, 45], "size")
    balances = band_columns("c_acctbal", [0, 1000, 5000], "balance")
    workers = t.part.agg(
        F.count("p_partkey").alias("labourer_total"),
        count_if(F.col("p_retailprice") >= 1000).alias("is_job_total"),
        *[c.alias(n) for n, c in sizes.items()],
    )
    return attach_totals(workers, t.customer.agg(*[c.alias(n) for n, c in balances.items()]))


@query(oracle="""
    WITH parents AS (SELECT o_orderkey AS pid FROM orders WHERE o_orderstatus IN ('F', 'O'))
    SELECT pid AS source_pid, pid FROM parents
    UNION
    SELECT p.pid, l.l_orderkey * 100 + l.l_linenumber
    FROM parents p JOIN lineitem l ON l.l_orderkey = p.pid
""")
def hierarchy_flatten(t: Tables) -> DataFrame:
    """Each parent with itself and each live child with its parent."""
    parents = t.orders.where(F.col("o_orderstatus").isin("F", "O"))
    children = t.lineitem.select(
        "l_orderkey", (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("child")
    )
    return with_children(parents, "o_orderkey", children, "child", "l_orderkey")


UNIT_SQL = {
    "day": "CAST({ts} AS DATE) = DATE '2001-06-14'",
    "month": "year({ts}) = 2001 AND month({ts}) = 6",
    "year": "year({ts}) = 2001",
}


@query(oracle="""
    WITH located AS (SELECT * FROM orders JOIN customer ON c_custkey = o_custkey),
    """ + ", ".join(f"""
    total_{u} AS (
      SELECT c_nationkey AS code, count(DISTINCT o_orderkey) AS sn_total_count,
             sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS sn_urgent_count
      FROM located WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) <= DATE '2001-06-14' GROUP BY 1),
    install_{u} AS (
      SELECT c_nationkey AS code, count(DISTINCT o_orderkey) AS sn_install_count
      FROM located WHERE o_orderstatus <> 'P' AND {c.format(ts='o_orderdate')} GROUP BY 1),
    remove_{u} AS (
      SELECT c_nationkey AS code, count(DISTINCT o_orderkey) AS sn_dismantle_count
      FROM located WHERE o_orderstatus = 'P' AND {c.format(ts='o_orderdate')} GROUP BY 1)
    """ for u, c in UNIT_SQL.items()) + " UNION ALL ".join(f"""
    SELECT '{u}' AS unit, n_nationkey AS code, n_name AS name,
           coalesce(a.sn_total_count, 0) AS sn_total_count,
           CAST(coalesce(a.sn_urgent_count, 0) AS BIGINT) AS sn_urgent_count,
           coalesce(b.sn_install_count, 0) AS sn_install_count,
           coalesce(c.sn_dismantle_count, 0) AS sn_dismantle_count
    FROM nation LEFT JOIN total_{u} a ON a.code = n_nationkey
    LEFT JOIN install_{u} b ON b.code = n_nationkey LEFT JOIN remove_{u} c ON c.code = n_nationkey
    """ for u in UNIT_SQL))
def device_totals_unit(t: Tables) -> DataFrame:
    """Per area and unit (day, month, year before the run date): devices in place, installed,
    removed. All measures of all units come from one scan; the device key is unique, so rows
    are devices."""
    day = previous_day(AS_OF_ORDERS)
    owner = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("code"))
    units = list(UNIT_SQL)
    live, gone = F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "P"
    in_place = live & (F.col("o_orderdate") < F.lit(AS_OF_ORDERS))
    measures = {
        "sn_total_count": (in_place, None),
        "sn_urgent_count": (in_place & (F.col("o_orderpriority") == "1-URGENT"), None),
    }
    for u in units:
        measures[f"install_{u}"] = (live & in_unit("o_orderdate", day, u), None)
        measures[f"dismantle_{u}"] = (gone & in_unit("o_orderdate", day, u), None)
    devices = t.orders.where(in_place | in_unit("o_orderdate", day, "year")).join(owner, "o_custkey")
    merged = conditional_measures(devices, ["code"], measures)
    areas = t.nation.select("n_nationkey", F.col("n_name").alias("name"))
    full = scaffold(areas, merged, [("n_nationkey", "code")])
    rows = F.array(*[
        F.struct(
            F.lit(u).alias("unit"),
            F.col(f"install_{u}").alias("sn_install_count"),
            F.col(f"dismantle_{u}").alias("sn_dismantle_count"),
        )
        for u in units
    ])
    return full.withColumn("u", F.explode(rows)).select(
        "u.unit",
        F.col("n_nationkey").alias("code"),
        "name",
        "sn_total_count",
        "sn_urgent_count",
        "u.sn_install_count",
        "u.sn_dismantle_count",
    )


@query(oracle=f"""
    SELECT l_orderkey AS pid, count(l_partkey) AS labourer_total,
           CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS on_job_count,
           {', '.join(f"CAST(sum(CASE WHEN l_linestatus = 'F' AND {c.format(ts='l_shipdate')} THEN 1 ELSE 0 END) AS BIGINT) AS off_job_{u}"
                      for u, c in UNIT_SQL.items())}
    FROM lineitem GROUP BY l_orderkey
""")
def project_totals_unit(t: Tables) -> DataFrame:
    """Per project: workers, on the job, left in the day, month, year before the run date."""
    day = previous_day(AS_OF_ORDERS)
    off = F.col("l_linestatus") == "F"
    return t.lineitem.groupBy(F.col("l_orderkey").alias("pid")).agg(
        F.count("l_partkey").alias("labourer_total"),
        count_if(F.col("l_linestatus") == "O").alias("on_job_count"),
        *[count_if(off & in_unit("l_shipdate", day, u)).alias(f"off_job_{u}") for u in UNIT_SQL],
    )


@query(oracle=f"""
    WITH per_type AS (
      SELECT o_orderstatus AS fee_type, n_name AS county_name, sum({money('o_totalprice')}) AS amt,
             sum(CASE WHEN c_mktsegment = 'BUILDING' THEN {money('o_totalprice')} ELSE 0 END) AS building
      FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
      WHERE year(o_orderdate) = 2001 AND month(o_orderdate) = 5 GROUP BY 1, 2)
    SELECT fee_type, county_name, CAST(amt AS DOUBLE) AS amt, CAST(building AS DOUBLE) AS building_amt,
           {share('building', 'amt')} AS building_proportion,
           {share('amt', '(SELECT sum(amt) FROM per_type)')} AS total_proportion
    FROM per_type
""")
def fee_share_last_month(t: Tables) -> DataFrame:
    """Last month's amounts by type and area with numeric shares of the row and of the grand
    total."""
    owner = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    names = t.nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("county_name")
    )
    recent = t.orders.where(in_previous_month("o_orderdate", AS_OF_ORDERS))
    rows = recent.join(owner, "o_custkey").join(names, "c_nationkey")
    amt = as_money("o_totalprice")
    sums = rows.groupBy(F.col("o_orderstatus").alias("fee_type"), "county_name").agg(
        F.sum(amt).alias("amt"),
        sum_if(F.col("c_mktsegment") == "BUILDING", amt).alias("building_amt"),
    )
    full = attach_totals(sums, sums.agg(F.sum("amt").alias("grand_total")))
    full = full.withColumns(
        {
            "building_proportion": proportion("building_amt", "amt"),
            "total_proportion": proportion("amt", "grand_total"),
        }
    )
    return doubles(full.drop("grand_total"), "amt", "building_amt")
