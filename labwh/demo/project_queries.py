"""Project flags, build reports and compliance rules on ``orders`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.demo.registry import money, query, share, share_text
from labwh.demo.tables import AS_OF_ORDERS, PRIORITIES, Tables
from labwh.functions import grace_month, in_previous_month, in_range, month_start, null_bucket, proportion
from labwh.functions import money as as_money
from labwh.operators import (
    add_flags,
    add_measures,
    conditional_measures,
    count_if,
    covered_status,
    lookup_levels,
    met_if,
    score_rules,
    with_shares,
)

ALL_FLAGS = [
    "has_returned", "has_open_line", "has_discount", "has_big_part", "has_city_supplier",
    "shipped_late",
]

FLAGS_CTE = """
    flags AS (
      SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderstatus, o.o_orderpriority, o.o_totalprice,
        CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
                          AND l.l_returnflag = 'R') THEN 1 ELSE 0 END AS has_returned,
        CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
                          AND l.l_linestatus = 'O') THEN 1 ELSE 0 END AS has_open_line,
        CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
                          AND l.l_discount >= 0.09) THEN 1 ELSE 0 END AS has_discount,
        CASE WHEN EXISTS (SELECT 1 FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
                          WHERE l.l_orderkey = o.o_orderkey AND p.p_size >= 40)
             THEN 1 ELSE 0 END AS has_big_part,
        CASE WHEN EXISTS (SELECT 1 FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
                          JOIN nation n ON n.n_nationkey = s.s_nationkey
                          JOIN region r ON r.r_regionkey = n.n_regionkey
                          WHERE l.l_orderkey = o.o_orderkey AND r.r_name = 'ASIA')
             THEN 1 ELSE 0 END AS has_city_supplier,
        CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
                          AND l.l_shipdate > o.o_orderdate + INTERVAL 60 DAY)
             THEN 1 ELSE 0 END AS shipped_late
      FROM orders o)
"""


def city_suppliers(t: Tables) -> DataFrame:
    return t.supplier.join(
        t.city_nations(), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi"
    )


LINE_FLAGS = {
    "has_returned": "l_returnflag = 'R'",
    "has_open_line": "l_linestatus = 'O'",
    "has_discount": "l_discount >= 0.09",
}


def line_flags() -> list[Column]:
    return [
        F.max(F.when(F.expr(cond), 1).otherwise(0)).alias(n) for n, cond in LINE_FLAGS.items()
    ]


def line_sums(t: Tables) -> DataFrame:
    """Flags and sums of the order lines, one row per order from one scan."""
    return t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        *line_flags(),
        F.max("l_shipdate").alias("last_ship"),
        F.count("*").alias("line_count"),
        F.sum(as_money("l_extendedprice")).alias("line_amt"),
    )


def flagged_orders(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """Orders with six 0/1 flags, line count and line amount."""
    line = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
    big = t.part.where(F.col("p_size") >= 40)
    big_lines = line.join(big, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    city_lines = line.join(
        city_suppliers(t), F.col("l_suppkey") == F.col("s_suppkey"), "left_semi"
    )
    flagged = add_flags(
        t.orders,
        "o_orderkey",
        [
            (big_lines, "l_orderkey", {"has_big_part": F.lit(True)}),
            (city_lines, "l_orderkey", {"has_city_supplier": F.lit(True)}),
        ],
    )
    out = add_measures(flagged, "o_orderkey", line_sums(t) if lines is None else lines)
    late = F.col("last_ship") > F.col("o_orderdate") + F.expr("INTERVAL '60' DAY")
    none = {n: F.coalesce(F.col(n), F.lit(0)) for n in LINE_FLAGS}
    return out.withColumns({**none, "shipped_late": F.when(late, 1).otherwise(0)})


@query(oracle=f"WITH {FLAGS_CTE} SELECT o_orderkey, {', '.join(ALL_FLAGS)} FROM flags")
def project_flags(t: Tables) -> DataFrame:
    """Six existence flags per order; one row per order."""
    return flagged_orders(t).select("o_orderkey", *ALL_FLAGS)


@query(oracle=f"""
    WITH {FLAGS_CTE}
    SELECT f.o_orderkey, f.o_custkey, f.o_orderstatus, CAST(f.o_orderdate AS DATE) AS create_date,
           n.n_name AS county_name, r.r_name AS city_name, {', '.join('f.' + x for x in ALL_FLAGS)},
           coalesce(s.line_count, 0) AS line_count, CAST(coalesce(s.line_amt, 0) AS DOUBLE) AS line_amt
    FROM flags f
    LEFT JOIN customer c ON c.c_custkey = f.o_custkey
    LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
    LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
    LEFT JOIN (SELECT l_orderkey, count(*) AS line_count, sum({money('l_extendedprice')}) AS line_amt
               FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = f.o_orderkey
""")
def project_wide_detail(t: Tables) -> DataFrame:
    """Order with flags, area names on two levels and line sums."""
    owner = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    wide = flagged_orders(t).join(owner, "o_custkey", "left")
    wide = wide.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    wide = lookup_levels(
        wide, t.region, {"city_name": ("n_regionkey", None)}, code="r_regionkey", name="r_name"
    )
    return wide.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_orderdate").cast("date").alias("create_date"),
        F.col("n_name").alias("county_name"),
        "city_name",
        *ALL_FLAGS,
        F.coalesce("line_count", F.lit(0)).alias("line_count"),
        F.coalesce("line_amt", F.lit(0)).cast("double").alias("line_amt"),
    )


def located_flags(t: Tables) -> DataFrame:
    """Flagged orders with the nation of their customer."""
    owner = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    flagged = flagged_orders(t).join(owner, "o_custkey")
    return flagged.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")


@query(oracle=f"""
    WITH {FLAGS_CTE}
    SELECT n.n_name AS county_name, year(f.o_orderdate) AS year, month(f.o_orderdate) AS month,
           f.o_orderpriority AS project_type, count(*) AS project_total,
           {', '.join(f'CAST(sum(f.{x}) AS BIGINT) AS {x}_total' for x in ALL_FLAGS)}
    FROM flags f JOIN customer c ON c.c_custkey = f.o_custkey
    JOIN nation n ON n.n_nationkey = c.c_nationkey
    WHERE f.o_orderpriority <> '5-LOW'
    GROUP BY ALL
""")
def build_type_day(t: Tables) -> DataFrame:
    """Area × month × project type: counts and flag sums; one pass, the type is a group key."""
    rows = located_flags(t).where(F.col("o_orderpriority").isin(list(PRIORITIES)[:4]))
    return rows.groupBy(
        F.col("n_name").alias("county_name"),
        F.year("o_orderdate").cast("long").alias("year"),
        F.month("o_orderdate").cast("long").alias("month"),
        F.col("o_orderpriority").alias("project_type"),
    ).agg(
        F.count("*").alias("project_total"),
        *[F.sum(f).alias(f"{f}_total") for f in ALL_FLAGS],
    )


BUILD_MEASURES = [f"{p}_total" for p in PRIORITIES.values()] + [f"{f}_total" for f in ALL_FLAGS]
BUILD_DAY_CTE = f"""
    {FLAGS_CTE},
    build_day AS (
      SELECT coalesce(CASE WHEN n.n_nationkey % 8 <> 7 THEN n.n_name END, 'other') AS county_name,
             year(f.o_orderdate) AS year, month(f.o_orderdate) AS month,
             count(f.o_orderkey) AS project_total,
             {', '.join(f"sum(CASE WHEN f.o_orderpriority = '{p}' THEN 1 ELSE 0 END) AS {n}_total"
                        for p, n in PRIORITIES.items())},
             {', '.join(f'sum(f.{x}) AS {x}_total' for x in ALL_FLAGS)}
      FROM flags f JOIN customer c ON c.c_custkey = f.o_custkey
      JOIN nation n ON n.n_nationkey = c.c_nationkey
      WHERE f.o_orderstatus IN ('F', 'O')
      GROUP BY 1, 2, 3)
"""


def build_day(t: Tables) -> DataFrame:
    rows = located_flags(t).where(F.col("o_orderstatus").isin("F", "O"))
    label = F.when(F.col("n_nationkey") % 8 != 7, F.col("n_name"))
    rows = rows.withColumns(
        {
            "county_name": null_bucket(label, "other"),
            "year": F.year("o_orderdate").cast("long"),
            "month": F.month("o_orderdate").cast("long"),
        }
    )
    measures = {"project_total": (F.lit(True), None)}
    for priority, name in PRIORITIES.items():
        measures[f"{name}_total"] = (F.col("o_orderpriority") == priority, None)
    for flag in ALL_FLAGS:
        measures[f"{flag}_total"] = (F.col(flag) == 1, None)
    return conditional_measures(rows, ["county_name", "year", "month"], measures)


def _build_shares(df: DataFrame) -> DataFrame:
    parts = {m.replace("_total", "_proportion"): m for m in BUILD_MEASURES}
    return with_shares(df, parts, "project_total", as_text=True)


BUILD_SHARES_SQL = ", ".join(
    f"CAST({m} AS BIGINT) AS {m}, {share_text(m, 'project_total')} AS {m.replace('_total', '_proportion')}"
    for m in BUILD_MEASURES
)


@query(oracle=f"""
    WITH {BUILD_DAY_CTE}
    SELECT county_name, year, month, project_total, {BUILD_SHARES_SQL} FROM build_day
""")
def build_day_share(t: Tables) -> DataFrame:
    """Area × month: projects by type and flag with shares; areas without a name form one
    bucket."""
    return _build_shares(build_day(t))


@query(oracle=f"""
    WITH {BUILD_DAY_CTE},
    total AS (
      SELECT county_name, CAST(sum(project_total) AS BIGINT) AS project_total,
             {', '.join(f'sum({m}) AS {m}' for m in BUILD_MEASURES)}
      FROM build_day GROUP BY county_name)
    SELECT county_name, project_total, {BUILD_SHARES_SQL} FROM total
""")
def build_total(t: Tables) -> DataFrame:
    """Area totals, added up from the monthly report; shares are taken anew."""
    sums = [F.sum(m).alias(m) for m in ["project_total", *BUILD_MEASURES]]
    return _build_shares(build_day(t).groupBy("county_name").agg(*sums))


@query(oracle="""
    SELECT coalesce(CASE WHEN n.n_nationkey % 8 <> 7 THEN n.n_name END, 'other') AS county_name,
           CAST(o_orderdate AS DATE) AS create_date, count(o_orderkey) AS project_total,
           CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS build_total,
           CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS stop_total,
           CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS complete_total,
           count(DISTINCT o_custkey) AS companys_sum
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation n ON n_nationkey = c_nationkey
    GROUP BY 1, 2
""")
def status_day(t: Tables) -> DataFrame:
    """Area × day: projects by state and distinct companies.

    Rows are first reduced per company, which makes the distinct count a plain count.
    """
    by_company = t.orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("create_date")).agg(
        F.count("o_orderkey").alias("n"),
        *[count_if(F.col("o_orderstatus") == s).alias(s) for s in ("F", "O", "P")],
    )
    owner = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nation = t.nation.select(
        F.col("n_nationkey").alias("c_nationkey"),
        null_bucket(F.when(F.col("n_nationkey") % 8 != 7, F.col("n_name")), "other").alias("county_name"),
    )
    located = by_company.join(owner, "o_custkey").join(nation, "c_nationkey")
    return located.groupBy("county_name", "create_date").agg(
        F.sum("n").alias("project_total"),
        F.sum("F").alias("build_total"),
        F.sum("O").alias("stop_total"),
        F.sum("P").alias("complete_total"),
        F.count("*").alias("companys_sum"),
    )


RULES = ["real", "bail", "account", "proxy_pay", "billboard", "pay"]
STATUS_COLUMNS = [
    "real_book_status", "real_pay_status", "bail_status", "account_special_status",
    "account_in_status", "account_three_status", "entrust_status", "billboard_status",
    "pay_status", "real_status", "account_status", "proxy_pay_status",
]

SCORES_CTE = f"""
    {FLAGS_CTE},
    due AS (
      SELECT f.*, date_trunc('month', DATE '2001-06-15') + to_days(CAST(f.o_orderkey % 28 + 1 + 4 AS INTEGER))
               AS due_day
      FROM flags f),
    judged AS (
      SELECT d.*, CASE WHEN 15 > day(due_day) AND month(due_day) = 6
                       THEN DATE '2001-05-01' ELSE DATE '2001-04-01' END AS judged_month
      FROM due d),
    lines AS (
      SELECT l_orderkey, count(DISTINCT l_suppkey) AS needed,
             count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_suppkey END) AS done
      FROM lineitem GROUP BY l_orderkey),
    components AS (
      SELECT j.o_orderkey, j.o_custkey, j.o_orderpriority, j.judged_month,
        CASE WHEN has_returned = 1 THEN 3 ELSE 1 END AS real_book_status,
        CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = j.o_orderkey
                          AND CAST(date_trunc('month', l.l_shipdate) AS DATE) = j.judged_month)
             THEN 3 ELSE 1 END AS real_pay_status,
        CASE WHEN has_discount = 1 THEN 3 ELSE 1 END AS bail_status,
        CASE WHEN has_city_supplier = 1 THEN 3 ELSE 1 END AS account_special_status,
        CASE WHEN has_open_line = 1 THEN 3 ELSE 1 END AS account_in_status,
        CASE WHEN has_big_part = 1 THEN 3 ELSE 1 END AS account_three_status,
        CASE WHEN x.done = 0 THEN 1 WHEN x.done < x.needed THEN 4 WHEN x.done = x.needed THEN 3
             ELSE 1 END AS entrust_status,
        CASE WHEN shipped_late = 1 THEN 3 ELSE 1 END AS billboard_status,
        CASE WHEN j.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS islw
      FROM judged j LEFT JOIN lines x ON x.l_orderkey = j.o_orderkey),
    scores AS (
      SELECT *, real_pay_status AS pay_status,
        CASE WHEN real_book_status = 3 AND real_pay_status = 3 THEN 3 ELSE 1 END AS real_status,
        CASE WHEN account_special_status = 3 AND account_three_status = 3 THEN 3 ELSE 1 END
          AS account_status,
        CASE WHEN real_pay_status = 3 AND islw = 1 AND entrust_status = 3 THEN 3
             WHEN real_pay_status = 3 AND islw = 0 AND entrust_status = 1 THEN 3
             ELSE 1 END AS proxy_pay_status
      FROM components)
"""


def order_scores(t: Tables) -> DataFrame:
    """Orders with component and composite statuses.

    Both candidate months are read in one pass over the lines; the grace rule then picks one.
    """
    last, second_last = month_start(AS_OF_ORDERS, -1), month_start(AS_OF_ORDERS, -2)
    ship = F.col("l_shipdate")
    per_supplier = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(
        *line_flags(),
        F.max(ship).alias("last_ship"),
        F.max(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("is_done"),
        F.max(F.when(in_previous_month(ship, AS_OF_ORDERS), 1).otherwise(0)).alias("paid_last"),
        F.max(F.when(in_range(ship, (second_last, last)), 1).otherwise(0)).alias("paid_before"),
    )
    kept = [*LINE_FLAGS, "last_ship", "paid_last", "paid_before"]
    lines = per_supplier.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        *[F.max(c).alias(c) for c in kept],
        F.count("l_suppkey").alias("needed"),
        F.sum("is_done").alias("done"),
    )
    rows = flagged_orders(t, lines).withColumn(
        "judged_month", grace_month(F.col("o_orderkey") % 28 + 1, AS_OF_ORDERS)
    )
    paid = F.when(F.col("judged_month") == F.lit(last), F.col("paid_last")).otherwise(
        F.col("paid_before")
    )
    pay = met_if(paid == 1)
    components = {
        "real_book_status": met_if(F.col("has_returned") == 1),
        "real_pay_status": pay,
        "bail_status": met_if(F.col("has_discount") == 1),
        "account_special_status": met_if(F.col("has_city_supplier") == 1),
        "account_in_status": met_if(F.col("has_open_line") == 1),
        "account_three_status": met_if(F.col("has_big_part") == 1),
        "entrust_status": covered_status(F.col("done"), F.col("needed")),
        "billboard_status": met_if(F.col("shipped_late") == 1),
        "pay_status": pay,
    }
    composites = {
        "real_status": ["real_book_status", "real_pay_status"],
        "account_status": ["account_special_status", "account_three_status"],
    }
    scored = score_rules(rows, components, composites)
    entrusted = F.when(F.col("o_orderpriority") == "1-URGENT", 3).otherwise(1)
    proxy = (F.col("real_pay_status") == 3) & (F.col("entrust_status") == entrusted)
    return scored.withColumn("proxy_pay_status", met_if(proxy))


@query(oracle=f"""
    WITH {SCORES_CTE}
    SELECT o_orderkey, judged_month, {', '.join(STATUS_COLUMNS)} FROM scores
""")
def six_rule_scores(t: Tables) -> DataFrame:
    """Rule statuses per order with the grace rule for payments."""
    return order_scores(t).select("o_orderkey", "judged_month", *STATUS_COLUMNS)


@query(oracle=f"""
    WITH {SCORES_CTE},
    counted AS (
      SELECT n.n_name AS county_name, o_orderpriority AS industry_type, count(*) AS project_count,
        {', '.join(f'CAST(sum(CASE WHEN {r}_status = 3 THEN 1 ELSE 0 END) AS BIGINT) AS {r}_count'
                   for r in RULES)},
        CAST(sum(CASE WHEN {' AND '.join(f'{r}_status = 3' for r in RULES)} THEN 1 ELSE 0 END)
             AS BIGINT) AS complete_count
      FROM scores JOIN customer ON c_custkey = o_custkey JOIN nation n ON n.n_nationkey = c_nationkey
      GROUP BY 1, 2)
    SELECT county_name, industry_type, project_count,
      {', '.join(f"{r}_count, {share(f'{r}_count', 'project_count')} AS {r}_proportion"
                 for r in [*RULES, 'complete'])}
    FROM counted
""")
def six_rule_statistics(t: Tables) -> DataFrame:
    """Area × industry: projects that meet each rule, and all six, with shares."""
    owner = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rows = order_scores(t).join(owner, "o_custkey")
    rows = rows.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    complete = F.lit(True)
    for r in RULES:
        complete = complete & (F.col(f"{r}_status") == 3)
    counts = {
        "project_count": (F.lit(True), None),
        **{f"{r}_count": (F.col(f"{r}_status") == 3, None) for r in RULES},
        "complete_count": (complete, None),
    }
    by = {"county_name": F.col("n_name"), "industry_type": F.col("o_orderpriority")}
    out = conditional_measures(rows.withColumns(by), list(by), counts)
    return out.withColumns(
        {f"{r}_proportion": proportion(f"{r}_count", "project_count") for r in [*RULES, "complete"]}
    )
