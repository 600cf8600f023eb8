"""Company reports on ``customer``, ``nation`` and ``supplier``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.demo.project_queries import city_suppliers
from labwh.demo.registry import money, query, share_text
from labwh.demo.tables import AS_OF_ORDERS, SEGMENTS, Tables
from labwh.functions import in_unit, previous_day
from labwh.functions import money as as_money
from labwh.operators import (
    attach_totals,
    conditional_measures,
    count_if,
    in_any,
    label_list,
    latest_per_key,
    lookup_levels,
    month_shift,
    outer_merge,
    rank_within,
    scaffold,
    split_by_membership,
    with_month_shift,
    with_shares,
)


def business_areas(t: Tables, *extra: str) -> DataFrame:
    """Distinct customer × supplier nation (× order columns) of the order lines."""
    nations = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    lines = t.lineitem.select("l_orderkey", "l_suppkey").join(nations, "l_suppkey")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", *extra)
    per_order = lines.select("l_orderkey", "s_nationkey").distinct()
    return per_order.join(orders, "l_orderkey").select("o_custkey", "s_nationkey", *extra).distinct()


def registered_area() -> Column:
    return F.when(F.col("c_nationkey") % 10 != 9, F.col("c_nationkey"))


BUSINESS_CTE = """
    business AS (
      SELECT DISTINCT o_custkey, s_nationkey
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey),
    company AS (
      SELECT c_custkey, c_mktsegment, CASE WHEN c_nationkey % 10 <> 9 THEN c_nationkey END AS area
      FROM customer),
    city AS (
      SELECT n_nationkey, n_name FROM nation JOIN region ON r_regionkey = n_regionkey
      WHERE r_name = 'ASIA')
"""


@query(oracle=f"""
    WITH {BUSINESS_CTE}
    SELECT c.c_custkey, c.c_mktsegment, a.n_name AS county_name, b.s_nationkey AS project_county_code,
           p.n_name AS project_county_name,
           row_number() OVER (PARTITION BY c.c_custkey ORDER BY b.s_nationkey) AS rank
    FROM company c
    LEFT JOIN nation a ON a.n_nationkey = c.area
    LEFT JOIN business b ON b.o_custkey = c.c_custkey
    LEFT JOIN nation p ON p.n_nationkey = b.s_nationkey
""")
def company_business_area(t: Tables) -> DataFrame:
    """Company × business area with names and an ordinal per company.

    A company has at most as many rows as there are areas, so the ordinal needs no split.
    """
    company = t.customer.select("c_custkey", "c_mktsegment", registered_area().alias("area"))
    areas = business_areas(t).withColumnRenamed("o_custkey", "c_custkey")
    rows = company.join(areas, "c_custkey", "left")
    ranked = rank_within(rows, ["c_custkey"], [F.col("s_nationkey")], "rank")
    named = lookup_levels(
        ranked,
        t.nation,
        {"county_name": ("area", None), "project_county_name": ("s_nationkey", None)},
        code="n_nationkey",
        name="n_name",
    )
    return named.select(
        "c_custkey",
        "c_mktsegment",
        "county_name",
        F.col("s_nationkey").alias("project_county_code"),
        "project_county_name",
        "rank",
    )


SEGMENT_COUNTS = ", ".join(
    f"sum(CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END) AS {n}_count" for s, n in SEGMENTS.items()
)


@query(oracle=f"""
    SELECT n.n_name AS name, x.companys_sum,
           {', '.join(f"CAST(x.{n}_count AS BIGINT) AS {n}_count, {share_text(f'x.{n}_count', 'x.companys_sum')} AS {n}_proportion"
                      for n in SEGMENTS.values())}
    FROM nation n LEFT JOIN (
      SELECT c_nationkey, count(c_custkey) AS companys_sum, {SEGMENT_COUNTS}
      FROM customer WHERE c_nationkey % 10 <> 9 GROUP BY c_nationkey) x ON x.c_nationkey = n.n_nationkey
""")
def company_counts_by_area(t: Tables) -> DataFrame:
    """Companies by segment for every area, also those without any."""
    known = t.customer.where(registered_area().isNotNull())
    measures = {"companys_sum": (F.col("c_custkey").isNotNull(), None)}
    for segment, name in SEGMENTS.items():
        measures[f"{name}_count"] = (F.col("c_mktsegment") == segment, None)
    counts = conditional_measures(known, ["c_nationkey"], measures)
    areas = t.nation.select("n_nationkey", F.col("n_name").alias("name"))
    full = scaffold(areas, counts, [("n_nationkey", "c_nationkey")], fill=None)
    parts = {f"{n}_proportion": f"{n}_count" for n in SEGMENTS.values()}
    return with_shares(full, parts, "companys_sum", as_text=True).drop("n_nationkey")


REGISTERED = ["registered_total", "registered_building"]
BUSINESS = ["business_total", "business_local"]
DAILY_CTE = f"""
    first_order AS (
      SELECT o_custkey, min(o_orderdate) AS d FROM orders GROUP BY o_custkey),
    registered AS (
      SELECT c_nationkey AS code, year(d) AS year, month(d) AS month, count(*) AS registered_total,
             sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS registered_building
      FROM customer JOIN first_order ON o_custkey = c_custkey GROUP BY 1, 2, 3),
    dealing AS (
      SELECT DISTINCT s_nationkey AS code, year(l_shipdate) AS year, month(l_shipdate) AS month,
             c_custkey, c_nationkey
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey
      JOIN customer ON c_custkey = o_custkey),
    business AS (
      SELECT code, year, month, count(*) AS business_total,
             sum(CASE WHEN c_nationkey = code THEN 1 ELSE 0 END) AS business_local
      FROM dealing GROUP BY 1, 2, 3),
    merged AS (
      SELECT coalesce(r.code, b.code) AS code, coalesce(r.year, b.year) AS year,
             coalesce(r.month, b.month) AS month, registered_total, registered_building,
             business_total, business_local
      FROM registered r FULL OUTER JOIN business b
        ON r.code = b.code AND r.year = b.year AND r.month = b.month),
    daily AS (
      SELECT n.n_name AS county_name, m.* EXCLUDE (code)
      FROM nation n LEFT JOIN merged m ON m.code = n.n_nationkey)
"""
DAILY_SHARES = f"""
    registered_total, CAST(registered_building AS BIGINT) AS registered_building,
    {share_text('registered_building', 'registered_total')} AS building_proportion,
    business_total, CAST(business_local AS BIGINT) AS business_local,
    {share_text('business_local', 'business_total')} AS local_proportion
"""


def registered_vs_business(t: Tables) -> DataFrame:
    first = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("d")
    )
    calendar = {"year": F.year("d").cast("long"), "month": F.month("d").cast("long")}
    by = ["code", "year", "month"]
    customer = t.customer.withColumn("code", F.col("c_nationkey"))
    registered = conditional_measures(
        customer.join(first, "c_custkey").withColumns(calendar),
        by,
        {
            "registered_total": (F.lit(True), None),
            "registered_building": (F.col("c_mktsegment") == "BUILDING", None),
        },
    )
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("code")
    )
    lines = t.lineitem.select("l_orderkey", "l_suppkey", F.col("l_shipdate").alias("d"))
    lines = lines.join(suppliers, "l_suppkey").withColumns(calendar)
    orders = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")
    )
    dealing = lines.join(orders, "l_orderkey").select(*by, "c_custkey").distinct()
    dealing = dealing.join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
    business = conditional_measures(
        dealing,
        by,
        {
            "business_total": (F.lit(True), None),
            "business_local": (F.col("c_nationkey") == F.col("code"), None),
        },
    )
    merged = outer_merge(by, registered, business, fill=None)
    areas = t.nation.select("n_nationkey", F.col("n_name").alias("county_name"))
    return scaffold(areas, merged, [("n_nationkey", "code")], fill=None).drop("n_nationkey")


def _daily_shares(df: DataFrame) -> DataFrame:
    df = with_shares(df, {"building_proportion": "registered_building"}, "registered_total", True)
    return with_shares(df, {"local_proportion": "business_local"}, "business_total", True)


@query(oracle=f"WITH {DAILY_CTE} SELECT county_name, year, month, {DAILY_SHARES} FROM daily")
def registered_vs_business_daily(t: Tables) -> DataFrame:
    """Area × month: companies registered there beside companies doing business there."""
    return _daily_shares(registered_vs_business(t))


@query(oracle=f"""
    WITH {DAILY_CTE},
    total AS (
      SELECT county_name,
             {', '.join(f'CAST(sum({m}) AS BIGINT) AS {m}' for m in REGISTERED + BUSINESS)}
      FROM daily GROUP BY county_name)
    SELECT county_name, {DAILY_SHARES} FROM total
""")
def area_totals_from_daily(t: Tables) -> DataFrame:
    """Area totals added up from the monthly report."""
    sums = [F.sum(m).alias(m) for m in REGISTERED + BUSINESS]
    return _daily_shares(registered_vs_business(t).groupBy("county_name").agg(*sums))


@query(oracle=f"""
    WITH monthly AS (
      SELECT o_custkey, year(l_shipdate) AS y, month(l_shipdate) AS m,
             sum({money('l_extendedprice')}) AS amt
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linestatus = 'F' GROUP BY 1, 2, 3),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY y DESC, m DESC) AS salary_top
      FROM monthly)
    SELECT c.c_custkey, CAST(coalesce(a.amt, 0) AS DOUBLE) AS salary_this_month,
           CAST(coalesce(b.amt, 0) AS DOUBLE) AS salary_last_month,
           CAST(coalesce(x.amt, 0) AS DOUBLE) AS salary_latest,
           CASE WHEN x.y IS NULL THEN '--'
                ELSE CAST(x.y AS VARCHAR) || '年' || CAST(x.m AS VARCHAR) || '月' END AS salary_latest_label,
           CASE WHEN a.amt > 0 THEN 1 ELSE 0 END AS is_salary
    FROM customer c
    LEFT JOIN monthly a ON a.o_custkey = c.c_custkey AND a.y = 2001 AND a.m = 6
    LEFT JOIN monthly b ON b.o_custkey = c.c_custkey AND b.y = 2001 AND b.m = 5
    LEFT JOIN ranked x ON x.o_custkey = c.c_custkey AND x.salary_top = 1
""")
def company_month_shift(t: Tables) -> DataFrame:
    """Company wages of this month, last month and the latest month with wages."""
    lines = t.lineitem.where(F.col("l_linestatus") == "F").select(
        "l_orderkey",
        F.year("l_shipdate").alias("y"),
        F.month("l_shipdate").alias("m"),
        as_money("l_extendedprice").alias("amt"),
    )
    # One row per order and month leaves the order's hash partition.
    per_order = lines.groupBy("l_orderkey", "y", "m").agg(F.sum("amt").alias("amt"))
    owner = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")
    )
    shifts = month_shift(
        per_order.join(owner, "l_orderkey"), "c_custkey", "y", "m", "amt", AS_OF_ORDERS, "salary"
    )
    out = with_month_shift(t.customer.select("c_custkey"), shifts, "c_custkey", "salary")
    amounts = ["salary_this_month", "salary_last_month", "salary_latest"]
    return out.withColumns({c: F.col(c).cast("double") for c in amounts}).withColumn(
        "is_salary", F.when(F.col("salary_this_month") > 0, 1).otherwise(0)
    )


@query(oracle=f"""
    WITH {BUSINESS_CTE},
    typed AS (
      SELECT DISTINCT o_custkey, o_orderpriority, s_nationkey
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey),
    ranked AS (
      SELECT c.c_custkey, c.area, x.o_orderpriority AS project_type, x.s_nationkey AS project_area,
             row_number() OVER (PARTITION BY c.c_custkey ORDER BY x.o_orderpriority, x.s_nationkey)
               AS type_top
      FROM company c LEFT JOIN typed x ON x.o_custkey = c.c_custkey)
    SELECT * FROM ranked
    WHERE project_area IN (SELECT n_nationkey FROM city) OR area IN (SELECT n_nationkey FROM city)
""")
def company_in_city(t: Tables) -> DataFrame:
    """Company × project type × area with type rank, kept when either area is in our city."""
    company = t.customer.select("c_custkey", registered_area().alias("area"))
    typed = business_areas(t, "o_orderpriority").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderpriority").alias("project_type"),
        F.col("s_nationkey").alias("project_area"),
    )
    order = [F.col("project_type"), F.col("project_area")]
    ranked = rank_within(company.join(typed, "c_custkey", "left"), ["c_custkey"], order, "type_top")
    city = t.city_nations()
    return in_any(ranked, [("project_area", city, "n_nationkey"), ("area", city, "n_nationkey")])


@query(oracle=f"""
    WITH {BUSINESS_CTE}
    SELECT a.n_name AS county_name,
      (SELECT count(DISTINCT c_custkey) FROM business b JOIN company c ON c_custkey = o_custkey
       WHERE b.s_nationkey = a.n_nationkey AND c.area IN (SELECT n_nationkey FROM city)) AS local_total,
      (SELECT count(DISTINCT c_custkey) FROM business b JOIN company c ON c_custkey = o_custkey
       WHERE b.s_nationkey = a.n_nationkey AND c.area NOT IN (SELECT n_nationkey FROM city))
        AS outside_total,
      (SELECT count(DISTINCT c_custkey) FROM business b JOIN company c ON c_custkey = o_custkey
       WHERE b.s_nationkey = a.n_nationkey AND c.area IS NULL) AS unknown_total
    FROM city a
""")
def company_locality_split(t: Tables) -> DataFrame:
    """Per area of our city: companies doing business there that are local, from outside, or
    without a registered area."""
    company = t.customer.select(F.col("c_custkey").alias("o_custkey"), registered_area().alias("area"))
    city = t.city_nations()
    rows = business_areas(t).join(company, "o_custkey")
    split = split_by_membership(
        rows,
        ["s_nationkey"],
        "area",
        city.select("n_nationkey"),
        "n_nationkey",
        "o_custkey",
        {"local": "local_total", "outside": "outside_total", "unknown": "unknown_total"},
    )
    full = scaffold(city.withColumnRenamed("n_name", "county_name"), split, [("n_nationkey", "s_nationkey")])
    return full.drop("n_nationkey")


FLAG_GROUPS = {"A": "accepted", "N": "fresh", "R": "returned"}


@query(oracle=f"""
    WITH labels AS (
      SELECT DISTINCT l_orderkey, l_returnflag, s_acctbal >= 0 AS paid,
             '[' || CASE WHEN s_acctbal >= 0 THEN 'paid' ELSE 'open' END || ']' || n_name AS label
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
    SELECT o.o_orderkey,
      {', '.join(f"coalesce((SELECT string_agg(label, '&' ORDER BY label) FROM labels x WHERE x.l_orderkey = o.o_orderkey AND x.l_returnflag = '{f}' AND {p}), '') AS {n}_{q}"
                 for f, n in FLAG_GROUPS.items() for p, q in (('x.paid', 'paid'), ('NOT x.paid', 'open')))}
    FROM orders o
""")
def company_label_lists(t: Tables) -> DataFrame:
    """Per project, for each company group, the sorted labels of paying and non-paying ones.

    The labels are area names, so a list holds at most as many entries as there are areas.
    """
    paid = F.col("s_acctbal") >= 0
    tag = F.concat(F.lit("["), F.when(paid, "paid").otherwise("open"), F.lit("]"), F.col("n_name"))
    nations = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    suppliers = t.supplier.join(nations, "s_nationkey").select(
        F.col("s_suppkey").alias("l_suppkey"), paid.alias("paid"), tag.alias("label")
    )
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag").join(suppliers, "l_suppkey")
    lists = {}
    for flag, name in FLAG_GROUPS.items():
        mine = F.col("l_returnflag") == flag
        lists[f"{name}_paid"] = (mine & F.col("paid"), "label")
        lists[f"{name}_open"] = (mine & ~F.col("paid"), "label")
    per_order = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(*label_list(lists, "&"))
    return t.orders.select("o_orderkey").join(per_order, "o_orderkey", "left").fillna("")


@query(oracle="""
    WITH people AS (
      SELECT CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment END AS origin, n_regionkey, n_nationkey,
             c_custkey, c_acctbal
      FROM customer JOIN nation ON n_nationkey = c_nationkey),
    on_job AS (
      SELECT origin, n_regionkey, n_nationkey, count(*) AS labourer_total,
             sum(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END) AS onjob_total
      FROM people GROUP BY 1, 2, 3),
    off_job AS (
      SELECT origin, n_regionkey, n_nationkey, count(DISTINCT c_custkey) AS offjob_total
      FROM people JOIN orders ON o_custkey = c_custkey
      WHERE o_orderstatus = 'P' AND year(o_orderdate) = 2001 AND month(o_orderdate) = 6
      GROUP BY 1, 2, 3)
    SELECT coalesce(a.origin, b.origin) AS origin, coalesce(a.n_regionkey, b.n_regionkey) AS city_code,
           coalesce(a.n_nationkey, b.n_nationkey) AS county_code,
           coalesce(labourer_total, 0) AS labourer_total,
           CAST(coalesce(onjob_total, 0) AS BIGINT) AS onjob_total,
           coalesce(offjob_total, 0) AS offjob_total
    FROM on_job a FULL OUTER JOIN off_job b
      ON a.origin = b.origin AND a.n_regionkey = b.n_regionkey AND a.n_nationkey = b.n_nationkey
""")
def platform_totals(t: Tables) -> DataFrame:
    """Origin × city × county: people, on the job, left in the month. Rows without an origin
    are not merged, as in a full outer join."""
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_mktsegment")).alias("origin"),
        F.col("n_regionkey").alias("city_code"),
        F.col("n_nationkey").alias("county_code"),
        "c_custkey",
        "c_acctbal",
    )
    by = ["origin", "city_code", "county_code"]
    on_job = conditional_measures(
        people,
        by,
        {"labourer_total": (F.lit(True), None), "onjob_total": (F.col("c_acctbal") >= 0, None)},
    )
    in_month = in_unit("o_orderdate", previous_day(AS_OF_ORDERS), "month")
    left = t.orders.where((F.col("o_orderstatus") == "P") & in_month)
    gone = people.join(left, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    off_job = gone.groupBy(*by).agg(F.count("*").alias("offjob_total"))
    return outer_merge(by, on_job, off_job, null_keys="apart")


ONJOB_CTE = """
    latest AS (
      SELECT * FROM (
        SELECT o_custkey, o_orderstatus,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders) WHERE rn = 1)
"""


@query(oracle=f"""
    WITH {ONJOB_CTE},
    city_total AS (
      SELECT count(*) AS person_total, sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS arrears_total
      FROM customer WHERE c_nationkey % 10 <> 9),
    county AS (
      SELECT c_nationkey, count(*) AS county_person_total,
             sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS county_arrears_total
      FROM customer JOIN latest ON o_custkey = c_custkey
      WHERE o_orderstatus = 'O' AND c_nationkey % 10 <> 9 GROUP BY c_nationkey)
    SELECT n.n_name AS county_name, t.person_total, CAST(t.arrears_total AS BIGINT) AS arrears_total,
           coalesce(c.county_person_total, 0) AS county_person_total,
           {share_text('coalesce(c.county_person_total, 0)', 't.person_total')} AS person_proportion,
           CAST(coalesce(c.county_arrears_total, 0) AS BIGINT) AS county_arrears_total,
           {share_text('coalesce(c.county_arrears_total, 0)', 't.arrears_total')} AS arrears_proportion
    FROM nation n CROSS JOIN city_total t LEFT JOIN county c ON c.c_nationkey = n.n_nationkey
""")
def onjob_share(t: Tables) -> DataFrame:
    """Area share of the grand totals of people and arrears; every area appears."""
    known = t.customer.where(registered_area().isNotNull())
    arrears = F.col("c_acctbal") < 0
    total = known.agg(
        F.count("*").alias("person_total"), count_if(arrears).alias("arrears_total")
    )
    latest = latest_per_key(
        t.orders.select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey"),
        ["o_custkey"],
        [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
    )
    working = latest.where(F.col("o_orderstatus") == "O")
    on_job = known.join(working, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    county = conditional_measures(
        on_job,
        ["c_nationkey"],
        {"county_person_total": (F.lit(True), None), "county_arrears_total": (arrears, None)},
    )
    areas = t.nation.select("n_nationkey", F.col("n_name").alias("county_name"))
    full = attach_totals(scaffold(areas, county, [("n_nationkey", "c_nationkey")]), total)
    full = with_shares(full, {"person_proportion": "county_person_total"}, "person_total", True)
    full = with_shares(full, {"arrears_proportion": "county_arrears_total"}, "arrears_total", True)
    return full.drop("n_nationkey")


@query(oracle=f"""
    WITH city AS (SELECT n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA')
    SELECT
      (SELECT count(*) FROM orders JOIN customer ON c_custkey = o_custkey
       WHERE c_nationkey IN (SELECT n_nationkey FROM city)) AS project_total,
      (SELECT count(DISTINCT c_custkey) FROM customer WHERE c_acctbal > 0) AS safeguard_total,
      (SELECT CAST(sum({money('c_acctbal')}) AS DOUBLE) FROM customer WHERE c_acctbal > 0) AS assure_amt,
      (SELECT count(*) FROM part WHERE p_size >= 5) AS realname_total,
      (SELECT count(*) FROM supplier JOIN nation ON n_nationkey = s_nationkey
       WHERE n_nationkey IN (SELECT n_nationkey FROM city)) AS companys_total,
      (SELECT CAST(sum({money('l_extendedprice')}) AS DOUBLE) FROM lineitem WHERE l_linestatus = 'F')
        AS real_amt
""")
def city_total_snapshot(t: Tables) -> DataFrame:
    """One row of independent totals."""
    ours = t.customer.join(
        t.city_nations(), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"
    )
    projects = t.orders.join(ours, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    deposits = t.customer.where(F.col("c_acctbal") > 0)
    return attach_totals(
        projects.agg(F.count("*").alias("project_total")),
        deposits.agg(
            F.countDistinct("c_custkey").alias("safeguard_total"),
            F.sum(as_money("c_acctbal")).cast("double").alias("assure_amt"),
        ),
        t.part.where(F.col("p_size") >= 5).agg(F.count("*").alias("realname_total")),
        city_suppliers(t).agg(F.count("*").alias("companys_total")),
        t.lineitem.where(F.col("l_linestatus") == "F").agg(
            F.sum(as_money("l_extendedprice")).cast("double").alias("real_amt")
        ),
    )
