"""Compliance reports on the derived detail tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwh.demo.registry import query, share
from labwh.demo.report_views import audit, plain
from labwh.demo.roles import AS_OF_REPORTS, OUR_CITY, Roles, with_roles
from labwh.demo.tables import Tables
from labwh.plans import compliance as plan

MONTHS = [dt.date(2001, m, 1) for m in (3, 4, 5, 6)]
VIEWS = {
    "months": "SELECT unnest([" + ", ".join(f"DATE '{m}'" for m in MONTHS) + "]) AS m",
}
KEY = "CAST(p.pid AS VARCHAR) || strftime(m, '%Y%m') AS id"
#: What every project and month report carries beside its own columns.
STAMPED = f"CAST(year(m) AS INTEGER) AS cur_date_year, CAST(month(m) AS INTEGER) AS cur_date_month, p.is_deleted, {audit(AS_OF_REPORTS, is_deleted=False)}"
DATED = "CAST(year(m) AS INTEGER) AS date_year, CAST(month(m) AS INTEGER) AS date_month"


def _income_sql(extra: str) -> str:
    return f"""
    SELECT {KEY}, p.pid, m AS cur_date, CAST(coalesce(sum(t.amt), 0) AS DOUBLE) AS amt,
      CASE WHEN sum(t.amt) > 0 THEN 3 ELSE 1 END AS status, {STAMPED}, {DATED}
    FROM base_projects p CROSS JOIN months
    LEFT JOIN bank_transfers t ON t.pid = p.pid AND date_trunc('month', t.trans_time) = m
      AND t.jtype = 1 AND t.is_deleted = 1 {extra}
    GROUP BY p.pid, p.is_deleted, m
    """


@query(oracle=with_roles(_income_sql("AND t.is_pro_valid > 0"), VIEWS))
def report_income_months(t: Tables) -> DataFrame:
    r = Roles(t)
    return plain(plan.income_months(r.base_projects, r.bank_transfers, MONTHS, AS_OF_REPORTS))


@query(oracle=with_roles(_income_sql(""), VIEWS))
def report_income_months_all(t: Tables) -> DataFrame:
    r = Roles(t)
    rows = plan.income_months(
        r.base_projects, r.bank_transfers, MONTHS, AS_OF_REPORTS, only_valid=False
    )
    return plain(rows)


@query(oracle=with_roles(f"""
    SELECT CAST(p.pid AS VARCHAR) || strftime(b.up_time, '%Y%m') AS id, p.pid, 3 AS status,
      CAST(m AS DATE) AS cur_date, b.up_time, {STAMPED}
    FROM base_projects p JOIN (
      SELECT pid, max(create_time) AS up_time, date_trunc('month', create_time) AS m FROM billboards
      GROUP BY pid, date_trunc('month', create_time)) b ON b.pid = p.pid
"""))
def report_billboard_months(t: Tables) -> DataFrame:
    r = Roles(t)
    return plan.billboard_months(r.base_projects, r.billboards, AS_OF_REPORTS)


@query(oracle=with_roles(f"""
    SELECT {KEY}, p.pid, m AS cur_date, max(b.create_time) AS up_time,
      CASE WHEN count(b.pid) > 0 THEN 3 ELSE 1 END AS status, {STAMPED}, {DATED}
    FROM base_projects p CROSS JOIN months
    LEFT JOIN billboards b ON b.pid = p.pid AND b.is_deleted = 1 AND b.create_time <= m
    GROUP BY p.pid, p.is_deleted, m
""", VIEWS))
def report_billboard_as_of(t: Tables) -> DataFrame:
    r = Roles(t)
    return plan.billboard_as_of(r.base_projects, r.billboards, MONTHS, AS_OF_REPORTS)


@query(oracle=with_roles(f"""
    SELECT {KEY}, p.pid, m AS cur_date,
      (SELECT count(DISTINCT i.id_card_no) FROM employment_intervals i WHERE i.source_pid = p.pid
        AND i.is_deleted = 1 AND i.endtime >= m AND i.starttime < m + INTERVAL 1 MONTH) AS real_count,
      (SELECT count(DISTINCT w.id_card_no) FROM batches b JOIN wages w ON w.batch_no = b.batch_no
        AND w.is_deleted = 1 AND w.status = 1 WHERE b.source_pid = p.pid AND b.is_deleted = 1
        AND b.status = 1 AND b.year_month = m) AS pay_count,
      CAST(coalesce((SELECT sum(b.real_amt) FROM batches b WHERE b.source_pid = p.pid AND b.is_deleted = 1
        AND b.status = 1 AND b.year_month = m), 0) AS DOUBLE) AS amt,
      CASE WHEN (SELECT sum(b.real_amt) FROM batches b WHERE b.source_pid = p.pid AND b.is_deleted = 1
        AND b.status = 1 AND b.year_month = m) > 0 THEN 3 ELSE 1 END AS status, {STAMPED}, {DATED}
    FROM base_projects p CROSS JOIN months
""", VIEWS))
def report_payroll_months(t: Tables) -> DataFrame:
    r = Roles(t)
    rows = plan.payroll_months(
        r.base_projects, r.employment_intervals, r.batches, r.wages, MONTHS, AS_OF_REPORTS
    )
    return plain(rows)


def scores(t: Tables) -> DataFrame:
    r = Roles(t)
    return plan.rule_scores(
        r.base_projects, r.companies, r.employment_intervals, r.deposits, r.special_accounts,
        r.bank_transfers, r.agreements, r.billboards, r.sub_projects, r.commissions, r.batches,
        AS_OF_REPORTS, OUR_CITY,
    )


def _exists(sql: str) -> str:
    return f"CASE WHEN EXISTS ({sql}) THEN 3 ELSE 1 END"


SCORE_VIEWS = {
    "judged": """
    SELECT p.*, CASE WHEN month(due) = 6 AND 15 > day(due) THEN DATE '2001-05-01' ELSE DATE '2001-04-01' END
      AS judged_month
    FROM (SELECT *, DATE '2001-06-01' + (pay_day + 4) AS due FROM base_projects) p
    """,
    "parts": f"""
    SELECT p.*, coalesce((SELECT min(c.company_name) FROM companies c WHERE c.cid = p.cid), '--') AS company_name,
      {_exists("SELECT 1 FROM employment_intervals i WHERE i.source_pid = p.pid AND i.is_job AND i.is_deleted = 1")}
        AS real_book_status,
      {_exists("SELECT 1 FROM batches b WHERE b.source_pid = p.pid AND b.is_deleted = 1 AND b.status = 1 AND b.year_month = p.judged_month")}
        AS pay_status,
      {_exists("SELECT 1 FROM deposits d WHERE d.cid = p.cid AND d.province_code = p.province_code AND d.city_code = p.city_code AND d.city_code <> '' AND d.is_deleted = 1 AND d.status IN (3, 4)")}
        AS bail_status,
      {_exists("SELECT 1 FROM special_accounts s WHERE s.pid = p.pid AND s.is_deleted = 1 AND s.status = 1")}
        AS account_special_status,
      CASE WHEN (SELECT sum(x.amt) FROM bank_transfers x WHERE x.pid = p.pid AND x.jtype = 1 AND x.is_deleted = 1
        AND x.is_pro_valid > 0 AND date_trunc('month', x.trans_time) = p.judged_month) > 0 THEN 3 ELSE 1 END
        AS account_in_status,
      {_exists("SELECT 1 FROM agreements g JOIN companies c ON c.cid = g.sg_cid AND c.is_deleted = 1 WHERE g.pid = p.pid AND g.is_deleted = 1")}
        AS account_three_status,
      {_exists("SELECT 1 FROM billboards b WHERE b.pid = p.pid")} AS billboard_status,
      p.city_code = '1002' AND p.industry_type = 1 AS strict,
      (SELECT count(DISTINCT c.organization_code) FROM sub_projects s JOIN companies c ON c.cid = s.unit_cid
        AND c.is_deleted = 1 WHERE s.source_pid = p.pid AND s.is_deleted = 1 AND s.status IN (3, 4)) AS needed,
      (SELECT count(DISTINCT k.subcontract_company_organization_code) FROM commissions k
        WHERE k.pid = p.pid AND k.is_deleted = 1) AS done
    FROM judged p
    """,
    "rated": """
    SELECT *, CASE WHEN strict THEN CASE WHEN needed > 0 THEN 1 ELSE 0 END WHEN done > 0 THEN 1 ELSE 0 END
        AS proxy_pay_islw,
      CASE WHEN strict AND needed = 0 THEN 1 WHEN done = 0 THEN 1 WHEN strict AND done < needed THEN 4 ELSE 3 END
        AS proxy_pay_entrustl_status,
      CASE WHEN real_book_status = 3 AND pay_status = 3 THEN 3 ELSE 1 END AS real_status,
      CASE WHEN account_special_status = 3 AND account_three_status = 3 THEN 3 ELSE 1 END AS account_status
    FROM parts
    """,
    "scored": """
    SELECT *, CASE WHEN pay_status = 3 AND proxy_pay_islw = 1 AND proxy_pay_entrustl_status = 3 THEN 3
      WHEN pay_status = 3 AND proxy_pay_islw = 0 AND proxy_pay_entrustl_status = 1 THEN 3 ELSE 1 END
      AS proxy_pay_status FROM rated
    """,
}
#: Columns of a scored project as the oracle has them, and those that it names or derives.
SCORE_SQL = f"""
    SELECT pid AS id, pid, industry_type, project_type, project_name, project_condition AS p_status, cid, company_name,
      investment_nature, province_code, city_code, county_code, CAST(construct_cost AS DOUBLE) AS construct_cost,
      real_status, real_book_status, 3 AS real_contract_status, pay_status AS real_pay_status, bail_status,
      account_status, account_special_status, account_in_status, account_three_status, proxy_pay_status,
      pay_status AS proxy_pay_payroll_status, proxy_pay_entrustl_status, proxy_pay_islw, billboard_status,
      pay_status, {audit(AS_OF_REPORTS, is_deleted=False)}, is_deleted, {AS_OF_REPORTS.year} AS date_year,
      {AS_OF_REPORTS.month} AS date_month
    FROM scored
"""


@query(oracle=with_roles(SCORE_SQL, SCORE_VIEWS))
def report_rule_scores(t: Tables) -> DataFrame:
    return plain(scores(t))


RATES = ", ".join(
    f"{r}_count, {share(f'{r}_count', 'project_count')} AS {r}_proportion" for r in [*plan.RULES, "complete"]
)


@query(oracle=with_roles(f"""
    SELECT city_code || county_code || '2001' || '06' || lpad(CAST(industry_type AS VARCHAR), 2, '0') AS id,
      province_code, city_code, county_code, industry_type, project_count, {RATES}
    FROM (SELECT province_code, city_code, county_code, industry_type, count(*) AS project_count,
      {', '.join(f'count(*) FILTER (WHERE {s} = 3) AS {r}_count' for r, s in plan.RULES.items())},
      count(*) FILTER (WHERE {' AND '.join(f'{s} = 3' for s in plan.RULES.values())}) AS complete_count
      FROM scored WHERE is_deleted = 1 AND project_condition = 3 GROUP BY ALL)
""", SCORE_VIEWS))
def report_rule_statistics(t: Tables) -> DataFrame:
    rows = plan.rule_statistics(scores(t), AS_OF_REPORTS)
    rates = [f"{r}_{x}" for r in [*plan.RULES, "complete"] for x in ("count", "proportion")]
    return rows.select("id", *plan.AREA, "project_count", *rates)


AREA = "province_code, city_code, county_code, industry_type"


@query(oracle=with_roles(f"""
    SELECT {AREA}, count(*) AS project_count,
      count(*) FILTER (WHERE project_condition = 3) AS project_construction,
      count(*) FILTER (WHERE project_condition = 5) AS project_stop,
      count(*) FILTER (WHERE project_condition = 6) AS project_completed,
      count(*) FILTER (WHERE project_condition = 4) AS project_complete,
      CAST(sum(board) AS BIGINT) AS billboard_count, CAST(sum(account) AS BIGINT) AS account_count,
      CAST(sum(coalesce(salary, 0)) AS DOUBLE) AS salary_amt_total,
      CAST(sum(CASE WHEN top = 1 THEN coalesce(bail, 0) ELSE 0 END) AS DOUBLE) AS bail_amt_total
    FROM (
      SELECT p.*, d.amt AS bail,
        CASE WHEN EXISTS (SELECT 1 FROM billboards b WHERE b.pid = p.pid AND b.is_deleted = 1) THEN 1 ELSE 0 END
          AS board,
        CASE WHEN EXISTS (SELECT 1 FROM special_accounts s WHERE s.pid = p.pid AND s.is_deleted = 1
          AND s.status = 1) THEN 1 ELSE 0 END AS account,
        (SELECT sum(b.real_amt) FROM batches b WHERE b.source_pid = p.pid AND b.status = 1 AND b.type = 1) AS salary,
        row_number() OVER (PARTITION BY d.cid, d.province_code, d.city_code ORDER BY p.pid DESC) AS top
      FROM base_projects p LEFT JOIN (
        SELECT cid, province_code, city_code, sum(assure_amt) AS amt FROM deposits
        WHERE is_deleted = 1 AND status IN (3, 4) AND city_code <> '' GROUP BY 1, 2, 3) d
        ON d.cid = p.cid AND d.province_code = p.province_code AND d.city_code = p.city_code
      WHERE p.is_deleted = 1 AND p.industry_type <> 0)
    GROUP BY {AREA}
"""))
def report_area_statistics(t: Tables) -> DataFrame:
    r = Roles(t)
    rows = plan.area_statistics(
        r.base_projects, r.billboards, r.deposits, r.special_accounts, r.batches, AS_OF_REPORTS
    )
    return plain(
        rows, *plan.AREA, "project_count", "project_construction", "project_stop",
        "project_completed", "project_complete", "billboard_count", "account_count",
        "salary_amt_total", "bail_amt_total",
    )


@query(oracle=with_roles(f"""
    SELECT p.province_code || p.city_code AS id, p.province_code, p.city_code, count(*) AS project_count,
      count(*) FILTER (WHERE project_condition = 3) AS project_construction,
      count(*) FILTER (WHERE project_condition = 5) AS project_stop,
      count(*) FILTER (WHERE project_condition = 6) AS project_completed,
      count(DISTINCT c.cid) AS company_count,
      (SELECT count(DISTINCT d.cid) FROM deposits d WHERE d.is_deleted = 1 AND d.status IN (3, 4)
        AND d.province_code = p.province_code AND d.city_code = p.city_code) AS company_bond_count,
      CAST(sum((SELECT nullif(count(*), 0) FROM billboards b WHERE b.pid = p.pid AND b.is_deleted = 1)) AS BIGINT)
        AS billboard_count, {audit(AS_OF_REPORTS)}
    FROM base_projects p LEFT JOIN companies c ON c.cid = p.cid
    WHERE p.is_deleted = 1 GROUP BY p.province_code, p.city_code
"""))
def report_city_statistics(t: Tables) -> DataFrame:
    r = Roles(t)
    return plan.city_statistics(r.base_projects, r.companies, r.deposits, r.billboards, AS_OF_REPORTS)


def _month_sql(first: str, y: int, m: int) -> str:
    sites = "(SELECT * FROM base_projects WHERE is_deleted = 1 AND industry_type <> 0)"
    return f"""
    SELECT coalesce(s.province_code, a.province_code, b.province_code) AS province_code,
      coalesce(s.city_code, a.city_code, b.city_code) AS city_code,
      coalesce(s.county_code, a.county_code, b.county_code) AS county_code,
      coalesce(s.industry_type, a.industry_type, b.industry_type) AS industry_type,
      CAST(coalesce(s.amt, 0) AS DOUBLE) AS salary_amt, coalesce(a.n, 0) AS company_safeguard_count,
      CAST(coalesce(b.amt, 0) AS DOUBLE) AS bail_amt
    FROM (SELECT {AREA}, sum(x.real_amt) AS amt FROM batches x JOIN {sites} p ON p.pid = x.source_pid
          WHERE x.status = 1 AND x.type = 1 AND x.year = {y} AND x.month = {m} GROUP BY ALL) s
    FULL OUTER JOIN (SELECT {AREA}, count(DISTINCT p.pid) AS n FROM special_accounts x JOIN {sites} p ON p.pid = x.pid
          WHERE x.is_deleted = 1 AND x.status = 1 AND date_trunc('month', x.create_time) = DATE '{first}'
          GROUP BY ALL) a
      ON a.province_code = s.province_code AND a.city_code = s.city_code
     AND a.county_code IS NOT DISTINCT FROM s.county_code AND a.industry_type = s.industry_type
    FULL OUTER JOIN (SELECT {AREA}, sum(CASE WHEN top = 1 THEN assure_amt ELSE 0 END) AS amt FROM (
          SELECT p.province_code, p.city_code, p.county_code, p.industry_type, x.assure_amt,
            row_number() OVER (PARTITION BY x.cid, x.province_code, x.city_code
              ORDER BY p.industry_type DESC, p.county_code NULLS FIRST, x.assure_amt DESC) AS top
          FROM deposits x JOIN {sites} p ON p.cid = x.cid AND p.province_code = x.province_code
            AND p.city_code = x.city_code
          WHERE x.is_deleted = 1 AND x.status IN (3, 4) AND date_trunc('month', x.create_time) = DATE '{first}')
          GROUP BY ALL) b
      ON b.province_code = coalesce(s.province_code, a.province_code)
     AND b.city_code = coalesce(s.city_code, a.city_code)
     AND b.county_code IS NOT DISTINCT FROM coalesce(s.county_code, a.county_code)
     AND b.industry_type = coalesce(s.industry_type, a.industry_type)
    """


def _month(t: Tables, as_of: dt.date) -> DataFrame:
    r = Roles(t)
    return plan.month_statistics(r.base_projects, r.special_accounts, r.deposits, r.batches, as_of)


@query(oracle=with_roles(f"""
    SELECT *, TRY_CAST(county_code || '200106' || lpad(CAST(industry_type AS VARCHAR), 2, '0') AS BIGINT) AS id,
      DATE '2001-06-01' AS cur_date, 2001 AS cur_date_year, 6 AS cur_date_month, {audit(AS_OF_REPORTS)}
    FROM ({_month_sql("2001-06-01", 2001, 6)})
"""))
def report_month_statistics(t: Tables) -> DataFrame:
    return plain(_month(t, AS_OF_REPORTS))


@query(oracle=with_roles("""
    SELECT TRY_CAST(county_code || '200106' || lpad(CAST(industry_type AS VARCHAR), 2, '0') AS BIGINT) AS id,
      province_code, city_code, county_code, industry_type, salary_amt, bail_amt FROM june
    UNION ALL
    SELECT TRY_CAST(county_code || '200105' || lpad(CAST(industry_type AS VARCHAR), 2, '0') AS BIGINT),
      province_code, city_code, county_code, industry_type, salary_amt, bail_amt FROM may
""", {"may": _month_sql("2001-05-01", 2001, 5), "june": _month_sql("2001-06-01", 2001, 6)}))
def report_merged_month_statistics(t: Tables) -> DataFrame:
    """The stored May and an outdated June, with the fresh June on top."""
    june = _month(t, AS_OF_REPORTS)
    may = _month(t, dt.date(2001, 5, 15))
    outdated = june.withColumn("salary_amt", F.lit(-1).cast(june.schema["salary_amt"].dataType))
    merged = plan.merge_month_statistics(may.unionByName(outdated), june)
    return plain(merged, "id", *plan.AREA, "salary_amt", "bail_amt")
