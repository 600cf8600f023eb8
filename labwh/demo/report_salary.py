"""Wage reports on the derived detail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from labwh.demo.registry import query, share_text
from labwh.demo.report_views import VIEWS, audit, plain
from labwh.demo.roles import AS_OF_REPORTS, OUR_CITY, Roles, details, with_roles
from labwh.demo.tables import Tables
from labwh.plans import salary as plan


@query(oracle=with_roles("""
    SELECT b.batch_no, b.cid, b.source_pid, b.pid, b.year, b.month, b.real_number,
      CAST(b.real_amt AS DOUBLE) AS real_amt, c.company_name, c.company_type, k.bank_name,
      coalesce(p.project_name, s.project_name) AS project_name,
      coalesce(p.county_code, s.county_code) AS county_code
    FROM batches b LEFT JOIN companies c ON c.cid = b.cid
    LEFT JOIN bank_accounts k ON k.bkid = b.bkid
    LEFT JOIN projects p ON p.pid = b.pid LEFT JOIN sub_projects s ON s.pid = b.pid
    WHERE b.status = 1 AND b.type = 1
"""))
def report_paid_batches(t: Tables) -> DataFrame:
    r = Roles(t)
    rows = plan.paid_batches(r.batches, r.companies, r.bank_accounts, r.projects, r.sub_projects)
    return plain(
        rows, "batch_no", "cid", "source_pid", "pid", "year", "month", "real_number", "real_amt",
        "company_name", "company_type", "bank_name", "project_name", "county_code",
    )


def salaries(t: Tables) -> DataFrame:
    r = Roles(t)
    return plan.salary_batches(
        r.batches, r.wages, r.companies, r.bank_accounts, r.projects, r.sub_projects, r.areas
    )


@query(oracle=with_roles("""
    SELECT * REPLACE (CAST(real_amt AS DOUBLE) AS real_amt, CAST(ss_real_amt AS DOUBLE) AS ss_real_amt)
    FROM salaries
""", VIEWS))
def report_salary_batches(t: Tables) -> DataFrame:
    return plain(salaries(t))


@query(oracle=with_roles("""
    SELECT year, month, city_name, county_code, county_name, bank_name, CAST(real_amt AS DOUBLE) AS real_amt,
      CAST(real_number AS BIGINT) AS real_number, project_total FROM bank_months
""", VIEWS))
def report_bank_area_month(t: Tables) -> DataFrame:
    return plain(plan.bank_area_month(salaries(t)))


@query(oracle=with_roles("""
    SELECT bank_name, CAST(sum(real_amt) AS DOUBLE) AS real_amt,
      CAST(sum(real_number) AS BIGINT) AS real_number, CAST(sum(project_total) AS BIGINT) AS project_total,
      row_number() OVER (ORDER BY sum(real_amt) DESC NULLS LAST, sum(real_number) DESC NULLS LAST,
        sum(project_total) DESC NULLS LAST, bank_name NULLS FIRST) AS rank
    FROM bank_months WHERE year = 1998 AND county_code = '100007' GROUP BY bank_name
""", VIEWS))
def report_bank_rank(t: Tables) -> DataFrame:
    return plain(plan.bank_rank(plan.bank_area_month(salaries(t)), 1998, "100007"))


@query(oracle=with_roles("""
    SELECT pid, project_name, county_name, bank_name, CAST(sum(ss_real_amt) AS DOUBLE) AS amt_total,
      CAST(sum(person_sum) AS BIGINT) AS person_total,
      row_number() OVER (PARTITION BY pid ORDER BY sum(ss_real_amt) DESC NULLS LAST,
        bank_name NULLS FIRST, project_name, county_name) AS rank
    FROM salaries GROUP BY pid, project_name, county_name, bank_name
""", VIEWS))
def report_project_bank_rank(t: Tables) -> DataFrame:
    return plain(plan.project_bank_rank(salaries(t)))


AREA_AMOUNTS = ["real_amt_total", *[f"{n}_amt_total" for n in plan.COMPANY_TYPES.values()]]


@query(oracle=with_roles(f"""
    SELECT province_name, city_name, county_name, year, month, batch_total,
      CAST(labourer_total AS BIGINT) AS labourer_total,
      {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in AREA_AMOUNTS)}
    FROM salary_area_months
""", VIEWS))
def report_salary_area_month(t: Tables) -> DataFrame:
    return plain(plan.area_months(salaries(t)))


def _period_sql(alias: str, prefix: str) -> str:
    shares = ", ".join(
        f"{share_text(f'{alias}.{n}_amt_total', f'{alias}.real_amt_total')} AS {prefix}{n}_proportion"
        for n in plan.COMPANY_TYPES.values()
    )
    amounts = ", ".join(f"CAST({alias}.{c} AS DOUBLE) AS {prefix}{c}" for c in AREA_AMOUNTS)
    return f"""{amounts}, {shares}, CAST({alias}.batch_total AS BIGINT) AS {prefix}batch_total,
      CAST({alias}.labourer_total AS BIGINT) AS {prefix}labourer_total"""


SUMS = ", ".join(f"sum({c}) AS {c}" for c in [*AREA_AMOUNTS, "batch_total", "labourer_total"])


@query(oracle=with_roles(f"""
    SELECT a.name AS county_name, m.year, m.month, {_period_sql('s', '')}, {_period_sql('m', 'lastmonth_')}
    FROM areas a
    LEFT JOIN (SELECT county_name, {SUMS} FROM salary_area_months GROUP BY 1) s ON s.county_name = a.name
    LEFT JOIN (SELECT county_name, year, month, {SUMS} FROM salary_area_months
               WHERE year = 2001 AND month = 5 GROUP BY 1, 2, 3) m ON m.county_name = a.name
    WHERE a.parent_code = '1002' AND a.is_deleted = 1
""", VIEWS))
def report_salary_area_totals(t: Tables) -> DataFrame:
    rows = plan.area_totals(plan.area_months(salaries(t)), Roles(t).areas, AS_OF_REPORTS, OUR_CITY)
    return plain(rows)


@query(oracle=with_roles(f"""
    SELECT CAST(amt AS DOUBLE) AS real_amt_total, batch_total, CAST(people AS BIGINT) AS labourer_total,
      CAST(c AS DOUBLE) AS construction_amt_total, {share_text('c', 'amt')} AS construction_amt_proportion,
      CAST(l AS DOUBLE) AS labour_amt_total, {share_text('l', 'amt')} AS labour_amt_proportion,
      n AS project_total, b AS build_project_total, {share_text('b', 'n')} AS build_project_proportion,
      d AS completed_project_total, {share_text('d', 'n')} AS completed_project_proportion
    FROM (SELECT sum(real_amt) AS amt, count(batch_no) AS batch_total, sum(real_number) AS people,
            sum(real_amt) FILTER (WHERE company_type = 2) AS c,
            sum(real_amt) FILTER (WHERE company_type = 3) AS l FROM salaries WHERE status IN (1, 6)),
         (SELECT count(pid) AS n, count(*) FILTER (WHERE project_condition = 1) AS b,
            count(*) FILTER (WHERE project_condition = 3) AS d
          FROM (SELECT DISTINCT pid, project_condition FROM salaries WHERE status IN (1, 6)))
""", VIEWS), created=AS_OF_REPORTS)
def report_salary_snapshot(t: Tables) -> DataFrame:
    return plain(plan.salary_snapshot(details(t).salary_batches(), AS_OF_REPORTS))


def line_tables(t: Tables) -> tuple:
    r = Roles(t)
    return (r.batches, r.wages, r.payroll_lines, r.projects, r.sub_projects, r.companies,
            r.bank_accounts, r.areas, AS_OF_REPORTS)


def lines(t: Tables) -> DataFrame:
    return plan.salary_lines(*line_tables(t))


@query(oracle=with_roles("""
    SELECT * REPLACE (CAST(batch_amt AS DOUBLE) AS batch_amt, CAST(real_amt AS DOUBLE) AS real_amt),
      round(12 * (2001 - year) + (6 - month) + 14 / 31.0::DOUBLE, 8) AS new_salary
    FROM salary_details
""", VIEWS))
def report_salary_detail(t: Tables) -> DataFrame:
    return plain(
        plan.salary_detail(*line_tables(t)), "source_pid", "source_project_name", "source_project_condition", "source_cid",
        "source_county_code", "pid", "project_name", "county_code", "county_name", "cid",
        "pro_company_name", "salary_cid", "salary_company_type", "salary_company_name", "year",
        "month", "year_month", "batch_no", "batch_status", "batch_amt", "id_card_no", "real_name",
        "real_amt", "status", "worktype_name", "group_name", "bank_name", "batch_top", "salary_top",
        "new_salary",
    )


LAST = "year = 2001 AND month = 5"


@query(oracle=with_roles(f"""
    SELECT CAST(amt AS DOUBLE) AS real_amt, CAST(c AS DOUBLE) AS "Construction_Amt",
      {share_text('c', 'amt')} AS "Construction_Amt_proportion", CAST(l AS DOUBLE) AS "labourer_Amt",
      {share_text('l', 'amt')} AS "labourer_Amt_proportion", labourer_count, batch_sum,
      n AS project_total, b AS build_project_total, {share_text('b', 'n')} AS build_project_proportion,
      d AS complete_project_total, {share_text('d', 'n')} AS complete_project_proportion,
      CAST(last_amt AS DOUBLE) AS last_real_amt, CAST(last_c AS DOUBLE) AS "last_Construction_Amt",
      {share_text('last_c', 'last_amt')} AS "last_Construction_Amt_proportion",
      CAST(last_l AS DOUBLE) AS "last_labourer_Amt",
      {share_text('last_l', 'last_amt')} AS "last_labourer_Amt_proportion",
      last_labourer_count, last_batch_sum
    FROM (SELECT sum(real_amt) AS amt, sum(real_amt) FILTER (WHERE {LAST}) AS last_amt,
            coalesce(sum(real_amt) FILTER (WHERE salary_company_type = 2), 0) AS c,
            coalesce(sum(real_amt) FILTER (WHERE salary_company_type = 3), 0) AS l,
            coalesce(sum(real_amt) FILTER (WHERE salary_company_type = 2 AND {LAST}), 0) AS last_c,
            coalesce(sum(real_amt) FILTER (WHERE salary_company_type = 3 AND {LAST}), 0) AS last_l,
            count(DISTINCT id_card_no) AS labourer_count,
            count(DISTINCT id_card_no) FILTER (WHERE {LAST}) AS last_labourer_count
          FROM salary_details WHERE status = 1),
         (SELECT count(DISTINCT batch_no) AS batch_sum,
            count(DISTINCT batch_no) FILTER (WHERE {LAST}) AS last_batch_sum FROM salary_details),
         (SELECT count(source_pid) AS n, count(*) FILTER (WHERE source_project_condition = 1) AS b,
            count(*) FILTER (WHERE source_project_condition IN (2, 3)) AS d
          FROM (SELECT DISTINCT source_pid, source_project_condition FROM salary_details))
""", VIEWS))
def report_salary_total(t: Tables) -> DataFrame:
    return plain(plan.salary_total(details(t).salary_lines(), AS_OF_REPORTS))


OWNERS = """(SELECT cid FROM projects WHERE status IN (3, 4, 5) AND is_deleted = 1
      AND project_type IN ('房屋建设工程', '附属工程', '市政工程', '其它')
    UNION SELECT unit_cid FROM sub_projects WHERE status IN (3, 4, 5) AND is_deleted = 1
      AND project_type IN ('房屋建设工程', '附属工程', '市政工程', '其它'))"""


METRICS_SQL = f"""
    SELECT CAST(year(c) AS INTEGER) AS year, CAST(month(c) AS INTEGER) AS month, type, amount FROM (
      SELECT c, 1 AS type, (SELECT count(DISTINCT d.cid) FROM deposits d WHERE d.is_deleted = 1
        AND d.status IN (3, 4) AND d.reg_date < c AND d.cid IN {OWNERS}) AS amount FROM cutoffs
      UNION ALL SELECT c, 3, (SELECT count(DISTINCT salary_cid) FROM salary_details
        WHERE status = 1 AND year_month < c) FROM cutoffs
      UNION ALL SELECT c, 4, (SELECT count(DISTINCT source_pid) FROM salary_details
        WHERE status = 1 AND year_month < c) FROM cutoffs
      UNION ALL SELECT c, 5, (SELECT count(DISTINCT id_card_no) FROM salary_details
        WHERE status = 1 AND year_month < c) FROM cutoffs
      UNION ALL SELECT c, 6, (SELECT CAST(trunc(sum(real_amt) / 10000) AS BIGINT) FROM salary_details
        WHERE status = 1 AND year_month < c) FROM cutoffs
      UNION ALL SELECT DISTINCT date_trunc('month', m.reg_date), 2,
        (SELECT CAST(trunc(sum(d.assure_amt)) AS BIGINT) FROM deposits d WHERE d.is_deleted = 1
         AND d.status IN (3, 4) AND d.cid IN {OWNERS}
         AND date_trunc('month', d.reg_date) <= date_trunc('month', m.reg_date))
        FROM deposits m WHERE m.is_deleted = 1 AND m.status IN (3, 4) AND m.cid IN {OWNERS})
"""
CUTOFF_VIEWS = {
    **VIEWS,
    "cutoffs": """
    SELECT CAST(DATE '2001-06-15' - to_months(CAST(k AS INTEGER)) AS DATE) AS c FROM range(0, 12) r(k)""",
}


def metrics(t: Tables) -> DataFrame:
    return details(t).metrics()


@query(oracle=with_roles(f"SELECT *, year AS date_year, month AS date_month FROM ({METRICS_SQL})", CUTOFF_VIEWS))
def report_monthly_metrics(t: Tables) -> DataFrame:
    return metrics(t)


@query(oracle=with_roles(f"""
    SELECT year, month, amount, type, CAST(year AS VARCHAR) || lpad(CAST(month AS VARCHAR), 2, '0') AS year_month
    FROM ({METRICS_SQL}) WHERE year IN (2000, 2001)
""", CUTOFF_VIEWS))
def report_monthly_metrics_export(t: Tables) -> DataFrame:
    return plan.monthly_metrics_export(metrics(t), [2000, 2001])


@query(oracle=with_roles(f"""
    SELECT CAST(source_pid AS VARCHAR) || year || lpad(CAST(month AS VARCHAR), 2, '0') AS id,
      source_pid AS pid, CASE WHEN sum(amt) > 0 THEN 3 ELSE 1 END AS status,
      make_date(year, month, 1) AS cur_date, year AS cur_date_year, month AS cur_date_month,
      CAST(sum(amt) AS DOUBLE) AS amt, {audit(AS_OF_REPORTS)}
    FROM batches WHERE is_deleted = 1 AND status = 1 GROUP BY source_pid, year, month
"""))
def report_proxy_pay(t: Tables) -> DataFrame:
    return plain(plan.proxy_pay(Roles(t).batches, AS_OF_REPORTS))
