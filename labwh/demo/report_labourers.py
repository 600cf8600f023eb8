"""Worker reports on the derived detail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from labwh.demo.registry import query, share_text
from labwh.demo.report_attendance import resumes
from labwh.demo.report_views import VIEWS, birthday_text, plain
from labwh.demo.roles import AS_OF_REPORTS, OUR_CITY, Roles, details, with_roles
from labwh.demo.tables import Tables
from labwh.plans import labourers as plan


@query(oracle=with_roles(f"""
    SELECT l.lid, l.gender, {birthday_text('l.birthday')} AS birthday,
      CAST(2001 - year(l.birthday) AS INTEGER) AS age, l.real_name, j.job_date, j.current_county_code,
      j.create_time, j.worktype_no, CASE WHEN j.lid IS NULL THEN 0 ELSE 1 END AS is_job,
      CAST(m.amt AS DOUBLE) AS real_amt, CASE WHEN m.lid IS NULL THEN 0 ELSE 1 END AS arrears_status
    FROM labourers l
    LEFT JOIN (SELECT * FROM employments WHERE is_job AND is_deleted = 1
               QUALIFY row_number() OVER (PARTITION BY lid ORDER BY create_time NULLS LAST, job_date,
                 current_county_code, worktype_no) = 1) j ON j.lid = l.lid
    LEFT JOIN (SELECT lid, sum(real_amt) AS amt FROM arrears_amounts WHERE is_deleted = 1 GROUP BY lid) m
      ON m.lid = l.lid
    WHERE l.is_deleted = 1
"""))
def report_labourer_day(t: Tables) -> DataFrame:
    r = Roles(t)
    rows = plan.labourer_day(r.labourers, r.employments, r.arrears_amounts, AS_OF_REPORTS)
    return plain(
        rows, "lid", "gender", "birthday", "age", "real_name", "job_date", "current_county_code",
        "create_time", "worktype_no", "is_job", "real_amt", "arrears_status",
    )


def histories(t: Tables) -> DataFrame:
    r = Roles(t)
    return plan.labourer_history(
        r.labourers, r.employments, r.arrears_amounts, r.areas, AS_OF_REPORTS
    )


@query(oracle=with_roles("SELECT * FROM histories", VIEWS))
def report_labourer_history(t: Tables) -> DataFrame:
    return plain(
        histories(t), "lid", "real_name", "gender", "birthday", "age", "real_grade", "job_date",
        "current_city_code", "current_county_code", "area_county_name", "create_time",
        "worktype_no", "top", "is_deleted", "is_job", "real_amt", "arrears_status",
    )


ON_JOB = """(SELECT * FROM histories WHERE top = 1 AND is_job = 1 AND is_deleted = 1
    AND current_city_code = '1002' AND real_grade <> 99)"""


@query(oracle=with_roles(f"""
    SELECT a.code, a.name AS county_name, g.person_total, g.arrears_total, g.no_arrears_total,
      c.county_person_total, {share_text('c.county_person_total', 'g.person_total')} AS person_proportion,
      c.county_arrears_total, {share_text('c.county_arrears_total', 'g.arrears_total')} AS arrears_proportion,
      c.county_no_arrears_total,
      {share_text('c.county_no_arrears_total', 'g.no_arrears_total')} AS no_arrears_proportion
    FROM areas a
    LEFT JOIN (SELECT current_county_code, count(lid) AS county_person_total,
                 count(*) FILTER (WHERE arrears_status = 1) AS county_arrears_total,
                 count(*) FILTER (WHERE arrears_status = 0) AS county_no_arrears_total
               FROM {ON_JOB} GROUP BY 1) c ON c.current_county_code = a.code
    LEFT JOIN (SELECT count(lid) AS person_total, count(*) FILTER (WHERE arrears_status = 1) AS arrears_total,
                 count(*) FILTER (WHERE arrears_status = 0) AS no_arrears_total
               FROM (SELECT * FROM histories) x WHERE top = 1 AND is_job = 1 AND is_deleted = 1
                 AND current_city_code = '1002' AND real_grade <> 99) g
      ON c.current_county_code IS NOT NULL
    WHERE a.parent_code = '1002' AND a.level = 3
""", VIEWS))
def report_onjob_share(t: Tables) -> DataFrame:
    return plan.onjob_share(details(t).labourer_history(), Roles(t).areas, OUR_CITY)


@query(oracle=with_roles("""
    SELECT a.name AS county_name,
      (SELECT count(*) FROM labourers WHERE real_grade <> 99 AND is_deleted = 1) AS labourer_total,
      (SELECT nullif(count(*), 0) FROM (SELECT * FROM employments
         WHERE is_deleted = 1 AND is_job AND current_city_code = '1002'
         QUALIFY row_number() OVER (PARTITION BY lid ORDER BY create_time DESC NULLS LAST,
           current_county_code DESC, job_date DESC) = 1) e
       WHERE e.current_county_code = a.code) AS onjob_labourer_total,
      (SELECT count(*) FROM (SELECT DISTINCT m.lid, m.arrears_salary_id, m.pid, k.id
         FROM arrears_amounts m JOIN arrears_cases k ON k.id = m.arrears_salary_id
         WHERE m.is_deleted = 1 AND k.status = 3 AND k.is_deleted = 1 AND k.pid <> 0)) AS arrears_total,
      (SELECT nullif(count(*), 0) FROM (SELECT DISTINCT m.lid, m.arrears_salary_id, m.pid, k.county_code
         FROM arrears_amounts m JOIN arrears_cases k ON k.id = m.arrears_salary_id
         WHERE m.is_deleted = 1 AND k.status = 3 AND k.is_deleted = 1 AND k.pid <> 0
           AND k.city_code = '1002') x WHERE x.county_code = a.code) AS county_arrears_total
    FROM areas a WHERE a.parent_code = '1002' AND a.level = 3
"""))
def report_onjob_totals(t: Tables) -> DataFrame:
    r = Roles(t)
    return plan.onjob_totals(
        r.labourers, r.employments, r.arrears_cases, r.arrears_amounts, r.areas, OUR_CITY
    )


BANDS = ", ".join(
    f"count(*) FILTER (WHERE age >= {lo}{f' AND age < {lo + 5}' if lo < 50 else ''}) AS age_dist_{n}"
    for lo, n in zip(plan.AGE_EDGES, plan.AGE_NAMES)
)


@query(oracle=with_roles(f"""
    SELECT count(lid) AS labourer_total,
      count(*) FILTER (WHERE is_job = 1 AND is_deleted = 1) AS is_job_total,
      count(*) FILTER (WHERE is_job = 0 OR is_deleted = 2) AS no_job_total,
      count(*) FILTER (WHERE gender = '男') AS man_total,
      count(*) FILTER (WHERE gender = '女') AS woman_total, {BANDS}
    FROM histories WHERE top = 1 AND real_grade <> 99
""", VIEWS), created=AS_OF_REPORTS)
def report_labourer_totals(t: Tables) -> DataFrame:
    return plan.labourer_totals(histories(t), AS_OF_REPORTS)


@query(oracle=with_roles("""
    SELECT p.province_code, p.city_code, p.county_code, p.project_name, p.pid, p.project_type, m.lid,
      m.real_name, CAST(sum(m.real_amt) AS DOUBLE) AS real_amt
    FROM arrears_cases k JOIN projects p ON p.pid = k.pid AND p.is_deleted = 1
    JOIN arrears_amounts m ON m.arrears_salary_id = k.id AND m.is_deleted = 1
    WHERE k.status IN (3, 4) AND k.is_deleted = 1 AND k.pid <> 0
    GROUP BY k.id, 1, 2, 3, 4, 5, 6, 7, 8
"""), created=AS_OF_REPORTS)
def report_arrears_detail(t: Tables) -> DataFrame:
    r = Roles(t)
    rows = plan.arrears_detail(r.arrears_cases, r.arrears_amounts, r.projects, AS_OF_REPORTS)
    return plain(rows)


@query(oracle=with_roles("SELECT * FROM resume_details", VIEWS))
def report_resume_detail(t: Tables) -> DataFrame:
    return resumes(t)


@query(oracle=with_roles("""
    SELECT project_county_code, project_county_name, project_type, count(*) AS labourer_count
    FROM resume_details WHERE lab_top = 1 AND is_job = 1 GROUP BY ALL
""", VIEWS))
def report_onjob_by_type(t: Tables) -> DataFrame:
    return plan.onjob_by_type(resumes(t))


@query(oracle=with_roles("""
    SELECT e.lid AS id, p.industry_type, p.county_code, e.lid, coalesce(e.real_name, l.real_name) AS real_name,
      coalesce(e.id_card_no, l.id_card_no) AS id_card_no, e.worktype_no, e.source_pid AS current_pid,
      e.current_cid, coalesce(c.company_name, '--') AS current_company_name, e.is_job,
      coalesce(l.mobilephone, '--') AS mobilephone,
      EXISTS (SELECT 1 FROM blacklist b WHERE b.lid = e.lid AND b.is_deleted = 1) AS bad_status
    FROM (SELECT * FROM employments QUALIFY row_number() OVER (PARTITION BY lid
            ORDER BY is_deleted, job_date DESC NULLS LAST, source_pid, worktype_no, current_cid) = 1) e
    JOIN base_projects p ON p.pid = e.source_pid AND p.is_deleted = 1
    LEFT JOIN labourers l ON l.lid = e.lid
    LEFT JOIN companies c ON c.cid = e.current_cid
"""))
def report_current_labourers(t: Tables) -> DataFrame:
    r = Roles(t)
    rows = plan.current_labourers(
        r.base_projects, r.employments, r.labourers, r.blacklist, r.companies, AS_OF_REPORTS
    )
    return rows.select(
        "id", "industry_type", "county_code", "lid", "real_name", "id_card_no", "worktype_no",
        "current_pid", "current_cid", "current_company_name", "is_job", "mobilephone", "bad_status",
    )
