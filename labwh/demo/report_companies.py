"""Company reports on the derived detail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from labwh.demo.registry import query, share_text
from labwh.demo.report_views import VIEWS, plain
from labwh.demo.roles import AS_OF_REPORTS, OUR_CITY, OUR_CITY_NAME, Roles, details, with_roles
from labwh.demo.tables import Tables
from labwh.plans import companies as plan

COMPANY_VIEWS = {
    **VIEWS,
    "company_name_rows": """
    SELECT c.cid, c.company_name, a1.name AS province_name, a2.name AS city_name, a3.name AS county_name,
      t.name AS company_type, c.location, b1.name AS project_province_name, b2.name AS project_city_name,
      b3.name AS project_county_name
    FROM companies c
    LEFT JOIN company_types t ON t.type = 'companytype' AND t.code = c.company_type
    LEFT JOIN (SELECT DISTINCT cid, province_code, city_code, county_code FROM projects
               WHERE is_completed = 'N' AND status = 3) p ON p.cid = c.cid
    LEFT JOIN areas a1 ON a1.level = 1 AND a1.code = c.province_code
    LEFT JOIN areas a2 ON a2.level = 2 AND a2.code = c.city_code
    LEFT JOIN areas a3 ON a3.level = 3 AND a3.code = c.county_code
    LEFT JOIN areas b1 ON b1.level = 1 AND b1.code = p.province_code
    LEFT JOIN areas b2 ON b2.level = 2 AND b2.code = p.city_code
    LEFT JOIN areas b3 ON b3.level = 3 AND b3.code = p.county_code
    WHERE c.is_deleted = 1 AND c.status = 3
    """,
}


def named(t: Tables) -> DataFrame:
    r = Roles(t)
    return plan.company_areas_by_name(r.companies, r.projects, r.company_types, r.areas, AS_OF_REPORTS)


@query(oracle=with_roles("SELECT * FROM company_name_rows", COMPANY_VIEWS))
def report_company_areas_by_name(t: Tables) -> DataFrame:
    return named(t).drop("year", "month", "day", "create_time")


def coded(t: Tables) -> DataFrame:
    r = Roles(t)
    kinds = r.company_types.where("type = 'companytype'")
    return plan.company_areas(r.companies, r.projects, kinds)


AREA_COLUMNS = [
    "cid", "company_name", "county_code", "company_type", "company_type_name", "is_location",
    "is_deleted", "status", "year", "month", "day", "project_province_code", "project_city_code",
    "project_county_code", "rank",
]
CODE_VIEWS = {
    **VIEWS,
    "company_area_rows": VIEWS["company_area_rows"].replace(
        "FROM company_types GROUP BY", "FROM company_types WHERE type = 'companytype' GROUP BY"
    ),
}


@query(oracle=with_roles("SELECT * FROM company_area_rows", CODE_VIEWS))
def report_company_areas(t: Tables) -> DataFrame:
    return coded(t).select(*AREA_COLUMNS)


def _counted(cols: dict[str, str], total: str) -> str:
    return ", ".join(f"x.{c}, {share_text(f'x.{c}', f'x.{total}')} AS {o}" for c, o in cols.items())


REGISTERED = {
    "EPC_count": "epc_proportion",
    "company_construction_count": "construction_proportion",
    "company_labour_count": "labour_proportion",
    "company_local_count": "local_proportion",
    "company_nonlocal_count": "nonlocal_proportion",
    "other": "other_proportion",
}
LOCALITY = """count(*) FILTER (WHERE {f} = 1) AS {p}local_count,
      count(*) FILTER (WHERE {f} = 2) AS {p}nonlocal_count,
      count(*) FILTER (WHERE {f} IS NULL OR {f} NOT IN (1, 2)) AS {p}other"""


@query(oracle=with_roles(f"""
    SELECT a.name, x.xz_companys_sum, {_counted(REGISTERED, 'xz_companys_sum')},
      y.yw_companys_sum, y.yw_company_local_count,
      {share_text('y.yw_company_local_count', 'y.yw_companys_sum')} AS yw_local_proportion,
      y.yw_company_nonlocal_count,
      {share_text('y.yw_company_nonlocal_count', 'y.yw_companys_sum')} AS yw_nonlocal_proportion,
      y.yw_company_other AS yw_other,
      {share_text('y.yw_company_other', 'y.yw_companys_sum')} AS yw_other_proportion
    FROM areas a
    LEFT JOIN (SELECT county_code, count(cid) AS xz_companys_sum,
        count(*) FILTER (WHERE company_type = 13) AS "EPC_count",
        count(*) FILTER (WHERE company_type = 4) AS company_construction_count,
        count(*) FILTER (WHERE company_type = 11) AS company_labour_count,
        {LOCALITY.format(f='location', p='company_').replace('company_other', 'other')}
      FROM old_companies WHERE is_deleted = 1 GROUP BY county_code) x ON x.county_code = a.code
    LEFT JOIN (SELECT project_county_name, count(cid) AS yw_companys_sum,
        {LOCALITY.format(f='location', p='yw_company_')}
      FROM company_name_rows WHERE project_city_name = 'ASIA' AND project_county_name IS NOT NULL
      GROUP BY 1) y ON y.project_county_name = a.name
    WHERE a.parent_code = '1002' AND a.is_deleted = 1
""", COMPANY_VIEWS), created=AS_OF_REPORTS)
def report_company_counts(t: Tables) -> DataFrame:
    r = Roles(t)
    rows = plan.company_counts(
        r.old_companies, named(t), r.areas, AS_OF_REPORTS, OUR_CITY, OUR_CITY_NAME
    )
    return rows


DAY_VIEWS = {
    **CODE_VIEWS,
    "company_day_rows": f"""
    SELECT a.code AS county_code, a.name AS county_name, coalesce(x.year, y.year) AS year,
      coalesce(x.month, y.month) AS month, coalesce(x.day, y.day) AS day, x.* EXCLUDE (county_code, year, month, day),
      y.* EXCLUDE (project_county_code, year, month, day)
    FROM areas a LEFT JOIN (
      (SELECT county_code, year, month, day, count(cid) AS xz_companys_sum,
         count(*) FILTER (WHERE company_type_name = '设计单位') AS "EPC_count",
         count(*) FILTER (WHERE company_type_name = '施工单位') AS company_construction_count,
         count(*) FILTER (WHERE company_type_name = '劳务企业') AS company_labour_count,
         count(*) FILTER (WHERE company_type_name = '建设集团') AS company_build_count,
         {LOCALITY.format(f='is_location', p='xz_')}
       FROM company_area_rows WHERE rank = 1 AND county_code IS NOT NULL GROUP BY 1, 2, 3, 4) x
      FULL OUTER JOIN
      (SELECT project_county_code, year, month, day, count(cid) AS yw_companys_sum,
         {LOCALITY.format(f='is_location', p='yw_')}
       FROM company_area_rows WHERE project_county_code IS NOT NULL AND project_city_code = '1002'
       GROUP BY 1, 2, 3, 4) y
      ON x.county_code = y.project_county_code AND x.year = y.year AND x.month = y.month AND x.day = y.day)
      ON a.code = coalesce(x.county_code, y.project_county_code)
    WHERE a.parent_code = '1002' AND a.is_deleted = 1
    """,
}


def _day_shares(types: dict[str, str]) -> str:
    parts = {t: (o, "xz_companys_sum") for t, o in types.items()}
    for side in ("xz", "yw"):
        for c, o in (("local_count", "local"), ("nonlocal_count", "nonlocal"), ("other", "other")):
            parts[f"{side}_{c}"] = (f"{side}_{o}_proportion", f"{side}_companys_sum")
    return ", ".join(f"{share_text(c, total)} AS {o}" for c, (o, total) in parts.items())


TYPE_SHARES = {t: plan.SHARES[t] for t in plan.TYPE_NAMES.values()}
TOTAL_SHARES = {t: o for t, o in TYPE_SHARES.items() if t != "company_build_count"}


def company_day_rows(t: Tables) -> DataFrame:
    return plan.company_days(coded(t), Roles(t).areas, OUR_CITY)


@query(oracle=with_roles(f"SELECT *, {_day_shares(TYPE_SHARES)} FROM company_day_rows", DAY_VIEWS))
def report_company_days(t: Tables) -> DataFrame:
    return company_day_rows(t)


@query(oracle=with_roles(f"""
    SELECT *, {_day_shares(TOTAL_SHARES)} FROM (
      SELECT county_code || '20010615' AS pkid, county_code, county_name,
        {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in plan.DAY_COUNTS if c != 'company_build_count')}
      FROM company_day_rows GROUP BY county_code, county_name)
""", DAY_VIEWS), created=AS_OF_REPORTS)
def report_company_totals_from_days(t: Tables) -> DataFrame:
    return plan.company_totals_from_days(company_day_rows(t), AS_OF_REPORTS)


@query(oracle=with_roles("""
    SELECT c.cid, c.company_name, c.company_type, c.county_code, d.type,
      coalesce(d.status, 1) AS safeguard_status,
      CAST(coalesce((SELECT sum(amt) FROM batches b WHERE b.cid = c.cid AND b.status = 1 AND b.is_deleted = 1
        AND b.year = 2001 AND b.month = 5), 0) AS DOUBLE) AS last_month_amt,
      CAST(coalesce((SELECT sum(amt) FROM batches b WHERE b.cid = c.cid AND b.status = 1 AND b.is_deleted = 1
        AND b.year = 2001 AND b.month = 6), 0) AS DOUBLE) AS this_month_amt,
      coalesce((SELECT b.year || '年' || b.month || '月' FROM batches b WHERE b.cid = c.cid AND b.status = 1
        AND b.is_deleted = 1 ORDER BY b.year DESC, b.month DESC LIMIT 1), '--') AS year_month,
      CASE WHEN EXISTS (SELECT 1 FROM special_accounts s WHERE s.cid = c.cid AND s.status = 1
        AND s.is_deleted = 1) THEN 1 ELSE 0 END AS account_status,
      CASE WHEN (SELECT sum(amt) FROM batches b WHERE b.cid = c.cid AND b.status = 1 AND b.is_deleted = 1
        AND b.year = 2001 AND b.month = 6) > 0 THEN 1 ELSE 0 END AS is_salary,
      (SELECT count(*) FROM (SELECT cid, pid FROM projects WHERE is_deleted = 1 UNION
         SELECT unit_cid, pid FROM sub_projects WHERE is_deleted = 1) p WHERE p.cid = c.cid) AS project_count
    FROM companies c
    LEFT JOIN (SELECT cid, status, type FROM deposits WHERE is_deleted = 1 AND status IN (3, 4)
               QUALIFY row_number() OVER (PARTITION BY cid
                 ORDER BY create_time DESC, status DESC, type DESC) = 1) d ON d.cid = c.cid
    WHERE c.is_deleted = 1 AND c.status = 3
"""), created=AS_OF_REPORTS)
def report_company_detail(t: Tables) -> DataFrame:
    r = Roles(t)
    rows = plan.company_detail(
        r.companies, r.deposits, r.batches, r.special_accounts, r.projects, r.sub_projects,
        AS_OF_REPORTS,
    )
    return plain(rows)


def project_types(t: Tables) -> DataFrame:
    r = Roles(t)
    return plan.company_project_types(r.companies, r.projects, r.sub_projects, r.areas, OUR_CITY)


@query(oracle=with_roles("SELECT * FROM company_project_rows", VIEWS))
def report_company_project_types(t: Tables) -> DataFrame:
    return project_types(t)


OURS = "(SELECT code FROM areas WHERE parent_code = '1002')"
TOTAL_PARTS = {
    "EPC_count": "epc_proportion",
    "company_construction_count": "construction_proportion",
    "company_labour_count": "labour_proportion",
    "company_build_count": "build_proportion",
    "other_company_count": "other_company_proportion",
    "local_company_total": "local_company_proportion",
    "nolocal_company_total": "nonlocal_company_proportion",
}


@query(oracle=with_roles(f"""
    SELECT x.company_total, {_counted(TOTAL_PARTS, 'company_total')} FROM (
      SELECT count(DISTINCT cid) AS company_total, count(*) FILTER (WHERE company_type = 1) AS "EPC_count",
        count(*) FILTER (WHERE company_type = 2) AS company_construction_count,
        count(*) FILTER (WHERE company_type = 3) AS company_labour_count,
        count(*) FILTER (WHERE company_type = 4) AS company_build_count,
        count(*) FILTER (WHERE county_code IS NULL OR county_code = '') AS other_company_count,
        count(DISTINCT cid) FILTER (WHERE county_code IN {OURS}) AS local_company_total,
        count(DISTINCT cid) FILTER (WHERE county_code NOT IN {OURS} AND county_code <> '')
          AS nolocal_company_total
      FROM company_project_rows WHERE type_top = 1) x
""", VIEWS), created=AS_OF_REPORTS)
def report_company_totals(t: Tables) -> DataFrame:
    rows = plan.company_totals(details(t).company_project_types(), Roles(t).areas, AS_OF_REPORTS, OUR_CITY)
    return rows


HERE = "FROM company_project_rows r WHERE r.project_county_code = a.code"
HOME = "FROM company_project_rows r WHERE r.county_code = a.code AND r.type_top = 1"


@query(oracle=with_roles(f"""
    SELECT x.*, {', '.join(f"{share_text(f'x.{c}', f'g.{total}')} AS {o}" for c, o, total in (
        ('xz_company_county_total', 'xz_company_proportion', 'xz_company_total'),
        ('yw_company_county_total', 'yw_company_proportion', 'yw_company_total'),
        ('local_company_total', 'yw_local_proportion', 'yw_company_total'),
        ('nolocal_company_total', 'yw_nolocal_proportion', 'yw_company_total'),
        ('other_company_total', 'yw_other_proportion', 'yw_company_total')))},
      CAST(g.xz_company_total AS BIGINT) AS xz_company_total,
      CAST(g.yw_company_total AS BIGINT) AS yw_company_total
    FROM area_rows x,
      (SELECT sum(xz_company_county_total) AS xz_company_total, sum(yw_company_county_total) AS yw_company_total
       FROM area_rows) g
""", {**VIEWS, "area_rows": f"""
    SELECT a.code, a.name, (SELECT count(DISTINCT cid) {HOME}) AS xz_company_county_total,
      (SELECT count(*) FILTER (WHERE company_type = 1) {HOME}) AS epc_count,
      (SELECT count(*) FILTER (WHERE company_type = 2) {HOME}) AS company_construction_count,
      (SELECT count(*) FILTER (WHERE company_type = 3) {HOME}) AS company_labour_count,
      (SELECT count(*) FILTER (WHERE company_type = 4) {HOME}) AS company_build_count,
      (SELECT count(DISTINCT cid) {HERE}) AS yw_company_county_total,
      (SELECT count(DISTINCT cid) {HERE} AND r.county_code IN {OURS}) AS local_company_total,
      (SELECT count(DISTINCT cid) {HERE} AND r.county_code NOT IN {OURS} AND r.county_code <> '')
        AS nolocal_company_total,
      (SELECT count(DISTINCT cid) {HERE} AND (r.county_code IS NULL OR r.county_code = ''))
        AS other_company_total
    FROM areas a WHERE a.parent_code = '1002'
    """}), created=AS_OF_REPORTS)
def report_company_area_totals(t: Tables) -> DataFrame:
    rows = plan.company_area_totals(details(t).company_project_types(), Roles(t).areas, AS_OF_REPORTS, OUR_CITY)
    return rows
