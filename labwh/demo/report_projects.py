"""Project reports on the derived detail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwh.demo.registry import query, share_text
from labwh.demo.report_views import VIEWS, plain
from labwh.demo.roles import AS_OF_REPORTS, OUR_CITY, OUR_CITY_NAME, Roles, with_roles
from labwh.demo.tables import Tables
from labwh.plans import projects as plan


@query(oracle=with_roles("""
    SELECT p.pid, p.cid, p.project_type,
      CASE WHEN p.is_completed = 'Y' THEN 3 WHEN p.is_lock = 'Y' THEN 2 ELSE 1 END AS project_status,
      a1.name AS province_name, a2.name AS city_name, a3.name AS county_name,
      year(p.create_time) || '-' || month(p.create_time) || '-' || day(p.create_time) AS create_time,
      CASE WHEN EXISTS (SELECT 1 FROM employments e JOIN labourers l ON l.lid = e.lid AND l.real_grade <> 99
        WHERE e.source_pid = p.pid) THEN 1 ELSE 0 END AS is_realname,
      CASE WHEN EXISTS (SELECT 1 FROM special_accounts s JOIN bank_accounts b
        ON b.bank_account_no = s.account_no AND b.cid = s.cid AND b.pid <> 0
        WHERE s.is_deleted = 1 AND s.status = 1 AND b.pid = p.pid) THEN 1 ELSE 0 END AS project_account_status,
      CASE WHEN EXISTS (SELECT 1 FROM deposits d WHERE d.cid = p.cid AND d.is_deleted = 1
        AND d.status IN (3, 4)) THEN 1 ELSE 0 END AS safeguard_status,
      CAST(coalesce((SELECT sum(d.assure_amt) FROM deposits d WHERE d.cid = p.cid AND d.is_deleted = 1
        AND d.status IN (3, 4)), 0) AS DOUBLE) AS assure_amt,
      (SELECT count(*) FROM billboards b WHERE b.pid = p.pid AND b.is_deleted = 1) AS billboards,
      CASE WHEN EXISTS (SELECT 1 FROM attendance_ext x WHERE x.pid = p.pid AND x.is_deleted = 1
        AND x.is_attendance = 1) THEN 1 ELSE 0 END AS is_attendance,
      CASE WHEN EXISTS (SELECT 1 FROM contracts c WHERE c.pid = p.pid AND c.is_deleted = 1
        AND NOT c.is_stop) THEN 1 ELSE 0 END AS contract_status,
      CASE WHEN EXISTS (SELECT 1 FROM agreements g WHERE g.pid = p.pid) THEN 1 ELSE 0 END AS is_agreement
    FROM projects p
    LEFT JOIN areas a1 ON a1.code = p.province_code AND a1.level = 1
    LEFT JOIN areas a2 ON a2.code = p.city_code AND a2.level = 2
    LEFT JOIN areas a3 ON a3.code = p.county_code AND a3.level = 3
"""))
def report_project_day_old(t: Tables) -> DataFrame:
    r = Roles(t)
    rows = plan.project_day_old(
        r.projects, r.areas, r.employments, r.labourers, r.special_accounts, r.bank_accounts,
        r.deposits, r.billboards, r.attendance_ext, r.contracts, r.agreements,
    )
    return plain(
        rows, "pid", "cid", "project_type", "project_status", "province_name", "city_name",
        "county_name", "create_time", "is_realname", "project_account_status", "safeguard_status",
        "assure_amt", "billboards", "is_attendance", "contract_status", "is_agreement",
    )


def days(t: Tables) -> DataFrame:
    r = Roles(t)
    return plan.project_day(
        r.projects, r.areas, r.employments, r.special_accounts, r.deposits, r.billboards, r.devices,
        r.attachments, r.audits, r.agreements, r.batches,
    )


DAY_COLUMNS = """pid, cid, response_code, project_type, status, is_deleted, project_condition,
    create_user, county_code, province_name, city_name, county_name, year, month, day, is_realname,
    project_account_status, safeguard_status, is_attendance, contract_status, is_agreement, billboards"""


@query(oracle=with_roles(f"""
    SELECT {DAY_COLUMNS}, created AS create_time, CAST(assure_amt AS DOUBLE) AS assure_amt,
      CAST(real_amt AS DOUBLE) AS real_amt FROM project_days
""", VIEWS))
def report_project_day(t: Tables) -> DataFrame:
    cols = [c.strip() for c in DAY_COLUMNS.split(",")]
    return plain(days(t), *cols, "create_time", "assure_amt", "real_amt")


FLAG_SUMS = ", ".join(
    f"CAST(sum({f}) AS BIGINT) AS {o}" for f, o in {"billboards": "billboards", **plan.FLAG_SUMS}.items()
)
TYPES = "('房屋建设工程', '市政工程', '附属工程', '其它')"


@query(oracle=with_roles(f"""
    SELECT coalesce(county_name, '其他') AS county_name, year, month, day, created AS create_time,
      project_type, count(pid) AS houses_total, {FLAG_SUMS}
    FROM project_days WHERE project_condition = 1 AND project_type IN {TYPES}
    GROUP BY 1, 2, 3, 4, 5, 6
""", VIEWS))
def report_build_area_types(t: Tables) -> DataFrame:
    return plan.build_area_types(days(t))


TYPE_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE project_type = '{label}') AS {n}_total" for label, n in plan.PROJECT_TYPES.items()
)


@query(oracle=with_roles(f"""
    SELECT coalesce(county_name, '其他') AS county_name, year, month, day, created AS create_time,
      count(pid) AS project_total, {TYPE_COUNTS}, {FLAG_SUMS}
    FROM project_days WHERE project_condition = 1 AND project_type IN {TYPES} GROUP BY 1, 2, 3, 4, 5
""", VIEWS))
def report_build_area_days(t: Tables) -> DataFrame:
    return plan.build_area_days(plan.build_area_types(days(t)))


SHARES = ", ".join(
    f"{share_text(c, 'project_total')} AS {c.removesuffix('_total')}_proportion" for c in plan.BUILD_TOTALS[1:]
)
OPEN = f"status IN (3, 4, 5) AND is_deleted = 1 AND project_condition = 1 AND project_type IN {TYPES}"


@query(oracle=with_roles(f"""
    SELECT *, {SHARES} FROM (
      SELECT coalesce(province_name, '其他') AS province_name, coalesce(city_name, '其他') AS city_name,
        coalesce(county_name, '其他') AS county_name, year, month, day, created AS create_time,
        count(pid) AS project_total, {TYPE_COUNTS}, {FLAG_SUMS}
      FROM project_days WHERE {OPEN} GROUP BY 1, 2, 3, 4, 5, 6, 7)
""", VIEWS))
def report_build_day(t: Tables) -> DataFrame:
    return plan.build_day(days(t))


@query(oracle=with_roles(f"""
    SELECT *, {SHARES} FROM (
      SELECT coalesce(province_name, '其他') AS province_name, coalesce(city_name, '其他') AS city_name,
        coalesce(county_name, '其他') AS county_name, count(pid) AS project_total, {TYPE_COUNTS}, {FLAG_SUMS}
      FROM project_days WHERE {OPEN} GROUP BY 1, 2, 3)
""", VIEWS))
def report_build_total(t: Tables) -> DataFrame:
    return plan.build_total(plan.build_day(days(t)))


STATES = """count(*) FILTER (WHERE project_condition = 1) AS bulid_total,
      count(*) FILTER (WHERE project_condition = 2) AS stop_total,
      count(*) FILTER (WHERE project_condition = 3) AS complete_total"""


@query(oracle=with_roles(f"""
    SELECT coalesce(county_name, '其他') AS county_name, year, month, day, created AS create_time,
      count(pid) AS project_total, {STATES}, count(DISTINCT cid) AS companys_sum,
      CAST(sum(billboards) AS BIGINT) AS billboards, CAST(sum(project_account_status) AS BIGINT) AS account_total
    FROM project_days GROUP BY 1, 2, 3, 4, 5
""", VIEWS))
def report_status_day(t: Tables) -> DataFrame:
    return plan.status_day(days(t))


OURS = "city_code = '1002' AND is_deleted = 1 AND status IN (3, 4, 5)"
PROJECT_SUMS = f"""count(pid) AS project_total, {STATES}, CAST(sum(billboards) AS BIGINT) AS billboards,
      CAST(sum(real_amt) AS DOUBLE) AS real_amt"""


@query(oracle=with_roles(f"""
    SELECT 'ASIA' AS city_name, x.*, y.*,
      (SELECT count(*) FROM labourers WHERE real_grade <> 99 AND is_deleted = 1) AS realname_total,
      (SELECT count(*) FROM companies WHERE is_deleted = 1 AND businesslicense_code <> '' AND status <> 4)
        AS companys_total
    FROM (SELECT {PROJECT_SUMS} FROM project_days
          WHERE {OURS} AND response_code <> '' AND create_user <> '') x,
         (SELECT count(*) FILTER (WHERE safeguard_status = 1) AS is_ompanys_safeguard,
            count(*) FILTER (WHERE safeguard_status = 0) AS no_ompanys_safeguard
          FROM (SELECT DISTINCT cid, assure_amt, safeguard_status FROM project_days)) y
""", VIEWS), created=AS_OF_REPORTS)
def report_city_snapshot_old(t: Tables) -> DataFrame:
    r = Roles(t)
    row = plan.city_snapshot_old(
        days(t), r.labourers, r.companies, AS_OF_REPORTS, OUR_CITY, OUR_CITY_NAME
    )
    return plain(row)


GLOBALS = """
      (SELECT count(DISTINCT cid) FROM deposits WHERE is_deleted = 1 AND status IN (3, 4))
        AS ompanys_safeguard_total,
      (SELECT CAST(sum(assure_amt) AS DOUBLE) FROM deposits WHERE is_deleted = 1 AND status IN (3, 4))
        AS assure_amt,
      (SELECT count(*) FROM labourers WHERE real_grade <> 99 AND is_deleted = 1) AS realname_total,
      (SELECT count(*) FROM companies WHERE is_deleted = 1 AND status = 3) AS companys_total,
      (SELECT count(*) FROM special_accounts WHERE is_deleted = 1 AND status = 1) AS account_total
"""


@query(oracle=with_roles(f"""
    SELECT 'ASIA' AS city_name, x.*, {GLOBALS}
    FROM (SELECT {PROJECT_SUMS} FROM project_days
          WHERE {OURS} AND response_code <> '' AND create_user <> '') x
""", VIEWS), created=AS_OF_REPORTS)
def report_city_snapshot(t: Tables) -> DataFrame:
    r = Roles(t)
    row = plan.city_snapshot(
        days(t), r.deposits, r.labourers, r.companies, r.special_accounts, AS_OF_REPORTS, OUR_CITY,
        OUR_CITY_NAME,
    )
    return plain(row)


def wide(t: Tables) -> DataFrame:
    r = Roles(t)
    return plan.project_detail(
        r.projects, r.sub_projects, r.companies, r.deposits, r.special_accounts,
        r.account_transfers, r.wages, r.employments, r.bank_accounts, r.billboards, r.devices,
        r.attachments, r.agreements, r.audits, r.batches, AS_OF_REPORTS,
    )


LABEL_VIEWS = {
    "tree": f"""
    SELECT pid AS source_pid, pid, cid FROM projects WHERE {OPEN}
    UNION SELECT source_pid, pid, unit_cid FROM sub_projects WHERE status IN (3, 4) AND is_deleted = 1
      AND project_condition = 1 AND project_type IN {TYPES}
    """,
    "company_labels": """
    SELECT DISTINCT t.source_pid, c.company_type, c.company_name, d.status IN (3, 4) AS pays, s.status = 1 AS filed,
      '[' || CASE d.status WHEN 3 THEN '在缴' WHEN 4 THEN '免缴' ELSE '未缴' END || ']' || c.company_name || '('
        || CAST(coalesce(d.assure_amt, CAST(0 AS DECIMAL(15,2))) AS VARCHAR) || '万元)' AS deposit_label,
      '[' || CASE WHEN s.status = 1 THEN '已备案' ELSE '未备案' END || ']' || c.company_name AS account_label
    FROM tree t JOIN companies c ON c.cid = t.cid
    LEFT JOIN deposits d ON d.cid = c.cid AND d.is_deleted = 1
    LEFT JOIN special_accounts s ON s.cid = c.cid AND s.is_deleted = 1
    """,
}


def _labels(kind: int, group: str) -> str:
    def listed(label: str, cond: str) -> str:
        return f"coalesce(string_agg(DISTINCT {label}, '&' ORDER BY {label}) FILTER (WHERE {cond}), '')"

    x = f"FROM company_labels x WHERE x.source_pid = p.pid AND x.company_type = {kind} HAVING count(*) > 0"
    return f"""
      (SELECT string_agg(DISTINCT company_name, '|' ORDER BY company_name) {x}) AS {group}_company_names,
      (SELECT {listed('deposit_label', 'pays IS TRUE')} {x}) AS {group}_company_safeguard_detail,
      (SELECT {listed('deposit_label', 'pays IS NOT TRUE')} {x}) AS {group}_nopay_company_safeguard_detail,
      (SELECT {listed('account_label', 'filed IS TRUE')} {x}) AS {group}_company_account_detail,
      (SELECT {listed('account_label', 'filed IS NOT TRUE')} {x}) AS {group}_no_company_account_detail"""


@query(oracle=with_roles(f"""
    SELECT p.pid, {', '.join(_labels(k, g) for k, g in plan.COMPANY_GROUPS.items())}
    FROM projects p
""", {**VIEWS, **LABEL_VIEWS}))
def report_project_labels(t: Tables) -> DataFrame:
    """The company label lists of the wide project report."""
    rows = wide(t)
    lists = [c for c in rows.columns if c.endswith("_detail")]
    names = [
        F.array_join(f"{g}_company_names", "|").alias(f"{g}_company_names")
        for g in plan.COMPANY_GROUPS.values()
    ]
    return rows.select("pid", *names, *lists)


@query(oracle=with_roles("""
    SELECT p.pid, p.cid, c.company_name, c.company_type, p.status, p.project_condition, p.county_code,
      CASE WHEN EXISTS (SELECT 1 FROM employments e WHERE e.source_pid = p.pid AND e.is_deleted = 1)
        THEN 1 ELSE 0 END AS is_realname,
      (SELECT count(DISTINCT e.lid) FROM employments e WHERE e.source_pid = p.pid AND e.is_job
        AND e.is_deleted = 1) AS labourers_count,
      CASE WHEN EXISTS (SELECT 1 FROM tree x JOIN special_accounts s ON s.cid = x.cid AND s.is_deleted = 1
        AND s.status = 1 WHERE x.source_pid = p.pid) THEN 1 ELSE 0 END AS project_account_status,
      CASE WHEN EXISTS (SELECT 1 FROM tree x JOIN bank_accounts b ON b.pid = x.pid AND b.is_deleted = 1
        WHERE x.source_pid = p.pid) THEN 1 ELSE 0 END AS is_bank_account,
      CAST(coalesce((SELECT sum(m.amt) FROM (SELECT pid, amt FROM account_transfers
          WHERE is_deleted = 1 AND status = 1 UNION ALL SELECT pid, real_amt FROM wages
          WHERE is_deleted = 1 AND status = 1) m JOIN tree x ON x.pid = m.pid
        WHERE x.source_pid = p.pid), 0) AS DOUBLE) AS all_amt,
      CASE WHEN EXISTS (SELECT 1 FROM tree x JOIN deposits d ON d.cid = x.cid AND d.is_deleted = 1
        AND d.status IN (3, 4) WHERE x.source_pid = p.pid) THEN 1 ELSE 0 END AS safeguard_status,
      CAST(coalesce((SELECT sum(d.assure_amt) FROM deposits d WHERE d.is_deleted = 1 AND d.status IN (3, 4)
        AND d.cid IN (SELECT x.cid FROM tree x WHERE x.source_pid = p.pid)), 0) AS DOUBLE) AS assure_amt,
      CASE WHEN EXISTS (SELECT 1 FROM billboards b WHERE b.pid = p.pid AND b.is_deleted = 1)
        THEN 1 ELSE 0 END AS is_billboards,
      CASE WHEN EXISTS (SELECT 1 FROM tree x JOIN devices e ON e.pid = x.pid AND e.isdelete = 'N'
        AND e.is_show WHERE x.source_pid = p.pid) THEN 1 ELSE 0 END AS is_attendance,
      CASE WHEN EXISTS (SELECT 1 FROM tree x JOIN attachments k ON k.pid = x.pid AND k.is_deleted = 1
        AND (k.contract1 <> '' OR k.contract2 <> '' OR k.contract3 <> '' OR k.contract4 <> ''
          OR k.contract5 <> '') WHERE x.source_pid = p.pid) THEN 1 ELSE 0 END AS contract_status,
      CASE WHEN EXISTS (SELECT 1 FROM tree x JOIN agreements g ON g.pid = x.pid AND g.is_deleted = 1
        JOIN audits u ON u.bus_id = g.pid AND u.is_deleted = 1 AND u.status = 1 AND u.type = 5
        WHERE x.source_pid = p.pid) THEN 1 ELSE 0 END AS is_agreement,
      CAST(coalesce((SELECT sum(b.real_amt) FROM batches b WHERE b.source_pid = p.pid AND b.status = 1
        AND b.type = 1), 0) AS DOUBLE) AS real_amt,
      CAST(coalesce((SELECT sum(b.real_amt) FROM batches b WHERE b.source_pid = p.pid AND b.status = 1
        AND b.type = 1 AND b.year = 2001 AND b.month = 6), 0) AS DOUBLE) AS this_month_amt
    FROM projects p LEFT JOIN companies c ON c.cid = p.cid
""", {**VIEWS, **LABEL_VIEWS}))
def report_project_detail(t: Tables) -> DataFrame:
    return plain(
        wide(t), "pid", "cid", "company_name", "company_type", "status", "project_condition",
        "county_code", "is_realname", "labourers_count", "project_account_status",
        "is_bank_account", "all_amt", "safeguard_status", "assure_amt", "is_billboards",
        "is_attendance", "contract_status", "is_agreement", "real_amt", "this_month_amt",
    )


@query(oracle=with_roles(f"""
    SELECT p.pid, p.cid, c.company_name, p.response_code, CAST(p.construct_cost AS DOUBLE) AS construct_cost,
      p.status, (SELECT count(DISTINCT e.lid) FROM employments e WHERE e.source_pid = p.pid AND e.is_job
        AND e.is_deleted = 1) AS labourers_count, p.project_condition
    FROM projects p LEFT JOIN companies c ON c.cid = p.cid
    WHERE p.city_code = '1002' AND p.is_deleted = 1 AND p.status IN (3, 4, 5)
"""))
def report_project_list(t: Tables) -> DataFrame:
    rows = plan.project_list(wide(t), OUR_CITY)
    return plain(
        rows, "pid", "cid", "company_name", "response_code", "construct_cost", "status",
        "labourers_count", "project_condition",
    )


@query(oracle=with_roles(f"""
    SELECT x.*, {GLOBALS} FROM (
      SELECT p.county_code, count(pid) AS project_total, {STATES},
        CAST(sum(CASE WHEN EXISTS (SELECT 1 FROM billboards b WHERE b.pid = p.pid AND b.is_deleted = 1)
          THEN 1 ELSE 0 END) AS BIGINT) AS billboards,
        CAST(sum(coalesce((SELECT sum(b.real_amt) FROM batches b WHERE b.source_pid = p.pid
          AND b.status = 1 AND b.type = 1), 0)) AS DOUBLE) AS real_amt
      FROM projects p WHERE {OURS} GROUP BY p.county_code) x
"""), created=AS_OF_REPORTS)
def report_county_snapshot(t: Tables) -> DataFrame:
    r = Roles(t)
    rows = plan.county_snapshot(
        wide(t), r.deposits, r.labourers, r.companies, r.special_accounts, AS_OF_REPORTS, OUR_CITY
    )
    return plain(rows)
