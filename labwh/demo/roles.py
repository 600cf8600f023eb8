"""Warehouse detail tables derived from the generated tables.

Company = customer, project = order, sub-project = order (every fourth one is live), worker = part, wage line,
employment and transfer = line item, deposit = customer balance, swipe and API call = event,
county = nation, city = region. Each table is one SELECT that Spark and DuckDB both accept, so
that reports and their oracles start from the same rows. Soft-deleted rows, unknown codes, empty
texts and missing times are part of the data.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame

from labwh.demo.tables import Tables
from labwh.plans.details import Details
from labwh.sources.staging import Run

# Fixed values.
OUR_CITY, OUR_CITY_NAME = "1002", "ASIA"
AS_OF_REPORTS = dt.date(2001, 6, 15)
AS_OF_SWIPES = dt.date(2024, 1, 20)


def _area(key: str) -> str:
    """Province, city and county code of a number."""
    return (
        f"CAST(10 + ({key} % 5) % 2 AS STRING) AS province_code, "
        f"CAST(1000 + {key} % 5 AS STRING) AS city_code, "
        f"CAST(100000 + {key} % 25 AS STRING) AS county_code"
    )


def _deleted(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 2 ELSE 1 END AS is_deleted"


def _project_area(key: str, pid: str) -> str:
    """Area codes with unknown and unlisted counties."""
    head, _, county = _area(key).rpartition(", ")
    county = county.removesuffix(" AS county_code")
    return (
        f"{head}, CASE WHEN {pid} % 17 = 0 THEN NULL WHEN {pid} % 19 = 0 THEN '999999' "
        f"ELSE {county} END AS county_code"
    )


PROJECT_TYPE = """CASE o_orderpriority WHEN '1-URGENT' THEN '房屋建设工程' WHEN '2-HIGH' THEN '市政工程'
    WHEN '3-MEDIUM' THEN '附属工程' WHEN '4-NOT SPECIFIED' THEN '其它' ELSE '水利工程' END"""
CONDITION = "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END"
# Every fourth order is a live sub-project of the order three before it.
PAID_PID = "CASE WHEN {k} % 4 = 3 THEN {k} + 1000000000 ELSE {k} - {k} % 4 END"
ORDER_DAY = "DATE '2000-01-01' + CAST({k} % 700 AS INT)"

_PROJECT = f"""
    SELECT o_orderkey AS pid, o_custkey AS cid, 'project-' || CAST(o_orderkey AS STRING) AS project_name,
      {PROJECT_TYPE} AS project_type, {{condition}} AS project_condition,
      CAST(3 + o_orderkey % 7 % 4 AS INT) AS status, {_deleted("o_orderkey % 13 = 0")},
      CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 11 = 1 THEN NULL ELSE 'R' END
        AS response_code,
      o_orderkey % 100 AS principal_empid, CAST(o_totalprice AS DECIMAL(15,2)) AS build_area,
      CAST(o_totalprice AS DECIMAL(16,4)) AS construct_cost,
      CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'u' END AS create_user, o_orderdate AS create_time,
      {_project_area('o_custkey', 'o_orderkey')},
      CAST(o_custkey % 3 AS INT) AS industry_type, CAST(o_orderkey % 4 AS INT) AS investment_nature,
      CAST(o_orderkey % 28 + 1 AS INT) AS pay_day,
      CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS is_completed,
      CASE WHEN o_orderstatus = 'O' THEN 'Y' ELSE 'N' END AS is_lock
    FROM orders
"""
_COMPANY = f"""
    SELECT c_custkey AS cid, c_name AS company_name, {{company_type}} AS company_type,
      CAST(10 + (c_nationkey % 5) % 2 AS STRING) AS province_code,
      CAST(1000 + c_nationkey % 5 AS STRING) AS city_code,
      CASE WHEN c_nationkey % 10 = 9 THEN NULL WHEN c_nationkey % 10 = 7 AND c_custkey % 2 = 0 THEN ''
           ELSE CAST(100000 + c_nationkey AS STRING) END AS county_code,
      {ORDER_DAY.format(k='c_custkey')} AS create_time, {ORDER_DAY.format(k='c_custkey')} AS checked_time,
      CAST(c_acctbal AS DECIMAL(15,2)) AS register_capital,
      CASE c_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 END AS is_location,
      CASE c_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 END AS location,
      {_deleted("c_custkey % 17 = 0")}, CASE WHEN c_custkey % 5 = 0 THEN 4 ELSE 3 END AS status,
      CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'L' END AS businesslicense_code,
      'ORG' || CAST(c_custkey % 50 AS STRING) AS organization_code
    FROM customer
"""
_SEGMENT = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN {} WHEN 'BUILDING' THEN {} WHEN 'FURNITURE' THEN {} WHEN 'HOUSEHOLD' THEN {} END"

ROLES: dict[str, str] = {
    "areas": """
    SELECT CAST(100000 + n_nationkey AS STRING) AS code, n_name AS name, 3 AS level,
      CAST(1000 + n_regionkey AS STRING) AS parent_code,
      CASE WHEN n_nationkey = 22 THEN 2 ELSE 1 END AS is_deleted FROM nation
    UNION ALL SELECT CAST(1000 + r_regionkey AS STRING), r_name, 2,
      CAST(10 + r_regionkey % 2 AS STRING), 1 FROM region
    UNION ALL SELECT DISTINCT CAST(10 + r_regionkey % 2 AS STRING),
      'PROVINCE_' || CAST(r_regionkey % 2 AS STRING), 1, '0', 1 FROM region
    """,
    "company_types": """
    SELECT 'companytype' AS type, 1 AS code, '建设集团' AS name
    UNION ALL SELECT 'companytype', 2, '施工单位' UNION ALL SELECT 'companytype', 3, '劳务企业'
    UNION ALL SELECT 'companytype', 4, '设计单位' UNION ALL SELECT 'worktype', 4, '木工'
    """,
    "projects": _PROJECT.format(condition=CONDITION),
    "base_projects": _PROJECT.format(condition="CAST(3 + o_orderkey % 9 % 4 AS INT)"),
    "sub_projects": f"""
    SELECT o_orderkey + 1000000000 AS pid, o_orderkey - 3 AS source_pid, o_custkey AS unit_cid,
      o_custkey AS cid, 'sub-' || CAST(o_orderkey AS STRING) AS project_name,
      {PROJECT_TYPE} AS project_type, CAST(3 + o_custkey % 3 AS INT) AS status,
      {_deleted("o_orderkey % 4 <> 3 OR o_orderkey % 5 = 0")}, {CONDITION} AS project_condition,
      {_area('o_custkey')}
    FROM orders
    """,
    "companies": _COMPANY.format(company_type=_SEGMENT.format(1, 2, 3, 4)),
    "old_companies": _COMPANY.format(company_type=_SEGMENT.format(13, 4, 11, 99)),
    "labourers": f"""
    SELECT p_partkey AS lid, p_name AS real_name,
      CASE WHEN p_partkey % 2 = 0 THEN 'id' ELSE 'ID' END || CAST(p_partkey AS STRING) AS id_card_no,
      CASE WHEN p_size % 2 = 0 THEN '男' ELSE '女' END AS gender,
      DATE '1950-01-01' + CAST(p_size * 365 AS INT) AS birthday, p_size % 3 AS nation_id,
      p_size % 2 AS married, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE '138' END AS mobilephone,
      CASE WHEN p_partkey % 20 = 0 THEN 99 ELSE p_size % 5 END AS real_grade, {_area('p_partkey')},
      CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 9 = 1 THEN ''
           ELSE CAST(p_size % 4 AS STRING) END AS nativeplace_id,
      p_size % 7 AS culture_level_type, p_size % 6 AS politics_type, 1 AS source_type,
      {_deleted("p_partkey % 23 = 0")}
    FROM part
    """,
    "employments": f"""
    SELECT l_partkey AS lid, l_orderkey AS source_pid, l_suppkey AS current_cid,
      CASE WHEN l_linenumber = 3 THEN NULL ELSE 'E' || CAST(l_partkey AS STRING) END AS real_name,
      CASE WHEN l_linenumber = 2 THEN NULL ELSE 'ID' || CAST(l_partkey AS STRING) END AS id_card_no,
      'project-' || CAST(l_orderkey AS STRING) AS source_project_name, l_shipdate AS job_date,
      CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) END
        AS job_end_date,
      CAST(l_linenumber AS STRING) AS worktype_no, 'T' || CAST(l_linenumber AS STRING) AS worktype_name,
      CASE WHEN l_linestatus = 'O' THEN TRUE WHEN l_linenumber = 7 THEN NULL ELSE FALSE END AS is_job,
      CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS is_deleted,
      CASE WHEN l_linenumber = 6 THEN NULL ELSE l_shipdate END AS create_time,
      CAST(1000 + l_suppkey % 5 AS STRING) AS current_city_code,
      CAST(100000 + l_suppkey % 25 AS STRING) AS current_county_code,
      'county' || CAST(l_suppkey % 25 AS STRING) AS current_county_name
    FROM lineitem
    """,
    "employment_intervals": """
    SELECT l_partkey AS lid, l_orderkey AS source_pid, 'ID' || CAST(l_partkey AS STRING) AS id_card_no,
      CAST(l_shipdate AS DATE) - CAST(l_quantity * 3 AS INT) AS starttime,
      CASE WHEN l_linenumber = 5 THEN DATE '2999-01-01' ELSE CAST(l_shipdate AS DATE) END AS endtime,
      l_linestatus = 'O' AS is_job, CASE WHEN l_linenumber = 6 THEN 2 ELSE 1 END AS is_deleted
    FROM lineitem
    """,
    "batches": f"""
    SELECT 'B' || CAST(o_orderkey AS STRING) AS batch_no, o_custkey AS cid,
      CASE WHEN o_orderkey % 29 = 0 THEN 0 ELSE o_orderkey - o_orderkey % 4 END AS source_pid,
      {PAID_PID.format(k='o_orderkey')} AS pid, o_custkey % 10 AS bkid,
      CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
      CAST(date_trunc('month', o_orderdate) AS DATE) AS year_month,
      CAST(o_orderkey % 40 AS INT) AS number, CAST(o_orderkey % 50 AS INT) AS real_number,
      CAST(o_totalprice AS DECIMAL(15,2)) AS amt, CAST(o_totalprice AS DECIMAL(15,2)) AS real_amt,
      CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 6 ELSE 7 END AS status,
      CASE WHEN o_orderkey % 10 = 0 THEN 2 ELSE 1 END AS type, {_deleted("o_orderkey % 31 = 0")},
      o_orderdate AS create_time
    FROM orders
    """,
    "wages": f"""
    SELECT 'B' || CAST(l_orderkey AS STRING) AS batch_no, {PAID_PID.format(k='l_orderkey')} AS pid,
      'W' || CAST(l_partkey % 1000 AS STRING) AS real_name,
      'ID' || CAST(l_partkey AS STRING) AS id_card_no,
      CAST(l_extendedprice AS DECIMAL(15,2)) AS real_amt,
      CAST(l_extendedprice AS DECIMAL(15,2)) AS total_amt,
      CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS status, l_linenumber % 2 AS is_labourer,
      CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS is_deleted, l_shipdate AS create_time
    FROM lineitem
    """,
    "payroll_lines": """
    SELECT 'B' || CAST(l_orderkey AS STRING) AS batch_no, 'ID' || CAST(l_partkey AS STRING) AS id_card_no,
      'T' || CAST(min(l_linenumber) AS STRING) AS worktype_name,
      'G' || CAST(max(l_linenumber) AS STRING) AS group_name
    FROM lineitem WHERE l_linenumber <= 3 GROUP BY l_orderkey, l_partkey
    """,
    "bank_accounts": f"""
    SELECT s_suppkey AS bkid, 'ACC' || CAST(s_suppkey AS STRING) AS bank_account_no, s_suppkey AS cid,
      CASE WHEN s_suppkey % 6 = 0 THEN 0 ELSE s_suppkey * 3 END AS pid,
      'BANK_' || CAST(s_nationkey AS STRING) AS bank_name, {_deleted("s_suppkey % 8 = 7")}
    FROM supplier
    """,
    "labourer_banks": """
    SELECT CASE WHEN l_partkey % 2 = 0 THEN 'id' ELSE 'ID' END || CAST(l_partkey AS STRING) AS id_card_no,
      'C' || CAST(l_suppkey AS STRING) AS bank_no, 'BANK_' || CAST(l_suppkey % 25 AS STRING) AS bank_name,
      l_shipdate AS create_time, CASE WHEN l_linenumber = 4 THEN 2 ELSE 1 END AS is_deleted
    FROM lineitem WHERE l_discount >= 0.05
    """,
    "account_transfers": f"""
    SELECT o_orderkey AS pid, CAST(o_totalprice AS DECIMAL(15,2)) AS amt,
      CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS status, {_deleted("o_orderkey % 14 = 0")}
    FROM orders WHERE o_orderstatus = 'P'
    """,
    "bank_transfers": """
    SELECT l_orderkey AS pid, CAST(l_extendedprice AS DECIMAL(15,2)) AS amt,
      CASE WHEN l_returnflag = 'A' THEN 2 ELSE 1 END AS jtype, l_linenumber % 4 AS is_pro_valid,
      l_shipdate AS trans_time, CASE WHEN l_linenumber = 6 THEN 2 ELSE 1 END AS is_deleted
    FROM lineitem
    """,
    "special_accounts": f"""
    SELECT c_custkey AS cid, c_custkey * 2 AS pid, 'ACC' || CAST(c_custkey AS STRING) AS account_no,
      CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS status, {_deleted("c_custkey % 11 = 0")},
      {ORDER_DAY.format(k='c_custkey')} AS create_time
    FROM customer WHERE c_mktsegment <> 'MACHINERY'
    """,
    "deposits": f"""
    SELECT c_custkey AS cid, CAST(c_acctbal AS DECIMAL(15,2)) AS assure_amt,
      CASE c_custkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 4 WHEN 2 THEN 1 ELSE 3 END AS status,
      CAST(c_custkey % 3 AS INT) AS type, {ORDER_DAY.format(k='c_custkey')} AS reg_date,
      {ORDER_DAY.format(k='c_custkey')} AS create_time,
      CAST(10 + (c_custkey % 5) % 2 AS STRING) AS province_code,
      CASE WHEN c_custkey % 9 = 0 THEN '' ELSE CAST(1000 + c_custkey % 5 AS STRING) END AS city_code,
      {_deleted("c_custkey % 15 = 0")}
    FROM customer WHERE c_acctbal > 0
    UNION ALL
    SELECT c_custkey, CAST(100.5 AS DECIMAL(15,2)), 4, 9, DATE '2001-06-03', DATE '2001-06-03',
      CAST(10 + (c_custkey % 5) % 2 AS STRING), CAST(1000 + c_custkey % 5 AS STRING), 1
    FROM customer WHERE c_mktsegment = 'BUILDING'
    """,
    "billboards": """
    SELECT l_orderkey AS pid, l_shipdate AS create_time,
      CASE WHEN l_linenumber = 2 THEN 2 ELSE 1 END AS is_deleted
    FROM lineitem WHERE l_returnflag = 'A'
    """,
    "devices": """
    SELECT o_orderkey AS id, o_orderkey AS pid,
      'SN' || CAST(o_orderkey - o_orderkey % 2 AS STRING) AS sn,
      'project-' || CAST(o_orderkey AS STRING) AS project_name, 'gate' AS equipmentname,
      CAST(o_orderkey % 3 AS INT) AS dev_type,
      CASE o_custkey % 6 WHEN 0 THEN '中控' WHEN 1 THEN '海康' WHEN 2 THEN '海清视讯' WHEN 3 THEN '赤道'
        WHEN 4 THEN '其他' ELSE 'X' END AS dev_manufacturer,
      CASE WHEN o_orderkey % 5 = 0 THEN 'Y' ELSE 'N' END AS isdelete, o_orderkey % 7 <> 0 AS is_show,
      o_orderkey % 9 <> 0 AS is_enable, DATE '2023-12-01' + CAST(o_orderkey % 55 AS INT) AS create_time,
      'u' AS create_user, DATE '2024-01-05' + CAST(o_orderkey % 21 AS INT) AS last_modify_time,
      'v' AS last_modify_user
    FROM orders
    """,
    "attachments": f"""
    SELECT o_orderkey AS pid, CASE WHEN o_orderkey % 3 = 0 THEN 'a' ELSE '' END AS contract1,
      CASE WHEN o_orderkey % 4 = 0 THEN 'b' END AS contract2, '' AS contract3, CAST(NULL AS STRING) AS contract4,
      CASE WHEN o_orderkey % 10 = 1 THEN 'e' ELSE '' END AS contract5, {_deleted("o_orderkey % 16 = 0")}
    FROM orders
    """,
    "audits": f"""
    SELECT o_orderkey AS bus_id, CASE WHEN o_custkey % 2 = 0 THEN 4 ELSE 5 END AS type,
      CASE WHEN o_custkey % 5 = 0 THEN 2 ELSE 1 END AS status, {_deleted("o_orderkey % 18 = 0")}
    FROM orders
    """,
    "agreements": f"""
    SELECT o_orderkey AS pid, o_custkey AS sg_cid, {_deleted("o_orderkey % 12 = 0")}
    FROM orders WHERE o_orderstatus <> 'P'
    """,
    "commissions": """
    SELECT l_orderkey - l_orderkey % 4 AS pid,
      'ORG' || CAST(l_suppkey % 50 AS STRING) AS subcontract_company_organization_code,
      CASE WHEN l_linenumber = 1 THEN 1 ELSE 2 END AS is_deleted
    FROM lineitem WHERE l_returnflag = 'N'
    """,
    "arrears_cases": f"""
    SELECT o_orderkey AS id, CASE WHEN o_orderkey % 37 = 0 THEN 0 ELSE o_orderkey END AS pid,
      CAST(3 + o_custkey % 3 AS INT) AS status, {_area('o_custkey')}, {_deleted("o_orderkey % 21 = 0")}
    FROM orders WHERE o_orderstatus = 'O'
    """,
    "arrears_amounts": """
    SELECT l_partkey AS lid, 'W' || CAST(l_partkey AS STRING) AS real_name, l_orderkey AS pid,
      l_orderkey AS arrears_salary_id, CAST(l_extendedprice AS DECIMAL(15,2)) AS real_amt,
      CASE WHEN l_linenumber = 7 THEN 2 ELSE 1 END AS is_deleted
    FROM lineitem WHERE l_returnflag = 'R'
    """,
    "blacklist": """
    SELECT l_partkey AS lid, l_linenumber AS bad_grade, l_shipdate AS create_time,
      CASE WHEN l_linenumber = 3 THEN 2 ELSE 1 END AS is_deleted
    FROM lineitem WHERE l_discount >= 0.09
    """,
    "contracts": f"""
    SELECT CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey END AS pid,
      {_deleted("o_orderkey % 8 = 0")}, o_orderkey % 5 = 0 AS is_stop
    FROM orders
    """,
    "attendance_ext": f"""
    SELECT o_orderkey AS pid, CAST(o_orderkey % 2 AS INT) AS is_attendance, {_deleted("o_orderkey % 9 = 0")}
    FROM orders WHERE o_orderpriority = '1-URGENT'
    """,
    "swipes": """
    SELECT user_id AS pid, 'SN' || CAST(event_id - event_id % 8 AS STRING) AS sn,
      CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 3 END AS direct,
      CASE WHEN event_type = 'error' THEN NULL ELSE 'ID' || CAST(user_id AS STRING) END AS idcardno,
      'N' || CAST(user_id AS STRING) AS full_name,
      CASE WHEN event_id % 3 = 0 THEN '139' END AS mobile, CASE WHEN event_id % 5 = 0 THEN 't' END AS tid,
      ts AS record_time, CASE WHEN event_id % 4 = 0 THEN NULL ELSE ts END AS insert_time,
      'gate' AS equp_name, CAST(NULL AS STRING) AS photo_path, 'k' AS app_key
    FROM events
    """,
    "api_log": """
    SELECT '[{"real_name": "N' || CAST(user_id AS STRING) || '", "id_card_no": "ID' || CAST(user_id AS STRING)
      || '", "' || CASE WHEN event_id % 3 = 0 THEN 'source_project' ELSE 'proj' END
      || '": {"pid": "' || CAST(event_id % 90 AS STRING) || '", "project_name": "P'
      || CAST(event_id % 90 AS STRING) || '"}}]' AS data,
      CASE WHEN event_type = 'error' THEN 'other' ELSE 'labourer.import' END AS method,
      CASE WHEN event_id % 10 = 0 THEN 1002 ELSE 1001 END AS appid, ts AS create_time, event_id
    FROM events
    """,
    "audit_log": """
    SELECT '[{' || chr(92) || '"real_name' || chr(92) || '": ' || chr(92) || '"N' || CAST(user_id AS STRING)
      || chr(92) || '", ' || chr(92) || '"mobilephone' || chr(92) || '": ' || chr(92) || '"13'
      || CAST(event_id AS STRING) || chr(92) || '"}]' AS data,
      'rejected ' || event_type AS message, ts AS request_time
    FROM events
    """,
    "request_log": """
    SELECT '{"dto": {"method": "' || CASE WHEN event_type = 'error' THEN 'other' ELSE 'labourer.import' END
      || '", "appid": "1001", "data": "D' || CAST(event_id % 400 AS STRING) || '"}}' AS request_content,
      '{"code": ' || CASE WHEN event_id % 3 = 0 THEN '0' ELSE '500' END || ', "message": "M'
      || event_type || '"}' AS response_content,
      CASE WHEN event_id % 7 = 0 THEN '/other' ELSE '/openapi' END AS api
    FROM events
    """,
}

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Roles:
    """Lazy access to the detail tables: ``Roles(tables).projects``."""

    def __init__(self, tables: Tables):
        self._tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        text = ROLES[name].replace("{", "{{").replace("}", "}}")
        text = re.sub(rf"\bFROM ({'|'.join(SOURCES)})\b", r"FROM {\1}", text)
        used = {s: getattr(self._tables, s) for s in SOURCES if f"{{{s}}}" in text}
        df = self._tables.spark.sql(text, **used)
        setattr(self, name, df)
        return df


def details(t: Tables) -> Details:
    """The stored details of one query's run. They stay as long as the query's result may be read."""
    if "shared_details" not in vars(t):
        t.shared_details = Details(Run(t.spark, "details"), Roles(t), AS_OF_REPORTS, OUR_CITY)
    return t.shared_details


def with_roles(sql: str, views: dict[str, str] | None = None) -> str:
    """Oracle SQL preceded by the detail tables and views it names."""
    known = {**ROLES, **(views or {})}
    found: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in found and re.search(rf"\b(FROM|JOIN|IN \(SELECT \w+ FROM) {name}\b", text):
                visit(known[name])
                found.append(name)

    visit(sql)
    parts = ",\n".join(f"{n} AS ({known[n].strip()})" for n in found)
    return f"WITH {parts}\n{sql.strip()}" if parts else sql
