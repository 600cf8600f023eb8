"""Detail reports written as oracle SQL, for the oracles of the reports that build on them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNITS = {
    "swipes": {
        "day": "CAST({ts} AS DATE) = DATE '2024-01-19'",
        "month": "strftime({ts}, '%Y%m') = '202401'",
        "year": "year({ts}) = 2024",
    },
    "reports": {
        "day": "CAST({ts} AS DATE) = DATE '2001-06-14'",
        "month": "strftime({ts}, '%Y%m') = '200106'",
        "year": "year({ts}) = 2001",
    },
}


def plain(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns (all by default), fixed-point amounts as doubles."""
    df = df.select(*cols) if cols else df
    decimals = [c for c, kind in df.dtypes if kind.startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


def audit(as_of: dt.date, is_deleted: bool = True) -> str:
    """Audit columns of a report row, as the plans stamp them."""
    columns = (f"'' AS create_user, DATE '{as_of}' AS create_time, "
               f"'' AS last_modify_user, DATE '{as_of}' AS last_modify_time")
    return f"{columns}, 1 AS is_deleted" if is_deleted else columns


def birthday_text(c: str) -> str:
    return f"year({c}) || '-' || month({c}) || '-' || day({c})"


VIEWS = {
    "swipe_pairs": """
    SELECT pid, CAST(record_time AS DATE) AS d, min(full_name) AS full_name,
      min(record_time) FILTER (WHERE direct = 1) AS tin, max(record_time) FILTER (WHERE direct = 2) AS tout,
      arg_min(sn, record_time) FILTER (WHERE direct = 1) AS in_sn,
      arg_max(sn, record_time) FILTER (WHERE direct = 2) AS out_sn,
      arg_min_null(idcardno, record_time) FILTER (WHERE direct = 1) AS in_card,
      arg_max_null(idcardno, record_time) FILTER (WHERE direct = 2) AS out_card,
      arg_min_null(insert_time, record_time) FILTER (WHERE direct = 1) AS in_up,
      arg_max_null(insert_time, record_time) FILTER (WHERE direct = 2) AS out_up
    FROM swipes WHERE direct IN (1, 2) GROUP BY 1, 2
    """,
    "device_details": """
    SELECT e.id, e.pid, p.project_name, p.province_code, p.city_code, p.county_code, p.project_condition,
      e.sn, e.equipmentname, e.dev_type, e.isdelete, e.create_time, e.create_user, e.last_modify_time,
      e.last_modify_user, e.dev_manufacturer, e.is_show, e.is_enable,
      CASE WHEN EXISTS (SELECT 1 FROM swipes s WHERE s.sn = e.sn AND s.idcardno IS NOT NULL
        AND CAST(s.record_time AS DATE) = DATE '2024-01-19') THEN 1 ELSE 0 END AS day_status,
      CASE WHEN EXISTS (SELECT 1 FROM swipes s WHERE s.sn = e.sn AND s.idcardno IS NOT NULL
        AND s.record_time >= TIMESTAMP '2024-01-01 00:00:00'
        AND s.record_time < TIMESTAMP '2024-02-01 00:00:00') THEN 1 ELSE 0 END AS month_status,
      CASE WHEN EXISTS (SELECT 1 FROM swipes s WHERE s.sn = e.sn AND s.idcardno IS NOT NULL
        AND s.record_time >= TIMESTAMP '2024-01-01 00:00:00'
        AND s.record_time < TIMESTAMP '2024-02-01 00:00:00') THEN 1 ELSE 0 END AS year_status
    FROM devices e JOIN projects p ON p.pid = e.pid
    WHERE p.status IN (3, 4, 5) AND p.is_deleted = 1
    """,
    "resume_details": f"""
    SELECT l.lid, l.real_name, l.id_card_no, l.gender, {birthday_text('l.birthday')} AS birthday,
      CAST(2001 - year(l.birthday) AS INTEGER) AS age, l.real_grade, l.nativeplace_id, l.nation_id, l.married,
      l.mobilephone, l.province_code, l.city_code, l.county_code, l.culture_level_type, l.politics_type, l.source_type,
      j.worktype_name, j.job_date, j.job_end_date, j.source_pid AS pid, j.project_name, j.project_type,
      j.project_province_code, j.project_city_code, j.project_county_code, a.name AS project_county_name, c.company_name,
      j.worktype_no, coalesce(j.lab_top, 1) AS lab_top,
      CASE WHEN j.is_job THEN 1 WHEN j.is_job IS NULL THEN 99 ELSE 0 END AS is_job,
      coalesce(b.bad_grade, 0) AS bad_grade, k.bank_no, k.bank_name,
      (SELECT count(DISTINCT i.source_pid) FROM employment_intervals i
       WHERE i.lid = l.lid AND i.is_deleted = 1) AS project_count
    FROM labourers l
    LEFT JOIN (
      SELECT e.*, p.project_name, p.project_type, p.province_code AS project_province_code, p.city_code AS project_city_code,
        p.county_code AS project_county_code,
        row_number() OVER (PARTITION BY e.lid ORDER BY e.is_job DESC NULLS LAST, e.job_date DESC NULLS LAST,
          p.pid, e.worktype_no, e.current_cid, e.job_end_date) AS lab_top
      FROM employments e JOIN projects p ON p.pid = e.source_pid
      WHERE e.is_deleted = 1 AND p.is_deleted = 1) j ON j.lid = l.lid
    LEFT JOIN companies c ON c.cid = j.current_cid
    LEFT JOIN areas a ON a.code = j.project_county_code AND a.level = 3
    LEFT JOIN (SELECT lid, bad_grade FROM blacklist WHERE is_deleted = 1 QUALIFY row_number() OVER
               (PARTITION BY lid ORDER BY create_time DESC, bad_grade DESC) = 1) b ON b.lid = l.lid
    LEFT JOIN (SELECT id_card_no, bank_no, bank_name FROM labourer_banks WHERE is_deleted = 1
               QUALIFY row_number() OVER (PARTITION BY id_card_no
                 ORDER BY create_time DESC, bank_no DESC, bank_name DESC) = 1) k
      ON k.id_card_no = l.id_card_no
    WHERE l.is_deleted = 1 AND l.real_grade <> 99
    """,
    "histories": f"""
    SELECT l.lid, l.real_name, l.gender, {birthday_text('l.birthday')} AS birthday,
      CAST(2001 - year(l.birthday) AS INTEGER) AS age, l.real_grade, j.job_date, j.current_city_code,
      j.current_county_code, j.area_county_name, j.create_time, j.worktype_no,
      coalesce(j.top, 1) AS top, coalesce(j.is_deleted, 1) AS is_deleted,
      CASE WHEN j.is_job THEN 1 ELSE 0 END AS is_job,
      (SELECT CAST(sum(m.real_amt) AS DOUBLE) FROM arrears_amounts m WHERE m.lid = l.lid AND m.is_deleted = 1)
        AS real_amt,
      CASE WHEN EXISTS (SELECT 1 FROM arrears_amounts m WHERE m.lid = l.lid AND m.is_deleted = 1)
        THEN 1 ELSE 0 END AS arrears_status
    FROM labourers l LEFT JOIN (
      SELECT e.*, a.name AS area_county_name, row_number() OVER (PARTITION BY e.lid
          ORDER BY e.is_job DESC NULLS LAST, e.is_deleted, e.create_time NULLS LAST, e.job_date,
            e.current_county_code, e.worktype_no) AS top
      FROM employments e LEFT JOIN areas a ON a.code = e.current_county_code AND a.level = 3) j
      ON j.lid = l.lid
    WHERE l.is_deleted = 1
    """,
    "salaries": """
    SELECT b.batch_no, b.cid, b.source_pid, b.pid, b.bkid, b.year, b.month, b.real_number, b.real_amt,
      b.status, b.type, c.company_name, c.company_type, c.is_location, k.bank_name, p.project_name,
      p.project_condition, p.status AS project_status, p.county_code, b.year_month, p.is_deleted,
      p.province_code, p.city_code, a1.name AS province_name, a2.name AS city_name, a3.name AS county_name,
      s.person_sum, s.ss_real_amt
    FROM batches b
    JOIN (SELECT pid AS source_pid, pid FROM projects UNION
          SELECT source_pid, pid FROM sub_projects WHERE is_deleted = 1) n
      ON n.source_pid = b.source_pid AND n.pid = b.pid
    JOIN projects p ON p.pid = n.source_pid AND p.status IN (3, 4, 5) AND p.is_deleted = 1
    LEFT JOIN companies c ON c.cid = b.cid
    LEFT JOIN bank_accounts k ON k.bkid = b.bkid
    LEFT JOIN areas a1 ON a1.code = p.province_code AND a1.level = 1
    LEFT JOIN areas a2 ON a2.code = p.city_code AND a2.level = 2
    LEFT JOIN areas a3 ON a3.code = p.county_code AND a3.level = 3
    LEFT JOIN (SELECT batch_no, count(DISTINCT real_name) AS person_sum, sum(real_amt) AS ss_real_amt
               FROM wages WHERE status = 1 AND is_deleted = 1 GROUP BY batch_no) s ON s.batch_no = b.batch_no
    WHERE b.source_pid <> 0 AND b.is_deleted = 1
    """,
    "salary_area_months": """
    SELECT province_name, city_name, county_name, year, month, sum(ss_real_amt) AS real_amt_total,
      count(batch_no) AS batch_total, sum(person_sum) AS labourer_total,
      coalesce(sum(ss_real_amt) FILTER (WHERE company_type = 1), 0) AS build_amt_total,
      coalesce(sum(ss_real_amt) FILTER (WHERE company_type = 2), 0) AS construction_amt_total,
      coalesce(sum(ss_real_amt) FILTER (WHERE company_type = 3), 0) AS labour_amt_total,
      coalesce(sum(ss_real_amt) FILTER (WHERE company_type = 4), 0) AS epc_amt_total
    FROM salaries WHERE status IN (1, 6) GROUP BY ALL
    """,
    "bank_months": """
    SELECT year, month, city_name, county_code, county_name, bank_name, sum(ss_real_amt) AS real_amt,
      sum(person_sum) AS real_number, count(DISTINCT pid) AS project_total
    FROM salaries GROUP BY ALL
    """,
    "salary_details": """
    SELECT n.source_pid, o.project_name AS source_project_name, o.project_condition AS source_project_condition,
      o.cid AS source_cid, o.county_code AS source_county_code, n.pid, n.project_name, n.county_code,
      a.name AS county_name, n.cid, pc.company_name AS pro_company_name, b.cid AS salary_cid,
      coalesce(sc.company_type, 0) AS salary_company_type, sc.company_name AS salary_company_name,
      b.year, b.month, b.year_month, b.batch_no, b.status AS batch_status, b.amt AS batch_amt,
      w.id_card_no, w.real_name, w.real_amt, w.status, l.worktype_name, l.group_name, k.bank_name,
      row_number() OVER (PARTITION BY b.batch_no ORDER BY w.id_card_no, w.real_name, w.real_amt,
        w.total_amt, w.status, l.worktype_name, n.pid, n.source_pid) AS batch_top,
      dense_rank() OVER (PARTITION BY n.source_pid ORDER BY b.status, b.year DESC, b.month DESC)
        AS salary_top
    FROM wages w JOIN batches b ON b.batch_no = w.batch_no
    JOIN (SELECT pid AS source_pid, pid, project_name, county_code, cid FROM projects
          UNION SELECT source_pid, pid, project_name, county_code, cid FROM sub_projects
          WHERE is_deleted = 1) n ON n.pid = b.pid
    JOIN projects o ON o.pid = n.source_pid AND o.status IN (3, 4, 5) AND o.is_deleted = 1
    LEFT JOIN payroll_lines l ON l.batch_no = w.batch_no AND l.id_card_no = w.id_card_no
    LEFT JOIN companies pc ON pc.cid = n.cid
    LEFT JOIN companies sc ON sc.cid = b.cid AND sc.is_deleted = 1
    LEFT JOIN areas a ON a.code = n.county_code AND a.level = 3
    LEFT JOIN bank_accounts k ON k.bkid = b.bkid
    WHERE w.is_deleted = 1 AND b.is_deleted = 1
    """,
    "project_days": """
    SELECT p.*, a1.name AS province_name, a2.name AS city_name, a3.name AS county_name,
      strftime(p.create_time, '%Y-%m-%d') AS created,
      CAST(year(p.create_time) AS INTEGER) AS year, CAST(month(p.create_time) AS INTEGER) AS month,
      CAST(day(p.create_time) AS INTEGER) AS day,
      CASE WHEN EXISTS (SELECT 1 FROM employments x WHERE x.source_pid = p.pid AND x.is_job
        AND x.is_deleted = 1) THEN 1 ELSE 0 END AS is_realname,
      CASE WHEN EXISTS (SELECT 1 FROM special_accounts x WHERE x.cid = p.cid AND x.is_deleted = 1
        AND x.status = 1) THEN 1 ELSE 0 END AS project_account_status,
      CASE WHEN EXISTS (SELECT 1 FROM deposits x WHERE x.cid = p.cid AND x.is_deleted = 1
        AND x.status IN (3, 4)) THEN 1 ELSE 0 END AS safeguard_status,
      coalesce((SELECT sum(x.assure_amt) FROM deposits x WHERE x.cid = p.cid AND x.is_deleted = 1
        AND x.status IN (3, 4)), 0) AS assure_amt,
      (SELECT count(*) FROM billboards x WHERE x.pid = p.pid AND x.is_deleted = 1) AS billboards,
      CASE WHEN EXISTS (SELECT 1 FROM devices x WHERE x.pid = p.pid AND x.isdelete = 'N' AND x.is_show)
        THEN 1 ELSE 0 END AS is_attendance,
      CASE WHEN EXISTS (SELECT 1 FROM attachments x JOIN audits y ON y.bus_id = x.pid AND y.type = 4
        AND y.status = 1 AND y.is_deleted = 1 WHERE x.pid = p.pid AND x.is_deleted = 1 AND (x.contract1 <> ''
        OR x.contract2 <> '' OR x.contract3 <> '' OR x.contract4 <> '' OR x.contract5 <> ''))
        THEN 1 ELSE 0 END AS contract_status,
      CASE WHEN EXISTS (SELECT 1 FROM agreements x JOIN audits y ON y.bus_id = x.pid AND y.type = 5
        AND y.status = 1 AND y.is_deleted = 1 WHERE x.pid = p.pid AND x.is_deleted = 1)
        THEN 1 ELSE 0 END AS is_agreement,
      (SELECT sum(x.real_amt) FROM batches x WHERE x.source_pid = p.pid AND x.status = 1 AND x.type = 1)
        AS real_amt
    FROM projects p
    LEFT JOIN areas a1 ON a1.code = p.province_code AND a1.level = 1
    LEFT JOIN areas a2 ON a2.code = p.city_code AND a2.level = 2
    LEFT JOIN areas a3 ON a3.code = p.county_code AND a3.level = 3
    """,
    "company_area_rows": """
    SELECT c.cid, c.company_name, c.county_code, c.company_type, t.name AS company_type_name, c.is_location,
      c.is_deleted, c.status, CAST(year(c.create_time) AS INTEGER) AS year,
      CAST(month(c.create_time) AS INTEGER) AS month, CAST(day(c.create_time) AS INTEGER) AS day,
      p.province_code AS project_province_code, p.city_code AS project_city_code,
      p.county_code AS project_county_code,
      row_number() OVER (PARTITION BY c.cid ORDER BY p.province_code NULLS FIRST,
        p.city_code NULLS FIRST, p.county_code NULLS FIRST) AS rank
    FROM companies c
    LEFT JOIN (SELECT code, min(name) AS name FROM company_types GROUP BY code) t ON t.code = c.company_type
    LEFT JOIN (SELECT DISTINCT cid, province_code, city_code, county_code FROM projects
               WHERE status IN (3, 4, 5) AND is_deleted = 1 AND project_condition = 1) p ON p.cid = c.cid
    WHERE c.is_deleted = 1 AND c.status = 3
    """,
    "company_project_rows": """
    SELECT * FROM (
      SELECT c.cid, c.company_type, c.county_code, p.project_type, p.city_code AS project_city_code,
        p.county_code AS project_county_code,
        row_number() OVER (PARTITION BY c.cid, c.company_type ORDER BY p.project_type NULLS FIRST,
          p.province_code NULLS FIRST, p.city_code NULLS FIRST, p.county_code NULLS FIRST) AS type_top
      FROM companies c LEFT JOIN (
        SELECT cid, project_type, province_code, city_code, county_code FROM projects
        WHERE status IN (3, 4, 5) AND is_deleted = 1
        UNION SELECT unit_cid, project_type, province_code, city_code, county_code FROM sub_projects
        WHERE status IN (3, 4) AND is_deleted = 1) p ON p.cid = c.cid
      WHERE c.is_deleted = 1 AND c.status = 3)
    WHERE project_county_code IN (SELECT code FROM areas WHERE parent_code = '1002')
       OR county_code IN (SELECT code FROM areas WHERE parent_code = '1002')
    """,
}
