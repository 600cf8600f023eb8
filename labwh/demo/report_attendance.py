"""Attendance reports on the derived detail tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from labwh.demo.registry import half_up, query
from labwh.demo.report_views import UNITS, VIEWS, audit
from labwh.demo.roles import AS_OF_REPORTS, AS_OF_SWIPES, OUR_CITY, Roles, details, with_roles
from labwh.demo.tables import Tables
from labwh.plans import attendance as plan
from labwh.plans.labourers import resume_detail

PAIR_VALUES = f"""
    SELECT CAST(pid AS VARCHAR) || year(d) || lpad(CAST(month(d) AS VARCHAR), 2, '0')
             || lpad(CAST(day(d) AS VARCHAR), 2, '0') AS id,
      pid, full_name, coalesce(in_card, out_card) AS idcardno, coalesce(in_up, out_up) AS insert_time,
      d AS record_date, CAST(year(d) AS INTEGER) AS record_year, CAST(month(d) AS INTEGER) AS record_month,
      CAST(day(d) AS INTEGER) AS record_day, in_sn, CAST(hour(tin) AS INTEGER) AS in_record_hour,
      CAST(minute(tin) AS INTEGER) AS in_record_minute, out_sn, CAST(hour(tout) AS INTEGER) AS out_record_hour,
      CAST(minute(tout) AS INTEGER) AS out_record_minute,
      {half_up("(date_diff('second', tin, tout) / 3600.0::DOUBLE)", 1)} AS worktime,
      CASE WHEN date_diff('second', tin, tout) >= 0 THEN 0 ELSE 1 END AS attendance_status
    FROM swipe_pairs
"""


@query(oracle=with_roles(f"""
    SELECT *, row_number() OVER (PARTITION BY pid ORDER BY record_date DESC) AS rank
    FROM ({PAIR_VALUES})""", VIEWS))
def report_daily_attendance(t: Tables) -> DataFrame:
    return plan.daily_attendance(Roles(t).swipes)


@query(oracle=with_roles(PAIR_VALUES, VIEWS))
def report_daily_attendance_keyed(t: Tables) -> DataFrame:
    return plan.daily_attendance_keyed(Roles(t).swipes)


@query(oracle=with_roles("""
    SELECT a.idcardno, a.full_name, 1 AS attendance_status,
      CASE WHEN EXISTS (SELECT 1 FROM labourers l WHERE upper(l.id_card_no) = upper(a.idcardno)
        AND l.real_grade <> 99 AND l.is_deleted = 1) THEN 1 ELSE 0 END AS is_realname,
      CASE WHEN EXISTS (SELECT 1 FROM wages w WHERE upper(w.id_card_no) = upper(a.idcardno)
        AND w.create_time > TIMESTAMP '2001-03-01 00:00:00' AND w.status = 1 AND w.is_labourer = 1
        AND w.is_deleted = 1) THEN 1 ELSE 0 END AS salary_status,
      p.project_name, p.project_condition, c.name AS county_name
    FROM (SELECT pid, d, coalesce(in_card, out_card) AS idcardno, full_name, coalesce(in_sn, out_sn) AS sn
          FROM swipe_pairs QUALIFY row_number() OVER (PARTITION BY pid ORDER BY d DESC) = 1) a
    LEFT JOIN (SELECT sn, pid FROM devices WHERE isdelete = 'N' AND is_show AND is_enable
               QUALIFY row_number() OVER (PARTITION BY sn ORDER BY create_time DESC, pid DESC) = 1) e
      ON e.sn = a.sn
    LEFT JOIN projects p ON p.pid = e.pid AND p.status IN (3, 4, 5) AND p.is_deleted = 1
    LEFT JOIN areas c ON c.code = p.county_code AND c.parent_code = '1002' AND c.level = 3
    WHERE a.d >= DATE '2024-01-15'
""", VIEWS))
def report_returned_workers(t: Tables) -> DataFrame:
    r = Roles(t)
    return plan.returned_workers(
        plan.daily_attendance(r.swipes), r.labourers, r.wages, r.projects, r.sub_projects, r.devices,
        r.areas, dt.date(2024, 1, 15), dt.date(2001, 3, 1), OUR_CITY,
    )


@query(oracle=with_roles("""
    SELECT pid, sn, direct, idcardno, full_name, coalesce(mobile, '无') AS mobile,
      coalesce(tid, '无') AS tid, record_time, coalesce(insert_time, record_time) AS insert_time,
      coalesce(equp_name, '无') AS equp_name, coalesce(photo_path, '无') AS photo_path,
      coalesce(app_key, '无') AS app_key, CAST(year(record_time) AS INTEGER) AS date_year,
      CAST(month(record_time) AS INTEGER) AS date_month
    FROM swipes WHERE idcardno IS NOT NULL AND record_time >= TIMESTAMP '2024-01-01 00:00:00'
      AND record_time < TIMESTAMP '2024-02-01 00:00:00'
"""))
def report_swipe_detail(t: Tables) -> DataFrame:
    return plan.swipe_detail(Roles(t).swipes, AS_OF_SWIPES, 0, 1)


@query(oracle=with_roles("""
    SELECT pid, sn, direct, idcardno, full_name, coalesce(mobile, '无') AS mobile, tid, record_time,
      record_time AS insert_time, equp_name, photo_path, coalesce(app_key, '无') AS app_key
    FROM swipes WHERE idcardno IS NOT NULL AND insert_time IS NULL
      AND record_time >= TIMESTAMP '2024-01-01 00:00:00'
"""))
def report_missing_upload(t: Tables) -> DataFrame:
    return plan.missing_upload(Roles(t).swipes, AS_OF_SWIPES)


@query(oracle=with_roles("""
    SELECT sn, idcardno, CAST(date_trunc('month', record_time) AS DATE) AS record_time,
      CAST(year(any_value(record_time)) AS INTEGER) AS date_year,
      CAST(month(any_value(record_time)) AS INTEGER) AS date_month
    FROM swipes WHERE idcardno IS NOT NULL AND record_time >= TIMESTAMP '2023-12-01 00:00:00'
    GROUP BY sn, idcardno, CAST(date_trunc('month', record_time) AS DATE)
"""))
def report_swipe_months(t: Tables) -> DataFrame:
    return plan.swipe_months(Roles(t).swipes, AS_OF_SWIPES, -1)


@query(oracle=with_roles("""
    SELECT pid, sn, record_time,
      CAST(pid AS VARCHAR) || CAST(CAST(floor(epoch(record_time)) AS BIGINT) AS VARCHAR) AS id
    FROM swipes WHERE record_time > TIMESTAMP '2024-01-10 12:00:00' AND pid = 7
"""))
def report_swipe_projection(t: Tables) -> DataFrame:
    rows = plan.swipe_projection(Roles(t).swipes, dt.datetime(2024, 1, 10, 12), 7)
    return rows.select("id", "pid", "sn", "record_time")


@query(oracle=with_roles("""
    SELECT sn, full_name, idcardno, pid, count(*) AS swipes FROM swipes
    WHERE strftime(record_time, '%Y-%m') = '2024-01' AND sn IN ('SN0', 'SN16', 'SN24')
    GROUP BY ALL
"""))
def report_device_swipe_counts(t: Tables) -> DataFrame:
    return plan.device_swipe_counts(Roles(t).swipes, dt.date(2024, 1, 1), ["SN0", "SN16", "SN24"])


@query(oracle=with_roles("""
    SELECT app_key, direct, equp_name, full_name, idcardno, insert_time, pid, record_time, sn, tid
    FROM swipes WHERE strftime(insert_time, '%Y-%m-%d') = '2024-01-06'
"""))
def report_swipes_uploaded_on(t: Tables) -> DataFrame:
    return plan.swipes_uploaded_on(Roles(t).swipes, dt.date(2024, 1, 6))


@query(oracle=with_roles("""
    SELECT full_name, idcardno, pid, sn, record_time, strftime(record_time, '%Y-%m-%d') AS record_date,
      strftime(record_time, '%Y-%m') AS record_month
    FROM swipes WHERE strftime(record_time, '%Y-%m') = '2024-01' AND sn IN ('SN0', 'SN16', 'SN24')
"""))
def report_device_swipe_list(t: Tables) -> DataFrame:
    return plan.device_swipe_list(Roles(t).swipes, dt.date(2024, 1, 1), ["SN0", "SN16", "SN24"])


def device_details(t: Tables) -> DataFrame:
    r = Roles(t)
    swipes = plan.swipe_detail(r.swipes, AS_OF_SWIPES, -1, 1)
    return plan.device_detail(r.devices, r.projects, swipes, AS_OF_SWIPES)


@query(oracle=with_roles("SELECT * FROM device_details", VIEWS))
def report_device_detail(t: Tables) -> DataFrame:
    return device_details(t)


@query(oracle=with_roles(f"""
    SELECT CAST(s.pid AS VARCHAR) || year(s.d) || lpad(CAST(month(s.d) AS VARCHAR), 2, '0')
             || lpad(CAST(day(s.d) AS VARCHAR), 2, '0') AS id,
      s.full_name, coalesce(s.in_sn, s.out_sn) AS sn, s.d AS record_date, s.in_sn, s.out_sn,
      coalesce({half_up("(date_diff('second', tin, tout) / 3600.0::DOUBLE)", 1)}, 0.0) AS worktime,
      CASE WHEN date_diff('second', tin, tout) >= 0 THEN 1 ELSE 0 END AS attendance_status,
      e.pid, p.project_name, p.county_code, e.isdelete
    FROM swipe_pairs s JOIN devices e ON e.sn = coalesce(s.in_sn, s.out_sn)
    JOIN projects p ON p.pid = e.pid AND p.is_deleted = 1
    WHERE s.d > e.create_time AND (e.isdelete = 'N' OR s.d < e.last_modify_time)
""", VIEWS))
def report_project_attendance(t: Tables) -> DataFrame:
    r = Roles(t)
    rows = plan.project_attendance(r.swipes, r.devices, r.projects, AS_OF_SWIPES)
    return rows.select(
        "id", "full_name", "sn", "record_date", "in_sn", "out_sn", "worktime", "attendance_status",
        "pid", "project_name", "county_code", "isdelete",
    )


def _device_totals_sql(unit: str) -> str:
    made = {"中控": "zk", "海康": "hk", "海清视讯": "hqsx", "赤道": "cd", "其他": "other"}
    inside = UNITS["swipes"][unit]
    here = "FROM device_details e WHERE e.county_code = a.code"
    key = {"day": "'20240119'", "month": "'202401'", "year": "'2024'"}[unit]
    month, day, code = {"day": (1, 19, 1), "month": (1, "NULL", 2), "year": ("NULL", "NULL", 3)}[unit]
    live = "e.isdelete = 'N' AND e.last_modify_time <= DATE '2024-01-19'"
    makers = ", ".join(
        f"(SELECT count(*) {here} AND {live} AND e.dev_manufacturer = '{m}') AS {n}_sn_count"
        for m, n in made.items()
    )
    return f"""
    SELECT a.code || {key} AS id, a.code, a.name,
      (SELECT count(DISTINCT e.sn) {here} AND {live}) AS sn_total_count,
      (SELECT CAST(coalesce(sum(e.{unit}_status), 0) AS BIGINT) {here} AND {live}) AS sn_online_count, {makers},
      (SELECT count(DISTINCT e.sn) {here} AND e.isdelete = 'N' AND {inside.format(ts='e.create_time')})
        AS sn_install_count,
      (SELECT count(DISTINCT e.sn) {here} AND e.isdelete = 'Y' AND {inside.format(ts='e.last_modify_time')})
        AS sn_dismantle_count,
      CAST(2024 AS INTEGER) AS year_time, CAST({month} AS INTEGER) AS month_time, CAST({day} AS INTEGER) AS day_time,
      DATE '2024-01-19' AS process_time, CAST({code} AS INTEGER) AS type
    FROM areas a WHERE a.parent_code = '1002'
    """


def _device_totals(t: Tables, unit: str) -> DataFrame:
    return plan.device_totals(device_details(t), Roles(t).areas, AS_OF_SWIPES, unit, OUR_CITY)


@query(oracle=with_roles(_device_totals_sql("day"), VIEWS))
def report_device_totals_day(t: Tables) -> DataFrame:
    return _device_totals(t, "day")


@query(oracle=with_roles(_device_totals_sql("month"), VIEWS))
def report_device_totals_month(t: Tables) -> DataFrame:
    return _device_totals(t, "month")


@query(oracle=with_roles(_device_totals_sql("year"), VIEWS))
def report_device_totals_year(t: Tables) -> DataFrame:
    return _device_totals(t, "year")


def resumes(t: Tables) -> DataFrame:
    r = Roles(t)
    return resume_detail(
        r.labourers, r.employments, r.projects, r.companies, r.blacklist, r.labourer_banks,
        r.employment_intervals, r.areas, AS_OF_REPORTS,
    )


def _calendar(unit: str, prefix: str = "") -> str:
    """Oracle SQL of the run day's parts and the unit's code."""
    code = {"day": 1, "month": 2, "year": 3}[unit]
    parts = {"year": 2001, "month": 6, "day": 14}
    return ", ".join(f"CAST({v} AS INTEGER) AS {prefix}{n}" for n, v in parts.items()) + f", CAST({code} AS INTEGER) AS type"


def _padded(value: str) -> str:
    """Oracle SQL of a text key's part: two characters at least."""
    return f"CASE WHEN length({value}) < 2 THEN lpad({value}, 2, '0') ELSE {value} END"


def _platform_sql(unit: str) -> str:
    inside = UNITS["reports"][unit].format(ts="job_end_date")
    by = "nativeplace_id, project_city_code, project_county_code"
    kind = "LEFT" if unit == "year" else "FULL OUTER"
    key = {"day": "20010614", "month": "200106", "year": "2001"}[unit]
    city, county = (_padded(f"coalesce(CAST(project_{x}_code AS VARCHAR), '0')") for x in ("city", "county"))
    origin = _padded("coalesce(nullif(CAST(nativeplace_id AS VARCHAR), ''), '99')")
    return f"""
    SELECT *, '{key}' || {city} || {county} || {origin} AS id,
      {_calendar(unit, "date_")}, DATE '2001-06-15' AS process_time
    FROM (
    SELECT coalesce(a.nativeplace_id, b.nativeplace_id) AS nativeplace_id,
      coalesce(a.project_city_code, b.project_city_code) AS project_city_code,
      coalesce(a.project_county_code, b.project_county_code) AS project_county_code,
      coalesce(labourer_total, 0) AS labourer_total, coalesce(onjob_total, 0) AS onjob_total,
      coalesce(offjob_total, 0) AS offjob_total
    FROM (SELECT {by}, count(*) AS labourer_total,
            count(*) FILTER (WHERE is_job = 1 AND CAST(job_date AS DATE) < DATE '2001-06-15') AS onjob_total
          FROM resume_details WHERE lab_top = 1 GROUP BY ALL) a
    {kind} JOIN (SELECT {by}, count(DISTINCT id_card_no) AS offjob_total
          FROM resume_details WHERE is_job = 0 AND {inside} GROUP BY ALL) b
      ON a.nativeplace_id = b.nativeplace_id AND a.project_city_code = b.project_city_code
     AND a.project_county_code = b.project_county_code)
    """


def _platform(t: Tables, unit: str) -> DataFrame:
    return plan.platform_totals(details(t).resumes(), AS_OF_REPORTS, unit)


@query(oracle=with_roles(_platform_sql("day"), VIEWS))
def report_platform_totals_day(t: Tables) -> DataFrame:
    return _platform(t, "day")


@query(oracle=with_roles(_platform_sql("month"), VIEWS))
def report_platform_totals_month(t: Tables) -> DataFrame:
    return _platform(t, "month")


@query(oracle=with_roles(_platform_sql("year"), VIEWS))
def report_platform_totals_year(t: Tables) -> DataFrame:
    return _platform(t, "year")


def _project_totals_sql(unit: str) -> str:
    key = {"day": "'20010614'", "month": "'200106'", "year": "'2001'"}[unit]
    return f"""
    SELECT CAST(pid AS VARCHAR) || {key} AS id, pid, project_name, project_province_code, project_city_code, project_county_code,
      count(id_card_no) AS labourer_total, count(*) FILTER (WHERE is_job = 1) AS on_job_count,
      count(*) FILTER (WHERE is_job = 0 AND {UNITS["reports"][unit].format(ts='job_end_date')})
        AS off_job_count, {_calendar(unit)}, DATE '2001-06-15' AS process_time
    FROM resume_details WHERE pid IS NOT NULL
    GROUP BY pid, project_name, project_province_code, project_city_code, project_county_code
    """


def _project_totals(t: Tables, unit: str) -> DataFrame:
    return plan.project_totals(resumes(t), AS_OF_REPORTS, unit)


@query(oracle=with_roles(_project_totals_sql("day"), VIEWS))
def report_project_totals_day(t: Tables) -> DataFrame:
    return _project_totals(t, "day")


@query(oracle=with_roles(_project_totals_sql("month"), VIEWS))
def report_project_totals_month(t: Tables) -> DataFrame:
    return _project_totals(t, "month")


@query(oracle=with_roles(_project_totals_sql("year"), VIEWS))
def report_project_totals_year(t: Tables) -> DataFrame:
    return _project_totals(t, "year")


@query(oracle=with_roles(f"""
    SELECT CAST(p.pid AS VARCHAR) || strftime(m.cur_date, '%Y%m') AS id, p.pid, m.cur_date,
      coalesce(e.real_count, 0) AS real_count, coalesce(s.attendance_count, 0) AS attendance_count,
      CASE WHEN s.attendance_count > 0 THEN 3 ELSE 1 END AS status, 1 AS is_exception, p.is_deleted,
      CAST(year(m.cur_date) AS INTEGER) AS cur_date_year, CAST(month(m.cur_date) AS INTEGER) AS cur_date_month,
      CAST(year(m.cur_date) AS INTEGER) AS date_year, CAST(month(m.cur_date) AS INTEGER) AS date_month,
      {audit(AS_OF_SWIPES, is_deleted=False)}
    FROM projects p CROSS JOIN (SELECT DATE '2023-12-01' AS cur_date UNION ALL SELECT DATE '2024-01-01') m
    LEFT JOIN (
      SELECT i.source_pid, x.cur_date, count(DISTINCT i.id_card_no) AS real_count
      FROM employment_intervals i, (SELECT DATE '2023-12-01' AS cur_date UNION ALL SELECT DATE '2024-01-01') x
      WHERE i.is_deleted = 1 AND i.endtime >= x.cur_date AND i.starttime < x.cur_date + INTERVAL 1 MONTH
      GROUP BY 1, 2) e ON e.source_pid = p.pid AND e.cur_date = m.cur_date
    LEFT JOIN (
      SELECT d.pid, CAST(date_trunc('month', w.record_time) AS DATE) AS cur_date,
        count(DISTINCT w.idcardno) AS attendance_count
      FROM devices d JOIN swipes w ON w.sn = d.sn
      WHERE d.isdelete = 'N' AND EXISTS (
        SELECT 1 FROM employment_intervals i WHERE i.id_card_no = w.idcardno AND i.is_deleted = 1
          AND i.endtime >= date_trunc('month', w.record_time)
          AND i.starttime < date_trunc('month', w.record_time) + INTERVAL 1 MONTH)
      GROUP BY 1, 2) s ON s.pid = p.pid AND s.cur_date = m.cur_date
"""))
def report_real_attendance(t: Tables) -> DataFrame:
    r = Roles(t)
    months = [dt.date(2023, 12, 1), dt.date(2024, 1, 1)]
    swiped = plan.swipe_months(r.swipes, AS_OF_SWIPES, -1)
    return plan.real_attendance(
        r.projects, r.employment_intervals, r.devices, swiped, months, AS_OF_SWIPES
    )


