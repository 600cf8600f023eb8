"""Attendance reports: daily pairs, devices, head counts by day, month and year."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.functions import (
    MISSING_TEXT,
    calendar_parts,
    in_unit,
    live,
    month_of,
    month_start,
    months_window,
    previous_day,
    text_key,
)
from labwh.operators import (
    active_by_window,
    active_in_period,
    conditional_measures,
    count_if,
    entity_periods,
    flag_exists,
    keyed_join,
    latest_per_key,
    merged_spans,
    met_if,
    outer_merge,
    pair_in_out,
    rank_within,
    scaffold,
    sum_if,
    with_children,
    within_validity,
)
from labwh.plans.common import (
    UNIT_CODES,
    UNVERIFIED_GRADE,
    add_names,
    areas_below,
    open_projects,
    stamp,
)
from labwh.sources.readers import partition_months

# Fixed values.
SWIPE_IN, SWIPE_OUT = 1, 2
MAKERS = {"中控": "zk", "海康": "hk", "海清视讯": "hqsx", "赤道": "cd", "其他": "other"}
DETAIL_DEFAULTS = ("mobile", "tid", "equp_name", "photo_path", "app_key")
SWIPE_COLUMNS = (
    "pid", "sn", "direct", "idcardno", "full_name", "mobile", "tid", "record_time",
    "insert_time", "equp_name", "photo_path", "app_key",
)


def _pairs(swipes: DataFrame, shared: Sequence[str], **variant) -> DataFrame:
    """Daily in/out pair per person with the calendar columns of the reports."""
    pairs = pair_in_out(
        swipes,
        ["pid"],
        "record_time",
        F.col("direct") == SWIPE_IN,
        F.col("direct") == SWIPE_OUT,
        in_cols={"in_sn": F.col("sn")},
        out_cols={"out_sn": F.col("sn")},
        shared=shared,
        **variant,
    )
    cols = calendar_parts("record_date", "record", upto="day")
    for side in ("in", "out"):
        cols[f"{side}_record_hour"] = F.hour(f"{side}_time")
        cols[f"{side}_record_minute"] = F.minute(f"{side}_time")
    pairs = pairs.withColumns(cols)
    return pairs.withColumn("id", text_key("pid", "record_year", "record_month", "record_day"))


PAIR_COLUMNS = (
    "id", "pid", "full_name", "idcardno", "insert_time", "record_date", "record_year",
    "record_month", "record_day", "in_sn", "in_record_hour", "in_record_minute", "out_sn",
    "out_record_hour", "out_record_minute", "worktime", "attendance_status",
)


def daily_attendance(swipes: DataFrame) -> DataFrame:
    """Person × day: in and out device, hour, minute, work hours, status (abnormal 1), recency.

    A person has at most one row per calendar day, so the recency rank needs no split.
    """
    pairs = _pairs(swipes, ["full_name", "idcardno", "insert_time"])
    latest = F.coalesce("in_time", "out_time").desc()
    return rank_within(pairs, ["pid"], [latest], "rank").select(*PAIR_COLUMNS, "rank")


def daily_attendance_keyed(swipes: DataFrame) -> DataFrame:
    """As :func:`daily_attendance` without the rank; rows without a key are left out."""
    pairs = _pairs(swipes, ["full_name", "idcardno", "insert_time"])
    return pairs.where(F.col("id").isNotNull()).select(*PAIR_COLUMNS)


def returned_workers(
    attendance: DataFrame,
    labourers: DataFrame,
    wages: DataFrame,
    projects: DataFrame,
    sub_projects: DataFrame,
    devices: DataFrame,
    areas: DataFrame,
    since: dt.date,
    paid_since: dt.date,
    city: str,
) -> DataFrame:
    """Workers whose latest attendance day is on or after ``since``: verified, paid after
    ``paid_since``, and the project of the device they used. Ids match in any letter case."""
    latest = attendance.where((F.col("record_date") >= F.lit(since)) & (F.col("rank") == 1))
    rows = latest.select(
        "idcardno",
        "full_name",
        F.coalesce("in_sn", "out_sn").alias("sn"),
        F.upper("idcardno").alias("who"),
    )
    verified = labourers.where((F.col("real_grade") != UNVERIFIED_GRADE) & live())
    paid = wages.where(
        (F.col("create_time") > F.lit(paid_since))
        & (F.col("status") == 1)
        & (F.col("is_labourer") == 1)
        & live()
    )
    rows = flag_exists(rows, verified.select(F.upper("id_card_no").alias("who")), ["who"], "is_realname")
    rows = flag_exists(rows, paid.select(F.upper("id_card_no").alias("who")), ["who"], "salary_status")

    opened = open_projects(projects)
    tree = with_children(opened, "pid", sub_projects.where(live()), "pid", "source_pid")
    facts = opened.select(
        F.col("pid").alias("source_pid"), "project_name", "project_condition", "county_code"
    )
    placed = tree.join(facts, "source_pid")
    usable = devices.where((F.col("isdelete") == "N") & F.col("is_show") & F.col("is_enable"))
    current = latest_per_key(
        usable.select("sn", "pid", "create_time"),
        ["sn"],
        [F.col("create_time").desc(), F.col("pid").desc()],
    )
    sites = keyed_join(current.select("sn", "pid"), placed, [("pid", "pid")])
    counties = areas.where((F.col("parent_code") == city) & (F.col("level") == 3))
    sites = add_names(sites, counties.withColumnRenamed("name", "county_name"), "county_code", "code", "county_name")
    sites = sites.select("sn", "project_name", "project_condition", "county_name")
    return keyed_join(rows, sites, [("sn", "sn")]).select(
        "idcardno",
        "full_name",
        F.lit(1).alias("attendance_status"),
        "is_realname",
        "salary_status",
        "project_name",
        "project_condition",
        "county_name",
    )


def swipe_detail(swipes: DataFrame, as_of: dt.date, first: int, last: int) -> DataFrame:
    """Swipes of a month window with defaults, partition columns added."""
    known = F.col("idcardno").isNotNull() & F.col("record_time").isNotNull()
    rows = swipes.where(known & months_window("record_time", as_of, first, last))
    return rows.select(*SWIPE_COLUMNS).withColumns(
        {
            **{c: F.coalesce(F.col(c), F.lit(MISSING_TEXT)) for c in DETAIL_DEFAULTS},
            "insert_time": F.coalesce("insert_time", "record_time"),
            "date_year": F.year("record_time"),
            "date_month": F.month("record_time"),
        }
    )


def missing_upload(swipes: DataFrame, as_of: dt.date, first: int = 0) -> DataFrame:
    """Swipes since a month offset whose upload time is missing."""
    rows = swipes.where(
        F.col("idcardno").isNotNull()
        & F.col("insert_time").isNull()
        & months_window("record_time", as_of, first)
    )
    return rows.select(*SWIPE_COLUMNS).withColumns(
        {
            "insert_time": F.col("record_time"),
            **{c: F.coalesce(F.col(c), F.lit(MISSING_TEXT)) for c in ("mobile", "app_key")},
        }
    )


def swipe_months(swipes: DataFrame, as_of: dt.date, first: int) -> DataFrame:
    """Device × person × month, distinct."""
    rows = swipes.where(F.col("idcardno").isNotNull() & months_window("record_time", as_of, first))
    distinct = rows.select("sn", "idcardno", month_of("record_time").alias("record_time")).distinct()
    return distinct.withColumns(
        {"date_year": F.year("record_time"), "date_month": F.month("record_time")}
    )


def swipe_projection(swipes: DataFrame, since: dt.datetime, pid=None) -> DataFrame:
    """Keyed swipe rows after a time, optionally of one person or project."""
    rows = swipes.where(F.col("record_time") > F.lit(since))
    if pid is not None:
        rows = rows.where(F.col("pid") == pid)
    key = F.concat(
        F.col("pid").cast("string"),
        F.unix_timestamp(F.col("record_time").cast("timestamp")).cast("string"),
    )
    return rows.select(key.alias("id"), *SWIPE_COLUMNS)


def swipes_uploaded_on(swipes: DataFrame, day: dt.date) -> DataFrame:
    """Swipes uploaded on one day."""
    rows = swipes.where(in_unit("insert_time", day, "day"))
    return rows.select(
        "app_key", "direct", "equp_name", "full_name", "idcardno", "insert_time", "pid",
        "record_time", "sn", "tid",
    )


def device_swipe_counts(
    swipes: DataFrame, month: dt.date, devices: Sequence[str], pid=None
) -> DataFrame:
    """Swipes per person and device in one month, for listed devices."""
    rows = swipes.where(in_unit("record_time", month, "month") & F.col("sn").isin(*devices))
    if pid is not None:
        rows = rows.where(F.col("pid") == pid)
    return rows.groupBy("sn", "full_name", "idcardno", "pid").agg(F.count("*").alias("swipes"))


def device_swipe_list(
    swipes: DataFrame, month: dt.date, devices: Sequence[str], pid=None
) -> DataFrame:
    """Swipes of listed devices in one month, latest first."""
    rows = swipes.where(in_unit("record_time", month, "month") & F.col("sn").isin(*devices))
    if pid is not None:
        rows = rows.where(F.col("pid") == pid)
    return rows.select(
        "full_name",
        "idcardno",
        "pid",
        "sn",
        "record_time",
        F.date_format("record_time", "yyyy-MM-dd").alias("record_date"),
        F.date_format("record_time", "yyyy-MM").alias("record_month"),
    ).orderBy(F.col("record_time").desc(), "sn", "idcardno")


def _recent_partitions(swipes: DataFrame, day: dt.date) -> DataFrame:
    """Partition filter for the year of ``day`` when the table is partitioned by year."""
    return swipes.where(F.col("date_year") == day.year) if "date_year" in swipes.columns else swipes


def device_detail(
    devices: DataFrame, projects: DataFrame, swipes: DataFrame, as_of: dt.date
) -> DataFrame:
    """Device with project and whether it was used on the day, in the month, in the year before
    the run date."""
    site = open_projects(projects).select(
        "pid", "project_name", "province_code", "city_code", "county_code", "project_condition"
    )
    rows = devices.drop("project_name").join(site, "pid")
    names = {"day": "day_status", "month": "month_status", "year": "year_status"}
    used = active_by_window(
        _recent_partitions(swipes, previous_day(as_of)), "sn", "record_time", as_of, names
    )
    rows = rows.join(used, "sn", "left").fillna(0, subset=list(names.values()))
    return rows.select(
        "id", "pid", "project_name", "province_code", "city_code", "county_code",
        "project_condition", "sn", "equipmentname", "dev_type", "isdelete", "create_time",
        "create_user", "last_modify_time", "last_modify_user", "dev_manufacturer", "is_show",
        "is_enable", *names.values(),
    )


def project_attendance(
    swipes: DataFrame, devices: DataFrame, projects: DataFrame, as_of: dt.date
) -> DataFrame:
    """Person × day pairs since the previous month, joined to the device's project while the
    device was in use. Missing side: 0 hours; normal status 1."""
    day = previous_day(as_of)
    if {"date_year", "date_month"} <= set(swipes.columns):
        # The window is the month of that day and the one before; other partitions are not opened.
        swipes = partition_months(swipes, [month_start(day), month_start(day - dt.timedelta(days=day.day))])
    recent = swipes.where(months_window("record_time", day, -1)).withColumns(
        {"insert_time": F.coalesce("insert_time", "record_time"), "swiped_at": F.col("record_time")}
    )
    pairs = _pairs(
        recent,
        ["full_name", "idcardno", "insert_time", "sn", "swiped_at"],
        missing_worktime=0,
        status_ok=1,
    )
    pairs = pairs.withColumnRenamed("swiped_at", "record_time").drop("pid", "in_time", "out_time")
    site = projects.where(live()).select(
        "pid", "project_name", "province_code", "city_code", "county_code", "project_condition",
        "project_type",
    )
    assets = devices.select(
        "sn", "pid", "equipmentname", "dev_type", "dev_manufacturer", "create_time",
        "last_modify_time", "isdelete", "is_show", "is_enable",
    ).join(site, "pid")
    rows = within_validity(
        pairs, assets, "sn", "record_time", "create_time", "last_modify_time",
        F.col("isdelete") == "N", periods=[month_start(day)], unique=["id"],
    )
    return rows.withColumns(
        {"date_year": F.col("record_year"), "date_month": F.col("record_month")}
    )


def _any(cond: Column) -> Column:
    return F.max(F.when(cond, 1).otherwise(0))


def device_totals(
    device_details: DataFrame, areas: DataFrame, as_of: dt.date, unit: str, city: str
) -> DataFrame:
    """County: devices in place, used, by maker, installed and removed in the day, month or year
    before the run date. One scan serves all measures."""
    day = previous_day(as_of)
    active, gone = F.col("isdelete") == "N", F.col("isdelete") == "Y"
    in_place = active & (F.col("last_modify_time") < F.lit(as_of))
    # Devices are counted once per serial number; the other measures count rows.
    per_sn = device_details.groupBy("county_code", "sn").agg(
        _any(in_place).alias("placed"),
        _any(active & in_unit("create_time", day, unit)).alias("installed"),
        _any(gone & in_unit("last_modify_time", day, unit)).alias("removed"),
        sum_if(in_place, f"{unit}_status").alias("online"),
        *[count_if(in_place & (F.col("dev_manufacturer") == m)).alias(n) for m, n in MAKERS.items()],
    )
    known = F.col("sn").isNotNull()
    merged = per_sn.groupBy("county_code").agg(
        sum_if(known, "placed").alias("sn_total_count"),
        F.sum("online").alias("sn_online_count"),
        *[F.sum(n).alias(f"{n}_sn_count") for n in MAKERS.values()],
        sum_if(known, "installed").alias("sn_install_count"),
        sum_if(known, "removed").alias("sn_dismantle_count"),
    )
    rows = scaffold(areas_below(areas, city), merged, [("code", "county_code")])
    parts = {"year_time": day.year, "month_time": day.month, "day_time": day.day}
    kept = list(parts.values())[: {"year": 1, "month": 2, "day": 3}[unit]]
    known = dict(zip(parts, kept))
    return rows.withColumns(
        {
            "id": text_key("code", *[F.lit(v) for v in kept]),
            **{n: F.lit(known.get(n)).cast("int") for n in parts},
            "process_time": F.lit(day),
            "type": F.lit(UNIT_CODES[unit]),
        }
    )


def platform_totals(resumes: DataFrame, as_of: dt.date, unit: str) -> DataFrame:
    """Origin × city × county: workers, on the job, left in the unit before the run date.

    Day and month keep groups that only have leavers; the year keeps groups with workers.
    Groups without an origin are not merged with each other, as the source join is on
    equality; their id carries 99 in its place.
    """
    day = previous_day(as_of)
    by = ["nativeplace_id", "project_city_code", "project_county_code"]
    started = F.col("job_date").cast("date") < F.lit(as_of)
    current = conditional_measures(
        resumes.where(F.col("lab_top") == 1),
        by,
        {
            "labourer_total": (F.lit(True), None),
            "onjob_total": ((F.col("is_job") == 1) & started, None),
        },
    )
    gone = resumes.where((F.col("is_job") == 0) & in_unit("job_end_date", day, unit))
    left = gone.groupBy(*by).agg(F.countDistinct("id_card_no").alias("offjob_total"))
    if unit == "year":
        rows = current.join(left, by, "left").fillna(0, subset=["offjob_total"])
    else:
        rows = outer_merge(by, current, left, null_keys="apart")
    origin = F.coalesce(F.col("nativeplace_id").cast("string"), F.lit("99"))
    parts = [day.year, day.month, day.day][: {"year": 1, "month": 2, "day": 3}[unit]]
    key = text_key(
        F.lit(parts[0]),
        *[F.lit(p) for p in parts[1:]],
        F.coalesce(F.col("project_city_code").cast("string"), F.lit("0")),
        F.coalesce(F.col("project_county_code").cast("string"), F.lit("0")),
        F.when(origin == "", "99").otherwise(origin),
    )
    return rows.withColumns(
        {
            "id": key,
            "date_year": F.lit(day.year),
            "date_month": F.lit(day.month),
            "date_day": F.lit(day.day),
            "process_time": F.lit(as_of),
            "type": F.lit(UNIT_CODES[unit]),
        }
    )


def project_totals(resumes: DataFrame, as_of: dt.date, unit: str) -> DataFrame:
    """Project: workers, on the job, left in the day, month or year before the run date."""
    day = previous_day(as_of)
    by = ["pid", "project_name", "project_province_code", "project_city_code", "project_county_code"]
    left = (F.col("is_job") == 0) & in_unit("job_end_date", day, unit)
    rows = conditional_measures(
        resumes.where(F.col("pid").isNotNull()),
        by,
        {
            "labourer_total": (F.col("id_card_no").isNotNull(), None),
            "on_job_count": (F.col("is_job") == 1, None),
            "off_job_count": (left, None),
        },
    )
    parts = [day.year, day.month, day.day][: {"year": 1, "month": 2, "day": 3}[unit]]
    return rows.withColumns(
        {
            "id": text_key("pid", *[F.lit(p) for p in parts]),
            "year": F.lit(day.year),
            "month": F.lit(day.month),
            "day": F.lit(day.day),
            "process_time": F.lit(as_of),
            "type": F.lit(UNIT_CODES[unit]),
        }
    )


def real_attendance(
    projects: DataFrame,
    employment_intervals: DataFrame,
    devices: DataFrame,
    person_months: DataFrame,
    months: Sequence[dt.date],
    as_of: dt.date,
) -> DataFrame:
    """Project × month: people employed, and people employed anywhere who swiped on the
    project's devices; status 3 if any did. All months are served by one pass over each input.
    Dates inside a month stand for the month, so the overlap test starts at its first day.
    """
    months = [month_start(m) for m in months]
    spans = employment_intervals.where(live())
    employed = active_in_period(
        spans, ["source_pid"], "id_card_no", "starttime", "endtime", months, "real_count"
    ).withColumnRenamed("source_pid", "pid")
    at_work = merged_spans(spans, ["id_card_no"], "starttime", "endtime", months, "first", "last")
    wanted = F.lit(False)
    for m in months:
        wanted = wanted | ((F.col("date_year") == m.year) & (F.col("date_month") == m.month))
    swiped = person_months.where(wanted).select(
        "sn", F.col("idcardno").alias("id_card_no"), F.col("record_time").alias("cur_date")
    )
    month = F.year("cur_date") * 12 + F.month("cur_date") - 1
    swiped = swiped.withColumn("month", month).join(
        at_work.withColumnRenamed("id_card_no", "who"),
        (F.col("id_card_no") == F.col("who")) & F.col("month").between(F.col("first"), F.col("last")),
        "left_semi",
    )
    sites = devices.where(F.col("isdelete") == "N").select("sn", "pid").distinct()
    attended = (
        swiped.join(sites, "sn")
        .select("pid", "cur_date", "id_card_no")
        .distinct()
        .groupBy("pid", "cur_date")
        .agg(F.count("*").alias("attendance_count"))
    )
    grid = entity_periods(projects.select("pid", "is_deleted"), months, "cur_date")
    rows = grid.join(employed, ["pid", "cur_date"], "left")
    rows = rows.join(attended, ["pid", "cur_date"], "left")
    rows = rows.fillna(0, subset=["real_count", "attendance_count"])
    return month_report(rows, as_of).withColumns(
        {"status": met_if(F.col("attendance_count") > 0), "is_exception": F.lit(1)}
    )


def month_report(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """Key, calendar, partition and audit columns of a project × month report."""
    y, m = F.year("cur_date"), F.month("cur_date")
    return rows.withColumns(
        {
            "id": text_key("pid", y, m),
            "cur_date_year": y,
            "cur_date_month": m,
            "date_year": y,
            "date_month": m,
            **stamp(as_of, is_deleted=False),
        }
    )
