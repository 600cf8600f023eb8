"""Swipe pairing, device validity and activity on ``events``: who = ``user_id``, swipe in =
``click``, swipe out = ``view``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.demo.registry import half_up, query
from labwh.demo.tables import AS_OF_EVENTS, Tables
from labwh.functions import in_unit, month_of, month_start, months_window, previous_day
from labwh.operators import (
    active_by_window,
    active_in_period,
    active_months,
    entity_periods,
    in_months,
    met_if,
    pair_in_out,
    rank_within,
    within_validity,
)
from labwh.sources.readers import since
from labwh.sources.staging import staged


def is_in() -> Column:
    return F.col("event_type") == "click"


def is_out() -> Column:
    return F.col("event_type") == "view"


PAIRS_CTE = """
    first_in AS (
      SELECT * FROM (
        SELECT user_id, CAST(ts AS DATE) AS d, ts, event_id,
               row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
        FROM events WHERE event_type = 'click') WHERE rn = 1),
    last_out AS (
      SELECT * FROM (
        SELECT user_id, CAST(ts AS DATE) AS d, ts, event_id,
               row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                  ORDER BY ts DESC, event_id DESC) AS rn
        FROM events WHERE event_type = 'view') WHERE rn = 1),
    pairs AS (
      SELECT coalesce(i.user_id, o.user_id) AS user_id, coalesce(i.d, o.d) AS record_date,
             i.event_id AS in_event, i.ts AS in_time, o.event_id AS out_event, o.ts AS out_time,
             date_diff('second', i.ts, o.ts) AS seconds
      FROM first_in i FULL OUTER JOIN last_out o ON i.user_id = o.user_id AND i.d = o.d)
"""


def _pairs(t: Tables, **variant) -> DataFrame:
    return pair_in_out(
        t.events,
        ["user_id"],
        "ts",
        is_in(),
        is_out(),
        in_cols={"in_event": F.col("event_id")},
        out_cols={"out_event": F.col("event_id")},
        **variant,
    )


@query(oracle=f"""
    WITH {PAIRS_CTE}
    SELECT user_id, record_date, in_event, CAST(hour(in_time) AS INTEGER) AS in_hour, CAST(minute(in_time) AS INTEGER) AS in_minute,
           out_event, CAST(hour(out_time) AS INTEGER) AS out_hour, CAST(minute(out_time) AS INTEGER) AS out_minute,
           {half_up("(seconds / 3600.0::DOUBLE)", 1)} AS worktime,
           CASE WHEN in_time IS NULL OR out_time IS NULL OR seconds < 0 THEN 1 ELSE 0 END
             AS attendance_status,
           row_number() OVER (PARTITION BY user_id ORDER BY record_date DESC) AS recency
    FROM pairs
""")
def attendance_pairs(t: Tables) -> DataFrame:
    """First swipe in and last swipe out per user and day; abnormal = 1."""
    ranked = rank_within(_pairs(t), ["user_id"], [F.col("record_date").desc()], "recency")
    return ranked.select(
        "user_id",
        "record_date",
        "in_event",
        F.hour("in_time").alias("in_hour"),
        F.minute("in_time").alias("in_minute"),
        "out_event",
        F.hour("out_time").alias("out_hour"),
        F.minute("out_time").alias("out_minute"),
        "worktime",
        "attendance_status",
        "recency",
    )


@query(oracle=f"""
    WITH {PAIRS_CTE}
    SELECT user_id, record_date, in_event, out_event,
           CASE WHEN seconds IS NULL THEN 0.0
                ELSE {half_up("(seconds / 3600.0::DOUBLE)", 1)} END AS worktime,
           CASE WHEN in_time IS NULL OR out_time IS NULL OR seconds < 0 THEN 0 ELSE 1 END
             AS attendance_status
    FROM pairs
""")
def attendance_pairs_strict(t: Tables) -> DataFrame:
    """Variant with 0 hours for a missing side; normal = 1."""
    return _pairs(t, missing_worktime=0, status_ok=1).select(
        "user_id", "record_date", "in_event", "out_event", "worktime", "attendance_status"
    )


@query(oracle="""
    SELECT DISTINCT event_type AS device, user_id, CAST(date_trunc('month', ts) AS DATE) AS record_month,
           year(ts) AS date_year, month(ts) AS date_month
    FROM events
    WHERE user_id IS NOT NULL AND ts >= TIMESTAMP '2024-01-01 00:00:00'
""")
def swipe_month_distinct(t: Tables) -> DataFrame:
    """Device × user × month, from the month of the run date on."""
    rows = t.events.where(F.col("user_id").isNotNull() & months_window("ts", AS_OF_EVENTS, 0))
    month = rows.select(F.col("event_type").alias("device"), "user_id", month_of("ts").alias("record_month"))
    return month.distinct().withColumns(
        {
            "date_year": F.year("record_month").cast("long"),
            "date_month": F.month("record_month").cast("long"),
        }
    )


@query(oracle="""
    SELECT u.user_id,
           coalesce(d.f, 0) AS day_status, coalesce(m.f, 0) AS month_status,
           coalesce(y.f, 0) AS year_status
    FROM (SELECT DISTINCT user_id FROM events) u
    LEFT JOIN (SELECT user_id, 1 AS f FROM events
               WHERE CAST(ts AS DATE) = DATE '2024-01-19' GROUP BY user_id) d USING (user_id)
    LEFT JOIN (SELECT user_id, 1 AS f FROM events
               WHERE year(ts) = 2024 AND month(ts) = 1 GROUP BY user_id) m USING (user_id)
    LEFT JOIN (SELECT user_id, 1 AS f FROM events
               WHERE year(ts) = 2024 GROUP BY user_id) y USING (user_id)
""")
def device_activity_flags(t: Tables) -> DataFrame:
    """Per user: active on the day, in the month, in the year before the run date."""
    names = {"day": "day_status", "month": "month_status", "year": "year_status"}
    devices = t.events.select("user_id").distinct()
    active = active_by_window(t.events, "user_id", "ts", AS_OF_EVENTS, names)
    return devices.join(active, "user_id", "left").fillna(0, subset=list(names.values()))


@query(oracle="""
    WITH validity AS (
      SELECT user_id, CAST(min(ts) AS DATE) AS installed, CAST(max(ts) AS DATE) AS removed
      FROM events GROUP BY user_id)
    SELECT e.event_id, e.user_id, CAST(e.ts AS DATE) AS event_date, v.installed, v.removed
    FROM events e JOIN validity v ON e.user_id = v.user_id
    WHERE date_diff('day', v.installed, CAST(e.ts AS DATE)) > 0
      AND (v.user_id % 2 = 1 OR date_diff('day', CAST(e.ts AS DATE), v.removed) > 0)
""")
def swipe_in_validity(t: Tables) -> DataFrame:
    """Events strictly after the user's first day and, for even users, before the last."""
    events = staged(t.events.select("event_id", "user_id", "ts"), "swipes")
    span = events.groupBy("user_id").agg(
        F.min("ts").cast("date").alias("installed"), F.max("ts").cast("date").alias("removed")
    )
    kept = within_validity(
        events, span, "user_id", "ts", "installed", "removed", F.col("user_id") % 2 == 1,
        periods=[month_start(AS_OF_EVENTS)], unique=["event_id"],
    )
    return kept.select(
        "event_id", "user_id", F.col("ts").cast("date").alias("event_date"), "installed", "removed"
    )


@query(oracle="""
    WITH employed AS (
      SELECT user_id, user_id % 10 AS project, min(ts) AS starttime, max(ts) AS endtime
      FROM events GROUP BY user_id),
    months AS (SELECT DATE '2024-01-01' AS cur_date UNION ALL SELECT DATE '2024-02-01'),
    at_work AS (
      SELECT m.cur_date, e.project, e.user_id
      FROM employed e JOIN months m
        ON e.endtime >= m.cur_date AND e.starttime < m.cur_date + INTERVAL 1 MONTH),
    swiped AS (
      SELECT DISTINCT w.cur_date, w.project, w.user_id
      FROM at_work w JOIN events c
        ON c.user_id = w.user_id AND c.event_type = 'click'
       AND CAST(date_trunc('month', c.ts) AS DATE) = w.cur_date)
    SELECT p.project, m.cur_date,
           (SELECT count(DISTINCT user_id) FROM at_work w
            WHERE w.project = p.project AND w.cur_date = m.cur_date) AS real_count,
           (SELECT count(*) FROM swiped s
            WHERE s.project = p.project AND s.cur_date = m.cur_date) AS attendance_count,
           CASE WHEN (SELECT count(*) FROM swiped s
                      WHERE s.project = p.project AND s.cur_date = m.cur_date) > 0
                THEN 3 ELSE 1 END AS status
    FROM (SELECT DISTINCT user_id % 10 AS project FROM events) p CROSS JOIN months m
""")
def attended_headcount_month(t: Tables) -> DataFrame:
    """Project × month: users employed in the month, and those of them who swiped."""
    months = [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    spans = t.events.groupBy("user_id").agg(
        F.min("ts").alias("starttime"), F.max("ts").alias("endtime")
    )
    spans = spans.withColumn("project", F.col("user_id") % 10)
    employed = active_in_period(
        spans, ["project"], "user_id", "starttime", "endtime", months, "real_count"
    )
    swiped = t.events.where(is_in() & in_months("ts", months))
    swiped = swiped.select("user_id", month_of("ts").alias("cur_date")).distinct()
    at_work = active_months(spans, "starttime", "endtime", months)
    attended = (
        at_work.join(swiped, ["user_id", "cur_date"], "left_semi")
        .groupBy("project", "cur_date")
        .agg(F.count("*").alias("attendance_count"))
    )
    grid = entity_periods(spans.select("project").distinct(), months, "cur_date")
    out = grid.join(employed, ["project", "cur_date"], "left")
    out = out.join(attended, ["project", "cur_date"], "left")
    out = out.fillna(0, subset=["real_count", "attendance_count"])
    return out.withColumn("status", met_if(F.col("attendance_count") > 0))


@query(oracle="""
    SELECT event_id, user_id, event_type, ts AS event_time, value
    FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'
""")
def incremental_scan(t: Tables) -> DataFrame:
    """Rows after the last run."""
    fresh = since(t.events, "ts", dt.datetime(2024, 1, 20))
    return fresh.select("event_id", "user_id", "event_type", F.col("ts").alias("event_time"), "value")


@query(oracle="""
    SELECT user_id, event_type, count(*) AS swipes, max(ts) AS last_swipe
    FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-19' AND event_type IN ('click', 'view')
    GROUP BY user_id, event_type
""")
def swipes_of_day(t: Tables) -> DataFrame:
    """Swipe counts by user and device on the day before the run date."""
    rows = t.events.where(in_unit("ts", previous_day(AS_OF_EVENTS), "day") & (is_in() | is_out()))
    return rows.groupBy("user_id", "event_type").agg(
        F.count("*").alias("swipes"), F.max("ts").alias("last_swipe")
    )
