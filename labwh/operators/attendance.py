"""Swipe pairing, device validity and activity flags."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labwh.functions.dates import in_unit, previous_day
from labwh.operators.common import fresh_name, require


def pair_in_out(
    swipes: DataFrame,
    who: Sequence[str],
    ts: str,
    is_in: Column,
    is_out: Column,
    in_cols: Mapping[str, Column] | None = None,
    out_cols: Mapping[str, Column] | None = None,
    shared: Sequence[str] = (),
    missing_worktime: float | None = None,
    status_ok: int = 0,
) -> DataFrame:
    """One row per person and day: first swipe in, last swipe out, hours, status.

    A single aggregation replaces two rankings and a full outer join, and each map task
    sends at most one partial row per person and day. Ties on the time are broken by the
    remaining carried columns. ``shared`` columns come from the first swipe in, else from
    the last swipe out. The status is ``status_ok`` if both sides exist and out is not
    before in, else ``1 - status_ok``. Hours have one decimal.
    """
    require(swipes, [*who, ts, *shared])
    in_cols, out_cols = dict(in_cols or {}), dict(out_cols or {})
    # min/max of a struct orders by time, then by the carried values.
    carried = [F.col(c) for c in shared]
    first_in = F.struct(
        F.col(ts).alias("at"), *[c.alias(n) for n, c in in_cols.items()], *carried
    )
    last_out = F.struct(
        F.col(ts).alias("at"), *[c.alias(n) for n, c in out_cols.items()], *carried
    )
    sided = swipes.where(is_in | is_out).withColumn("record_date", F.col(ts).cast("date"))
    if in_cols or out_cols or shared:
        lo, hi = F.min(F.when(is_in, first_in)), F.max(F.when(is_out, last_out))
        pairs = sided.groupBy(*who, "record_date").agg(lo.alias("_in"), hi.alias("_out"))
        t_in, t_out = F.col("_in.at"), F.col("_out.at")
    else:
        # Plain times keep the fixed-width hash aggregate.
        lo, hi = F.min(F.when(is_in, F.col(ts))), F.max(F.when(is_out, F.col(ts)))
        pairs = sided.groupBy(*who, "record_date").agg(lo.alias("_in"), hi.alias("_out"))
        t_in, t_out = F.col("_in"), F.col("_out")

    seconds = _epoch_seconds(t_out) - _epoch_seconds(t_in)
    hours = F.round(seconds / F.lit(3600), 1)
    if missing_worktime is not None:
        hours = F.coalesce(hours, F.lit(float(missing_worktime)))
    ok = t_in.isNotNull() & t_out.isNotNull() & (seconds >= 0)
    return pairs.select(
        *who,
        "record_date",
        t_in.alias("in_time"),
        t_out.alias("out_time"),
        *[F.col(f"_in.{n}").alias(n) for n in in_cols],
        *[F.col(f"_out.{n}").alias(n) for n in out_cols],
        *[F.coalesce(F.col(f"_in.{n}"), F.col(f"_out.{n}")).alias(n) for n in shared],
        hours.alias("worktime"),
        F.when(ok, F.lit(status_ok)).otherwise(F.lit(1 - status_ok)).alias("attendance_status"),
    )


def _epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts.cast("timestamp"))


#: Parts that the events of an asset and period are dealt to, beside the periods.
VALIDITY_PARTS = 8


def within_validity(
    events: DataFrame,
    assets: DataFrame,
    on: str,
    ts: str,
    installed: str,
    removed: str,
    active: Column,
    periods: Sequence[dt.date] = (),
    unique: Sequence[str] = (),
) -> DataFrame:
    """Events on an asset strictly after its first day and, once removed, strictly before its
    last day. The asset's columns are added; ``active`` is a condition on the asset. An asset listed several
    times gives a row for each listing in force.

    Events and bounds are merged in one shuffle and read in the order of their days: the listings that began
    are carried forward to the events behind them. Each input is read once and no key is counted.

    An asset with very many events is cut by time: ``periods`` are dates at which to cut (months of the
    job, say), and events before the first and after the last one are periods of their own, so any dates
    give the same result. Inside a period its events are dealt to parts by a hash of ``unique``, columns that tell
    events apart (all if not given). A listing goes to the parts of the periods that it touches.
    """
    require(events, [on, ts, *unique])
    require(assets, [on, installed, removed])
    clash = [c for c in assets.columns if c in events.columns and c != on]
    if clash:
        raise ValueError(f"columns {clash} are on both sides; rename or drop them first")
    period, part, day, asset, began = (fresh_name(events, x) for x in ("period", "part", "day", "asset", "began"))
    cuts = sorted(set(periods))

    def period_of(date: Column) -> Column:
        return sum((F.when(date >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))

    first, last = F.col(installed).cast("date"), F.col(removed).cast("date")
    in_force = F.coalesce(active, F.lit(False))
    # A listing without a first day, or removed without a last one, never counts.
    listed = assets.where(first.isNotNull() & F.col(on).isNotNull() & (in_force | (last > first)))
    listed = listed.select(
        on, first.alias(began), last.alias(day), in_force.alias("_on"), F.struct(*assets.columns).alias(asset)
    )
    until = F.when(F.col("_on"), F.lit(len(cuts))).otherwise(period_of(F.col(day)))
    box = F.struct(F.col(began).alias("began"), F.col(day).alias("ended"), F.col("_on").alias("on"), F.col(asset).alias("row"))
    bounds = listed.select(
        on, F.col(began).alias(day), box.alias(asset), F.explode(F.sequence(period_of(F.col(began)), until)).alias(period)
    )
    bounds = bounds.withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(VALIDITY_PARTS - 1))))
    at = F.col(ts).cast("date")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in unique or events.columns]), F.lit(VALIDITY_PARTS)).cast("int")
    moved = events.where(F.col(on).isNotNull() & at.isNotNull()).withColumns(
        {day: at, period: period_of(at), part: salt}
    )
    merged = moved.unionByName(bounds, allowMissingColumns=True)
    w = Window.partitionBy(on, period, part).orderBy(day).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    carried = merged.withColumn(began, F.collect_list(asset).over(w)).where(F.col(asset).isNull())
    here = F.filter(
        began,
        lambda x: (F.datediff(F.col(day), x["began"]) > 0) & (x["on"] | F.coalesce(F.datediff(x["ended"], F.col(day)) > 0, F.lit(False))),
    )
    rows = carried.withColumn(asset, F.explode(here))
    added = [F.col(f"{asset}.row.{c}").alias(c) for c in assets.columns if c != on]
    return rows.select(*events.columns, *added)


def active_by_window(
    events: DataFrame, key: str, ts: str, as_of: dt.date, names: Mapping[str, str]
) -> DataFrame:
    """Per key 1/0: any event on the day, in the month, in the year of the day before
    ``as_of``. ``names`` maps a unit to its output column. One scan serves all units and
    the filter to the widest unit reaches it."""
    require(events, [key, ts])
    day = previous_day(as_of)
    units = [u for u in ("year", "month", "day") if u in names]
    return (
        events.where(in_unit(ts, day, units[0]))
        .groupBy(key)
        .agg(*[
            F.max(F.when(in_unit(ts, day, u), 1).otherwise(0)).alias(n) for u, n in names.items()
        ])
    )
