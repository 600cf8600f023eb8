"""Month-by-month series. One pass over the facts serves any number of periods; the list of
periods is a job argument and enters the plan as literals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labwh.functions.dates import add_months, month_of, month_start
from labwh.functions.labels import MISSING_NAME, month_label
from labwh.operators.common import fresh_name, require
from labwh.operators.measures import running_total, sum_if


def month_shift(
    df: DataFrame, key: str, y: str, m: str, value: str, as_of: dt.date, prefix: str
) -> DataFrame:
    """Per key: sum in the month before ``as_of``, in its month, and in the latest month that
    has rows, with that month's label. Sums without rows are 0."""
    require(df, [key, y, m, value])
    now, prev = month_start(as_of), month_start(as_of, -1)
    monthly = df.groupBy(key, y, m).agg(F.sum(value).alias("_v"))
    at_now = (F.col(y) == now.year) & (F.col(m) == now.month)
    at_prev = (F.col(y) == prev.year) & (F.col(m) == prev.month)
    month_number = F.col(y) * 12 + F.col(m)
    return monthly.groupBy(key).agg(
        sum_if(at_now, "_v").alias(f"{prefix}_this_month"),
        sum_if(at_prev, "_v").alias(f"{prefix}_last_month"),
        F.max_by(F.col("_v"), month_number).alias(f"{prefix}_latest"),
        month_label(F.max_by(F.col(y), month_number), F.max_by(F.col(m), month_number)).alias(
            f"{prefix}_latest_label"
        ),
    )


def with_month_shift(base: DataFrame, shifts: DataFrame, key: str, prefix: str) -> DataFrame:
    """Adds :func:`month_shift` columns to ``base``; keys without rows get 0 and ``--``."""
    out = base.join(shifts, key, "left")
    sums = [f"{prefix}_{n}" for n in ("this_month", "last_month", "latest")]
    label = f"{prefix}_latest_label"
    return out.withColumns({
        **{c: F.coalesce(F.col(c), F.lit(0).cast(shifts.schema[c].dataType)) for c in sums},
        label: F.coalesce(F.col(label), F.lit(MISSING_NAME)),
    })


def entity_periods(entities: DataFrame, periods: Sequence[dt.date], name: str) -> DataFrame:
    """One row per entity and period: the periods are a literal array on each entity row."""
    dates = F.array(*[F.lit(p) for p in periods])
    return entities.withColumn(name, F.explode(dates))


def in_months(ts: str, months: Sequence[dt.date]) -> Column:
    """Rows whose month is listed; the outer range on the raw column reaches the scan."""
    lo, hi = min(months), add_months(max(months), 1)
    c = F.col(ts)
    return (c >= F.lit(lo)) & (c < F.lit(hi)) & month_of(ts).isin([F.lit(x) for x in months])


def period_series(
    entities: DataFrame,
    facts: DataFrame,
    key: str,
    ts: str,
    months: Sequence[dt.date],
    measures: Mapping[str, Column],
    name: str = "cur_date",
    fill: object | None = 0,
) -> DataFrame:
    """One row per (entity, month) with the facts inside the month; entities without facts
    stay with ``fill``. ``measures`` are aggregate expressions."""
    require(entities, [key])
    require(facts, [key, ts])
    months = [month_start(x) for x in months]
    inside = facts.where(in_months(ts, months)).withColumn(name, month_of(ts))
    sums = inside.groupBy(key, name).agg(*[c.alias(n) for n, c in measures.items()])
    grid = entity_periods(entities, months, name)
    out = grid.join(sums, [key, name], "left")
    if fill is None:
        return out
    return out.withColumns({
        n: F.coalesce(F.col(n), F.lit(fill).cast(sums.schema[n].dataType)) for n in measures
    })


def cutoff_of(ts: Column | str, cutoffs: Sequence[dt.date], inclusive: bool = False) -> Column:
    """Earliest cutoff that the row counts for: the first one after ``ts`` (or on it, with
    ``inclusive``); NULL when it lies after all of them."""
    c = F.col(ts) if isinstance(ts, str) else ts
    out = F.lit(None).cast("date")
    for x in sorted(cutoffs, reverse=True):
        hit = c <= F.lit(x) if inclusive else c < F.lit(x)
        out = F.when(hit, F.lit(x)).otherwise(out)
    return out


def before(ts: str, cutoffs: Sequence[dt.date], inclusive: bool = False) -> Column:
    last = F.lit(max(cutoffs))
    return F.col(ts) <= last if inclusive else F.col(ts) < last


def cumulative_sums(
    facts: DataFrame, ts: str, cutoffs: Sequence[dt.date], measures: Mapping[str, Column | str],
    name: str = "cutoff",
) -> DataFrame:
    """Per cutoff the sums over all facts strictly before it, from one pass: facts are added
    up between neighbouring cutoffs and a running sum over the few cutoffs follows."""
    rows = facts.where(before(ts, cutoffs)).withColumn(name, cutoff_of(ts, cutoffs))
    steps = rows.groupBy(name).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    return _run_over_cutoffs(facts, steps, cutoffs, list(measures), name)


def cumulative_distinct(
    facts: DataFrame, ts: str, cutoffs: Sequence[dt.date], ids: Mapping[str, str],
    name: str = "cutoff",
) -> DataFrame:
    """Per cutoff the exact number of distinct ids seen strictly before it.

    Each id is counted at the first cutoff after its first appearance and the counts are
    summed up. All id columns share one scan: rows are turned into (metric, id, time) and
    reduced to the first time per id before the shuffle. Ids of different types go as text.
    """
    mixed = len({facts.schema[c].dataType for c in ids.values()}) > 1
    values = {n: F.col(c).cast("string") if mixed else F.col(c) for n, c in ids.items()}
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), v.alias("id")) for n, v in values.items()])
    seen = (
        facts.where(before(ts, cutoffs))
        .select(F.col(ts).alias("at"), F.explode(pairs).alias("p"))
        .where(F.col("p.id").isNotNull())
        .groupBy(F.col("p.metric").alias("metric"), F.col("p.id").alias("id"))
        .agg(F.min("at").alias("first_seen"))
    )
    steps = (
        seen.withColumn(name, cutoff_of("first_seen", cutoffs))
        .groupBy(name)
        .agg(*[F.count(F.when(F.col("metric") == n, 1)).alias(n) for n in ids])
    )
    return _run_over_cutoffs(facts, steps, cutoffs, list(ids), name)


def _run_over_cutoffs(
    facts: DataFrame, steps: DataFrame, cutoffs: Sequence[dt.date], names: list[str], name: str
) -> DataFrame:
    grid = facts.sparkSession.createDataFrame([(c,) for c in sorted(cutoffs)], f"{name} date")
    full = grid.join(steps, name, "left")
    full = full.withColumns(
        {n: F.coalesce(F.col(n), F.lit(0).cast(steps.schema[n].dataType)) for n in names}
    )
    for n in names:
        full = running_total(full, [name], n, n)
    return full


def latest_up_to(
    entities: DataFrame, facts: DataFrame, key: str, ts: str, cutoffs: Sequence[dt.date],
    carry: Sequence[str], name: str = "cur_date", inclusive: bool = True,
) -> DataFrame:
    """Per (entity, cutoff) the latest fact up to the cutoff; NULL when there is none yet.

    Facts are reduced to the latest one between neighbouring cutoffs; the newest non-NULL of
    them is then carried forward over the few cutoffs of each entity.
    """
    require(facts, [key, ts, *carry])
    box = F.struct(F.col(ts).alias("_at"), *[F.col(c) for c in carry])
    steps = (
        facts.where(before(ts, cutoffs, inclusive))
        .withColumn(name, cutoff_of(ts, cutoffs, inclusive))
        .groupBy(key, name)
        .agg(F.max(box).alias("_box"))
    )
    w = Window.partitionBy(key).orderBy(name)
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = entity_periods(entities, cutoffs, name).join(steps, [key, name], "left")
    out = out.withColumn("_box", F.last("_box", ignorenulls=True).over(w))
    fields = [F.col("_box._at").alias(ts), *[F.col(f"_box.{c}").alias(c) for c in carry]]
    return out.select(*entities.columns, name, *fields)


def active_months(
    intervals: DataFrame, start: str, end: str, months: Sequence[dt.date], name: str = "cur_date"
) -> DataFrame:
    """One row per interval and requested month that it overlaps: ``end >= first day`` and
    ``start < first day of the next month``.

    Intervals are clamped to the requested span first, so an open end (far-away date) costs
    at most one row per requested month; reversed intervals go out. A NULL end never
    overlaps, as in the range test.
    """
    require(intervals, [start, end])
    months = sorted(month_start(x) for x in months)
    lo, hi = months[0], months[-1]
    first = F.greatest(month_of(start), F.lit(lo))
    last = F.least(month_of(end), F.lit(hi))
    meets = (F.col(end) >= F.lit(lo)) & (F.col(start) < F.lit(add_months(hi, 1)))
    spans = intervals.where(meets).withColumn("_first", first).withColumn("_last", last)
    spans = spans.where(F.col("_first") <= F.col("_last"))
    steps = F.sequence(F.col("_first"), F.col("_last"), F.expr("interval 1 month"))
    out = spans.withColumn(name, F.explode(steps)).drop("_first", "_last")
    gaps = add_months(lo, len(months) - 1) != hi
    return out.where(F.col(name).isin([F.lit(x) for x in months])) if gaps else out


def _month_number(date: Column | str) -> Column:
    return F.year(date) * 12 + F.month(date) - 1


def merged_spans(
    intervals: DataFrame, by: Sequence[str], start: str, end: str, months: Sequence[dt.date],
    first: str, last: str,
) -> DataFrame:
    """Per key ``by`` the month spans ``first`` to ``last`` (numbers of months) in which an interval overlaps
    a month, overlapping and neighbouring spans merged. Spans are clamped to the requested months,
    reversed intervals and intervals without a start or an end go out, as the range test has it.

    Equal spans are reduced before the shuffle, so a key brings at most as many rows as there are pairs of
    requested months; merging is one ordered pass with the farthest end so far.
    """
    require(intervals, [*by, start, end])
    months = sorted(month_start(x) for x in months)
    lo, hi = months[0], months[-1]
    meets = (F.col(end) >= F.lit(lo)) & (F.col(start) < F.lit(add_months(hi, 1)))
    a = F.greatest(_month_number(start), F.lit(lo.year * 12 + lo.month - 1))
    b = F.least(_month_number(end), F.lit(hi.year * 12 + hi.month - 1))
    spans = intervals.where(meets).select(*by, a.alias(first), b.alias(last)).where(F.col(first) <= F.col(last))
    spans = spans.distinct()
    w = Window.partitionBy(*by).orderBy(first, last)
    reach = F.max(last).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col(first) > reach + 1, F.lit(True))
    island = fresh_name(intervals, "island")
    marked = spans.withColumn(island, opens).withColumn(
        island, F.count_if(F.col(island)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return marked.groupBy(*by, island).agg(F.min(first).alias(first), F.max(last).alias(last)).drop(island)


def active_in_period(
    intervals: DataFrame, group: Sequence[str], ident: str, start: str, end: str,
    months: Sequence[dt.date], count: str, name: str = "cur_date",
) -> DataFrame:
    """Distinct ids per group and month whose interval overlaps the month; months without any are left out.

    The intervals of one id in a group are merged, so a month counts an id once; a merged span then
    adds one at its first month and takes it away behind its last one, and the running sum of a group's changes is
    its number of ids. Rows do not grow with the number of months before that sum.
    """
    months = sorted({month_start(x) for x in months})
    first, last, at, step, n = (fresh_name(intervals, x) for x in ("first", "last", "at", "step", "n"))
    known = intervals.where(F.col(ident).isNotNull())
    spans = merged_spans(known, [*group, ident], start, end, months, first, last)
    change = F.array(
        F.struct(F.col(first).alias("at"), F.lit(1).cast("long").alias("step")),
        F.struct((F.col(last) + 1).alias("at"), F.lit(-1).cast("long").alias("step")),
    )
    changes = spans.select(*group, F.explode(change).alias("c")).select(
        *group, F.col("c.at").alias(at), F.col("c.step").alias(n)
    )
    # Map tasks add up the changes of a month; a group then has at most one row per month.
    steps = changes.groupBy(*group, at).agg(F.sum(n).alias(n))
    listed = steps.groupBy(*group).agg(F.collect_list(F.struct(at, n)).alias(step))
    none = F.lit(0).cast("long")

    def heads_in(month: dt.date) -> Column:
        k = month.year * 12 + month.month - 1
        return F.aggregate(step, none, lambda total, c: total + F.when(c[at] <= k, c[n]).otherwise(none))

    heads = F.array(*[
        F.struct(F.lit(x).alias("month"), heads_in(x).alias("heads")) for x in months
    ])
    out = listed.select(*group, F.explode(heads).alias("h"))
    out = out.select(*group, F.col("h.month").alias(name), F.col("h.heads").alias(count))
    return out.where(F.col(count) > 0)
