"""Exact distinct counts as bitmaps over dense ids: a day's state is merged into months and years.

A state row holds one bucket of 64 ids as the bits of a long. A row is as narrow as a fact and there are at most as many
as distinct facts, however few ids of a bucket a group has; longs are merged by hash aggregation. Bits are set and merged on the map
side, so a group's ids meet as one row per bucket and task, whatever the number of events, and a longer period is the OR of its days:
nothing is counted again from the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwh.operators.common import null_safe_join, require

UNITS = ("day", "month", "year")


def dense_ids(df: DataFrame, ident: str, name: str, known: DataFrame | None = None) -> DataFrame:
    """``(ident, name)``: a number for each distinct id. Numbers of ids that come from one task are
    consecutive, so buckets are full; they are not consecutive from task to task. The result must be stored before it is
    used twice (``sources.staging.staged``), as a new run may number otherwise.

    With ``known``, an earlier result, its ids keep their numbers and new ones get numbers above.
    """
    require(df, [ident])
    ids = df.where(F.col(ident).isNotNull()).select(ident).distinct()
    number = F.monotonically_increasing_id()
    if known is None:
        return ids.withColumn(name, number)
    above = known.select(F.coalesce(F.max(name), F.lit(-1).cast("long")).alias("top")).scalar()
    new = ids.join(known, ident, "left_anti").withColumn(name, number + above + 1)
    return known.select(ident, name).unionByName(new)


def day_bitmaps(df: DataFrame, by: Sequence[str], ts: str, number: str) -> DataFrame:
    """State of exact distinct counts: one row per group, day and bucket with the bitmap of its ids. ``number`` is a
    dense non-negative number of the id; rows without one or without a time are not counted."""
    require(df, [*by, ts, number])
    ident = F.col(number).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), ident.bitwiseAND(63).cast("int"))
    rows = df.where(F.col(number).isNotNull() & F.col(ts).isNotNull()).select(
        *by, F.col(ts).cast("date").alias("day"), F.shiftright(ident, 6).alias("bucket"), bit.alias("bits"))
    return merge_states(rows, by)


def merge_states(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group, day and bucket from states of several runs."""
    return state.groupBy(*by, "day", "bucket").agg(F.bit_or("bits").alias("bits"))


def distinct_by_unit(state: DataFrame, by: Sequence[str], count: str) -> DataFrame:
    """Per group the exact distinct ids of each day, month and year: columns ``unit``, ``period`` (first day)
    and ``count``. One pass over the state serves all units; no unit is derived from the facts. The state is shuffled once, by
    group and bucket, before its rows are given to their three units."""
    require(state, [*by, "day", "bucket", "bits"])
    starts = F.array(*[
        F.struct(F.lit(i).alias("unit"), (F.trunc("day", u) if u != "day" else F.col("day")).alias("period"))
        for i, u in enumerate(UNITS)
    ])
    # A given number of parts: adaptive execution would join them to as many as there are cores, of any size.
    parts = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = state.repartition(parts, *by, "bucket").select(*by, "bucket", "bits", F.explode(starts).alias("p"))
    merged = rows.groupBy(*by, F.col("p.unit").alias("_unit"), F.col("p.period").alias("_period"), "bucket").agg(F.bit_or("bits").alias("bits"))
    counts = merged.groupBy(*by, "_unit", "_period").agg(F.sum(F.bit_count("bits")).alias(count))
    unit = F.element_at(F.array(*map(F.lit, UNITS)), F.col("_unit") + 1)
    return counts.select(*by, unit.alias("unit"), F.col("_period").alias("period"), count)


def number_column(df: DataFrame, ident: str, ids: DataFrame, name: str) -> DataFrame:
    """``df`` with the dense number of its id."""
    return null_safe_join(df, ids.select(ident, name), [ident], "left")
