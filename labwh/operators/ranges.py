"""Rankings by measured bounds: keys are cut where a sample of their own rows says so."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labwh.operators.common import fresh_name, no_clash, null_safe_join, require
from labwh.operators.measures import attach_totals
from labwh.sources.staging import staged

#: Ranges that all rows together are cut into, per shuffle partition, and sampled rows per range.
RANGES_PER_PARTITION = 4
SAMPLES_PER_RANGE = 32


@dataclass(frozen=True)
class By:
    """A column to order by. NULLs come first when ascending and last when descending, unless told."""

    column: str
    descending: bool = False
    nulls_first: bool | None = None

    @property
    def leading_nulls(self) -> bool:
        return not self.descending if self.nulls_first is None else self.nulls_first

    @property
    def sort(self) -> Column:
        c = F.col(self.column)
        if self.descending:
            return c.desc_nulls_first() if self.leading_nulls else c.desc_nulls_last()
        return c.asc_nulls_first() if self.leading_nulls else c.asc_nulls_last()


def numbered_rows(df: DataFrame, row: str, stem: str = "rows") -> DataFrame:
    """``df`` stored once, with a unique number per row in column ``row``."""
    return staged(df.withColumn(row, F.monotonically_increasing_id()), stem)


def not_after(bound: Column, order: Sequence[By]) -> Column:
    """Whether the struct ``bound`` sorts before the row's own columns, or is equal to them."""
    out = F.lit(True)
    for by in reversed(order):
        a, b = bound[by.column], F.col(by.column)
        out = (
            F.when(a.eqNullSafe(b), out)
            .when(a.isNull(), F.lit(by.leading_nulls))
            .when(b.isNull(), F.lit(not by.leading_nulls))
            .otherwise(a > b if by.descending else a < b)
        )
    return out


def range_bounds(
    df: DataFrame, keys: Sequence[str], order: Sequence[By], name: str, ranges: int, total: int
) -> DataFrame:
    """Per key the bounds of its ranges, as an array of structs in order.

    Rows are picked by a hash of the last order column, which must be unique: about
    ``SAMPLES_PER_RANGE`` rows for each of the ``ranges`` ranges of the whole table. Inside a key every
    ``SAMPLES_PER_RANGE``-th picked row is a bound. A uniform sample is a quantile sketch: a range
    holds its share of the rows give or take a fifth, and all bounds together are at most ``ranges``, whatever
    the size of the table. Keys with few rows have no bound.
    """
    row = order[-1].column
    share = min(1.0, ranges * SAMPLES_PER_RANGE / max(1, total))
    buckets = 1 << 40
    # Scattered by two rounds of hashing, as consecutive numbers should not be picked together.
    lot = F.pmod(F.xxhash64(F.xxhash64(F.col(row))), F.lit(buckets))
    picked = df.where(lot < int(share * buckets)).select(*keys, *[by.column for by in order])
    rn = fresh_name(df, "rn")
    w = Window.partitionBy(*keys).orderBy(*[by.sort for by in order])
    marked = picked.withColumn(rn, F.row_number().over(w)).where(F.col(rn) % SAMPLES_PER_RANGE == 0)
    bound = F.struct(F.col(rn).alias("_rn"), *[F.col(by.column) for by in order])
    return marked.groupBy(*keys).agg(F.sort_array(F.collect_list(bound)).alias(name))


def range_of(bounds: Column, order: Sequence[By], ranges: int) -> Column:
    """Number of bounds that a row does not sort before, by binary search; 0 without bounds."""
    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))

    def halve(span: Column, _: Column) -> Column:
        lo, hi = span["lo"], span["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        below = not_after(F.get(bounds, mid), order)
        return F.struct(
            F.when((lo < hi) & below, mid + 1).otherwise(lo).alias("lo"),
            F.when((lo < hi) & ~below, mid).otherwise(hi).alias("hi"),
        )

    steps = F.array(*[F.lit(i) for i in range(ranges.bit_length() + 1)])
    return F.when(bounds.isNull(), 0).otherwise(F.aggregate(steps, start, halve, lambda s: s["lo"]))


def _cells(
    df: DataFrame, keys: Sequence[str], order: Sequence[By], row: str, bounds: str, cell: str, n: str
) -> tuple[DataFrame, DataFrame]:
    """The rows of a stored table with the number of their key's range, and the rows per range of the keys that are cut."""
    ranges = RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*order, By(row)]
    found = range_bounds(df, keys, order, bounds, ranges, df.count())
    if keys:
        # At most a bound per range, so all of them go to every task; the rows are not shuffled for it.
        cut = null_safe_join(df, F.broadcast(found), keys, "left")
    else:
        cut = attach_totals(df, found.agg(F.max(bounds).alias(bounds)))
    celled = cut.withColumn(cell, range_of(F.col(bounds), order, ranges))
    counts = celled.where(F.col(bounds).isNotNull()).groupBy(*keys, cell).agg(F.count("*").alias(n))
    return celled.drop(bounds), counts


def _numbered(
    celled: DataFrame, counts: DataFrame, keys: Sequence[str], order: Sequence[By], name: str, cell: str, n: str
) -> DataFrame:
    """Adds the number of the row in its key; the rows are dealt by key and range."""
    at = [*keys, cell]
    before = fresh_name(celled, "before")
    earlier = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*at, F.sum(n).over(earlier).alias(before))
    placed = null_safe_join(celled, F.broadcast(starts), at, "left")
    w = Window.partitionBy(*at).orderBy(*[by.sort for by in order])
    rank = F.row_number().over(w) + F.coalesce(F.col(before), F.lit(0).cast("long"))
    return placed.withColumn(name, rank).drop(before)


def rank_by_ranges(
    df: DataFrame, keys: Sequence[str], order: Sequence[By], name: str, row: str | None = None
) -> DataFrame:
    """``row_number`` per key, kept for every row, in which no task gets a whole key. ``keys`` may be
    empty (one league table).

    The rows are stored once. A sample of them gives the bounds that cut each large key into ranges of about
    equal size; a range is numbered by its own task and starts after the counts of the ranges before it.
    The number of a row breaks ties, so rows that are equal in all order columns are cut as well. The
    rows are shuffled once, by key and range; bounds and counts are as many as there are ranges, four per
    shuffle partition, and are broadcast.

    ``row`` names a unique column of a table that is stored already (:func:`numbered_rows`).
    """
    require(df, [*keys, *[by.column for by in order]])
    columns = [c for c in df.columns if c != row]
    if row is None:
        row = fresh_name(df, "row")
        df = numbered_rows(df, row, "ranked")
    bounds, cell, n = (fresh_name(df, x) for x in ("bounds", "cell", "n"))
    celled, counts = _cells(df, keys, order, row, bounds, cell, n)
    return _numbered(celled, counts, keys, [*order, By(row)], name, cell, n).select(*columns, name)


def join_ranked(
    left: DataFrame, df: DataFrame, keys: Sequence[str], order: Sequence[By], name: str, row: str
) -> DataFrame:
    """Left join with the rows of ``df`` and their number per key (:func:`rank_by_ranges`, whose arguments these are).

    The ranges of a key are dealt once, for the numbers and for the join: rows of ``left`` are copied to each
    range of a key that is cut. So a key that holds much of ``df`` stays balanced in the join too, and the rows of
    ``df`` are shuffled once. NULL keys match nothing.
    """
    require(left, keys)
    require(df, [*keys, row, *[by.column for by in order]])
    no_clash(left, df, keys)
    bounds, cell, n, cells = (fresh_name(left, x, df) for x in ("bounds", "cell", "n", "cells"))
    known = df.dropna(subset=list(keys))
    celled, counts = _cells(known, keys, order, row, bounds, cell, n)
    numbered = _numbered(celled, counts, keys, [*order, By(row)], name, cell, n)
    spans = counts.groupBy(*keys).agg(F.collect_list(cell).alias(cells))
    copied = left.join(F.broadcast(spans), list(keys), "left")
    copied = copied.withColumn(cell, F.explode(F.coalesce(F.col(cells), F.array(F.lit(0))))).drop(cells)
    added = [c for c in df.columns if c not in (*keys, row)]
    return copied.join(numbered, [*keys, cell], "left").select(*left.columns, *added, name)
