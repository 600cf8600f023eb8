"""One row per key, rankings inside a key, and amounts counted once per owner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labwh.operators.common import fresh_name, null_safe_join, require


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: int = 1
) -> DataFrame:
    """First ``keep`` rows per key by ``order``; the order must be total.

    Spark limits each map task to ``keep`` rows per key before the shuffle
    (``WindowGroupLimit``), so a key that holds much of the table does not travel whole.
    """
    require(df, keys)
    rn = fresh_name(df, "rn")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= keep).drop(rn)


def latest_values(
    df: DataFrame,
    keys: Sequence[str],
    latest: dict[str, tuple[Column, Sequence[str]]],
    also: Sequence[Column] = (),
) -> DataFrame:
    """Several "latest row" lookups per key from one pass: ``{output: (condition, columns)}``
    keeps, among the rows that meet the condition, the one with the greatest columns (first
    column first) as a struct; NULL when none does. ``also`` adds plain aggregates."""
    require(df, keys)
    picks = [
        F.max(F.when(cond, F.struct(*cols))).alias(name) for name, (cond, cols) in latest.items()
    ]
    return df.groupBy(*keys).agg(*picks, *also)


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    split: Column | None = None,
) -> DataFrame:
    """``row_number`` per key, kept for every row. ``keys`` may be empty (one league table).

    A window sends a whole key to one task. Keys are therefore cut into cells by ``split``, which
    must grow with ``order``: rows that sort earlier have a smaller or equal value, NULL first.
    Each cell is numbered by its own task, starting after the rows of earlier cells; only the
    cell counts meet per key. The rows are shuffled once.

    ``df`` is read for the cells and the rows: hand in a stored table when it is expensive to
    compute. Without ``split`` the caller states that keys are small by nature (days of a person,
    areas of a company).
    """
    require(df, keys)
    if split is None:
        if not keys:
            raise ValueError("a ranking over the whole result needs split")
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w).cast("long"))

    cell, start, n = (fresh_name(df, x) for x in ("cell", "start", "n"))
    celled = df.withColumn(cell, split)
    at = [*keys, cell]
    earlier = Window.partitionBy(*keys).orderBy(F.col(cell).asc_nulls_first())
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(n).over(earlier), F.lit(0))
    counts = celled.groupBy(*at).agg(F.count("*").alias(n))
    # One marker row per cell carries its start into the cell's task and sorts first there.
    markers = counts.select(*at, before.alias(start))
    rows = celled.select(*df.columns, cell).unionByName(markers, allowMissingColumns=True)
    w = Window.partitionBy(*at).orderBy(F.col(start).asc_nulls_last(), *order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offset = F.coalesce(F.first(start).over(so_far) - 1, F.lit(0))
    ranked = rows.withColumn(name, F.row_number().over(w) + offset)
    return ranked.where(F.col(start).isNull()).select(*df.columns, name)


def dense_rank_within(
    df: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    order: Sequence[Column],
    name: str,
    among: DataFrame | None = None,
) -> DataFrame:
    """``dense_rank`` per key by the columns ``by``, in the given order.

    The distinct value tuples are ranked and joined back, so a key with many rows costs
    one task only as many rows as it has distinct tuples. ``among`` may name a cheaper frame
    that holds the same tuples.
    """
    source = df if among is None else among
    require(df, [*keys, *by])
    require(source, [*keys, *by])
    at = [*keys, *by]
    w = Window.partitionBy(*keys).orderBy(*order)
    ranks = source.select(*at).distinct().withColumn(name, F.row_number().over(w).cast("long"))
    return null_safe_join(df, ranks, at, "left")


def sum_once(
    df: DataFrame,
    by: Sequence[str],
    owner: Sequence[str],
    amount: str,
    order: Sequence[Column],
    name: str,
) -> DataFrame:
    """Sum per group in which each owner's amount counts once, on its first row by ``order``.

    Groups without any first row stay, with 0. Rows without an owner count as one owner. One
    pass: each task sends one row per (group, owner), and an owner meets in one task with as
    many rows as it has groups.
    """
    require(df, [*by, *owner, amount])
    rn = fresh_name(df, "rn")
    per_group = latest_per_key(df, [*by, *owner], order)
    w = Window.partitionBy(*owner).orderBy(*order)
    first = per_group.withColumn(rn, F.row_number().over(w))
    total = F.sum(F.when(F.col(rn) == 1, F.col(amount)))
    zero = F.lit(0).cast(df.schema[amount].dataType)
    return first.groupBy(*by).agg(F.coalesce(total, zero).alias(name))
