"""Existence flags: one stacked, pre-aggregated table and one join for any number of flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.operators.common import require
from labwh.operators.spread import spread_join


def key_flags(
    sources: Sequence[tuple[DataFrame, str, Mapping[str, Column]]], key: str
) -> DataFrame:
    """Stacks ``(frame, key column, {flag: condition})`` sources into one row per key with a
    0/1 column per flag. Several flags on one frame share its scan."""
    names = [f for _, _, flags in sources for f in flags]
    if len(set(names)) != len(names):
        raise ValueError(f"flag names must be unique, got {names}")
    stacked = None
    for frame, col, flags in sources:
        require(frame, [col])
        hit = None
        for cond in flags.values():
            hit = cond if hit is None else hit | cond
        part = frame.where(hit & F.col(col).isNotNull()).select(
            F.col(col).alias(key),
            *[
                (F.when(flags[n], 1).otherwise(0) if n in flags else F.lit(0)).alias(n)
                for n in names
            ],
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(key).agg(*[F.max(n).alias(n) for n in names])


def add_flags(
    base: DataFrame,
    key: str,
    sources: Sequence[tuple[DataFrame, str, Mapping[str, Column]]],
    spread: bool | Sequence[str] = False,
) -> DataFrame:
    """Adds a 0/1 column per flag to ``base``; the row count does not change. All flags on
    one key cost one aggregation and one join. ``spread`` is for a base that may repeat one
    key very often; it names the columns that tell the base's rows apart (True: all)."""
    require(base, [key])
    flags = key_flags(sources, key)
    names = [c for c in flags.columns if c != key]
    return _attach(base, flags, [key], spread).withColumns(
        {n: F.coalesce(F.col(n), F.lit(0)) for n in names}
    )


def flag_exists(
    base: DataFrame, other: DataFrame, on: Sequence[str], name: str, spread: bool | Sequence[str] = False
) -> DataFrame:
    """1 if a row with the same key exists in ``other``, else 0. The key may have several
    columns; matches never multiply rows."""
    require(base, on)
    require(other, on)
    hits = other.select(*on).dropna(subset=list(on)).distinct().withColumn(name, F.lit(1))
    joined = _attach(base, hits, on, spread)
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def add_measures(
    base: DataFrame, key: str, *aggregates: DataFrame, spread: bool | Sequence[str] = False
) -> DataFrame:
    """Left-joins per-key aggregates (one row per key each) to ``base``."""
    for a in aggregates:
        base = _attach(base, a, [key], spread)
    return base


def _attach(
    base: DataFrame, per_key: DataFrame, on: Sequence[str], spread: bool | Sequence[str]
) -> DataFrame:
    if spread:
        return spread_join(base, per_key, on, "left", unique=None if spread is True else spread)
    return base.join(per_key, list(on), "left")
