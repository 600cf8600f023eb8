"""Merging aggregates and stored with fresh rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwh.operators.common import fresh_name, require


def outer_merge(
    keys: Sequence[str], *frames: DataFrame, fill: object | None = 0, null_keys: str = "together"
) -> DataFrame:
    """All keys of n aggregates, measures side by side, missing measures ``fill``.

    The frames hold one row per key. They are stacked and grouped once, so a key present in
    any subset of them gives one row; inputs already partitioned by the keys are not
    shuffled again. ``null_keys="apart"`` keeps rows with a NULL key separate per input, as
    a full outer join would; ``"together"`` merges them.
    """
    if null_keys not in ("together", "apart"):
        raise ValueError(f"null_keys must be 'together' or 'apart', got {null_keys!r}")
    for f in frames:
        require(f, keys)
    by = list(keys)
    if null_keys == "apart":
        has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        side = fresh_name(frames[0], "side")
        frames = tuple(
            f.withColumn(side, F.when(has_null, i).otherwise(-1)) for i, f in enumerate(frames)
        )
        by.append(side)
    measures: dict[str, object] = {}
    for f in frames:
        for c in f.columns:
            if c in by:
                continue
            if c in measures:
                raise ValueError(f"measure {c} is in two inputs")
            measures[c] = f.schema[c].dataType
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    # One non-NULL value per key at most, so max only picks it.
    merged = stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in measures])
    if fill is not None:
        merged = merged.withColumns(
            {c: F.coalesce(F.col(c), F.lit(fill).cast(t)) for c, t in measures.items()}
        )
    return merged.select(*keys, *measures)


def merge_latest(stored: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored and fresh rows by key: a fresh value wins unless it is NULL; rows that exist on
    one side only are kept. Each side holds one row per key; NULL keys are equal."""
    require(stored, keys)
    require(fresh, stored.columns)
    values = [c for c in stored.columns if c not in keys]
    old = stored.select(*[F.col(c).alias(f"_old_{c}") for c in (*keys, *values)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in keys])
    joined = fresh.select(*stored.columns).join(old, same, "full")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"_old_{c}")).alias(c) for c in stored.columns])


def upsert_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after inserting or fully replacing the rows of ``source`` by key. The source
    must be unique per key, NULL keys are equal; see ``sources.sinks.upsert`` for the check and the write."""
    require(target, keys)
    require(source, target.columns)
    new = source.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    kept = target.join(new, same, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def check_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raises when a key occurs twice. Counts are combined before the shuffle and a single
    offending key is fetched."""
    twice = source.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate key in the rows to merge: {twice[0].asDict()}")
