"""Checks and joins shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the input has {df.columns}")


def fresh_name(df: DataFrame, stem: str, *more: DataFrame) -> str:
    name, taken = f"_{stem}", {c for x in (df, *more) for c in x.columns}
    while name in taken:
        name = f"_{name}"
    return name


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi join in which NULL keys match each other; each key column appears once.

    ``<=>`` is an equi-join condition to Spark, so the join still hashes or sorts on the keys.
    """
    renamed = {k: f"_r_{k}" for k in keys}
    cond = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()]
    )
    joined = left.join(right.withColumnsRenamed(renamed), cond, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*renamed.values())


def no_clash(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    clash = [c for c in right.columns if c in left.columns and c not in keys]
    if clash:
        raise ValueError(f"columns {clash} are on both sides; rename or drop them first")


def keyed_join(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str = "left"
) -> DataFrame:
    """Equi join on differently named columns; the right side's keys are dropped.

    Right-side columns that the left side already has raise, so no name is ambiguous.
    """
    require(left, [a for a, _ in on])
    require(right, [b for _, b in on])
    renamed = {b: f"_r_{b}" for _, b in on}
    no_clash(left, right, list(renamed))
    cond = reduce(lambda a, b: a & b, [F.col(a) == F.col(renamed[b]) for a, b in on])
    joined = left.join(right.withColumnsRenamed(renamed), cond, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*renamed.values())
