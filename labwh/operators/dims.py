"""Dimension lookups, hierarchies, scaffolds and membership splits. No broadcast hint is
given: Spark broadcasts a dimension when its measured size is under the threshold and
shuffles both sides otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.operators.common import keyed_join, require
from labwh.operators.measures import count_if


def lookup_levels(
    df: DataFrame,
    dim: DataFrame,
    outputs: Mapping[str, tuple[str, int | None]],
    code: str = "code",
    name: str = "name",
    level: str = "level",
) -> DataFrame:
    """Adds ``{output: (code column, level)}`` names from one dimension in several roles.

    Unmatched codes give NULL. A code listed twice on a level counts once, so the row count
    does not change. Level None takes the dimension as it is.
    """
    require(dim, [code, name])
    for out, (col, lv) in outputs.items():
        role = dim if lv is None else dim.where(F.col(level) == lv)
        role = role.groupBy(code).agg(F.min(name).alias(out))
        df = keyed_join(df, role, [(col, code)])
    return df


def with_children(
    parents: DataFrame, parent_key: str, children: DataFrame, child_key: str, child_parent: str
) -> DataFrame:
    """Rows ``(source_pid, pid)``: each parent maps to itself and each child of a listed
    parent to that parent, without duplicates."""
    own = parents.select(F.col(parent_key).alias("source_pid"), F.col(parent_key).alias("pid"))
    below = children.select(F.col(child_parent).alias("source_pid"), F.col(child_key).alias("pid"))
    listed = parents.select(F.col(parent_key).alias("source_pid"))
    below = below.join(listed, "source_pid", "left_semi")
    return own.union(below).distinct()


def scaffold(
    dim: DataFrame,
    measures: DataFrame,
    on: Sequence[tuple[str, str]],
    fill: object | None = 0,
) -> DataFrame:
    """Every member of ``dim`` appears; measures without rows get ``fill`` (None keeps NULL)."""
    keys = {b for _, b in on}
    out = keyed_join(dim, measures, on)
    if fill is None:
        return out
    added = [c for c in measures.columns if c not in keys]
    return out.withColumns({
        c: F.coalesce(F.col(c), F.lit(fill).cast(measures.schema[c].dataType)) for c in added
    })


def membership(df: DataFrame, col: str, members: DataFrame, member: str, name: str) -> DataFrame:
    """Adds 'local' (in the set), 'outside' (not in it, non-empty) or 'unknown' (NULL or '')."""
    require(df, [col])
    marks = members.select(F.col(member)).distinct().withColumn("_in", F.lit(True))
    joined = keyed_join(df, marks, [(col, member)])
    blank = F.col(col).isNull() | (F.col(col).cast("string") == "")
    label = F.when(blank, "unknown").when(F.col("_in"), "local").otherwise("outside")
    return joined.withColumn(name, label).drop("_in")


def split_by_membership(
    df: DataFrame,
    by: Sequence[str],
    col: str,
    members: DataFrame,
    member: str,
    ident: str,
    names: Mapping[str, str],
) -> DataFrame:
    """Distinct ``ident`` per group that are local, outside or unknown.

    The ids are made distinct first, so a large group is spread over tasks by id and only
    counts meet per group.
    """
    labelled = membership(df, col, members, member, "_side")
    ids = labelled.where(F.col(ident).isNotNull()).select(*by, ident, "_side").distinct()
    aggs = [count_if(F.col("_side") == side).alias(out) for side, out in names.items()]
    return ids.groupBy(*by).agg(*aggs)


def in_any(df: DataFrame, tests: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Rows whose column is in at least one id set: ``(column, set frame, set column)``,
    the OR of several IN subqueries."""
    marks: list[Column] = []
    out = df
    for i, (col, ids, ident) in enumerate(tests):
        mark = f"_hit{i}"
        keys = ids.select(F.col(ident)).distinct().withColumn(mark, F.lit(True))
        out = keyed_join(out, keys, [(col, ident)])
        marks.append(F.coalesce(F.col(mark), F.lit(False)))
    cond = marks[0]
    for m in marks[1:]:
        cond = cond | m
    return out.where(cond).drop(*[f"_hit{i}" for i in range(len(tests))])


def not_in(df: DataFrame, col: str, ids: DataFrame, ident: str) -> DataFrame:
    """SQL ``NOT IN``: NULL values never qualify; NULLs in the set are dropped, as the set is
    a list of codes."""
    known = ids.select(F.col(ident)).where(F.col(ident).isNotNull())
    return keyed_join(df.where(F.col(col).isNotNull()), known, [(col, ident)], "left_anti")
