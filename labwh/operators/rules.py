"""Compliance rules: component statuses and composites made of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.functions.labels import MET, NOT_MET, PARTLY_MET
from labwh.operators.common import require


def met_if(cond: Column) -> Column:
    """3 when the condition holds, else (also when it is NULL) 1."""
    return F.when(cond, F.lit(MET)).otherwise(F.lit(NOT_MET))


def all_met(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c) == MET for c in columns])


def score_rules(
    df: DataFrame, components: Mapping[str, Column], composites: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Adds component statuses, then composites: 3 only if all named components are 3."""
    scored = df.withColumns(dict(components))
    for parts in composites.values():
        require(scored, parts)
    return scored.withColumns({n: met_if(all_met(p)) for n, p in composites.items()})


def covered_status(done: Column, needed: Column) -> Column:
    """3 when at least as many are done as needed, 4 when only some are, 1 when none is."""
    some = done > 0
    return F.when(some & (done < needed), PARTLY_MET).when(some, MET).otherwise(NOT_MET)
