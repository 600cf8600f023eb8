"""Joins that stay balanced when one key holds much of a side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwh.operators.common import fresh_name, no_clash, require
from labwh.operators.heavy import heavy_keys, with_parts


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    skewed: str = "left",
    hot_rows: int | None = None,
    counted: DataFrame | None = None,
    unique: Sequence[str] | None = None,
) -> DataFrame:
    """Inner, left, left semi or left anti equi join that stays balanced when one key holds much
    of the ``skewed`` side.

    Spark's adaptive execution splits a skewed join by itself when both inputs come straight
    from a shuffle. It cannot when an input was aggregated on the key, or when the skewed
    side is the right one of a left join; this join is for those cases. Its heavy keys are named by a
    summary that tasks reduce for themselves (:mod:`labwh.operators.heavy`): keys above the size of an average part
    of the table, or with ``hot_rows`` rows or more. Their rows are dealt to parts by a hash of
    ``unique``, columns that tell rows apart (all columns if not given; equal rows then stay together), and
    the matching rows of the other side are copied to each part. Rows with a NULL key match
    nothing and are spread as well.

    Only the key columns of the skewed side are read for the summary; ``counted`` may name a cheaper frame
    with about the same keys (which ones are named only matters for the balance, except that a key
    of a spread right side of a left join must occur in that side).
    """
    if skewed not in ("left", "right") or how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a {how} join on its {skewed} side")
    if skewed == "right" and how in ("left_semi", "left_anti"):
        raise ValueError("a semi or anti join has no rows of its right side to spread")
    require(left, on)
    require(right, on)
    no_clash(left, right, on)
    big, small = (left, right) if skewed == "left" else (right, left)
    require(big, unique or [])
    part, parts, mark = (fresh_name(left, x) for x in ("part", "parts", "mark"))
    heavy = heavy_keys(big if counted is None else counted, on, parts, rows=hot_rows)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    chosen = F.when(no_key, F.lit(2**31 - 1)).otherwise(F.coalesce(F.col(parts), F.lit(1)))
    row_hash = F.xxhash64(*[F.col(c) for c in unique or big.columns])
    cut = with_parts(big, on, heavy, parts).withColumn(part, F.pmod(row_hash, chosen).cast("int"))
    cut = cut.drop(parts).withColumn(mark, F.lit(True))
    spans = F.sequence(F.lit(0), F.coalesce(F.col(parts), F.lit(1)) - 1)
    copied = with_parts(small, on, heavy, parts).withColumn(part, F.explode(spans))
    at = [*on, part]
    if skewed == "left":
        out = cut.join(copied.drop(parts), at, how)
    else:
        out = copied.join(cut, at, how)
        if how == "left":
            # A hot key has matches; copies that met none of them are not rows of the result.
            out = out.where(F.col(mark).isNotNull() | F.col(parts).isNull())
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in on]
    return out.select(*left.columns, *added)
