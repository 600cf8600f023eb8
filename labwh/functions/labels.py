"""Column helpers for group labels, text keys and liveness tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
LIVE = 1
OTHER_LABEL = "其他"
MISSING_TEXT = "无"
MISSING_NAME = "--"
NOT_MET, HANDLED, MET, PARTLY_MET = 1, 2, 3, 4


def live(flag: str = "is_deleted") -> Column:
    """Row that is not soft-deleted."""
    return F.col(flag) == LIVE


def null_bucket(c: Column | str, label: str = OTHER_LABEL) -> Column:
    """NULL group label to ``label``; group by the result, not by the raw column."""
    return F.coalesce(_col(c), F.lit(label))


def filled(c: Column | str) -> Column:
    """Non-empty text, never NULL. Numbers are compared as text."""
    return F.coalesce(_col(c).cast("string") != "", F.lit(False))


def any_filled(*cols: Column | str) -> Column:
    cond = filled(cols[0])
    for c in cols[1:]:
        cond = cond | filled(c)
    return cond


def text_key(*parts: Column | str, pad: int = 2) -> Column:
    """Composite text key. Parts after the first get leading zeros up to ``pad`` characters,
    so (…,1,11) and (…,11,1) differ."""
    head, *tail = [_col(p) for p in parts]
    return F.concat(head.cast("string"), *[_padded(t, pad) for t in tail])


def month_label(y: Column | str, m: Column | str) -> Column:
    return F.concat(_col(y).cast("string"), F.lit("年"), _col(m).cast("string"), F.lit("月"))


def _padded(c: Column, pad: int) -> Column:
    text = c.cast("string")
    return F.when(F.length(text) < pad, F.lpad(text, pad, "0")).otherwise(text)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
