"""Small helpers for tests on hand-made rows."""

from __future__ import annotations

import datetime as dt


def rows(df, *cols):
    """Result rows as sorted tuples of the named columns; NULLs first."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(x is not None, str(x)) for x in r])


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def plan_text(df) -> str:
    """Physical plan as text, before any adaptive change."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()
