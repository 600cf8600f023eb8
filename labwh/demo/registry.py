"""Registration of queries next to their SQL oracles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame

from labwh.demo.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, created: dt.date | None = None):
    """Registers a query under its function name, with the SQL it must agree with. ``created`` is the run date that
    the report puts into ``create_time``; the SQL need not name it."""
    if oracle is not None and created is not None:
        oracle = f"SELECT *, DATE '{created}' AS create_time FROM ({oracle.strip()})"

    def add(fn: Callable[[Tables], DataFrame]):
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def half_up(value: str, digits: int) -> str:
    """Oracle SQL for rounding a double half up on its shortest decimal text, as Spark does."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def share(num: str, den: str) -> str:
    """Oracle SQL for a share in percent; NULL when the denominator is 0 or NULL."""
    return half_up(f"(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0) * 100)", 2)


def share_text(num: str, den: str) -> str:
    return f"(CAST({share(num, den)} AS VARCHAR) || '%')"


def money(value: str) -> str:
    """Oracle SQL for a fixed-point amount."""
    return f"CAST({value} AS DECIMAL(15,2))"
