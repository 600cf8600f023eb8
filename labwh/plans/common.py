"""Pieces shared by the report plans."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.functions import LIVE, live, proportion
from labwh.operators import keyed_join

# Fixed values.
OPEN_STATUSES = (3, 4, 5)
OPEN_SUB_STATUSES = (3, 4)
DEPOSIT_STATUSES = (3, 4)
RUNNING, STOPPED, COMPLETED = 1, 2, 3
UNVERIFIED_GRADE = 99
PROJECT_TYPES = {
    "房屋建设工程": "houses",
    "市政工程": "municipal",
    "附属工程": "sub",
    "其它": "other",
}
PROVINCE, CITY, COUNTY = 1, 2, 3
UNIT_CODES = {"day": 1, "month": 2, "year": 3}


def open_projects(projects: DataFrame) -> DataFrame:
    """Approved, running or finished projects that are live."""
    return projects.where(F.col("status").isin(*OPEN_STATUSES) & live())


def valid_deposits(deposits: DataFrame) -> DataFrame:
    return deposits.where(live() & F.col("status").isin(*DEPOSIT_STATUSES))


def located_deposits(deposits: DataFrame) -> DataFrame:
    """Valid deposits with a province and a city."""
    rows = valid_deposits(deposits)
    for c in ("province_code", "city_code"):
        rows = rows.where(F.col(c).isNotNull() & (F.col(c) != ""))
    return rows


def areas_below(areas: DataFrame, parent: str) -> DataFrame:
    """``code, name`` of the areas below one city."""
    return areas.where(F.col("parent_code") == parent).select("code", "name")


def text_shares(df: DataFrame, parts: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``{output: (part, total)}`` shares as text."""
    return df.withColumns({o: proportion(n, d, as_text=True) for o, (n, d) in parts.items()})


def date_text(ts: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(ts, pattern)


def stamp(as_of: dt.date, is_deleted: bool = True) -> dict[str, Column]:
    """Audit columns of a report row."""
    cols = {
        "create_user": F.lit(""),
        "create_time": F.lit(as_of),
        "last_modify_user": F.lit(""),
        "last_modify_time": F.lit(as_of),
    }
    return {**cols, "is_deleted": F.lit(LIVE)} if is_deleted else cols


def add_names(df: DataFrame, dim: DataFrame, key: str, dim_key: str, *columns: str) -> DataFrame:
    """Columns of a table whose primary key is ``dim_key``.

    The table is joined as it is, without a guarding aggregation, so that adaptive execution
    can split a key that most rows refer to.
    """
    return keyed_join(df, dim.select(dim_key, *columns), [(key, dim_key)])
