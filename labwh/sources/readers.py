"""Inputs: database tables, catalog tables, files, generated rows, job parameters.

All options (addresses, accounts) come from the caller; nothing is stored here.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    where: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Database table. With ``partition_column``, ``bounds`` and ``num_partitions`` the table
    is read by that many parallel queries; without them by one. ``where`` and the selected
    columns are pushed to the database."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column:
        if bounds is None or num_partitions is None:
            raise ValueError("partition_column needs bounds and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(num_partitions))
        )
    df = reader.load()
    return df.where(where) if where else df


def read_table(spark: SparkSession, name: str, where: str | Column | None = None) -> DataFrame:
    """Catalog table by name; a filter on partition columns prunes partitions."""
    df = spark.table(name)
    return df if where is None else df.where(where)


def read_path(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    where: str | Column | None = None,
    **options: str,
) -> DataFrame:
    """Any file or table format Spark knows (``parquet``, ``orc``, ``delta``, …)."""
    df = spark.read.format(fmt).options(**options).load(path)
    return df if where is None else df.where(where)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one row per line in column ``value``."""
    return spark.read.text(path)


def partition_months(
    df: DataFrame, months: Sequence[dt.date], y: str = "date_year", m: str = "date_month"
) -> DataFrame:
    """Rows of the listed months of a table partitioned by year and month. The condition is on
    the partition columns themselves, so other partitions are not opened."""
    cond = F.lit(False)
    for x in months:
        cond = cond | ((F.col(y) == x.year) & (F.col(m) == x.month))
    return df.where(cond)


def since(df: DataFrame, ts: str, cut: dt.datetime, inclusive: bool = False) -> DataFrame:
    """Incremental scan: rows after ``cut``. The bound is a literal on the raw column, so the
    source can skip files and row groups."""
    c = F.col(ts)
    return df.where(c >= F.lit(cut) if inclusive else c > F.lit(cut))


def number_rows(spark: SparkSession, start: int, stop: int, parts: int | None = None) -> DataFrame:
    return spark.range(start, stop, 1, parts) if parts else spark.range(start, stop)


def register(tables: Mapping[str, DataFrame]) -> None:
    """Temp views, for callers who write SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def bound_sql(spark: SparkSession, query: str, **args: object) -> DataFrame:
    """SQL with ``:name`` parameters, bound rather than spliced into the text."""
    return spark.sql(query, args=args)


def parameter(spark: SparkSession, name: str, default: str | None = None) -> str | None:
    """Job parameter ``spark.project.<name>`` of the session."""
    return spark.conf.get(f"spark.project.{name}", default)


def parameter_dates(spark: SparkSession, name: str = "dateMaps") -> list[dt.date]:
    """Comma list of dates in a job parameter."""
    text = parameter(spark, name) or ""
    return [dt.date.fromisoformat(x.strip()[:10]) for x in text.split(",") if x.strip()]
