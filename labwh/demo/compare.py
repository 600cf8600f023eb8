"""Compares query results with the SQL oracles in DuckDB.

    python -m labwh.demo.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from labwh.demo import all_oracles, all_queries
from labwh.demo.tables import Tables

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(" ")
    return repr(value) if not isinstance(value, bool) else f"bool {value}"


# Spark type -> DuckDB type, so that both sides also agree on the column types.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def table(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when columns, row count and all values agree; an empty result counts as a fault."""
    cols, mine = table(df.columns, [tuple(r) for r in df.collect()])
    if not mine:
        return "no rows"
    res = con.execute(sql)
    other_cols, theirs = table([d[0] for d in res.description], res.fetchall())
    if cols != other_cols:
        return f"columns {cols} / {other_cols}"
    types = {d[0]: str(d[1]) for d in res.description}
    wrong = [f"{c}: {k} / {types[c]}" for c, k in df.dtypes if TYPES.get(k) != types[c]]
    if wrong:
        return f"types {wrong}"
    if mine == theirs:
        return None
    a, b = set(mine), set(theirs)
    return (
        f"rows {len(mine)} / {len(theirs)}; only here {sorted(a - b)[:3]}; "
        f"only in the oracle {sorted(b - a)[:3]}; columns {cols}"
    )


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = oracle_connection(folder), 0
    queries, oracles = all_queries(), all_oracles()
    for name in names or list(queries):
        start = time.time()
        try:
            df = queries[name](Tables(spark, folder))
            if name in oracles:
                diff = differences(df, con, oracles[name])
            else:
                diff = None if df.count() else "no rows"
        except Exception as error:
            diff = f"{type(error).__name__}: {str(error)[:1200]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - start:.1f}s {diff or ''}", flush=True)
    print(f"{bad} of {len(names or queries)} queries differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
