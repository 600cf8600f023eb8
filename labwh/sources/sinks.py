"""Outputs: overwrite, append, upsert, partition publishing, stored-and-fresh merge, audit.

No sink overwrites files that its own plan reads. Merged tables are written to a new place
first, and the old one stays readable until the new one is complete.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labwh.operators.common import require
from labwh.operators.merge import check_unique, merge_latest, upsert_rows
from labwh.sources.staging import fresh_path, shared_dir, staged

DYNAMIC_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
AUDIT_SCHEMA = "create_time timestamp, class_name string, message string"


def write_jdbc(df: DataFrame, options: Mapping[str, str], table: str, mode: str = "overwrite"):
    """Report into a database table; ``mode`` overwrite or append. Types without a database
    counterpart raise in Spark's writer."""
    df.write.format("jdbc").options(**options).option("dbtable", table).mode(mode).save()


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet"):
    df.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(path)


def append_snapshot(df: DataFrame, path: str, fmt: str = "parquet"):
    """Dated snapshot; earlier runs stay."""
    df.write.format(fmt).mode("append").save(path)


def insert_overwrite(df: DataFrame, table: str):
    """Replaces a catalog table's rows, columns matched by name. In a partitioned table only
    the partitions in the data are replaced."""
    spark = df.sparkSession
    cols = spark.table(table).columns
    require(df, cols)
    # ``insertInto`` takes this mode from the session only.
    before = spark.conf.get(DYNAMIC_OVERWRITE)
    spark.conf.set(DYNAMIC_OVERWRITE, "dynamic")
    try:
        df.select(*cols).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(DYNAMIC_OVERWRITE, before)


def insert_partition(
    df: DataFrame, table: str, partition: Mapping[str, str], replace: bool = False
):
    """INSERT INTO or INSERT OVERWRITE one named partition of a catalog table."""
    spark = df.sparkSession
    view = f"rows_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    spec = ", ".join(f"{c} = :{c}" for c in partition)
    verb = "OVERWRITE" if replace else "INTO"
    try:
        spark.sql(
            f"INSERT {verb} TABLE {table} PARTITION ({spec}) SELECT * FROM {view}",
            args=dict(partition),
        )
    finally:
        spark.catalog.dropTempView(view)


def publish_partitions(df: DataFrame, path: str, cols: Sequence[str]):
    """Replaces only the partitions present in ``df``; running it again gives the same table.

    Rows are rebalanced by partition before the write: small partitions get one file instead
    of one per task, and a partition with much of the data is cut into several tasks of the
    advisory size.
    """
    require(df, cols)
    writer = df.hint("rebalance", *cols).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def same_partitions(source: DataFrame, cols: Sequence[str]) -> Column:
    """Condition for the partitions that ``source`` has rows of. The distinct partition values,
    a list as long as the table's partition listing, become literals, so that other
    partitions are not opened."""
    cond = F.lit(False)
    for row in source.select(*cols).distinct().collect():
        one = F.lit(True)
        for c in cols:
            one = one & F.col(c).eqNullSafe(F.lit(row[c]))
        cond = cond | one
    return cond


def publish_both(
    df: DataFrame, history: str, cols: Sequence[str], current: str, drop: Sequence[str] = ()
):
    """One result into a partitioned history and a current table. The result is written to the
    shared folder once and copied from there, so the query runs once and nothing has to stay
    in executor memory."""
    rows = staged(df, "publish")
    publish_partitions(rows, history, cols)
    rows.drop(*drop).write.mode("overwrite").parquet(current)


def upsert(
    target_path: str, source: DataFrame, keys: Sequence[str], new_path: str
) -> DataFrame:
    """Inserts new keys and fully replaces existing ones; the result is written to
    ``new_path`` and returned. The caller points readers at it once this returns; a crash
    leaves the old table as it was."""
    spark = source.sparkSession
    source = staged(source, "upsert-source")  # read several times from here on
    check_unique(source, keys)
    target = spark.read.parquet(target_path)
    upsert_rows(target, source, keys).write.mode("errorifexists").parquet(new_path)
    return spark.read.parquet(new_path)


def upsert_partitions(
    path: str, source: DataFrame, keys: Sequence[str], cols: Sequence[str]
) -> None:
    """Upsert into a partitioned table whose partition columns are part of the key: only the
    partitions that the source touches are read and rewritten.

    The merged partitions go to the shared folder first and replace the old ones from there.
    """
    if not set(cols) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    spark = source.sparkSession
    source = staged(source, "upsert-source")  # read several times from here on
    check_unique(source, keys)
    old = spark.read.schema(source.schema).parquet(path).where(same_partitions(source, cols))
    merged = staged(upsert_rows(old.select(*source.columns), source, keys), "upsert")
    publish_partitions(merged, path, cols)


def merge_stored(
    stored_path: str, fresh: DataFrame, keys: Sequence[str], new_path: str
) -> DataFrame:
    """Stored report with fresh values on top, written to ``new_path`` and returned."""
    fresh = staged(fresh, "merge-fresh")
    check_unique(fresh, keys)
    stored = fresh.sparkSession.read.parquet(stored_path)
    check_unique(stored, keys)
    merge_latest(stored, fresh, keys).write.mode("errorifexists").parquet(new_path)
    return fresh.sparkSession.read.parquet(new_path)


def point_table(spark: SparkSession, table: str, path: str) -> None:
    """Points an external catalog table at a finished copy."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def upsert_database(
    df: DataFrame,
    connect: Callable[[], object],
    table: str,
    keys: Sequence[str],
    placeholder: str = "?",
    batch_size: int = 2000,
) -> None:
    """INSERT … ON CONFLICT DO UPDATE of all columns into a database, in batches.

    ``connect`` opens one connection per partition, inside the task. A partition is one
    transaction: it commits at its end and rolls back on error, and a retried task repeats
    the same statements with the same outcome.
    """
    check_unique(df, keys)
    cols = df.columns
    marks = ", ".join([placeholder] * len(cols))
    updates = ", ".join(f"{c} = excluded.{c}" for c in cols)
    statement = (
        f"INSERT INTO {table} ({', '.join(cols)}) VALUES ({marks}) "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {updates}"
    )

    def send(rows):
        conn = connect()
        try:
            cursor, batch = conn.cursor(), []
            for row in rows:
                batch.append(tuple(row))
                if len(batch) == batch_size:
                    cursor.executemany(statement, batch)
                    batch = []
            if batch:
                cursor.executemany(statement, batch)
            conn.commit()
        except Exception:
            conn.rollback()
            raise
        finally:
            conn.close()

    df.foreachPartition(send)


def run_audited(
    spark: SparkSession,
    name: str,
    job: Callable[[], object],
    audit_path: str,
    at: dt.datetime | None = None,
):
    """Runs a write; on failure appends (time, job, message) to the audit table and raises the
    error again."""
    try:
        return job()
    except Exception as error:
        row = [(at or dt.datetime.now(), name, str(error))]
        spark.createDataFrame(row, AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(
            audit_path
        )
        raise


def preview(df: DataFrame, n: int = 20) -> None:
    df.show(n, truncate=False)


def month_partition_columns(df: DataFrame, ts: str) -> DataFrame:
    """Adds the partition columns ``date_year`` and ``date_month`` of a timestamp."""
    return df.withColumns({"date_year": F.year(ts), "date_month": F.month(ts)})
