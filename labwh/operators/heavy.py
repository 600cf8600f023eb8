"""Heavy hitters: the keys that hold much of a table, from a summary that every task reduces for itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labwh.operators.common import fresh_name, require

#: Keys are looked at that hold at least one part in this many, per shuffle partition and at most.
PARTS_PER_PARTITION = 4
MOST_PARTS = 2048
#: Items a summary tracks per part; an estimate is off by at most 3.5 / (TRACKED * parts) of all rows.
TRACKED = 8
#: Summaries are merged in groups before the last merge.
MERGE_GROUPS = 64

_PLAIN = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _item(df: DataFrame, keys: Sequence[str]) -> Column:
    """The key as one value: itself, or its columns as text. NULL if a column is."""
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, _PLAIN):
        return F.col(keys[0])
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return F.when(known, F.to_json(F.struct(*[F.col(k).alias(f"c{i}") for i, k in enumerate(keys)])))


def default_parts(df: DataFrame) -> int:
    """Parts that a table is thought to be cut into: four per shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_PARTS, PARTS_PER_PARTITION * partitions)


def heavy_keys(
    df: DataFrame, keys: Sequence[str], name: str, parts: int | None = None, rows: int | None = None
) -> DataFrame:
    """``(item, name)``: the keys that hold at least one of ``parts`` equal parts of all rows (or ``rows``
    rows), and how many such parts they hold. At most ``parts`` keys come back, whatever the table's size.

    Each task keeps a frequent-items summary of bounded size, so nothing is shuffled by key. A key's count is
    estimated with an error of at most 3.5 / (8 * parts) of all rows, so a key of twice the share is never missed;
    which keys are named only sets how the work is dealt. Keys with a NULL are not named.
    """
    require(df, keys)
    parts = parts or default_parts(df)
    tracked = TRACKED * max(128, parts)
    group = (F.spark_partition_id() % MERGE_GROUPS).alias("group")
    items = df.select(_item(df, keys).alias("item"), group).where(F.col("item").isNotNull())
    per_group = items.groupBy("group").agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k_accumulate(item, {tracked})").alias("summary")
    )
    # Grouped by a constant, as an empty task of an ungrouped merge has no summary to hand on.
    merged = per_group.groupBy(F.lit(1)).agg(F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(summary, {tracked})").alias("summary"))
    found = merged.where(F.col("n") > 0).select(
        "n", F.explode(F.expr(f"approx_top_k_estimate(summary, {parts})")).alias("f")
    )
    size = F.greatest(F.lit(1), F.lit(rows) if rows else F.ceil(F.col("n") / parts))
    return found.select(F.col("f.item").alias("item"), F.ceil(F.col("f.count") / size).cast("int").alias(name)).where(
        F.col(name) > 1 if rows is None else F.col(name) >= 1
    )


def with_parts(df: DataFrame, keys: Sequence[str], heavy: DataFrame, name: str) -> DataFrame:
    """Adds the number of parts of the row's key; NULL for keys that are not heavy. The heavy keys are few by
    definition, so they are sent to every task."""
    item = fresh_name(df, "item")
    marked = df.withColumn(item, _item(df, keys))
    return marked.join(F.broadcast(heavy.withColumnRenamed("item", item)), item, "left").drop(item)
