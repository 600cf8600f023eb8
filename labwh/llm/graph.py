"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwh.llm.common import staged


#: Rows of a part file. Tables whose size is known before they are written get no more files than that takes.
FILE_ROWS = 1 << 14


def in_files(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of about ``rows`` rows in as many partitions as they fill files, if it has more."""
    return df.coalesce(max(1, math.ceil(rows / FILE_ROWS)))


def components(links: DataFrame, rows: int) -> DataFrame:
    """(node, root) of every node in ``links`` (u, v); the root is the smallest node reachable.
    ``rows`` is about how many links there are; it only decides how many files they are written to.

    Each round ties every node to the smallest neighbour it sees: first the larger neighbours of a
    node, then the smaller ones. Rounds grow with the logarithm of the longest path. The edge table
    is written each round, so lineage stays short and a lost executor costs one round.
    """
    edges = staged(in_files(
        links.where(~F.col("u").eqNullSafe(F.col("v")))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), rows), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.least("u", "m").alias("v"))
        down = large.where("u <> v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = staged(in_files(small.select("e.*").where("u <> v").distinct(), rows), "edges")
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen, rows = state, state[0]
