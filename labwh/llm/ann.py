"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded sample of the vectors. Each vector is represented by the order of all pivots by
distance, and posted in the inverted files of its nearest ones. A query reads the files of its own
nearest pivots, ranks what it finds by Spearman's footrule between the two orders, and the best of it
is ranked again by exact distance.

The index is cut into shards of bounded size, each with its own inverted files, as document-partitioned
text indexes are; a query goes to every shard and brings back its few best rows. Shards are dealt by
hash, so a hot region of the space is spread over all of them. Equal vectors are one entry that keeps
its smallest ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labwh.llm.common import pick, staged


@dataclass(frozen=True)
class PermutationIndex:
    """``pivots`` are chosen from ``sample`` vectors (all, if there are fewer); that bounds what the driver
    and the tasks are sent. A vector is posted with its ``posted`` nearest pivots; a query reads the files of its ``read`` nearest.
    ``share`` of a shard, ``least`` at least, is ranked by exact distance for each query. Shards have about ``shard`` entries,
    and are searched by up to about ``block`` queries at a time."""

    pivots: int = 256
    sample: int = 2048
    posted: int = 24
    read: int = 24
    share: float = 0.10
    least: int = 512
    shard: int = 16_384
    block: int = 16_384


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v (doubles) of the vectors that take part: not NULL, without NULL or non-finite
    components, not zero, of the most frequent dimension (ties: the smaller)."""
    t = pick(vectors, "vec_id", "embedding").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    t = t.where(F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    size = t.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return t.where(F.size("v") == (size["d"] if size else 0))


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows of the sample, each the farthest from those before it, so that a dense region does
    not take many pivots."""
    chosen, far = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def positions(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Position of each pivot in each row's order, nearest 0, ties to the smaller pivot."""
    order = np.argsort((pivots**2).sum(1)[None, :] - 2 * (x @ pivots.T), axis=1, kind="stable")
    at = np.empty(order.shape, np.int16)
    np.put_along_axis(at, order, np.arange(order.shape[1], dtype=np.int16)[None, :], 1)
    return at


def footrule(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Footrule distance of one vector's positions to those of many."""
    return np.abs(others - query).sum(1, dtype=np.int64)


class Shard:
    """Entries with their inverted files: for each pivot, which entries have it among the nearest."""

    def __init__(self, reps: np.ndarray, vectors: np.ndarray, at: np.ndarray, index: PermutationIndex):
        self.reps, self.vectors, self.at, self.index = reps, vectors, at, index
        entry, pivot = np.nonzero(at < index.posted)
        by = np.argsort(pivot, kind="stable")
        self.entry, self.start = entry[by], np.searchsorted(pivot[by], np.arange(at.shape[1] + 1))

    def nearest(self, vector: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest entries found and their distances; ties at the edge are all kept."""
        found = np.zeros(len(self.reps), bool)
        for pivot in np.flatnonzero(at < self.index.read):
            found[self.entry[self.start[pivot] : self.start[pivot + 1]]] = True
        rows = np.flatnonzero(found)
        most = max(self.index.least, 4 * k, int(self.index.share * len(self.reps)))
        if len(rows) > most:
            far = footrule(at, self.at[rows])
            rows = rows[far <= np.partition(far, most - 1)[most - 1]]
        distance = np.sqrt(((self.vectors[rows] - vector) ** 2).sum(1))
        if len(rows) > k:
            keep = distance <= np.partition(distance, k - 1)[k - 1]
            rows, distance = rows[keep], distance[keep]
        return self.reps[rows], distance


def search(vectors: DataFrame, is_query: Column, k: int = 10, index: PermutationIndex = PermutationIndex()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of each row that meets
    ``is_query`` among all other rows, by Euclidean distance, ties to the smaller vec_id.

    Rows that take no part (see ``usable``) are neither queries nor candidates. Rows with one vec_id
    twice are not candidates of each other. NULL ids are never returned as candidates. All rows are
    indexed; fewer than ``k`` candidates are returned if there are no more. An empty table gives no
    rows; extra columns are dropped.
    """
    spark = vectors.sparkSession
    rows = usable(vectors).where(F.col("vec_id").isNotNull())
    rows = rows.withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit(1), "v")})
    # The ids of equal vectors; one more than k, as a query is not its own neighbour.
    first = Window.partitionBy("k1", "k2").orderBy("vec_id")
    ids = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    distinct = staged(ids.groupBy("k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.min_by("v", "vec_id").alias("v"),
        F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-vectors")
    n = distinct.count()
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()),
                           T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    if not n:
        return spark.createDataFrame([], schema)
    sample = distinct.orderBy(F.xxhash64(F.lit("pivot"), "rep"), "rep").limit(index.sample)
    pivots = spread(np.array([r["v"] for r in sample.select("v").collect()], dtype=np.float64), index.pivots)

    def represent(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.slice(start, 1024)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
                rows = [r.tobytes() for r in positions(x, pivots)] if len(part) else []
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(rows, pa.binary())],
                                                 names=["rep", "v", "at"])

    posted = staged(distinct.select("rep", "v").mapInArrow(represent, "rep long, v array<double>, at binary"), "ann-index")
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "k1", "k2").join(
        distinct.select("k1", "k2", "rep"), ["k1", "k2"]).select("query_id", "rep")
    queries = staged(queries, "ann-queries")
    asked = posted.join(queries.select("rep").distinct(), "rep", "left_semi")
    shards, blocks = math.ceil(n / index.shard), math.ceil(max(1, queries.count()) / index.block)
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = posted.select("rep", "v", "at", F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int").alias("shard"),
                         every(blocks).alias("block"))
    right = asked.select(F.col("rep").alias("query"), F.col("v").alias("q"), F.col("at").alias("query_at"),
                         F.pmod(F.xxhash64(F.lit(1), "rep"), F.lit(blocks)).cast("int").alias("query_block"),
                         every(shards).alias("query_shard"))

    def read(entries, asking):
        import pyarrow as pa

        def vectors(column):
            return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

        def places(column):
            return np.frombuffer(b"".join(column.to_pylist()), np.int16).reshape(len(column), -1)

        by, found, far = [], [], []
        if entries.num_rows and asking.num_rows:
            files = Shard(entries.column("rep").to_numpy(), vectors(entries.column("v")), places(entries.column("at")), index)
            for rep, x, at in zip(asking.column("query").to_pylist(), vectors(asking.column("q")), places(asking.column("query_at"))):
                reps, distance = files.nearest(x, at, k + 1)
                by.append(np.full(len(reps), rep))
                found.append(reps)
                far.append(distance)
        flat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        return pa.table({"query": flat(by, np.int64), "rep": flat(found, np.int64), "score": flat(far, np.float64)})

    found = left.groupBy("shard", "block").cogroup(right.groupBy("query_shard", "query_block")).applyInArrow(
        read, "query long, rep long, score double")
    near = Window.partitionBy("query").orderBy("score", "rep")
    # Entries hold different vectors; the k + 1 nearest of them hold the k + 1 nearest ids.
    best = found.withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 1).drop("r")
    pairs = best.join(distinct.select("rep", "ids"), "rep")
    closest = Window.partitionBy("query").orderBy("score", "vec_id")
    ranked = pairs.select("query", "score", F.explode("ids").alias("vec_id")).withColumn(
        "r", F.row_number().over(closest)).where(F.col("r") <= k + 1).drop("r")
    last = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return queries.join(ranked, F.col("rep") == F.col("query")).where("query_id <> vec_id").withColumn(
        "rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
