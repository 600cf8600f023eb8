"""Hard negatives by exact integer inner products.

Vectors become integers. Anchors and candidates are dealt into blocks; a task gets one block of each and
multiplies them tile by tile: int64 tiles padded with zeros, Strassen's seven products, each level with
integer additions only, so every score is exact. What a task keeps is a heap per anchor that merges with
those of other tasks by taking the first of both:

* positives: the first rows of the anchor's label, by score, then id;
* windows: per anchor and positive the first rows of other labels whose score lies in the positive's window.

Each candidate meets each anchor in one task. The shuffle carries vectors once per block of the other side, and
heaps; scores stay in the task. Rows are told apart by a number given when they are stored, so that copies
of a row are dealt to all blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labwh.llm.common import pick, staged

#: Squared norms below this keep every sum and its hundredfold inside 64 bits.
MAX_SQUARED_NORM = 2**56


@dataclass(frozen=True)
class NegativeRules:
    """``positives`` per anchor, ``negatives`` per window; a negative's score is between ``low`` and ``high``
    percent of the positive's. Components are multiplied by ``scale`` and rounded down. Blocks bound a task's
    memory: its vectors are held once, scores one tile at a time."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    scale: int = 256
    anchor_block: int = 8192
    candidate_block: int = 8192
    tile: int = 512
    leaf: int = 64


def strassen(a: np.ndarray, b: np.ndarray, leaf: int) -> np.ndarray:
    """Product of int64 matrices whose sides can be halved until the shortest is at most ``leaf``.

    Sums wrap around at 64 bits, which leaves the product right wherever it fits itself.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf or m % 2 or k % 2 or n % 2:
        return a @ b
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


def padded(x: np.ndarray, rows: int, columns: int) -> np.ndarray:
    out = np.zeros((rows, columns), np.int64)
    out[: x.shape[0], : x.shape[1]] = x
    return out


def products(a: np.ndarray, b: np.ndarray, tile: int, leaf: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row of a, first row of b, scores) of all tiles of a · bᵀ, rows of b in ascending order."""
    even = lambda n, most: min(most, 1 << max(0, n - 1).bit_length())
    inner = even(a.shape[1], 1 << 30)
    for j in range(0, len(b), tile):
        right = b[j : j + tile]
        right_tile = np.ascontiguousarray(padded(right, even(len(right), tile), inner).T)
        for i in range(0, len(a), tile):
            left = a[i : i + tile]
            scores = strassen(padded(left, even(len(left), tile), inner), right_tile, leaf)
            yield i, j, scores[: len(left), : len(right)]


class Heaps:
    """The first ``size`` entries of each slot: greatest score first, ties to the entry offered earlier."""

    def __init__(self, slots: int, size: int) -> None:
        self.score = np.full((slots, size), np.iinfo(np.int64).min)
        self.entry = np.full((slots, size), -1, np.int64)
        self.full = np.zeros(slots, bool)

    def offer(self, slots: np.ndarray, scores: np.ndarray, allowed: np.ndarray, first: int) -> None:
        """Scores (a row per slot) of the entries ``first``, ``first + 1``, ..., where ``allowed``."""
        better = allowed & (~self.full[slots, None] | (scores > self.score[slots, -1:]))
        rows, columns = np.nonzero(better)
        if not len(rows):
            return
        size = self.score.shape[1]
        touched, rows = np.unique(rows, return_inverse=True)
        # Old entries come first among equal scores; lexsort is stable.
        slot = np.concatenate([np.repeat(np.arange(len(touched)), size), rows])
        score = np.concatenate([self.score[slots[touched]].ravel(), scores[touched][rows, columns]])
        entry = np.concatenate([self.entry[slots[touched]].ravel(), first + columns])
        real = entry >= 0
        slot, score, entry = slot[real], score[real], entry[real]
        by = np.lexsort((-score, slot))
        slot, score, entry = slot[by], score[by], entry[by]
        starts = np.searchsorted(slot, np.arange(len(touched)))
        rank = np.arange(len(slot)) - starts[slot]
        keep = rank < size
        at = slots[touched][slot[keep]]
        self.score[at, rank[keep]] = score[keep]
        self.entry[at, rank[keep]] = entry[keep]
        self.full[slots[touched]] = self.entry[slots[touched], -1] >= 0

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slot, score and entry of everything kept."""
        slots, ranks = np.nonzero(self.entry >= 0)
        return slots, self.score[slots, ranks], self.entry[slots, ranks]


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column as int64, shorter ones filled up with zeros."""
    column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def usable(vectors: DataFrame, label: Column, scale: int) -> DataFrame:
    """vec_id, label and the integer vector ``v`` of rows that take part: label and vector are there, and
    each component is a finite number."""
    picked = pick(vectors, "vec_id", "label", "embedding").withColumn("label", label.cast("long"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = picked.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~odd)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * scale).cast("double"), 2))
    checked = F.when(norm < MAX_SQUARED_NORM, whole).otherwise(F.raise_error(F.lit("a vector is too long for exact 64-bit scores")))
    return rows.select("vec_id", "label", checked.alias("v"))


def _by_id(table):
    """Rows by id, rows without one last; copies in the order of their row numbers."""
    return table.sort_by([("vec_id", "ascending"), ("row", "ascending")])  # NULLs sort last


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, rules: NegativeRules = NegativeRules()) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on vec_id, ``label`` the label to use instead of the column. Higher scores
    come first, ties by smaller vec_id, rows without id last. Rows without label or vector, or with a component
    that is NULL or not finite, take no part. Shorter vectors count as filled up with zeros. Every row is
    a row of its own: copies of an anchor are anchors and positives of each other, and rows with one id are told
    apart. Anchors without positives, and windows without negatives, give no rows, nor does an empty table.
    Extra columns are dropped. Vectors whose products could leave 64 bits raise an error.
    """
    stored = usable(vectors, F.col("label") if label is None else label, rules.scale)
    stored = staged(stored.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    anchors = stored.where(is_anchor)
    facts = stored.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors"), F.max(F.size("v")).alias("width")).first()
    blocks = math.ceil(max(1, facts["anchors"]) / rules.anchor_block)
    shards = math.ceil(max(1, facts["n"]) / rules.candidate_block)
    width = facts["width"] or 0
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    # Another hash than that of the blocks, so that the two are independent.
    shard = F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(shards)).cast("int")
    dealt = stored.select("row", "vec_id", "label", "v", shard.alias("shard"), every(blocks).alias("block"))

    def meet(asked: DataFrame, task, schema: str) -> DataFrame:
        """``task`` on each pair of a block of anchors and a shard of candidates."""
        own = asked.select(*[F.col(c).alias(c) for c in asked.columns])  # other columns than those of ``dealt``
        copies = own.withColumn("anchor_block", block).withColumn("anchor_shard", every(shards))
        return copies.groupBy("anchor_block", "anchor_shard").cogroup(dealt.groupBy("block", "shard")).applyInArrow(task, schema)

    def positives(asked, rows):
        import pyarrow as pa

        found = []
        if asked.num_rows and rows.num_rows:
            rows = _by_id(rows)
            own, theirs = asked.column("label").to_numpy(), rows.column("label").to_numpy()
            left, right = _matrix(asked.column("v"), width), _matrix(rows.column("v"), width)
            asked_row, row = asked.column("row").to_numpy(), rows.column("row").to_numpy()
            heaps = Heaps(len(left), rules.positives)
            for value in np.intersect1d(own, theirs):
                mine_, other = np.flatnonzero(own == value), np.flatnonzero(theirs == value)
                for i, j, scores in products(left[mine_], right[other], rules.tile, rules.leaf):
                    slots, here = mine_[i : i + len(scores)], other[j : j + scores.shape[1]]
                    allowed = asked_row[slots][:, None] != row[here][None, :]
                    # Within one label, places in ``other`` ascend with the id.
                    heaps.offer(slots, scores, allowed, j)
                places = heaps.entry[mine_]
                heaps.entry[mine_] = np.where(places >= 0, other[places], -1)
            slots, scores, entries = heaps.entries()
            found = [pa.array(asked_row[slots]), rows.column("row").take(pa.array(entries)),
                     rows.column("vec_id").take(pa.array(entries)), pa.array(scores)]
        names = ["row", "positive", "positive_id", "positive_score"]
        return pa.table(found or [pa.array([], pa.int64())] * 4, names=names)

    best = meet(anchors.select("row", "label", "v"), positives, "row long, positive long, positive_id long, positive_score long")
    order = [F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last(), F.col("positive")]
    best = best.withColumn("r", F.row_number().over(Window.partitionBy("row").orderBy(*order))).where(F.col("r") <= rules.positives)
    best = staged(best, "negatives-positives")
    windows = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("r", "positive_score"))).alias("p"))
    asked = anchors.join(windows, "row").select("row", "label", "v", F.transform("p", lambda p: p["positive_score"]).alias("p"))

    def negatives(asked, rows):
        import pyarrow as pa

        found = []
        if asked.num_rows and rows.num_rows:
            rows = _by_id(rows)
            own, theirs = asked.column("label").to_numpy(), rows.column("label").to_numpy()
            left, right = _matrix(asked.column("v"), width), _matrix(rows.column("v"), width)
            sizes = np.diff(asked.column("p").combine_chunks().offsets.to_numpy())
            scored = _matrix(asked.column("p"), rules.positives)
            low, high = -(-rules.low * scored // 100), rules.high * scored // 100
            asked_row = asked.column("row").to_numpy()
            heaps = [Heaps(len(left), rules.negatives) for _ in range(rules.positives)]
            for i, j, scores in products(left, right, rules.tile, rules.leaf):
                slots = np.arange(i, i + len(scores))
                other = own[slots][:, None] != theirs[j : j + scores.shape[1]][None, :]
                for k, heap in enumerate(heaps):
                    inside = other & (scores >= low[slots, k][:, None]) & (scores <= high[slots, k][:, None])
                    heap.offer(slots, scores, inside & (sizes[slots] > k)[:, None], j)
            parts = [(k, *heap.entries()) for k, heap in enumerate(heaps)]
            slots = np.concatenate([p[1] for p in parts])
            entries = pa.array(np.concatenate([p[3] for p in parts]))
            found = [pa.array(asked_row[slots]), pa.array(np.concatenate([np.full(len(p[1]), p[0] + 1) for p in parts])),
                     rows.column("row").take(entries), rows.column("vec_id").take(entries),
                     pa.array(np.concatenate([p[2] for p in parts]))]
        names = ["row", "r", "negative", "negative_id", "negative_score"]
        return pa.table(found or [pa.array([], pa.int64())] * 5, names=names)

    near = meet(asked, negatives, "row long, r long, negative long, negative_id long, negative_score long")
    order = [F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last(), F.col("negative")]
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("row", "r").orderBy(*order))).where(F.col("rank") <= rules.negatives)
    named = best.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return named.withColumn("r", F.col("r").cast("long")).join(near, ["row", "r"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
