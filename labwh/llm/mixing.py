"""Mixing sources to target weights by the cube method.

Each source gets a target number of words. Its documents are taken a whole number of times, and the
fractional rest of that rate is a sampling problem: inclusion probabilities move through the null
space of the balancing constraints (words and documents of the source) until they are 0 or 1.

The flight runs over cells of a source (rows dealt by hash, sorted inside), streaming with a dozen
open units as its whole state. What a cell leaves open goes to the next level, where a source has
fewer cells, until one cell is left and a small landing problem is solved by trying every rounding.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labwh.llm.common import WORD_PATTERN, pick, staged

#: Units left open by a flight; the landing tries 2 to this power roundings.
OPEN = 12
NEAR = 1e-9


def target_words(sizes: Sequence[tuple[str | None, int]], weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                 most: float = 2.0) -> dict[str | None, float]:
    """Target of each source. Sources are ordered by code point, NULL last, and weigh ``weights`` in
    turn; together they get ``share`` times all words. No target exceeds ``most`` times the source's
    words; what is beyond goes to the others by weight until none is above."""
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {name: weights[i % len(weights)] for i, (name, _) in enumerate(ordered)}
    size = dict(ordered)
    left, free, target = share * sum(size.values()), set(size), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        above = [s for s in free if unit * weight[s] > most * size[s]]
        if not above:
            return target | {s: unit * weight[s] for s in free}
        for s in above:
            target[s] = most * size[s]
            free.remove(s)
        left = share * sum(size.values()) - math.fsum(target.values())
    return target


def move(probabilities: list[float], sizes: list[float], draw: float) -> list[float]:
    """One step for three units: along the direction that keeps the sums of the probabilities and of
    probability times size, to where a unit becomes 0 or 1; which way is drawn so that each
    probability keeps its expectation."""
    a, b, c = sizes
    u = (c - b, a - c, b - a)
    if not any(u):
        u = (1.0, -1.0, 0.0)

    def reach(sign: float) -> float:
        return min((1 - p if sign * d > 0 else p) / abs(d) for p, d in zip(probabilities, u) if d)

    up, down = reach(1), reach(-1)
    step = up if draw * (up + down) < down else -down
    moved = [p + step * d for p, d in zip(probabilities, u)]
    return [0.0 if p < NEAR else 1.0 if p > 1 - NEAR else p for p in moved]


def land(probabilities: list[float], sizes: list[float]) -> list[float]:
    """The rounding of at most ``OPEN`` units that is nearest to the balanced totals: in words, and a
    little in documents."""
    import numpy as np

    n = len(sizes)
    if not n:
        return []
    bits = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    off = bits - np.array(probabilities)
    x = np.array(sizes, dtype=float)
    cost = np.abs(off @ x) + 0.02 * x.mean() * np.abs(off.sum(1))
    return bits[int(cost.argmin())].astype(float).tolist()


def _flight(rows: DataFrame, seed: int, landing: bool) -> DataFrame:
    """Moves the probabilities (column ``p``) of the rows of each (source, cell)."""
    columns = rows.columns
    at = {c: columns.index(c) for c in ("source", "cell", "size", "p")}

    def run(batches: Iterator) -> Iterator:
        import random

        import pyarrow as pa

        key, units, draw, out, schema = None, [], random.Random(), [], None

        def settle():
            while len(units) > OPEN:
                # The three most alike in size move, so that large and small ones stay for the landing.
                units.sort(key=lambda r: -r[at["size"]])
                i = min(range(len(units) - 2), key=lambda k: units[k][at["size"]] / units[k + 2][at["size"]])
                three = units[i : i + 3]
                for row, p in zip(three, move([r[at["p"]] for r in three], [r[at["size"]] for r in three], draw.random())):
                    row[at["p"]] = p
                out.extend(r for r in three if r[at["p"]] in (0.0, 1.0))
                units[i : i + 3] = [r for r in three if r[at["p"]] not in (0.0, 1.0)]

        def close():
            if landing:
                units.sort(key=lambda r: -r[at["size"]])
                for row, p in zip(units, land([r[at["p"]] for r in units], [r[at["size"]] for r in units])):
                    row[at["p"]] = p
            out.extend(units)
            units.clear()

        def ready(least: int):
            if len(out) >= least:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, schema.field(i).type) for i, c in enumerate(zip(*out))], schema=schema)
                out.clear()

        for batch in batches:
            schema = batch.schema
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if (row[at["source"]], row[at["cell"]]) != key:
                    close()
                    key = row[at["source"]], row[at["cell"]]
                    draw.seed(f"{seed}/{key}")
                units.append(list(row))
                settle()
            yield from ready(10_000)
        close()
        yield from ready(1)

    return rows.mapInArrow(run, rows.schema)


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
        cell_rows: int = 4096, seed: int = 17, max_sources: int = 100_000) -> DataFrame:
    """doc_id, source, row_hash, size, source_size, target, copies and taken for every document.

    ``copies`` is how often the mix takes the document, ``taken`` is copies times size. Documents
    without words (NULL text too) are not taken. NULL is a source of its own. Order inside a cell is
    by hash of the whole row, so reruns over the same rows agree; repeated rows are units of their
    own. Texts of any length are counted whole; an empty table gives no rows. Extra columns are dropped. Sources are a catalogue: one row each reaches the driver, and
    more than ``max_sources`` of them is an error.
    """
    sized = staged(
        pick(docs, "doc_id", "source", "text").select(
            "doc_id", "source",
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD_PATTERN)).cast("long").alias("size"),
            F.xxhash64("doc_id", "source", "text").alias("row_hash")),
        "mix-sizes")
    spark = sized.sparkSession
    found = sized.groupBy("source").agg(F.sum("size").alias("n"), F.count_if(F.col("size") > 0).alias("rows")).limit(
        max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    target = target_words([(r["source"], r["n"]) for r in found], weights, share, most)
    rows = {r["source"]: r["rows"] for r in found}
    plan = []
    for r in found:
        rate = target[r["source"]] / r["n"] if r["n"] else 0.0
        whole = math.floor(rate + NEAR)
        plan.append((r["source"], r["n"], float(target[r["source"]]), whole, max(0.0, rate - whole) if rate - whole > NEAR else 0.0))
    plan_rows = spark.createDataFrame(plan, "source string, source_size long, target double, whole long, p double")
    kind = sized.schema["source"].dataType
    plan_rows = plan_rows.withColumn("source", F.col("source").cast(kind))

    def with_plan(df: DataFrame) -> DataFrame:
        # One row per source, bounded by max_sources.
        p = F.broadcast(plan_rows.withColumnRenamed("source", "plan_source"))
        return df.join(p, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")

    columns = ["doc_id", "source", "row_hash", "size"]
    every = with_plan(sized)
    needs = (F.col("p") > 0) & (F.col("size") > 0)
    decided = [every.where(~needs).select(*columns, F.lit(0.0).alias("p"))]
    opened = every.where(needs).select(*columns, "p")
    fractional = {s for s, *_, p in plan if p > 0}
    left = {s: n for s, n in rows.items() if s in fractional and n}
    level = 0
    while left:
        cells = {s: max(1, math.ceil(n / cell_rows)) for s, n in left.items()}
        landing = max(cells.values()) == 1
        of = spark.createDataFrame([(s, n) for s, n in cells.items()], "cell_source string, cells long")
        dealt = opened.join(F.broadcast(of.withColumn("cell_source", F.col("cell_source").cast(kind))),
                            F.col("source").eqNullSafe(F.col("cell_source")))
        dealt = dealt.withColumn("cell", F.pmod(F.xxhash64(F.lit(level), "row_hash"), F.col("cells"))).select(*columns, "p", "cell")
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(sum(left.values()) / 100_000))
        dealt = dealt.repartition(parts, "source", "cell").sortWithinPartitions(
            "source", "cell", "row_hash", "doc_id", "size", "p")
        moved = staged(_flight(dealt, seed + level, landing).select(*columns, "p"), f"mix-level{level}")
        closed = F.col("p").isin(0.0, 1.0)
        decided.append(moved.where(closed))
        opened = moved.where(~closed)
        left = {} if landing else {r["source"]: r["count"] for r in opened.groupBy("source").count().collect()}
        level += 1
    chosen = decided[0]
    for part in decided[1:]:
        chosen = chosen.unionByName(part)
    chosen = with_plan(chosen.withColumnRenamed("p", "extra"))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("extra").cast("long")).otherwise(0)
    return chosen.select("doc_id", "source", "row_hash", "size", "source_size", "target",
                         copies.cast("long").alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))
