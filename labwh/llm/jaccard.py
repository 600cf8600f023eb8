"""N-gram Jaccard join by size: subsets of small sets, inverted lists of large ones.

Documents are sets of word shingles; equal sets are one class. Two sets of sizes a <= b have
Jaccard similarity t or more only if they share at least r(a, b) = ceil(t (a + b) / (1 + t)) shingles.

* Small sets enumerate, for each partner size, all their subsets of exactly r shingles. Sets that
  list the same subset for the same pair of sizes are similar.
* Large sets are posted in inverted lists, of one of two kinds. Lists of ``shingles``: a set's rarest ones, the first
  n - r + 1 in one fixed order, r the least number that a similar set must share. The order puts shingles last that a
  summary names as frequent; each task reduces the summary for itself, in bounded memory; any order is exact,
  the summary only keeps the lists short. Lists of ``blocks``: the hash range is cut into more blocks than similar
  sets can differ in, so similar sets share a whole non-empty block; at a high threshold that is fewer false members, as a
  passage that many documents share seldom fills a block. Similar sets are found by scanning a set's lists.

The boundary between the two is where the total cost of the list entries is least. Candidates whose signatures
allow the similarity are then compared shingle by shingle; only their sets are fetched.

Lists are not expanded into pairs. Members are compared with the head of a list first, in a few rounds
with other heads; only members of one list that are still in different components are compared with
each other afterwards, so every pair in a list is either compared or known to be connected. Links, components and lists stay distributed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labwh.llm.common import pick, staged
from labwh.llm.graph import components, in_files

M64 = (1 << 64) - 1
#: Blocks beyond the pigeonhole's need, so that blocks empty on both sides do not count as shared.
SPARE = 3
#: Shingles that a task tracks to find frequent ones, and frequent ones that are kept in all.
TRACKED, FREQUENT = 1 << 17, 1 << 15
#: Words of 64 bits in a set's parity: unrelated sets of up to some 1,000 shingles are told apart by 512 bits.
PARITY = 8
PARITIES = [f"p{i}" for i in range(1, PARITY + 1)]
#: Words of 64 bits in the folded parity that list entries carry.
FOLDED = 2
FOLDS = [f"q{i}" for i in range(1, FOLDED + 1)]
#: Neighbours in a list that a member is held against before its set is fetched.
NEIGHBOURS = 32
#: Sets of this size or more are always large.
SMALL_LIMIT = 48


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def scramble_int(x: int) -> int:
    return int(scramble(np.array([x & M64], np.uint64))[0])


@dataclass(frozen=True)
class Frequent:
    """Shingles (sorted) that many different sets hold, and in how many they were counted."""

    shingles: np.ndarray
    counts: np.ndarray


NONE_FREQUENT = Frequent(np.zeros(0, np.uint64), np.zeros(0, np.int64))


class Counter:
    """Counts of shingles in at most about twice ``TRACKED`` places: when they are used up, the most frequent
    stay and all counts are lowered by the first that does not, so a count is too low by at most
    the number of shingles seen / ``TRACKED``."""

    def __init__(self) -> None:
        self.shingles, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, found: np.ndarray) -> None:
        self.waiting.append(found)
        self.held += len(found)
        if self.held >= 4 * TRACKED:
            self.settle()

    def settle(self) -> None:
        seen, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.waiting]), return_counts=True)
        self.waiting, self.held = [], 0
        every, place = np.unique(np.concatenate([self.shingles, seen]), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, place, np.concatenate([self.counts, times]))
        if len(every) > TRACKED:
            least = np.partition(total, len(total) - TRACKED - 1)[len(total) - TRACKED - 1]
            every, total = every[total > least], total[total > least] - least
        self.shingles, self.counts = every, total

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        self.settle()
        often = self.counts > 1
        return self.shingles[often], self.counts[often]


@dataclass(frozen=True)
class Similarity:
    """Threshold ``percent`` / 100 and shingle length in words. ``scan_cost`` prices an entry of a large
    set against one of a small set: a shared subset is a similar pair already, while members of a large
    set's list have to be scanned and compared; lists of single shingles hold four times as many of those.
    ``lists`` is the kind of the large sets' lists."""

    percent: int = 90
    words: int = 3
    scan_cost: float = 4.0
    lists: str = "blocks"

    def __post_init__(self) -> None:
        if self.lists not in ("blocks", "shingles"):
            raise ValueError(f"lists are 'blocks' or 'shingles', got {self.lists!r}")

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the text's shingles: A-Z lower-cased, words between white
        space; fewer words than a shingle are one shorter shingle."""
        import xxhash

        found = (text or "").encode("utf-8", "replace").lower().split()
        if not found:
            return np.zeros(0, np.uint64)
        h = np.array([xxhash.xxh64_intdigest(w) for w in found], np.uint64)
        n = min(self.words, len(h))
        rolled = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            rolled = scramble(rolled * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i])
        return np.unique(rolled)

    def partners(self, size: int) -> range:
        """Sizes that a similar set can have."""
        return range(-(-self.percent * size // 100), 100 * size // self.percent + 1)

    def needed(self, a: int, b: int) -> int:
        """Shingles that sets of these sizes must share."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def posted(self, size: int) -> int:
        """Shingles that a large set is posted under: one of them must be among those that a similar set shares."""
        return size - self.needed(size, self.partners(size)[0]) + 1

    def difference(self, total: int) -> int:
        """The most shingles in which similar sets of that total size can differ."""
        return (100 - self.percent) * total // (100 + self.percent)

    # Size classes of the inverted lists: each is 1.5 times as wide as the one below.

    def size_class(self, size: int) -> int:
        k = 0
        while self.class_end(k) <= size:
            k += 1
        return k

    @staticmethod
    def class_end(k: int) -> int:
        end = 8
        for _ in range(k):
            end += end // 2
        return end

    def classes_of(self, size: int) -> list[int]:
        """Classes whose lists a set is posted in: its own, and those of larger partners."""
        return list(range(self.size_class(size), self.size_class(self.partners(size)[-1]) + 1))

    def blocks(self, k: int) -> int:
        return self.difference(2 * (self.class_end(k) - 1)) + 1 + SPARE

    # Cost in list entries.

    def small_cost(self, size: int, boundary: int) -> int:
        return sum(math.comb(size, size - self.needed(size, b)) for b in self.partners(size)
                   if b < boundary and self.needed(size, b) <= min(size, b))

    def large_cost(self, size: int) -> float:
        if self.lists == "shingles":
            return 4 * self.scan_cost * self.posted(size)
        return self.scan_cost * sum(self.blocks(k) for k in self.classes_of(size))

    def boundary(self, counts: dict[int, int]) -> int:
        """Sets below it are small. ``counts`` has the number of sets of each size below
        ``SMALL_LIMIT``; larger ones cost the same whatever is chosen."""

        def total(x: int) -> float:
            return sum(n * ((self.small_cost(s, x) if s < x else 0)
                            + (self.large_cost(s) if self.partners(s)[-1] >= x else 0))
                       for s, n in counts.items() if s < SMALL_LIMIT)

        return min(range(1, SMALL_LIMIT + 1), key=lambda x: (total(x), x))

    def rarest(self, found: np.ndarray, frequent: Frequent) -> np.ndarray:
        """The first ``posted`` shingles: those not known as frequent by hash, then the others by count and hash."""
        count = self.posted(len(found))
        at = np.minimum(np.searchsorted(frequent.shingles, found), max(0, len(frequent.shingles) - 1))
        known = frequent.shingles[at] == found if len(frequent.shingles) else np.zeros(len(found), bool)
        if not known[:count].any():
            return found[:count]  # sets are sorted by hash
        times = np.where(known, frequent.counts[at], 0)
        return found[np.lexsort((found, times))[:count]]

    def entries(self, found: np.ndarray, boundary: int, frequent: Frequent) -> np.ndarray:
        """Keys of the lists that a set belongs to."""
        size = len(found)
        value = scramble(found)
        keys: list[np.ndarray] = []
        if size < boundary:
            whole = int(value.sum(dtype=np.uint64)) if size else 0
            for b in self.partners(size):
                less = size - self.needed(size, b)
                if b < boundary and less >= 0 and self.needed(size, b) <= b:
                    salt = scramble_int(min(size, b) << 32 | max(size, b))
                    sums = [whole - sum(c) for c in combinations(map(int, value), less)]
                    keys.append(scramble(np.array([x & M64 for x in sums], np.uint64) ^ np.uint64(salt)))
        if self.partners(size)[-1] >= boundary and self.lists == "shingles":
            keys.append(scramble(self.rarest(found, frequent) ^ np.uint64(0xA0761D6478BD642F)))
        elif self.partners(size)[-1] >= boundary:
            for k in self.classes_of(size):
                blocks = self.blocks(k)
                # Hashes are sorted, so blocks of the hash range are runs.
                starts = np.searchsorted(found >> np.uint64(32), (np.arange(blocks, dtype=np.uint64) << np.uint64(32)) // np.uint64(blocks))
                ends = np.append(starts[1:], size)
                totals = np.concatenate([[np.uint64(0)], np.cumsum(value, dtype=np.uint64)])
                sums = totals[ends] - totals[starts]
                salts = scramble(np.arange(blocks, dtype=np.uint64) | np.uint64((k + 1) << 40))
                full = ends > starts
                if blocks - full.sum() > SPARE:
                    full[:] = True  # only such sets can share nothing but empty blocks
                keys.append(scramble(sums + salts)[full])
        return np.concatenate(keys) if keys else np.zeros(0, np.uint64)

    def parity(self, found: np.ndarray) -> list[int]:
        """``PARITY`` words of 64 bits: the parity of the number of shingles in each of as many hash classes as there
        are bits. Sets that differ in d shingles differ in at most d bits."""
        bits = np.bincount((found & np.uint64(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY) & 1
        return np.packbits(bits.astype(np.uint8)).view(">i8").tolist()

    def signature(self, found: np.ndarray) -> np.ndarray:
        """The parity over as many hash classes as the set has shingles, or more: words of 64 bits, ``PARITY`` at least and
        their number a power of two, so that a longer signature folds to the length of a shorter one."""
        bits = 64 * max(PARITY, 1 << (max(1, -(-len(found) // 64)) - 1).bit_length())
        odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8)).view(">i8").astype(np.int64)

    def folded(self, found: np.ndarray) -> list[int]:
        """The parity with its hash classes merged to 64 for each of ``FOLDED`` words; the bound on differing bits holds too."""
        return np.bitwise_xor.reduce(np.array(self.parity(found), np.int64).reshape(-1, FOLDED)).tolist()


def _per_document(
    docs: DataFrame, sim: Similarity, schema: T.StructType, make, once: bool = False, finish=None
) -> DataFrame:
    """Rows that ``make(doc_id, shingles, k)`` yields for each document, in bounded batches; k is the
    64-bit hash of the set. With ``once`` a task skips sets that it has seen, so that a group of
    copies is reduced before any shuffle. ``finish`` yields a task's last rows from the counts of the
    shingles of its different sets."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        columns: list[list] = [[] for _ in arrow]
        held, seen, counter = 0, set(), Counter() if finish else None
        weight = lambda column: sum(x.size if isinstance(x, np.ndarray) else 1 for x in column) if isinstance(column, list) else len(column)

        def emit():
            arrays = []
            for c, f in zip(columns, arrow):
                arrays.append(pa.concat_arrays([pa.array(x, f.type) for x in c]) if c else pa.array([], f.type))
                c.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, text in zip(ids, batch.column(1)):
                found = sim.shingles(text.as_py())
                k = xxhash.xxh3_64_intdigest(found.tobytes())
                if once or finish:
                    known = (len(found), k) in seen
                    seen.add((len(found), k))
                    if known and once:
                        continue
                    if finish and not known:
                        counter.add(found)
                rows = make(doc_id, found, np.array([k], np.uint64).view(np.int64))
                for c, x in zip(columns, rows):
                    c.append(x)
                held += weight(rows[-1])
                if held >= 1 << 16 or len(columns[0]) >= 1024:
                    yield emit()
                    held = 0
        yield emit()
        if finish:
            for rows in finish(counter):
                for c, x in zip(columns, rows):
                    c.append(x)
                yield emit()

    return pick(docs, "doc_id", "text").mapInArrow(run, schema)


def document_sets(docs: DataFrame, sim: Similarity) -> DataFrame:
    """doc_id, n (size), k (64-bit hash of the set), p1 to p8 (parity) and the signature of each document. Size and
    hash together identify a set. For lists of shingles, rows of size -1 are the tasks' counts of repeated shingles over their different
    sets: k is the shingle, p1 the count."""

    def make(doc_id, found, k):
        return [doc_id], [len(found)], k, *[[p] for p in sim.parity(found)], [sim.signature(found)]

    def finish(counter: Counter):
        shingles, counts = counter.repeated()
        for i in range(0, len(shingles), 1 << 14):
            part = shingles[i : i + (1 << 14)].view(np.int64)
            none = [np.zeros(len(part), np.int64)] * (PARITY - 1)
            yield [[None] * len(part), np.full(len(part), -1), part, counts[i : i + (1 << 14)], *none, [None] * len(part)]

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           *[T.StructField(c, T.LongType()) for c in ("n", "k", *PARITIES)],
                           T.StructField("signature", T.ArrayType(T.LongType()))])
    return _per_document(docs, sim, schema, make, finish=finish if sim.lists == "shingles" else None)


def frequent_shingles(sets: DataFrame) -> Frequent:
    """The ``FREQUENT`` most counted shingles of the staged ``document_sets``; that many rows reach the driver."""
    counted = sets.where("n = -1").groupBy("k").agg(F.sum("p1").alias("times"))
    rows = counted.orderBy(F.col("times").desc(), "k").limit(FREQUENT).collect()
    shingles = np.array([r["k"] for r in rows], np.int64).view(np.uint64)
    by = np.argsort(shingles)
    return Frequent(shingles[by], np.array([r["times"] for r in rows], np.int64)[by])


def list_entries(docs: DataFrame, sim: Similarity, boundary: int, frequent: Frequent = NONE_FREQUENT) -> DataFrame:
    """key, n, k, q1, q2 (folded parity): one row per list that a set belongs to, and per task that holds a copy of the set."""

    def make(_, found, k):
        keys = sim.entries(found, boundary, frequent).view(np.int64) if len(found) else np.zeros(0, np.int64)
        return np.full(len(keys), len(found)), np.repeat(k, len(keys)), *[np.full(len(keys), q) for q in sim.folded(found)], keys

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("n", "k", *FOLDS, "key")])
    return _per_document(docs, sim, schema, make, once=True)


def full_sets(docs: DataFrame, sim: Similarity) -> DataFrame:
    """n, k, shingles: the sets themselves, once per task."""

    def make(_, found, k):
        return [len(found)], k, [found.view(np.int64)]

    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("k", T.LongType()),
                           T.StructField("shingles", T.ArrayType(T.LongType()))])
    return _per_document(docs, sim, schema, make, once=True)


def _possible(sim: Similarity, a, b, words: Sequence[str] = PARITIES) -> Column:
    """Sizes and parities of two sets, given by functions from a name to its column, allow the similarity."""
    na, nb = a("n"), b("n")
    bits = sum((F.bit_count(a(p).bitwiseXOR(b(p))) for p in words), F.lit(0))
    return ((100 * F.least(na, nb) >= sim.percent * F.greatest(na, nb))
            & (bits * (100 + sim.percent) <= (100 - sim.percent) * (na + nb)))


def _of(prefix: str):
    return lambda name: F.col(prefix + name)


def _with_partner(listed: DataFrame, sim: Similarity, words: Sequence[str]) -> DataFrame:
    """Rows (key, n, k, ``words``) of lists of more than ``NEIGHBOURS`` others, and of shorter ones those with a member
    of fitting size and parity."""
    by = Window.partitionBy("key").orderBy("n", "k")
    around = by.rowsBetween(-NEIGHBOURS, NEIGHBOURS)
    held = listed.withColumn("around", F.collect_list(F.struct("n", "k", *words)).over(around)).withColumn(
        "size", F.count("*").over(Window.partitionBy("key")))
    partner = F.exists("around", lambda x: ((x["n"] != F.col("n")) | (x["k"] != F.col("k")))
                       & _possible(sim, F.col, lambda c: x[c], words))
    return held.where((F.col("size") > NEIGHBOURS + 1) | partner).drop("around", "size")


def list_members(entries: DataFrame, classes: DataFrame, sim: Similarity) -> DataFrame:
    """key, n, k and parity of the members of lists that another member may be similar to.

    A member is dropped if no other member of its list has a fitting size (those next to it by size tell), or, in
    lists of up to ``NEIGHBOURS`` others, if none has a fitting parity. In longer lists all stay. The folded parity of
    the entries drops most of them behind their one shuffle; the whole parity is fetched for the rest.
    """
    # Shuffled once, by key: copies that several tasks listed are merged behind that shuffle.
    listed = entries.repartition("key").groupBy("key", "n", "k").agg(*[F.first(q).alias(q) for q in FOLDS])
    by = Window.partitionBy("key").orderBy("n", "k")
    near = lambda other: F.coalesce(
        100 * F.least(F.col("n"), other) >= sim.percent * F.greatest(F.col("n"), other), F.lit(False))
    fitting = listed.withColumn("fits", near(F.lag("n").over(by)) | near(F.lead("n").over(by))).where("fits").drop("fits")
    fitting = staged(_with_partner(fitting, sim, FOLDS).select("key", "n", "k"), "lists")
    placed = fitting.join(classes.select("n", "k", *PARITIES), ["n", "k"])
    return staged(_with_partner(placed, sim, PARITIES).select("key", "n", "k", *PARITIES), "members")


def _renamed(df: DataFrame, prefix: str, *names: str) -> DataFrame:
    return df.select(*[F.col(n).alias(prefix + n) for n in names])


def _alike(pairs: DataFrame, classes: DataFrame, sim: Similarity) -> DataFrame:
    """Those of ``pairs`` (an, ak, bn, bk) whose signatures allow the similarity. A signature takes a bit or two for each
    shingle, so it is a small part of its set."""
    found = pairs.join(_renamed(classes, "b", "n", "k", "signature"), ["bn", "bk"]).join(
        _renamed(classes, "a", "n", "k", "signature"), ["an", "ak"])
    shorter = F.size("asignature") <= F.size("bsignature")
    found = found.select("an", "ak", "bn", "bk", F.when(shorter, F.col("asignature")).otherwise(F.col("bsignature")).alias("short"),
                         F.when(shorter, F.col("bsignature")).otherwise(F.col("asignature")).alias("long"))
    # Words of both that fold to the same place cancel out where the sets agree.
    differing = F.transform("short", lambda w, i: F.aggregate(
        F.sequence(i, F.size("long") - 1, F.size("short")), w, lambda x, j: x.bitwiseXOR(F.get("long", j))))
    bits = F.aggregate(differing, F.lit(0), lambda total, w: total + F.bit_count(w))
    return found.where(bits * (100 + sim.percent) <= (100 - sim.percent) * (F.col("an") + F.col("bn"))).select(
        "an", "ak", "bn", "bk")


def _fetched(docs: DataFrame, sim: Similarity, pairs: DataFrame, classes: DataFrame, had: DataFrame | None = None) -> DataFrame:
    """``had`` (n, k, shingles) with the other sets of ``pairs``, each once."""
    ends = pairs.select(F.col("an").alias("n"), F.col("ak").alias("k")).unionByName(
        pairs.select(F.col("bn").alias("n"), F.col("bk").alias("k"))).distinct()
    if had is not None:
        ends = ends.join(had.select("n", "k"), ["n", "k"], "left_anti")
    wanted = staged(ends.join(classes, ["n", "k"]).select("n", "k", "doc_id"), "wanted")
    if had is not None and wanted.isEmpty():
        return had
    some = pick(docs, "doc_id", "text").alias("d").join(
        wanted.select("doc_id").distinct().alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")), "left_semi")
    # Documents that share an id bring sets that nobody asked for.
    found = full_sets(some, sim).join(wanted.select("n", "k"), ["n", "k"], "left_semi").dropDuplicates(["n", "k"])
    found = staged(found.select("n", "k", "shingles"), "sets")
    return found if had is None else had.unionByName(found)


def _compared(pairs: DataFrame, sets: DataFrame, sim: Similarity) -> DataFrame:
    """``pairs`` (an, ak, bn, bk) with ``linked``. Sets come by two joins whose pair side can be
    split where one set has many partners."""
    found = pairs.join(_renamed(sets, "b", "n", "k", "shingles"), ["bn", "bk"]).join(
        _renamed(sets, "a", "n", "k", "shingles"), ["an", "ak"])
    both = F.size(F.array_intersect("ashingles", "bshingles"))
    return found.select("an", "ak", "bn", "bk", both.alias("both")).select(
        "an", "ak", "bn", "bk",
        (100 * F.col("both") >= sim.percent * (F.col("an") + F.col("bn") - F.col("both"))).alias("linked"))


def _roots(links: DataFrame, rows: int) -> DataFrame:
    """n, k, root of all sets in links, which are ``rows``."""
    node = lambda p: F.struct(F.col(f"{p}n").alias("n"), F.col(f"{p}k").alias("k"))
    return components(links.select(node("a").alias("u"), node("b").alias("v")), rows).select(
        "node.n", "node.k", "root")


def _with_root(df: DataFrame, roots: DataFrame, prefix: str) -> DataFrame:
    """Column ``{prefix}root``; a set without links is its own root."""
    found = roots.select(F.col("n").alias(f"{prefix}n"), F.col("k").alias(f"{prefix}k"), F.col("root").alias("found"))
    own = F.struct(F.col(f"{prefix}n").alias("n"), F.col(f"{prefix}k").alias("k"))
    return df.join(found, [f"{prefix}n", f"{prefix}k"], "left").withColumn(
        f"{prefix}root", F.coalesce("found", own)).drop("found")


def _classes(sets: DataFrame) -> DataFrame:
    """n, k, parity, signature and the smallest doc_id of each set that is not empty, stored."""
    return staged(sets.where("n > 0").groupBy("n", "k").agg(
        *[F.first(c).alias(c) for c in (*PARITIES, "signature")], F.min("doc_id").alias("doc_id")), "classes")


def similar_classes(
    docs: DataFrame, sim: Similarity, sets: DataFrame, frequent: Frequent, rounds: int = 2
) -> tuple[DataFrame, DataFrame]:
    """Links between different sets (an, ak, bn, bk; enough of them to connect all that is connected)
    and the roots (n, k, root) of the sets in them. ``sets`` are the staged ``document_sets``.

    ``rounds`` only decides how much is connected through list heads before the rest is compared."""
    classes = _classes(sets)
    counts = {r["n"]: r["count"] for r in classes.where(F.col("n") < SMALL_LIMIT).groupBy("n").count().collect()}
    boundary = sim.boundary(counts)

    members = list_members(list_entries(docs, sim, boundary, frequent), classes, sim)

    none = sets.sparkSession.createDataFrame([], "an long, ak long, bn long, bk long, linked boolean")
    done, linked, roots, found = none, 0, _roots(none, 0), None
    columns = ["n", "k", *PARITIES, "root"]
    pair = ["an", "ak", "bn", "bk"]

    def side(prefix: str, extra: tuple[str, ...] = ()) -> list[Column]:
        return [F.col(c).alias(prefix + c) for c in (*columns, *extra)]

    def of_open_lists() -> DataFrame:
        """Members, with roots, of lists that more than one component is in."""
        placed = _with_root(members, roots, "")
        mixed = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
        return staged(placed.join(mixed, "key", "left_semi").select("key", *columns), "open-lists")

    for turn in range(rounds + 1):
        open_lists = of_open_lists()
        if open_lists.isEmpty():
            break
        if turn < rounds:
            # A head for each list, another one each turn; each member meets the head that it shares most with.
            by = Window.partitionBy("key").orderBy(F.xxhash64(F.lit(turn), "k"), "n").rowsBetween(
                Window.unboundedPreceding, Window.currentRow)
            headed = open_lists.select(*side("b"), *[F.first(c).over(by).alias("a" + c) for c in columns])
            headed = headed.where((F.col("aroot") != F.col("broot")) & _possible(sim, _of("a"), _of("b")))
            best = headed.groupBy(*pair).agg(F.count("*").alias("shared")).groupBy("bn", "bk").agg(
                F.max_by(F.struct("an", "ak"), F.struct("shared", "ak", "an")).alias("a"))
            candidates = best.select(F.least(F.col("a"), F.struct(F.col("bn").alias("an"), F.col("bk").alias("ak"))).alias("a"),
                                     F.greatest(F.col("a"), F.struct(F.col("bn").alias("an"), F.col("bk").alias("ak"))).alias("b"))
            candidates = candidates.select("a.an", "a.ak", F.col("b.an").alias("bn"), F.col("b.ak").alias("bk")).distinct()
        else:
            # All pairs that are left, each from the first list that both are in, as far as the first lists
            # of a set tell; what is emitted twice is removed after.
            firsts = open_lists.groupBy("n", "k").agg(F.slice(F.sort_array(F.collect_set("key")), 1, 16).alias("firsts"))
            rows = open_lists.join(firsts, ["n", "k"])
            a, b = rows.select("key", *side("a", ("firsts",))), rows.select(F.col("key").alias("bkey"), *side("b", ("firsts",)))
            earlier = F.array_min(F.array_intersect("afirsts", "bfirsts"))
            candidates = a.join(b, (F.col("key") == F.col("bkey")) & (F.struct("an", "ak") < F.struct("bn", "bk"))
                                & (F.col("aroot") != F.col("broot")) & _possible(sim, _of("a"), _of("b"))
                                & (F.coalesce(earlier, F.col("key")) >= F.col("key"))).select(*pair).distinct()
        candidates = staged(_alike(candidates.join(done, pair, "left_anti"), classes, sim), "candidates")
        found = _fetched(docs, sim, candidates, classes, found)
        result = staged(_compared(candidates, found, sim), "compared")
        done = done.unionByName(result)
        more = result.where("linked").count()
        if more:
            linked += more
            roots = staged(in_files(_roots(done.where("linked"), linked), 2 * linked), "roots")
    return done.where("linked").select(*pair), roots


def _sets(docs: DataFrame, sim: Similarity) -> tuple[DataFrame, Frequent]:
    """The stored sets of all documents, and the shingles that are frequent in them."""
    stored = staged(document_sets(docs, sim), "document-sets")
    return stored.where("n >= 0"), frequent_shingles(stored) if sim.lists == "shingles" else NONE_FREQUENT


def join(docs: DataFrame, sim: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    A component is what links of Jaccard similarity ``percent`` / 100 or more connect; its id is the
    smallest doc_id in it. NULL, empty and blank texts have the empty set: linked with nothing, and
    their own component. Documents with equal sets, repeated rows included, are linked. Rows with
    NULL doc_id take part; a component of such rows alone has NULL as its id. Extra columns are
    dropped; an empty table gives no rows. Texts of any length are compared whole. Shingles and sets
    are told apart by 64-bit hashes.
    """
    sets, frequent = _sets(docs, sim)
    _, roots = similar_classes(docs, sim, sets, frequent)
    classes = sets.where("n > 0").groupBy("n", "k").agg(F.min("doc_id").alias("least"))
    placed = _with_root(classes, roots, "")
    ids = placed.groupBy("root").agg(F.min("least").alias("component"))
    named = placed.join(ids, "root").select("n", "k", "component")
    return sets.join(named, ["n", "k"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def set_links(docs: DataFrame, sim: Similarity, sets: DataFrame, frequent: Frequent) -> DataFrame:
    """All links between different sets (an, ak, bn, bk), each once. ``sets`` are the staged
    ``document_sets``. Sets that share a list are all compared, so the work grows with the pairs."""
    classes = _classes(sets)
    counts = {r["n"]: r["count"] for r in classes.where(F.col("n") < SMALL_LIMIT).groupBy("n").count().collect()}
    members = list_members(list_entries(docs, sim, sim.boundary(counts), frequent), classes, sim)
    names = ("n", "k", *PARITIES)
    a = members.select("key", *[F.col(c).alias(f"a{c}") for c in names])
    b = members.select("key", *[F.col(c).alias(f"b{c}") for c in names])
    pairs = a.join(b, "key").where((F.struct("an", "ak") < F.struct("bn", "bk")) & _possible(sim, _of("a"), _of("b")))
    pairs = staged(_alike(pairs.select("an", "ak", "bn", "bk").distinct(), classes, sim), "pairs")
    found = _fetched(docs, sim, pairs, classes)
    return _compared(pairs, found, sim).where("linked").drop("linked")


def count_links(docs: DataFrame, sim: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles and n_links, the number of other documents that each is linked with.

    NULL, empty and blank texts have no links. Documents with equal sets, repeated rows included, are
    linked. Extra columns are dropped; an empty table gives no rows.
    """
    sets, frequent = _sets(docs, sim)
    links = staged(set_links(docs, sim, sets, frequent), "links")
    copies = sets.where("n > 0").groupBy("n", "k").agg(F.count("*").alias("copies"))
    both = links.unionByName(links.select(F.col("bn").alias("an"), F.col("bk").alias("ak"), F.col("an").alias("bn"), F.col("ak").alias("bk")))
    others = both.join(_renamed(copies, "b", "n", "k", "copies"), ["bn", "bk"]).groupBy(
        F.col("an").alias("n"), F.col("ak").alias("k")).agg(F.sum("bcopies").alias("others"))
    linked = copies.join(others, ["n", "k"], "left").select(
        "n", "k", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return sets.join(linked, ["n", "k"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
