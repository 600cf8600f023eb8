"""Periodic runs of words by recompression.

A run is a stretch of words with smallest period q that is at least ``min_exponent`` periods and
``min_words`` words long and that neither neighbour extends.

* Candidates lie on the harmonic grid: of period p the places 0, p, 2p, ... are looked at. A run of four
  periods holds four neighbouring grid places, so three equalities in a row of W[kp] = W[(k + 1)p] mark it.
* Recompression turns the texts that hold candidates into a run-length grammar: block compression and pair
  compression take turns until nothing is left to compress. Equal stretches are parsed alike but for their ends.
* A longest common extension (LCE) climbs the grammar as long as both sides agree and comes down where
  they part, in O(log n) steps. Two of them, to the right and to the left, give the exact ends of a candidate.

Texts are worked off in batches; the words of a batch are one sequence with a letter of its own between
two texts, so all queries of a batch are answered together by array operations. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from labwh.llm.common import pick


@dataclass(frozen=True)
class RunRules:
    """``min_exponent`` is at least 4: the grid needs four places in a run. ``batch_words`` bounds
    what a task works on at once; a longer text is a batch of its own."""

    min_words: int = 6
    min_exponent: int = 4
    batch_words: int = 400_000

    def __post_init__(self) -> None:
        if self.min_exponent < 4:
            raise ValueError("min_exponent must be 4 or more")


@dataclass
class Level:
    """One sequence of the grammar, with an end mark behind its last letter. ``before`` and ``from_here``
    count the letters of the same parent in front of a letter, and from it on."""

    letters: np.ndarray
    before: np.ndarray
    from_here: np.ndarray
    parent: np.ndarray
    first: np.ndarray  # of each letter of the level above: its first letter here
    blocks: bool  # letters of one parent are equal

    def mirrored(self) -> Level:
        n, above = len(self.letters) - 1, len(self.first) - 1
        flip = lambda a, end: np.append(a[:n][::-1], np.int32(end))
        last = self.first[1:][::-1] - 1
        return Level(flip(self.letters, -1), flip(self.from_here - 1, 0), flip(self.before + 1, 1),
                     flip(above - 1 - self.parent, above), np.append(n - 1 - last, n).astype(np.int32), self.blocks)


def _heads(letters: np.ndarray, known: int, round_: int, blocks: bool) -> np.ndarray:
    """Which letters begin a parent."""
    if blocks:
        return np.append(True, letters[1:] != letters[:-1])
    # The alphabet is dealt into two classes by a hash; a letter of one before one of the other is a pair.
    mixed = (letters.astype(np.uint64) + np.uint64(round_ * 7919 + 1)) * np.uint64(0x9E3779B97F4A7C15)
    side = (mixed >> np.uint64(40) & np.uint64(1)).astype(bool)
    up, down = ~side[:-1] & side[1:], side[:-1] & ~side[1:]
    return np.append(True, ~(up if up.sum() >= down.sum() else down))


class Grammar:
    """Run-length grammar of a sequence of letters 0, 1, 2, ... by recompression."""

    def __init__(self, letters: np.ndarray) -> None:
        self.forward: list[Level] = []
        letters = letters.astype(np.int32)
        known, round_, idle = int(letters.max(initial=-1)) + 1, 0, 0
        while len(letters) > 2 and idle < 8:
            blocks = round_ % 2 == 0
            heads = _heads(letters, known, round_, blocks)
            round_ += 1
            if heads.all():
                idle += not blocks
                continue
            idle = 0
            first = np.flatnonzero(heads)
            sizes = np.diff(np.append(first, len(letters)))
            parent = np.cumsum(heads) - 1
            before = np.arange(len(letters)) - first[parent]
            many = np.flatnonzero(sizes > 1)
            # The rule of a parent: letter and size of a block, or both letters of a pair.
            second = sizes[many] if blocks else letters[first[many] + 1]
            rule = letters[first[many]].astype(np.int64) * (int(second.max()) + 1) + second
            distinct, names = np.unique(rule, return_inverse=True)
            above = letters[first]
            above[many] = known + names
            known += len(distinct)
            i32 = lambda a, end: np.append(a, end).astype(np.int32)
            self.forward.append(Level(i32(letters, -1), i32(before, 0), i32(sizes[parent] - before, 1),
                                      i32(parent, len(first)), i32(first, len(letters)), blocks))
            letters = above
        self.top = np.append(letters, np.int32(-1))
        self.backward = [level.mirrored() for level in self.forward]
        self.top_mirrored = np.append(letters[::-1], np.int32(-1))
        self.size = len(self.forward[0].letters) - 1 if self.forward else len(letters)

    def right(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of equal letters from places ``x`` and ``y`` on; x < y."""
        return _extend(self.forward, self.top, x, y)

    def left(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of equal letters in front of places ``x`` and ``y``."""
        return _extend(self.backward, self.top_mirrored, self.size - x, self.size - y)


def _extend(levels: list[Level], top: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    begin, x, y = x, x.copy(), y.copy()
    stopped: list[np.ndarray] = []
    live = np.arange(len(x))
    for level in levels:
        # Climb: walk to the end of the parents on both sides, which must be the same walk.
        a, b = x[live], y[live]
        same = level.letters[a] == level.letters[b]
        inside = same & ((level.before[a] > 0) | (level.before[b] > 0))
        if level.blocks:
            ahead_a, ahead_b = level.from_here[a], level.from_here[b]
            step = np.where(inside & (ahead_a == ahead_b), ahead_a, 0)
        else:
            step = inside.astype(np.int32)
        a, b = a + step, b + step
        x[live], y[live] = a, b
        climbs = same & (level.before[a] == 0) & (level.before[b] == 0)
        stopped.append(live[~climbs])
        live = live[climbs]
        x[live], y[live] = level.parent[x[live]], level.parent[y[live]]
    _walk(top, None, x, y, live)
    for level, here in zip(reversed(levels), reversed(stopped)):
        x[live], y[live] = level.first[x[live]], level.first[y[live]]
        live = np.concatenate([live, here])
        _walk(level.letters, level.from_here if level.blocks else None, x, y, live)
    return x - begin


def _walk(letters: np.ndarray, ahead: np.ndarray | None, x: np.ndarray, y: np.ndarray, live: np.ndarray) -> None:
    """Moves on while the letters agree; in blocks by as many as both have left."""
    while len(live):
        a, b = x[live], y[live]
        same = letters[a] == letters[b]
        live, a, b = live[same], a[same], b[same]
        step = 1 if ahead is None else np.minimum(ahead[a], ahead[b])
        x[live], y[live] = a + step, b + step


def candidates(letters: np.ndarray, ends: np.ndarray, rules: RunRules) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs on the harmonic grid. ``ends`` are the ends of the texts in ``letters``, longest text
    first, so that long periods look at long texts only."""
    sizes = np.diff(np.append(-1, ends)) - 1
    places, periods = [], []
    most = int(sizes[0]) // rules.min_exponent if len(sizes) else 0
    for p in range(1, most + 1):
        texts = int(np.searchsorted(-sizes, -max(rules.min_words, rules.min_exponent * p), side="right"))
        if not texts:
            break
        grid = letters[: ends[texts - 1] : p]
        same = grid[1:] == grid[:-1]
        hits = np.flatnonzero(same[2:] & same[1:-1] & same[:-2])
        if len(hits):
            places.append(hits.astype(np.int64) * p)
            periods.append(np.full(len(hits), p, np.int64))
    flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return flat(places), flat(periods)


def _ends_of(grammar: Grammar, at: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return at - grammar.left(at, at + p), at + p + grammar.right(at, at + p)


def runs_of(texts: list[np.ndarray], rules: RunRules = RunRules()) -> list[np.ndarray]:
    """Per text, a sequence of letters 0, 1, 2, ..., its runs as rows (start, length, period) by start, then period."""
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(texts)
    order = sorted((i for i, t in enumerate(texts) if len(t) >= rules.min_words), key=lambda i: -len(texts[i]))
    if not order:
        return out

    def joined(of: list[int]) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum([len(texts[i]) + 1 for i in of]) - 1
        letters = np.zeros(ends[-1] + 1, np.int32)
        for i, end in zip(of, ends):
            letters[end - len(texts[i]) : end] = texts[i]
        letters[ends] = max(int(texts[i].max()) for i in of) + 1 + np.arange(len(of))
        return letters, ends

    letters, ends = joined(order)
    at, p = candidates(letters, ends, rules)
    text = np.searchsorted(ends, at)
    inside = at + 3 * p < ends[text]  # not from one text to the next
    at, p, text = at[inside], p[inside], text[inside]
    if not len(at):
        return out
    # The grammar is made of the texts that hold candidates.
    held = np.unique(text)
    starts = np.append(0, ends[:-1] + 1)
    kept = [order[i] for i in held]
    letters, new_ends = joined(kept)
    new_starts = np.append(0, new_ends[:-1] + 1)
    now = np.searchsorted(held, text)
    at = at - starts[text] + new_starts[now]
    grammar = Grammar(letters)

    # Neighbouring candidates of one period are mostly one run: the first of them is asked first.
    leads = np.append(True, (np.diff(at) != p[1:]) | (np.diff(p) != 0))
    lead = np.flatnonzero(leads)
    start, end = _ends_of(grammar, at[lead], p[lead])
    mine = np.cumsum(leads) - 1
    rest = np.flatnonzero(~leads & (at + p >= end[mine]))
    more_start, more_end = _ends_of(grammar, at[rest], p[rest])
    start, end = np.concatenate([start, more_start]), np.concatenate([end, more_end])
    period = np.concatenate([p[lead], p[rest]])
    long = end - start >= np.maximum(rules.min_words, rules.min_exponent * period)
    start, end, period = start[long], end[long], period[long]
    # One stretch has one smallest period; multiples of it give the same stretch.
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    new = np.append(True, (np.diff(start) != 0) | (np.diff(end) != 0))[: len(start)]
    start, end, period = start[new], end[new], period[new]
    by = np.lexsort((period, start))
    start, end, period = start[by], end[by], period[by]
    text = np.searchsorted(new_ends, start)
    rows = np.stack([start - new_starts[text], end - start, period], axis=1)
    for i in np.unique(text):
        out[kept[i]] = rows[text == i]
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in no run behind its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] == 0


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """Run with the exactly greatest length / period; ties to the smallest start, then period."""
    if not len(runs):
        return None
    ratio = runs[:, 1] / runs[:, 2]
    close = runs[ratio >= ratio.max() * (1 - 1e-12)].tolist()  # what doubles cannot tell apart
    return tuple(min(close, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])))


def find_runs(docs: DataFrame, rules: RunRules = RunRules()) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), the strongest run's start, length,
    period and exponent_milli (NULL without runs), and the text with each run cut to its first period.

    Words are runs of characters other than ASCII white space, numbered from 0; kept words are joined by
    one space. NULL and blank texts have no words and an empty text. Texts of any length are worked on
    whole, in memory in proportion to the longest. Rows are independent: ids may be NULL or repeat, and each row
    gives one row. An empty table gives no rows; extra columns are dropped.
    """
    docs = pick(docs, "doc_id", "text")
    run_type = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(run_type)), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("period", T.LongType()),
        T.StructField("exponent_milli", T.LongType()), T.StructField("collapsed", T.StringType()),
    ])

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)

        def rows(ids: list, texts: list[list[bytes]]):
            names: dict[bytes, int] = {}
            letters = [np.array([names.setdefault(w, len(names)) for w in words], np.int32) for words in texts]
            found = runs_of(letters, rules)
            out: list[tuple] = []
            for doc_id, words, runs in zip(ids, texts, found):
                best = strongest(runs)
                if best:
                    words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs))]
                    best = (*best, 1000 * best[1] // best[2])
                out.append((doc_id, len(words), runs, *(best or (None,) * 4), b" ".join(words)))
            counts = [len(t) for t in texts]
            for i in range(0, len(out), 1024):
                part = out[i : i + 1024]
                run_rows = np.concatenate([r[2] for r in part])
                offsets = np.cumsum([0] + [len(r[2]) for r in part])
                fields = [pa.array(run_rows[:, k], pa.int64()) for k in range(3)]
                struct = pa.StructArray.from_arrays(fields, fields=list(arrow.field("runs").type.value_type))
                columns = [
                    pa.array([r[0] for r in part], arrow.field("doc_id").type), pa.array(counts[i : i + 1024], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct).cast(arrow.field("runs").type),
                    *[pa.array([r[k] for r in part], pa.int64()) for k in (3, 4, 5, 6)],
                    pa.array([r[7] for r in part], pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

        ids, texts, held = [], [], 0
        for batch in batches:
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                text = batch.column(1)[i].as_py()
                words = (text or "").encode().split()  # bytes split at ASCII white space, as the word rule does
                if texts and held + len(words) > rules.batch_words:
                    yield from rows(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                held += len(words)
        if texts:
            yield from rows(ids, texts)

    return docs.mapInArrow(work, schema)
