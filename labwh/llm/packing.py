"""Packing by minimum bin slack.

Documents become token ids; whole windows of a long document are sequences of their own, and the
remainders are packed: for each window the longest remaining piece is taken, and a bitset
subset-sum over the multiset of remaining lengths picks what fills the rest closest to capacity,
with counts found by backtracking. Slack that is left is closed by cutting one more piece, and the
last window of a pool is split at powers of two, so no sequence is padded.

Pieces are packed in pools of bounded size inside the task that tokenised them: nothing is
shuffled, memory is bounded by the pool, and a lost task repeats only its own work.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from labwh.llm.common import pick

if TYPE_CHECKING:
    import tiktoken


#: White space as the pattern's \s has it; Python's has \x1c to \x1f besides.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space from this length on is cut out before the pattern, which fails on about a million.
LONG_RUN = 100_000
LONG_SPACES = re.compile(f"(?<![{SPACES}])[{SPACES}]{{{LONG_RUN},}}")


class Encoder:
    """Ids as the ``tokenizers`` library gives them without options but ``add_special_tokens=False``: the added
    tokens of the vocabulary stand for themselves wherever they occur, the text between them is split by the
    pattern and merged by rank."""

    def __init__(self, ranks: tiktoken.Encoding, added: dict[str, int]):
        self._ranks, self._added = ranks, added
        marks = sorted(map(re.escape, added), key=len, reverse=True)
        self._marks = re.compile(f"({'|'.join(marks)})") if added else None

    def encode_ordinary(self, text: str) -> list[int]:
        if not any(mark in text for mark in self._added):
            return self._split(text)
        ids: list[int] = []
        for part in self._marks.split(text):
            if part in self._added:
                ids.append(self._added[part])
            else:
                ids += self._split(part)
        return ids

    def _split(self, text: str) -> list[int]:
        """Long white space is one piece, without its last character if a text follows, as by the pattern."""
        if len(text) < LONG_RUN:
            return self._ranks.encode_ordinary(text)
        ids, at = [], 0
        for run in LONG_SPACES.finditer(text):
            end = run.end() - (run.end() < len(text))
            ids += self._ranks.encode_ordinary(text[at : run.start()])
            ids += self._ranks._encode_single_piece(text[run.start() : end])
            at = end
        return ids + self._ranks.encode_ordinary(text[at:])


@dataclass(frozen=True)
class ByteBpe:
    """A byte-level BPE vocabulary as ranks, with the added tokens of its ``tokenizers`` file. The encoder gives the
    ids that the ``tokenizers`` library gives for that file (tested); it is about five times faster."""

    path: str
    pattern: str
    added: tuple[tuple[str, int], ...] = ()

    @staticmethod
    def named(name: str = "byte_bpe_50k.tiktoken") -> ByteBpe:
        import public_tokenizers

        added, of_tokenizers = [], public_tokenizers.path(name.replace(".tiktoken", ".json"))
        if os.path.exists(of_tokenizers):
            with open(of_tokenizers, encoding="utf-8") as file:
                added = json.load(file)["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{name} has added tokens that take in or ask for what is beside them")
        return ByteBpe(public_tokenizers.path(name), public_tokenizers.PATTERN,
                       tuple((t["content"], t["id"]) for t in added))

    def encoder(self) -> Encoder:
        import base64

        import tiktoken

        with open(self.path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return Encoder(tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={}),
                       dict(self.added))


def fill(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """Counts of lengths whose sum is closest to ``room`` from below.

    ``lengths`` is ascending; ``counts`` says how many of each are left. Bit s of the set is on if s
    can be reached. Longer pieces come first and the search stops once ``room`` is reached, so
    short pieces are kept for later windows.
    """
    reach, mask, trail = 1, (1 << (room + 1)) - 1, []
    for at in range(bisect_right(lengths, room) - 1, -1, -1):
        length = lengths[at]
        left = min(counts[length], room // length)
        if not left:
            continue
        trail.append((length, reach))
        step = 1
        while left:
            take = min(step, left)
            reach |= (reach << take * length) & mask
            left -= take
            step *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(trail):
        used = 0
        while not before >> total & 1:
            total -= length
            used += 1
        if used:
            chosen[length] = used
    return chosen


def pack_lengths(pieces: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences for pieces of 1 to ``capacity`` - 1 tokens: lists of (piece, start in it, length).

    Each token lies in exactly one sequence. All sequences have ``capacity`` tokens except the last
    ones, whose sizes are the powers of two of what is left.
    """
    queues: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i in range(len(pieces) - 1, -1, -1):
        queues[pieces[i]].append((i, 0))
    counts = defaultdict(int, {k: len(v) for k, v in queues.items()})
    lengths = sorted(queues)
    left = sum(pieces)
    out: list[list[tuple[int, int, int]]] = []

    def pop(length: int) -> tuple[int, int, int]:
        piece, start = queues[length].pop()
        counts[length] -= 1
        if not counts[length]:
            del lengths[bisect_right(lengths, length) - 1]
        return piece, start, length

    while left >= capacity:
        longest = lengths[-1]
        window = [pop(longest)]
        chosen = fill(lengths, counts, capacity - longest)
        if longest + sum(k * n for k, n in chosen.items()) == capacity:
            # The same multiset again, as often as it is there.
            need = dict(chosen)
            need[longest] = need.get(longest, 0) + 1
            have = {k: counts[k] + (k == longest) for k in need}
            times = min(have[k] // n for k, n in need.items())
            for again in range(times):
                if again:
                    window = [pop(longest)]
                window += [pop(k) for k, n in chosen.items() for _ in range(n)]
                out.append(window)
            left -= times * capacity
            continue
        window += [pop(k) for k, n in chosen.items() for _ in range(n)]
        slack = capacity - sum(x[2] for x in window)
        piece, start, length = pop(lengths[-1])
        window.append((piece, start, slack))
        rest = length - slack
        if not counts[rest]:
            lengths.insert(bisect_right(lengths, rest), rest)
        queues[rest].append((piece, start + slack))
        counts[rest] += 1
        out.append(window)
        left -= capacity

    tail = [pop(lengths[-1]) for _ in range(sum(counts.values()))]
    while left:
        size = 1 << left.bit_length() - 1
        window, room = [], size
        while room:
            piece, start, length = tail.pop(0)
            took = min(room, length)
            window.append((piece, start, took))
            if took < length:
                tail.insert(0, (piece, start + took, length - took))
            room -= took
        out.append(window)
        left -= size
    return out


def pack(docs: DataFrame, tokenizer: ByteBpe | None = None, capacity: int = 2048, end_id: int = 1,
         pool_pieces: int = 4096) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit),
    sequence_id and offset (gapless from 0 in each sequence).

    NULL and empty texts are the end id alone. Very long texts are cut into windows. Repeated rows
    are packed as often as they occur; an empty table gives no rows; extra columns are dropped.
    Sequence ids are unique: the task's number and a running number in it.
    """
    tokenizer = tokenizer or ByteBpe.named()
    docs = pick(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        encode = tokenizer.encoder().encode_ordinary
        sequence = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        pool: list[tuple] = []

        def ready(force: bool = False):
            if rows and (force or len(rows) >= 1024):
                columns = [pa.array(c, arrow.field(i).type) for i, c in enumerate(zip(*rows))]
                rows.clear()
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

        def flush():
            nonlocal sequence
            for window in pack_lengths([len(p[3]) // 4 for p in pool], capacity):
                offset = 0
                for piece, start, length in window:
                    doc_id, begin, tokens, ids = pool[piece]
                    rows.append((doc_id, begin + start, length, tokens, ids[4 * start : 4 * (start + length)],
                                 sequence, offset))
                    offset += length
                sequence += 1
                yield from ready()
            pool.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array(encode(text.as_py() or "") + [end_id], dtype="<u4")
                whole = len(ids) // capacity * capacity
                for start in range(0, whole, capacity):
                    rows.append((doc_id, start, capacity, len(ids), ids[start : start + capacity].tobytes(), sequence, 0))
                    sequence += 1
                if whole < len(ids):
                    pool.append((doc_id, whole, len(ids), ids[whole:].tobytes()))
                yield from ready()
                if len(pool) >= pool_pieces:
                    yield from flush()
        yield from flush()
        yield from ready(force=True)

    return docs.mapInArrow(run, schema)
