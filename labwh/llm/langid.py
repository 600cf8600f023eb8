"""Language identification by string kernels.

A text is the set of its character n-grams of all lengths up to ``max_n`` (blended spectrum,
presence only), hashed into ``dim`` places. The kernel of two texts is the size of the common set
over the geometric mean of both sizes. Nyström landmarks give an explicit feature map, and
one-versus-rest kernel ridge regression is solved in it; both end up in one matrix, so texts are
scored by two matrix products per batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labwh.llm.common import pick

#: Name for texts without a letter.
UNDETERMINED = "und"


@dataclass(frozen=True)
class SpectrumKernel:
    """``dim`` is a power of two."""

    max_n: int = 3
    dim: int = 1 << 14

    def mark(self, text: str, row: np.ndarray) -> None:
        """Sets the places of the text's n-grams in ``row`` to 1. The whole text is used; its memory
        is four bytes per character and n-gram length."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        shift = np.uint32(32 - self.dim.bit_length() + 1)
        rolled = np.zeros(len(codes), np.uint32)
        for n in range(1, min(self.max_n, len(codes)) + 1):
            # Of the n-gram that starts at each place.
            rolled = rolled[: len(codes) - n + 1] * np.uint32(31) + codes[n - 1 :]
            row[(rolled * np.uint32(2654435761) + np.uint32(n * 40503)) >> shift] = 1

    def presence(self, texts: list[str]) -> np.ndarray:
        rows = np.zeros((len(texts), self.dim), np.float32)
        for text, row in zip(texts, rows):
            self.mark(text, row)
        return rows


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Normalised kernel of two presence matrices; 0 for empty sets."""
    norm = lambda x: np.sqrt(np.maximum(x.sum(1), 1))
    return (a @ b.T) / norm(a)[:, None] / norm(b)[None, :]


@dataclass(frozen=True)
class LanguageModel:
    """Landmark texts and the matrix from their kernel values to the score of each language."""

    spectrum: SpectrumKernel
    languages: tuple[str, ...] = ()
    landmarks: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))

    def predict(self, texts: list[str | None], batch: int = 128) -> tuple[list[str], list[float]]:
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        usable = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        for at in range(0, len(usable), batch):
            some = usable[at : at + batch]
            found = kernel(self.spectrum.presence([texts[i] for i in some]), self.landmarks) @ self.weights
            for i, best, value in zip(some, found.argmax(1), found.max(1)):
                names[i] = self.languages[best]
                scores[i] = float(min(1.0, max(0.0, value)))
        return names, scores


def solve(spectrum: SpectrumKernel, sets: np.ndarray, languages: list[str], landmarks: int, ridge: float) -> LanguageModel:
    """From presence rows in a fixed order and their languages. Landmarks are the first rows of each
    language in turn."""
    names = sorted(set(languages))
    if not names:
        return LanguageModel(spectrum)
    label = np.array([names.index(x) for x in languages])
    per = max(1, landmarks // len(names))
    chosen = np.concatenate([np.flatnonzero(label == k)[:per] for k in range(len(names))])
    marks = sets[chosen]
    values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    phi = kernel(sets, marks).astype(np.float64) @ root
    # Each language weighs alike, whatever its share of the sample.
    weight = 1.0 / np.bincount(label, minlength=len(names))[label]
    weight *= len(label) / weight.sum()
    target = (label[:, None] == np.arange(len(names))).astype(np.float64)
    left = phi.T @ (weight[:, None] * phi) + ridge * np.eye(phi.shape[1])
    return LanguageModel(spectrum, tuple(names), marks, (root @ np.linalg.solve(left, phi.T @ (weight[:, None] * target))).astype(np.float32))


def fit(docs: DataFrame, used: Column | None = None, spectrum: SpectrumKernel = SpectrumKernel(), sample: int = 4000,
        landmarks: int = 128, ridge: float = 1.0, max_languages: int = 1000) -> LanguageModel:
    """Learned from text and non-NULL lang of the rows that meet ``used``.

    About ``sample`` rows, the same number for each language, chosen by hash of the id, and twice that number at
    most, also where ids are NULL or repeat; they reach the driver as packed presence bits (2 KiB each). Languages are a
    catalogue: one row each reaches the driver, and more than ``max_languages`` of them is an error.
    """
    rows = pick(docs, "doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if used is not None:
        rows = rows.where(used)
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(max_languages + 1).collect()}
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not counts:
        return LanguageModel(spectrum)
    quota = max(20, sample // len(counts))
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("lang") == name, min(1.0, quota / n)).otherwise(share)
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30)
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("order", T.LongType()),
                           T.StructField("bits", T.BinaryType())])

    def bits(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out, row = [], np.zeros(spectrum.dim, np.uint8)
            for text in batch.column(2):
                row[:] = 0
                text = text.as_py()
                if any(map(str.isalpha, text)):
                    spectrum.mark(text, row)
                out.append(np.packbits(row).tobytes() if row.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             names=["lang", "order", "bits"])

    # Tasks limit their rows before the shuffle, so rows with one id do not meet in full.
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "text"), "text"))
    some = rows.where(picked).withColumn("turn", turn).where(F.col("turn") <= 2 * quota)
    found = some.select("lang", F.xxhash64("doc_id").alias("order"), "text").mapInArrow(bits, schema)
    some = sorted(((r["order"], r["lang"], bytes(r["bits"])) for r in found.where("bits IS NOT NULL").collect()))
    sets = np.array([np.unpackbits(np.frombuffer(b, np.uint8)) for *_, b in some], dtype=np.float32)
    return solve(spectrum, sets, [lang for _, lang, _ in some], landmarks, ridge)


def predict(docs: DataFrame, model: LanguageModel, batch: int = 128) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every whole text.

    ``und`` and 0 for NULL texts, texts without a letter, and a model that learned nothing. Ties go
    to the first language by name. Repeated rows give repeated results; extra columns are dropped.
    """
    rows = pick(docs, "doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for block in batches:
            names, scores = [], []
            for at in range(0, len(block), batch):
                a, b = model.predict(block.column(1).slice(at, batch).to_pylist(), batch)
                names += a
                scores += b
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)
