"""Helpers shared by the corpus operators: staged tables, whitespace rule, split of rows into folds."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labwh.sources.staging import shared_dir

#: White space of the word rule, as a Java character class and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def fresh_path(spark: SparkSession, stem: str) -> str:
    """New path in the shared folder. Whoever runs the job empties that folder afterwards; results
    are lazy, so an operator cannot remove what its result still reads."""
    return f"{shared_dir(spark)}/{stem}-{uuid.uuid4().hex}"


def staged(df: DataFrame, stem: str) -> DataFrame:
    """Written once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, stem)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns never clash with computed ones."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % folds


def words_of(text: Column) -> Column:
    """Words of a text as an array; NULL text has none."""
    inner = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(inner != "", F.split(inner, SPACE_CLASS + "+")).otherwise(F.array().cast("array<string>"))


def doubles(values: Sequence[float]) -> Column:
    """A constant array of doubles; folded to one literal by the optimizer."""
    if not values:
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")
