"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet, and the next
stage reads that. All but the last return the columns of ``documents``. Documents without doc_id, and
different documents with the same one, are documents like any other: the filters carry the rows, and
the near copies are told apart by a key of the whole row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwh.llm import jaccard, mixing, packing, quality_model, quality_rules
from labwh.llm.common import fold, fresh_path

#: Near copies: at least 0.8 similar in five-word shingles.
NEAR = jaccard.Similarity(percent=80, words=5, lists="shingles")
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Stages express decisions of fitted models and a sampling design; SQL cannot.
ORACLE_SQL = None


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns with h1 and h2, two hashes of the whole row; NULLs count by their place."""
    known = [F.col(c) for c in COLUMNS] + [F.col(c).isNull() for c in COLUMNS]
    return _columns(docs).withColumns({f"h{i}": F.xxhash64(F.lit(i), *known) for i in (1, 2)})


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Rows are carried through, so no text is shuffled."""
    return quality_rules.judge(docs, carry=COLUMNS).where("kept").select("carried.*")


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from the labels of all ``documents``
    without the held-out third: the rules before it leave few examples of bad ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    every = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scores = quality_model.classify(docs, labels, used=fold(F.col("doc_id"), 3) != 1, learn_from=every, carry=COLUMNS)
    return scores.where("predicted = 1").select("carried.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id, rows without one last. Blank
    texts are near copies of nothing; rows that are equal in all columns stay once."""
    rows = _keyed(docs)
    # The join compares its ids only with each other, so the row's key can be one.
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "h1", "h2")
    found = jaccard.join(rows.select(key.alias("doc_id"), "text"), NEAR)
    heads = found.where("doc_id.h1 = component_id.h1 AND doc_id.h2 = component_id.h2").select("doc_id.h1", "doc_id.h2")
    return rows.join(heads, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"]).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. Rows are told apart by a key of the whole row; rows that are
    equal in all columns are one row with the sum of their copies."""
    rows = _keyed(docs).withColumn("row", F.concat_ws("-", F.hex("h1"), F.hex("h2"))).drop("h1", "h2")
    taken = mixing.mix(rows.select(F.col("row").alias("doc_id"), "text", "source")).where("copies > 0")
    times = taken.groupBy(F.col("doc_id").alias("row")).agg(F.sum("copies").alias("times"))
    found = rows.dropDuplicates(["row"]).join(times, "row")
    return found.select(*COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row per piece, with its token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing to weights", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        out = fresh_path(spark, f"stage{i}")
        made = stage(spark, docs, sf_dir)
        made.write.parquet(out)
        docs = spark.read.schema(made.schema).parquet(out)
    return docs.select("doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset")
