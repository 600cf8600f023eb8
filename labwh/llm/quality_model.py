"""Quality classifier: regularised quadratic discriminant over document statistics.

Statistics of whole texts are columns; class means and second moments are one aggregation over all
labelled rows (two rows reach the driver). Covariances shrink towards the pooled one and towards a
multiple of the identity. Scores compare Mahalanobis log densities by Cholesky factors that are
computed once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.llm.common import pick, staged
from labwh.llm.quality_rules import CLASSES, document_statistics


def features(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, ``carried`` (a struct of the columns ``carry``) and ``x``, the transformed statistics of every whole text. Counts become logarithms,
    shares square roots; NULL and empty texts are all zero."""
    s = document_statistics(docs, carry)
    chars = F.col("word_chars") + F.get("class_counts", F.lit(CLASSES.index("space")))
    share = lambda part, whole: F.when(whole > 0, F.sqrt(part / whole)).otherwise(0.0)
    n = F.col("n_words")
    unique = F.size(F.array_distinct("words"))
    short = F.size(F.filter("words", lambda w: F.length(w) <= 3))
    values: list[Column] = [
        F.log1p(n.cast("double")),
        F.when(n > 0, F.log(F.col("word_chars") / n)).otherwise(0.0),
        F.when(n > 0, F.log(unique / n)).otherwise(0.0),
        share(short, n),
        share(F.col("n_dup_lines"), n),
        *[share(F.get("class_counts", F.lit(CLASSES.index(c))), chars)
          for c in ("space", "upper", "digit", "symbol", "punctuation")],
    ]
    return s.select("doc_id", "carried", F.array(*[v.cast("double") for v in values]).alias("x"))


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors, log determinants and log priors of classes 0 and 1. Without
    rows of both classes there are no factors, and every score is ``constant``."""

    means: tuple[np.ndarray, ...] = ()
    factors: tuple[np.ndarray, ...] = ()
    log_dets: tuple[float, ...] = ()
    log_priors: tuple[float, ...] = ()
    constant: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1, row by row."""
        if not self.factors:
            return np.full(len(x), self.constant)
        density = [
            p - 0.5 * (d + (((x - m) @ f.T) ** 2).sum(1))
            for m, f, d, p in zip(self.means, self.factors, self.log_dets, self.log_priors)
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def discriminant(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], to_pooled: float = 0.2,
                 to_identity: float = 0.02) -> Discriminant:
    """From count, sum and sum of outer products of each class. ``to_pooled`` is the share of the
    pooled covariance in each class's, ``to_identity`` that of the identity times its mean variance."""
    known = {k: v for k, v in moments.items() if v[0] > 1}
    if set(known) != {0, 1}:
        total = sum(v[0] for v in moments.values())
        return Discriminant(constant=moments[1][0] / total if total and 1 in moments else 0.0 if total else 0.5)
    total = sum(v[0] for v in known.values())
    means = {k: s / n for k, (n, s, _) in known.items()}
    spread = {k: ss / n - np.outer(means[k], means[k]) for k, (n, _, ss) in known.items()}
    pooled = sum(known[k][0] / total * spread[k] for k in known)
    factors, dets = [], []
    for k in (0, 1):
        cov = (1 - to_pooled) * spread[k] + to_pooled * pooled
        d = len(cov)
        cov = (1 - to_identity) * cov + to_identity * max(np.trace(pooled) / d, 1e-6) * np.eye(d)
        low = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(low))
        dets.append(float(2 * np.log(np.diag(low)).sum()))
    return Discriminant(tuple(means[k] for k in (0, 1)), tuple(factors), tuple(dets),
                        tuple(float(np.log(known[k][0] / total)) for k in (0, 1)))


def fit(labelled: DataFrame, **shrinkage: float) -> Discriminant:
    """From ``x`` and ``label`` (0 or 1; others are ignored), over all rows."""
    rows = labelled.where(F.col("label").isin(0, 1))
    d = len(features_names())
    cells = [F.get("x", F.lit(i)) for i in range(d)]
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(cells)]
    products = [F.sum(cells[i] * cells[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    found = rows.groupBy("label").agg(F.count("*").alias("n"), *sums, *products).collect()
    moments = {}
    for r in found:
        second = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                second[i, j] = second[j, i] = r[f"p{i}_{j}"]
        moments[int(r["label"])] = (r["n"], np.array([r[f"s{i}"] for i in range(d)]), second)
    return discriminant(moments, **shrinkage)


def features_names() -> tuple[str, ...]:
    """Names of the entries of ``x``."""
    return ("words", "word_length", "distinct", "short", "dup_lines", "space", "upper", "digit", "symbol", "punctuation")


def scored(rows: DataFrame, model: Discriminant) -> DataFrame:
    """``rows`` with ``score`` from ``x``."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(model.score(np.vstack(x.to_numpy())) if len(x) else [])

    return rows.withColumn("score", score("x"))


def classify(docs: DataFrame, labels: DataFrame, used: Column | None = None,
             learn_from: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, ``carried`` (a struct of the columns ``carry``), score and predicted for every document, learned from ``labels`` (doc_id, label) of the
    documents ``learn_from`` (default: the same ones).

    ``used`` is a condition on doc_id that labelled rows must meet. A document with several labels
    counts with the largest. NULL ids, NULL labels and labels without a document teach nothing; such
    documents are scored like any other. Repeated rows give repeated results, an empty table none;
    extra columns are dropped. Labels and ids are no input of a score. Texts of any length are taken whole.
    """
    rows = features(docs, carry)
    if learn_from is None:  # else each table is read once
        rows = staged(rows, "quality-features")
    known = pick(labels, "doc_id", "label").where(F.col("label").isNotNull())
    if used is not None:
        known = known.where(used)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    shown = rows if learn_from is None else features(learn_from)
    model = fit(shown.join(known, "doc_id"))
    return scored(rows, model).select(
        "doc_id", "carried", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
