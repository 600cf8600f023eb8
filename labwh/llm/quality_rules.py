"""Quality rules by distribution divergence.

A document's character-class histogram and its common-word histogram are compared with references
of its language by Jensen-Shannon distance (base 2, so 0 to 1). References are statistics of the
whole corpus: the most frequent words of each language, and the mean histograms of its documents.

Everything is DataFrame code. Corpus statistics reduce before the shuffle (one row per distinct
word and task, one row per language and task), so a hot language or source does not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labwh.llm.common import SPACE_CLASS, doubles, fresh_path, pick, staged, words_of

CLASSES = ("lower", "space", "upper", "digit", "symbol", "other_letter", "punctuation")
SYMBOLS = "#*$%&|<>"
#: Name of the reference made from all languages, for documents without a known one.
POOLED = "*"


@dataclass(frozen=True)
class DivergenceRules:
    """Thresholds. ``common_words`` words make a language's word histogram; words over ``max_word_chars``
    characters are never among them, and by default none is that long. Histograms of documents
    under ``min_words`` words are not judged (too noisy), and languages with fewer than
    ``min_reference`` usable documents are judged by the pooled reference."""

    common_words: int = 16
    max_word_chars: int = 2**31 - 1
    min_words: int = 50
    min_reference: int = 20
    max_class_distance: float = 0.30
    max_word_distance: float = 0.40
    max_repeat_percent: int = 50


def _window_hashes(words: Column) -> Column:
    """64-bit hash of each three-word window, in order of position."""
    hashed = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.slice(hashed, 1, F.greatest(F.size(words) - 2, F.lit(0)))


def _repeated_words(hashes: Column) -> Column:
    """Words inside windows that occur at least twice, first included.

    Sorted hashes show which ones repeat. A 64-bit mask of those leaves few windows to be sorted
    with their positions, which settles it exactly; the work is n log n for a text of any length.
    Intermediate arrays are bound once as the only element of an outer array.
    """
    bind = lambda value, then: F.flatten(F.transform(F.array(value), then))
    low = lambda h: h.bitwiseAND(63).cast("int")
    one = F.lit(1).cast("long")
    bit = lambda h: F.call_function("shiftleft", one, low(h))

    def places(g: Column) -> Column:
        return F.filter(
            F.transform(g, lambda x, k: F.when(
                (x["h"] == F.get(g, k - 1)["h"]) | (x["h"] == F.get(g, k + 1)["h"]), x["i"])),
            lambda i: i.isNotNull())

    def candidates(mask: Column) -> Column:
        return F.sort_array(F.filter(
            F.transform(hashes, lambda h, i: F.when(
                bit(h).bitwiseAND(mask) != 0, F.struct(h.alias("h"), i.alias("i")))),
            lambda x: x.isNotNull()))

    mask = bind(F.sort_array(hashes), lambda g: F.array(F.aggregate(
        F.zip_with(g, F.slice(g, 2, F.size(g)), lambda a, b: F.when(a == b, a)),
        F.lit(0).cast("long"),
        lambda m, h: F.when(h.isNull(), m).otherwise(m.bitwiseOR(bit(h))))))
    twice = bind(F.get(mask, F.lit(0)), lambda m: bind(candidates(m), places))
    return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda i: F.array(i, i + 1, i + 2)))))


def document_statistics(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, lang, the columns ``carry`` as one struct ``carried``, the base counts and class histogram, and the words of every whole text. NULL text counts as empty. Extra columns are dropped."""
    carried = F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(None).alias("nothing")])
    t = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"), carried.alias("carried"))
    # Lower-case letters are most of a text; the other classes are counted on what is left.
    t = t.select("*", words_of(F.col("text")).alias("words"),
                 F.regexp_replace("text", r"\p{Ll}+", "").alias("rest"))
    t = t.select("*", F.size("words").cast("long").alias("n_words"),
                 F.regexp_replace("rest", SPACE_CLASS + "+", "").alias("marks"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    t = t.select("*", _window_hashes(F.col("words")).alias("windows"), lines.alias("lines"),
                 F.translate("marks", SYMBOLS, "").alias("plain"))
    t = t.select("*", F.size("windows").alias("n_windows"),
                 F.size(F.array_distinct("windows")).alias("n_distinct"),
                 F.regexp_replace("plain", r"\p{Lu}+", "").alias("no_upper"))
    t = t.select("*", F.regexp_replace("no_upper", "[0-9]+", "").alias("no_digit"))
    t = t.select("*", F.regexp_replace("no_digit", r"\p{L}+", "").alias("punctuation"))
    length = lambda c: F.length(c).cast("long")
    counts = {
        "lower": length("text") - length("rest"),
        "space": length("rest") - length("marks"),
        "upper": length("plain") - length("no_upper"),
        "digit": length("no_upper") - length("no_digit"),
        "symbol": length("marks") - length("plain"),
        "other_letter": length("no_digit") - length("punctuation"),
        "punctuation": length("punctuation"),
    }
    return t.select(
        "doc_id",
        "lang",
        "carried",
        "words",
        "n_words",
        (length("text") - length("rest") + length("marks")).alias("word_chars"),
        (length("marks") - length("plain")).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("n_windows") > F.col("n_distinct"), _repeated_words(F.col("windows"))).otherwise(0).cast("long").alias("n_repeat_words"),
        F.array(*[counts[c].cast("double") for c in CLASSES]).alias("class_counts"),
    )


def common_words(docs: DataFrame, rules: DivergenceRules) -> dict[str, list[str]]:
    """The words that occur in most documents of each language and of all, ties to the smaller
    word; words of every length up to ``max_word_chars`` are counted. At most ``common_words`` rows per
    language reach the driver."""
    words = pick(docs, "lang", "text").select("lang", F.explode(F.array_distinct(words_of(F.col("text")))).alias("word"))
    words = words.where(F.length("word") <= rules.max_word_chars)
    counts = words.groupBy("lang", "word").count()
    # One chain, so that the texts are read once: each count goes to its language and to the pool.
    both = counts.select(
        F.explode(F.array_compact(F.array("lang", F.lit(POOLED)))).alias("lang"), "word", "count"
    ).groupBy("lang", "word").agg(F.sum("count").alias("count"))
    top = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    rows = both.withColumn("r", F.row_number().over(top)).where(F.col("r") <= rules.common_words)
    found: dict[str, list[str]] = {}
    for row in rows.orderBy("lang", "r").select("lang", "word").toLocalIterator():
        found.setdefault(row["lang"], []).append(row["word"])
    return found


def _word_counts(hits: Column, common: Column) -> Column:
    """How often each common word is among ``hits``."""
    return F.transform(common, lambda w: (F.size(hits) - F.size(F.array_remove(hits, w))).cast("double"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms that each sum to 1."""

    def half(x: Column, y: Column) -> Column:
        return F.aggregate(
            F.zip_with(x, y, lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)),
            F.lit(0.0),
            lambda s, v: s + v,
        )

    return F.sqrt(F.greatest(F.lit(0.0), (half(p, q) + half(q, p)) / 2))


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda s, v: s + v)
    return F.transform(counts, lambda v: F.when(total > 0, v / total).otherwise(0.0))


def judge(docs: DataFrame, rules: DivergenceRules = DivergenceRules(), carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: base counts, both distances (NULL where the guard forbids a verdict),
    base_failed and kept, and the columns ``carry`` as one struct ``carried``. Carrying what a filter
    needs saves it a join.

    NULL or empty text has no words and fails the base rules. NULL or rare languages use the pooled
    reference. Repeated rows give repeated results; an empty table gives none.
    """
    common = common_words(docs, rules)
    # A map literal per language is bounded by languages x common_words.
    lists = F.lit(None).cast("array<string>")
    if common:
        named = F.create_map(*[x for k, v in common.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
        lists = F.coalesce(F.element_at(named, F.col("lang")), F.element_at(named, F.lit(POOLED)))
        every = sorted({w for v in common.values() for w in v})
    else:
        every = [""]
    s = document_statistics(docs, carry)
    s = s.select(
        *[c for c in s.columns if c != "words"],
        lists.alias("common"),
        F.filter("words", lambda w: w.isin(every)).alias("hits"),
    )
    s = s.select(*[c for c in s.columns if c not in ("common", "hits")],
                 F.coalesce(_word_counts(F.col("hits"), F.col("common")), F.array().cast("array<double>")).alias("named"))
    s = s.select(
        *[c for c in s.columns if c not in ("named", "class_counts")],
        _shares(F.col("class_counts")).alias("classes"),
        _shares(F.concat("named", F.array(
            F.col("n_words") - F.aggregate("named", F.lit(0.0), lambda a, v: a + v)))).alias("word_shares"),
    )
    stats = staged(s, "divergence-statistics")

    usable = stats.where(F.col("n_words") >= rules.min_words)
    n = rules.common_words + 1
    means = [F.avg(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES))]
    means += [F.avg(F.get("word_shares", F.lit(i))).alias(f"w{i}") for i in range(n)]
    by_lang = usable.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.count("*").alias("n"), *means)
    pooled = usable.groupBy(F.lit(POOLED).alias("lang")).agg(F.count("*").alias("n"), *means)
    refs = {r["lang"]: r for r in by_lang.where(F.col("n") >= rules.min_reference).unionByName(pooled).collect()}

    def reference(kind: str, size: int) -> Column:
        named = [x for k, r in refs.items()
                 for x in (F.lit(k), doubles([r[f"{kind}{i}"] or 0.0 for i in range(size)]))]
        if not named:
            return F.lit(None).cast("array<double>")
        m = F.create_map(*named)
        return F.coalesce(F.element_at(m, F.col("lang")), F.element_at(m, F.lit(POOLED)))

    guard = F.col("n_words") >= rules.min_words
    base_failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    out = stats.select(
        *[c for c in stats.columns],
        reference("c", len(CLASSES)).alias("class_reference"),
        reference("w", n).alias("word_reference"),
    ).select(
        "doc_id", "carried", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        F.when(guard, js_distance(F.col("classes"), F.col("class_reference"))).alias("class_distance"),
        F.when(guard, js_distance(F.col("word_shares"), F.col("word_reference"))).alias("word_distance"),
    )
    far = (F.coalesce("class_distance", F.lit(0.0)) > rules.max_class_distance) | (
        F.coalesce("word_distance", F.lit(0.0)) > rules.max_word_distance
    )
    return out.withColumn("kept", ~F.col("base_failed") & ~far)
