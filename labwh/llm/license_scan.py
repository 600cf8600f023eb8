"""License detection by ordered signature rules; DataFrame code only.

* Texts become words in lower case. A word is written with its number in front, so that what a regex
  finds tells its place by itself.
* A rule is tried only on texts that hold its keyword; most texts hold none and cost one look for the keywords.
* Detections of a text are an interval of words each. One that lies inside another is dropped if the other's kind
  is at least as sure; of equal intervals the surer kind stays, then the earlier rule. Detections that only
  overlap both stay.

Rules are a constant of the plan. Texts are not shuffled, only what was found in them: one row per text
and detection, ordered by place, so a text with very many detections is swept in linear time.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labwh.llm.common import pick
from labwh.llm.license_rules import LICENSES, NOTICE, PHRASES, TAG

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Everything in ASCII that is no digit or letter, once A-Z are lower case.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Kinds from the surest on, with what a detection of the kind is worth.
WORTH = {"tag": 1.0, "text": 0.95, "notice": 0.9, "link": 0.85, "name": 0.75, "hint": 0.5}
KINDS = list(WORTH)


@dataclass(frozen=True)
class Signature:
    """A rule: ``regex`` finds ``label`` in numbered words; it is tried on texts that hold the word ``keyword``."""

    label: str
    kind: str
    keyword: str
    regex: str


def numbered(regex: str) -> str:
    """Regex over words with one space between them as one over words with their numbers."""
    step = r"(  \d++:)"
    return r" \d++:(" + re.sub(" ", lambda _: step, regex) + ") "


def signatures(licenses: Mapping[str, str] = LICENSES) -> list[Signature]:
    """Rules in their order: kinds from the surest on, inside a kind as written."""
    found = []
    for label, block in licenses.items():
        for line in filter(None, map(str.strip, block.splitlines())):
            kind, keyword, regex = line.split(" ", 2)
            if kind == "tag":
                found.append(Signature(label, kind, "spdx", numbered(TAG + regex)))
                continue
            found.append(Signature(label, kind, keyword, numbered(regex)))
            if kind == "name":
                found.append(Signature(label, "notice", keyword, numbered(NOTICE + f"({regex})")))
    return sorted(found, key=lambda s: KINDS.index(s.kind))


def _bind(value: Column, then) -> Column:
    """``then`` of a value that is computed once per row; ``then`` gives an array."""
    return F.flatten(F.transform(F.array(value), then))


def _texts(values: list[str]) -> Column:
    """A constant array of texts without line feeds; folded to one literal by the optimizer."""
    return F.split(F.lit("\n".join(values)), "\n")


def _found(words: Column, rules: list[tuple[str, str]]) -> Column:
    """Array of (rule, start, n_words) of all rules (keyword, regex) in an array of words."""
    table = F.arrays_zip(_texts([k for k, _ in rules]).alias("keyword"), _texts([r for _, r in rules]).alias("regex"),
                         _texts([str(i) for i in range(len(rules))]).cast("array<int>").alias("rule"))
    keywords = _texts(sorted({k for k, _ in rules}))

    def hits(text: Column, rule: Column) -> Column:
        return F.transform(F.regexp_extract_all(text, rule["regex"], F.lit(0)), lambda hit: F.struct(
            rule["rule"].alias("rule"),
            F.substring_index(F.ltrim(hit), ":", 1).cast("long").alias("start"),
            (F.length(hit) - F.length(F.replace(hit, F.lit(":"), F.lit("")))).cast("long").alias("n_words")))

    def scan(text: Column, present: Column) -> Column:
        tried = F.filter(table, lambda rule: F.array_contains(present, rule["keyword"]))
        return F.flatten(F.transform(tried, lambda rule: hits(text, rule)))

    def look(each: Column) -> Column:
        present = F.array_intersect(each, keywords)
        text = F.array_join(F.transform(each, lambda w, i: F.concat(F.lit(" "), i.cast("string"), F.lit(":"), w, F.lit(" "))), "")
        return _bind(present, lambda p: F.when(F.size(p) > 0, _bind(text, lambda t: scan(t, p))).otherwise(none))

    none = F.array().cast("array<struct<rule:int,start:bigint,n_words:bigint>>")
    return _bind(words, look)


def _rules(phrases: Mapping[str, str], licenses: Mapping[str, str]) -> tuple[list[Signature], list[Signature]]:
    """Phrases as rules, and the signatures. A phrase's last word is its keyword."""
    base = [Signature(label, "phrase", phrase.split(" ")[-1], numbered(phrase)) for phrase, label in phrases.items()]
    return base, signatures(licenses)


def detect(docs: DataFrame, licenses: Mapping[str, str] = LICENSES, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """One row per document and detection, and one for a document without: row, doc_id, n_words, rule, label, kind,
    worth, start (word number from 0), length (words), kept. ``row`` tells documents apart, ``kept`` is false for
    detections inside others; phrases are always kept and suppress nothing.

    NULL and blank texts have no words. Texts of any length are scanned whole. Ids may be NULL or repeat. An empty
    table gives no rows; extra columns are dropped.
    """
    base, rules = _rules(phrases, licenses)
    every = [*base, *rules]
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, UPPER.lower())
    words = F.trim(F.regexp_replace(text, BETWEEN_WORDS, " "))
    rows = pick(docs, "doc_id", "text").select("doc_id", F.monotonically_increasing_id().alias("row"), words.alias("words"))
    spaces = F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit("")))
    table = [(s.keyword, s.regex) for s in every]
    # Counted before the detections become rows, which then carry no text.
    counted = rows.select("row", "doc_id", F.when(F.col("words") == "", 0).otherwise(spaces + 1).cast("long").alias("n_words"),
                          _found(F.split("words", " "), table).alias("hits"))
    found = counted.select("row", "doc_id", "n_words", F.explode_outer("hits").alias("hit"))
    of = lambda values, kind: F.get(_texts([str(v) for v in values]), F.col("rule")).cast(kind)
    ranks = [0] * len(base) + [KINDS.index(s.kind) + 1 for s in rules]
    seen = found.select("row", "doc_id", "n_words", "hit.rule", "hit.start", F.col("hit.n_words").alias("length")).withColumn(
        "rank", of(ranks, "int"))
    end = F.col("start") + F.col("length")
    # What begins earlier, or together and is not shorter, comes first: of each kind the farthest end so far.
    sweep = Window.partitionBy("row").orderBy("start", F.col("length").desc(), "rank", "rule").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.lit(False)
    for level in range(1, len(KINDS) + 1):
        farthest = F.max(F.when((F.col("rank") >= 1) & (F.col("rank") <= level), end)).over(sweep)
        inside = inside | ((F.col("rank") == level) & F.coalesce(farthest >= end, F.lit(False)))
    return seen.select(
        "row", "doc_id", "n_words", "rule", of([s.label for s in every], "string").alias("label"),
        of([s.kind for s in every], "string").alias("kind"), of([WORTH.get(s.kind, 0.0) for s in every], "double").alias("worth"),
        "start", "length", (~inside).alias("kept"))


def scan(docs: DataFrame, licenses: Mapping[str, str] = LICENSES, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """One row per document: doc_id, n_words; of the phrases n_base (all places), first_word, last_word (NULL without)
    and base_labels; labels of phrases and kept detections; score, what the surest kept detection is
    worth (0 without). Labels are distinct, sorted and joined by commas, '' without. See ``detect`` for odd input.
    """
    seen = detect(docs, licenses, phrases)
    phrase, kept = F.col("kind") == "phrase", F.col("kept")
    joined = lambda cond: F.array_join(F.sort_array(F.collect_set(F.when(cond, F.col("label")))), ",")
    return seen.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.count_if(phrase).alias("n_base"), F.min(F.when(phrase, F.col("start"))).alias("first_word"),
        F.max(F.when(phrase, F.col("start"))).alias("last_word"), joined(phrase).alias("base_labels"),
        joined(kept).alias("labels"), F.coalesce(F.max(F.when(kept, F.col("worth"))), F.lit(0.0)).alias("score"),
        F.count_if(kept & ~phrase).alias("n_detections"),
    ).drop("row")
