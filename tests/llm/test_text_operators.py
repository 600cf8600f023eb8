"""Packing, mixing, language id, quality rules and classifier against brute force and edge cases."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labwh.llm import langid, mixing, packing, quality_model, quality_rules

DOCS = "doc_id long, text string, lang string, source string, start long, carried string, k long"
ODD = [None, "", " \n\t", "a", "a b c a b c", "x\x0by\x85z", "é ü 漢字 😀", "l\nl\n \nl", "### $$ %"]


def documents(spark, texts, langs=("en", None), sources=("s1", "s2", None)):
    """Rows with clashing extra columns; ids count from 0."""
    rows = [(i, t, langs[i % len(langs)], sources[i % len(sources)], 7, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@given(st.lists(st.integers(1, 63), max_size=120), st.sampled_from([64, 100]))
@settings(max_examples=60, deadline=None)
def test_packed_lengths_cover_each_token_once_without_padding(pieces, capacity):
    seen = [[0] * n for n in pieces]
    for window in packing.pack_lengths(pieces, capacity):
        size = sum(n for *_, n in window)
        assert size == capacity or size & (size - 1) == 0
        for piece, start, n in window:
            for i in range(start, start + n):
                seen[piece][i] += 1
    assert all(x == 1 for piece in seen for x in piece)


@given(st.lists(st.integers(1, 40), max_size=10), st.integers(0, 80))
@settings(max_examples=80, deadline=None)
def test_fill_is_the_best_subset_sum(pieces, room):
    counts = Counter(pieces)
    chosen = packing.fill(sorted(counts), counts, room)
    assert all(0 < n <= counts[k] for k, n in chosen.items())
    sums = {0}
    for p in pieces:
        sums |= {s + p for s in sums}
    assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= room)


@given(st.text(max_size=80))
@settings(max_examples=150, deadline=None)
def test_rank_encoder_gives_the_ids_of_the_tokenizers_library(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    if not hasattr(test_rank_encoder_gives_the_ids_of_the_tokenizers_library, "pair"):
        own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        own.encode_special_tokens = True
        test_rank_encoder_gives_the_ids_of_the_tokenizers_library.pair = own, packing.ByteBpe.named().encoder()
    own, ranks = test_rank_encoder_gives_the_ids_of_the_tokenizers_library.pair
    assert ranks.encode_ordinary(text) == own.encode(text, add_special_tokens=False).ids


def unmodified_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: own.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_encoded_as_by_the_unmodified_tokenizer(spark):
    own, encode = unmodified_tokenizer(), packing.ByteBpe.named().encoder().encode_ordinary
    mark = "<|endoftext|>"
    assert encode(f"a{mark}b") == [64, 50256, 65]
    rnd = random.Random(3)
    bits = [mark, mark, "<|endoftext", "|>", "<|", " ", "  ", "\n", "a", " word's", "12", "é漢😀", "\x1c\x85"]
    texts = [mark, mark * 3, f" {mark} ", f"x  {mark}  y", f"<{mark}>"] + [
        "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 12))) for _ in range(500)]
    assert [encode(t) for t in texts] == [own(t) for t in texts]
    found = defaultdict(dict)
    for r in packing.pack(documents(spark, texts[:40]), capacity=16).collect():
        assert r.doc_tokens == len(own(texts[r.doc_id])) + 1
        found[r.doc_id][r.start] = np.frombuffer(r.ids, "<u4").tolist()
    assert all(sum((found[i][s] for s in sorted(found[i])), []) == own(t) + [1] for i, t in enumerate(texts[:40]))


def test_very_long_white_space_is_encoded_as_by_the_unmodified_tokenizer(spark):
    own, encode = unmodified_tokenizer(), packing.ByteBpe.named().encoder().encode_ordinary
    many = 1_100_000
    texts = [" " * many + "a", "x" + " " * many, "a\n" + "\n" * many + " b", "\u2003\xa0" * (many // 2) + "1", " \n" * (many // 2) + "!",
             " " * many + "<|endoftext|>" + " " * many + "é", ("x" + " " * 99_999) * 12 + "y" + " " * 100_000 + "z",
             "\x1c" * many + "a", " " * 300_000 + "\x1f" + " " * 300_000]
    for text in texts:
        assert encode(text) == own(text)
    rows = packing.pack(documents(spark, texts[:1])).collect()
    assert sum(r.length for r in rows) == len(own(texts[0])) + 1 == rows[0].doc_tokens


def test_pack_gives_every_document_back(spark):
    texts = ODD + ["word " * 3000, "word " * 3000, "a<|endoftext|>b"]
    rows = packing.pack(documents(spark, texts), capacity=64, pool_pieces=5).collect()
    encode = packing.ByteBpe.named().encoder().encode_ordinary
    ids, ends = defaultdict(dict), defaultdict(int)
    for r in rows:
        got = np.frombuffer(r.ids, "<u4").tolist()
        assert len(got) == r.length and r.start not in ids[r.doc_id]
        ids[r.doc_id][r.start] = got
    for i, t in enumerate(texts):
        assert sum((ids[i][s] for s in sorted(ids[i])), []) == encode(t or "") + [1]
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert all(n == 64 or n & (n - 1) == 0 for n in ends.values())
    assert packing.pack(documents(spark, [])).count() == 0


def test_targets_share_what_is_beyond_the_limit():
    got = mixing.target_words([("b", 100), (None, 100), ("a", 10), ("c", 100)], weights=(5, 2, 1))
    assert got["a"] == 20 and math.isclose(sum(got.values()), 1.5 * 310)
    assert math.isclose(got["b"] / got["c"], 2) or got["b"] == 200
    assert mixing.target_words([]) == {} and mixing.target_words([("a", 0)]) == {"a": 0}


@given(st.lists(st.floats(0.01, 0.99), min_size=3, max_size=3), st.lists(st.integers(1, 9), min_size=3, max_size=3),
       st.floats(0, 0.999))
@settings(max_examples=100, deadline=None)
def test_a_step_keeps_both_totals_and_settles_a_unit(p, x, draw):
    moved = mixing.move(p, x, draw)
    assert math.isclose(sum(moved), sum(p), abs_tol=1e-6)
    assert math.isclose(sum(a * b for a, b in zip(moved, x)), sum(a * b for a, b in zip(p, x)), abs_tol=1e-5)
    assert any(m in (0.0, 1.0) for m in moved) and all(0 <= m <= 1 for m in moved)


def test_mix_comes_near_its_targets_and_agrees_with_reruns(spark):
    rnd = random.Random(2)
    texts = [" ".join("w" * rnd.randint(1, 60)) for _ in range(600)] + ODD + ["a b"] * 30
    docs = documents(spark, texts)
    got = mixing.mix(docs, cell_rows=64).collect()
    assert len(got) == len(texts)
    taken, target = Counter(), {}
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 3 for s, t in target.items())
    again = mixing.mix(docs.repartition(3), cell_rows=64).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    assert mixing.mix(documents(spark, [])).count() == 0


def test_language_is_learned_from_used_rows_only(spark):
    rnd = random.Random(4)
    make = lambda letters: " ".join("".join(rnd.choice(letters) for _ in range(4)) for _ in range(30))
    texts = [make("abcde" if i % 2 else "uvwxyz") for i in range(120)] + ["123 !", None, "", "vwx" * 20_000]
    docs = documents(spark, texts, langs=("L2", "L1"))
    model = langid.fit(docs, used=F.col("doc_id") % 5 != 0, landmarks=16)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert all(got[i].lang_pred == ("L1" if i % 2 else "L2") for i in range(120))
    assert [got[i].lang_pred for i in range(120, 124)] == ["und", "und", "und", "L2"]
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = langid.fit(docs.where("false"))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(docs.where("false"), model).count() == 0


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    places = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(places))


def test_base_counts_equal_brute_force(spark):
    rnd = random.Random(1)
    texts = ODD + [" ".join(rnd.choice("abcdefgh") for _ in range(n)) for n in (2, 3, 40, 300, 5000)] + ["q\nq " * 30]
    got = quality_rules.judge(documents(spark, texts), carry=["source"]).collect()
    assert len(got) == len(texts)
    for r in got:
        n, *_, repeated = want = base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n) and not (r.base_failed and r.kept)
        assert r.carried.source == (("s1", "s2", None)[r.doc_id % 3])
    assert quality_rules.judge(documents(spark, [])).count() == 0


def test_divergent_documents_are_rejected(spark):
    rnd = random.Random(6)
    word = lambda: rnd.choice(["the", "of", "and"]) if rnd.random() < 0.3 else f"word{rnd.choice('abcdefghijklmnop')}x" * rnd.randint(1, 9)
    plain = lambda: " ".join(word() for _ in range(120))
    bad = [" ".join(f"W{rnd.randint(1, 400)}##$" for _ in range(120)) for _ in range(3)]
    got = {r.doc_id: r.kept for r in quality_rules.judge(documents(spark, [plain() for _ in range(60)] + bad, langs=("en",))).collect()}
    assert all(got[i] for i in range(60)) and not any(got[60 + i] for i in range(3))


def test_common_words_have_any_length(spark):
    texts = ["nevertheless the 東京都庁舎前広場" if i % 2 else "nevertheless of" for i in range(6)]
    got = quality_rules.common_words(documents(spark, texts, langs=("en",)), quality_rules.DivergenceRules())
    assert got["en"] == got[quality_rules.POOLED] == ["nevertheless", "of", "the", "東京都庁舎前広場"]


def test_js_distance(spark):
    row = spark.range(1).select(
        quality_rules.js_distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0))).alias("far"),
        quality_rules.js_distance(F.array(F.lit(0.5), F.lit(0.5)), F.array(F.lit(0.5), F.lit(0.5))).alias("near")).first()
    assert math.isclose(row.far, 1.0) and row.near == 0.0


def test_discriminant_equals_the_densities():
    rnd = np.random.default_rng(3)
    x = {0: rnd.normal(0, 2, (300, 3)), 1: rnd.normal(1, 1, (500, 3))}
    model = quality_model.discriminant({k: (len(v), v.sum(0), v.T @ v) for k, v in x.items()}, 0.0, 0.0)
    probe = rnd.normal(0, 2, (20, 3))

    def density(k):
        cov = np.cov(x[k].T, bias=True)
        d = probe - x[k].mean(0)
        return np.log(len(x[k])) - 0.5 * (np.linalg.slogdet(cov)[1] + np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))

    assert np.allclose(model.score(probe), 1 / (1 + np.exp(density(0) - density(1))))


def test_classifier_on_odd_rows_and_missing_labels(spark):
    rnd = random.Random(8)
    good = [" ".join(f"w{rnd.randint(1, 200)}" for _ in range(60)) for _ in range(40)]
    bad = ["spam! " * rnd.randint(40, 80) for _ in range(40)]
    docs = documents(spark, good + bad + ODD)
    labels = spark.createDataFrame([(i, 1 if i < 40 else 0, "x") for i in range(60)] + [(None, 1, "x"), (2, None, "x"), (10**6, 0, "x")],
                                   "doc_id long, label int, text string")
    got = {r.doc_id: r for r in quality_model.classify(docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got.values())
    assert sum(got[i].predicted == (i < 40) for i in range(80)) >= 78
    alone = quality_model.classify(docs, labels.where("label = 1")).collect()
    assert {r.score for r in alone} == {1.0}
    assert {r.score for r in quality_model.classify(docs, labels.where("false")).collect()} == {0.5}
    assert quality_model.classify(docs.where("false"), labels).count() == 0
