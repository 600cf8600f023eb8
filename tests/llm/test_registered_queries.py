"""The registered queries that SQL cannot express, on the given tables, and plain versions of their models."""

from __future__ import annotations

import itertools
import math
import pathlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from labwh.llm import langid, mixing, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no generated tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_op1_covers_every_id_once(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in queries.op1_packing(spark, FOLDER).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for doc_id, found in pieces.items():
        ids = np.array(tokenizer.encode(docs[doc_id].text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0


def test_op2_takes_about_the_target_of_each_source(spark, docs):
    rows = queries.op2_mixing(spark, FOLDER).collect()
    size = {d: len(WORD.findall(r.text or "")) for d, r in docs.items()}
    total, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.size == size[r.doc_id] and r.taken == r.copies * r.size <= 2 * r.size
        total[docs[r.doc_id].source] += r.size
        taken[docs[r.doc_id].source] += r.taken
        most[docs[r.doc_id].source] = max(most[docs[r.doc_id].source], r.size)
    target = mixing.target_words(list(total.items()))
    for r in rows:
        assert r.source_size == total[docs[r.doc_id].source] and r.target == pytest.approx(target[docs[r.doc_id].source])
        # Of one source all documents are taken either so often or once more.
        rate = r.target / r.source_size if r.source_size else 0
        assert r.size == 0 or r.copies in (math.floor(rate + 1e-9), math.ceil(rate - 1e-9))
    for source, words in taken.items():
        assert abs(words - target[source]) <= max(most[source], 0.02 * target[source])
    again = {(r.doc_id, r.copies) for r in queries.op2_mixing(spark, FOLDER).collect()}
    assert again == {(r.doc_id, r.copies) for r in rows}


def test_landing_is_the_best_rounding():
    rnd = random.Random(6)
    for _ in range(60):
        n = rnd.randrange(1, 8)
        p, x = [rnd.random() for _ in range(n)], [rnd.randrange(1, 50) for _ in range(n)]

        def cost(bits, p=p, x=x):
            off = [b - q for b, q in zip(bits, p)]
            return abs(sum(o * s for o, s in zip(off, x))) + 0.02 * sum(x) / len(x) * abs(sum(off))

        assert cost(mixing.land(p, x)) == pytest.approx(min(cost(b) for b in itertools.product((0, 1), repeat=n)))


def test_a_flight_step_keeps_words_and_documents():
    rnd = random.Random(7)
    for _ in range(200):
        p, x = [rnd.uniform(0.01, 0.99) for _ in range(3)], [rnd.choice([1, 5, 9, 9]) for _ in range(3)]
        moved = mixing.move(p, x, rnd.random())
        assert any(q in (0.0, 1.0) for q in moved) and all(0 <= q <= 1 for q in moved)
        assert sum(moved) == pytest.approx(sum(p), abs=1e-6)
        assert sum(q * s for q, s in zip(moved, x)) == pytest.approx(sum(q * s for q, s in zip(p, x)), abs=1e-6)


def places(text, spectrum):
    """The hashed n-grams of a text, one by one."""
    out = set()
    codes = [ord(c) for c in text.lower()]
    for n in range(1, spectrum.max_n + 1):
        for i in range(len(codes) - n + 1):
            rolled = 0
            for c in codes[i : i + n]:
                rolled = (rolled * 31 + c) % 2**32
            mixed = (rolled * 2654435761 + n * 40503) % 2**32
            out.add(mixed >> (32 - spectrum.dim.bit_length() + 1))
    return out


def test_language_scores_equal_plain_kernel_ridge_regression():
    rnd = random.Random(11)
    spectrum = langid.SpectrumKernel(dim=1 << 10)
    alphabet = {"a": "abcde ", "b": "cdefgé ", "c": "xyzabж "}
    text = lambda lang: "".join(rnd.choice(alphabet[lang]) for _ in range(30))
    langs = [rnd.choice("abc") for _ in range(60)]
    texts = [text(x) for x in langs]
    model = langid.solve(spectrum, spectrum.presence(texts), langs, landmarks=12, ridge=1.0)

    sets = [places(t, spectrum) for t in texts]
    k = lambda s, t: len(s & t) / math.sqrt(len(s) * len(t))
    marks = [i for x in "abc" for i in [j for j, y in enumerate(langs) if y == x][:4]]
    mm = np.array([[k(sets[i], sets[j]) for j in marks] for i in marks])
    nm = np.array([[k(s, sets[j]) for j in marks] for s in sets])
    w = np.array([1 / langs.count(x) for x in langs])
    w *= len(w) / w.sum()
    target = np.array([[float(x == y) for y in "abc"] for x in langs])
    # In the landmarks' span, with the norm of the kernel: (Kᵀ W K + ridge M) α = Kᵀ W y.
    alpha = np.linalg.solve(nm.T @ (w[:, None] * nm) + mm, nm.T @ (w[:, None] * target))
    new = [text(x) for x in "abcabcabc"] + ["é", "zz"]
    scores = np.array([[k(places(t, spectrum), sets[j]) for j in marks] for t in new]) @ alpha
    names, best = model.predict(new)
    assert names == ["abc"[i] for i in scores.argmax(1)]
    assert best == pytest.approx(np.clip(scores.max(1), 0, 1), abs=2e-3)


def test_op3_finds_held_out_languages(spark, docs):
    rows = queries.op3_language_id(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out and docs[r.doc_id].lang is not None and r.lang_pred != "und"]
    assert {r.doc_id for r in rows if r.held_out} == {d for d in docs if zlib.crc32(str(d).encode()) % 5 == 0}
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.95 * len(held)


def test_op5_recall_against_brute_force(spark):
    rows = [r for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
            if r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding) and any(r.embedding)]
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = defaultdict(dict)
    for r in queries.op5_permutation_index(spark, FOLDER).collect():
        got[r.query_id][r.rank] = r
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        distance = np.sqrt(((x - x[q]) ** 2).sum(1))
        best = [i for i in np.lexsort((ids, distance)) if i != q][:10]
        mine = got[ids[q]]
        assert sorted(mine) == list(range(1, len(best) + 1))
        hits += len({r.vec_id for r in mine.values()} & {int(ids[i]) for i in best})
        total += len(best)
        for r in mine.values():
            assert r.score == pytest.approx(distance[np.flatnonzero(ids == r.vec_id)[0]])
    assert hits >= 0.9 * total


def test_op7_judges_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = queries.op7_quality_classifier(spark, FOLDER).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.85 * len(held)
