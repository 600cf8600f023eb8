"""Periodic runs, license scan and hard negatives against brute force and edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labwh.llm import license_rules, license_scan, negatives, periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


def plain_runs(words):
    """All runs (start, length, period), by looking at every period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > s and i + q - s >= max(6, 4 * q):
                found.setdefault((s, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


@given(st.lists(st.integers(0, 2), max_size=60), st.lists(st.integers(0, 2), max_size=12), st.integers(0, 9))
@settings(max_examples=300, deadline=None)
def test_runs_are_those_of_a_plain_search(front, block, times):
    words = front + block * times + front[:3]
    got = periodic.runs_of([np.array(words, np.int32), np.array(front, np.int32)])
    assert [tuple(r) for r in got[0].tolist()] == plain_runs(words)
    assert [tuple(r) for r in got[1].tolist()] == plain_runs(front)


def test_extensions_of_the_grammar_are_exact():
    rnd = random.Random(4)
    for letters in ([rnd.randrange(3) for _ in range(400)] * 3, [0] * 900, [rnd.randrange(2) for _ in range(50)] * 20, [1], [1, 1]):
        grammar, n = periodic.Grammar(np.array(letters)), len(letters)
        if n < 3:
            continue
        x = np.array([rnd.randrange(n - 1) for _ in range(400)])
        y = np.array([rnd.randrange(a + 1, n) for a in x])
        for a, b, right, left in zip(x, y, grammar.right(x, y), grammar.left(x, y)):
            k = 0
            while b + k < n and letters[a + k] == letters[b + k]:
                k += 1
            assert k == right
            k = 0
            while k < a and letters[a - 1 - k] == letters[b - 1 - k]:
                k += 1
            assert k == left


def test_recompression_shrinks_to_a_few_letters():
    grammar = periodic.Grammar(np.array([random.Random(1).randrange(50) for _ in range(20_000)]))
    assert len(grammar.top) <= 3 and len(grammar.forward) < 120


ODD = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "x\x0by\x85z x", "b " * 8, "a b " * 4 + "c", "é 漢 " * 5, "a b a b a b a",
       " ".join(["u v w"] * 4 + ["q"] * 7 + ["u v w"] * 5)]


def test_runs_of_odd_rows(spark):
    rows = [(None if i == 3 else 5 if i in (4, 5) else i, t, "x", 1, 2) for i, t in enumerate(ODD)]
    rows += rows[5:7]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, n_words int, w int")
    found = periodic.find_runs(docs, periodic.RunRules(batch_words=10)).collect()
    key = lambda r: (str(r[0]), r[1])
    want = []
    for doc_id, text, *_ in rows:
        words = WORD.findall(text or "")
        want.append((doc_id, len(words), plain_runs(words), " ".join(plain_kept(words, plain_runs(words)))))
    got = [(r.doc_id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, want))
    for r in found:
        best = max(r.runs, key=lambda x: (x.length / x.period, -x.start, -x.period), default=None)
        assert (r.start, r.length, r.period) == ((best.start, best.length, best.period) if best else (None,) * 3)
        assert r.exponent_milli == (1000 * best.length // best.period if best else None)
    assert periodic.find_runs(docs.limit(0)).count() == 0


def test_very_long_texts_of_runs():
    rnd = random.Random(2)
    block = [rnd.randrange(1000) for _ in range(5000)]
    text = [rnd.randrange(1000) for _ in range(30_000)] + block * 30 + [7] * 100_000
    got = periodic.runs_of([np.array(text, np.int32)])[0].tolist()
    assert [30_000, 150_000, 5000] in got and any(n >= 100_000 and q == 1 for _, n, q in got)
    with pytest.raises(ValueError):
        periodic.RunRules(min_exponent=3)


def test_periodic_query_against_a_plain_version(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, FOLDER).collect()}
    assert len(got) == len(rows)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = plain_runs(words) if len(words) < 6000 else None
        if runs is None:
            continue
        r = got[doc_id]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(" ".join(plain_kept(words, runs)))
    assert sum(r.n_runs > 0 for r in got.values()) > 5


def license_rows(spark, texts):
    rows = [(None if i == 1 else 3 if i in (3, 4) else i, t, "x", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, start string, rank int")


LICENSED = [
    None, "", "plain words of no license at all", "Released under the MIT License.", "MIT License MIT License mit\nlicense",
    "SPDX-License-Identifier: GPL-2.0-or-later", "This work is licensed under the GNU General Public License, version 3.",
    "licensed under the Apache License, Version 2.0 and the MIT license", "smit license, mit licenses; mitŁ license",
    "GPLv3 or later; CC BY-NC-SA 4.0; Creative Commons Attribution-ShareAlike 4.0 International; \x7f the Unlicense \x00 ISC licence",
    "apache\x85license", "Copyright (c) 2019 X. All rights reserved. " + "GENERAL\tPUBLIC\nLICENSE " * 3,
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. (BSD-3-Clause)",
    "cc by 4 0 2 0 " * 3, "license " * 50 + "eclipse public license v 2.0",
]


def test_license_scan_against_sql(spark):
    docs = license_rows(spark, LICENSED * 2)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    want = con.execute(queries.oracles()["op12_license_scan"])
    names = [d[0] for d in want.description]
    got = license_scan.scan(docs)
    assert set(got.columns) == set(names)
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(
        str(tuple(r)) for r in want.fetchall())


def test_license_detections_inside_surer_ones_go(spark):
    text = "Licensed under the Apache License, Version 2.0"
    rows = license_scan.detect(license_rows(spark, [text])).collect()
    kept = {(r.label, r.kind, r.start, r.length) for r in rows if r.kept}
    assert kept == {("apache", "phrase", 3, 2), ("apache-2.0", "notice", 0, 8)}
    assert {(r.label, r.kind) for r in rows if not r.kept} >= {("apache", "hint"), ("apache-2.0", "name")}
    assert len(license_scan.signatures()) > 300
    # Detections that only overlap both stay; equal places go to the earlier rule.
    own = {"a": "name y x y\nname y x y", "b": "name y x y\nname z y z"}
    rows = license_scan.detect(license_rows(spark, ["x y z"]), own, {}).collect()
    assert {(r.label, r.start, r.length, r.kept) for r in rows} == {("a", 0, 2, True), ("a", 0, 2, False), ("b", 0, 2, False), ("b", 1, 2, True)}


def test_license_rules_match_what_they_name(spark):
    texts = {"apache-2.0": "Apache-2.0", "gpl-3.0-or-later": "GNU GPL version 3 or later", "bsd-3-clause": "the New BSD License",
             "cc0-1.0": "CC0 1.0 Universal", "mpl-2.0": "Mozilla Public License, v. 2.0", "lgpl-2.1": "GNU Lesser General Public License v2.1",
             "ofl-1.1": "SIL Open Font License, Version 1.1", "cc-by-sa-4.0": "https://creativecommons.org/licenses/by-sa/4.0/"}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts.values())], "doc_id long, text string")
    got = {r.doc_id: r.labels.split(",") for r in license_scan.scan(docs).collect()}
    for i, label in enumerate(texts):
        assert label in got[i], (label, got[i])


def test_license_scan_of_long_texts_and_no_rows(spark):
    text = "word " * 300_000 + "mit license " * 20_000 + "tail"
    row = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (340_001, 20_000, 300_000, 339_998)
    assert row.labels == "mit" and row.n_detections == 20_000
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.scan(empty).count() == 0


@given(st.integers(1, 70), st.integers(1, 40), st.integers(1, 70), st.integers(1, 8), st.integers(0, 2**32 - 1))
@settings(max_examples=60, deadline=None)
def test_strassen_tiles_are_exact_products(m, k, n, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(2**24), 2**24, (m, k)), rng.integers(-(2**24), 2**24, (n, k))
    got = np.zeros((m, n), np.int64)
    for i, j, scores in negatives.products(a, b, 32, leaf):
        got[i : i + scores.shape[0], j : j + scores.shape[1]] = scores
    assert (got == a @ b.T).all()


@given(st.lists(st.lists(st.integers(0, 4), min_size=6, max_size=6), min_size=3, max_size=3), st.integers(1, 5))
@settings(max_examples=60, deadline=None)
def test_heaps_keep_the_first_of_each_slot(scores, size):
    scores = np.array(scores)
    heaps = negatives.Heaps(3, size)
    for j in (0, 2, 4):
        heaps.offer(np.arange(3), scores[:, j : j + 2], np.ones((3, 2), bool), j)
    for slot in range(3):
        want = sorted(range(6), key=lambda e: (-scores[slot][e], e))[:size]
        assert [e for e in heaps.entry[slot] if e >= 0] == want


def plain_negatives(rows, rules):
    """Rows are (vec_id, label, vector or None)."""
    usable = [(i, v, lb, [math.floor(rules.scale * x) for x in vec]) for i, (v, vec, lb) in enumerate(rows)
              if lb is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    last = lambda v: (v is None, v or 0)
    out = []
    for i, v, lb, vec in usable:
        if v is None or v % 50:
            continue
        scored = sorted(((-dot(vec, w), last(u), j, u, m) for j, u, m, w in usable if j != i))
        for s, _, _, u, _ in [x for x in scored if x[4] == lb][: rules.positives]:
            window = [x for x in scored if x[4] != lb and rules.low * -s <= 100 * -x[0] <= rules.high * -s]
            out += [(v, u, r + 1, x[3], -s, -x[0]) for r, x in enumerate(window[: rules.negatives])]
    return out


@pytest.mark.parametrize("blocks", [{}, {"anchor_block": 2, "candidate_block": 9, "tile": 4, "leaf": 1}])
def test_hard_negatives_against_brute_force(spark, blocks):
    rnd = random.Random(9)
    rows = [(i, [round(rnd.gauss(0, 1) + (i % 3 == k), 2) for k in range(6)], rnd.choice([0, 1, 1, 2])) for i in range(201)]
    rows += [(50, rows[50][1], rows[50][2]), (None, rows[3][1], 1), (400, [0.0] * 6, 1), (401, None, 1), (402, [1.0, None], 1),
             (403, [float("nan")] * 6, 1), (404, [1.0] * 6, None), (450, [float("inf")] + [1.0] * 5, 2), (406, [2.0, 2.0], 1), (408, [], 2)]
    rows += [(500 + i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.125], i % 2) for i in range(60)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "vec_id long, embedding array<double>, label int, row string, r int").repartition(5)
    rules = negatives.NegativeRules(**blocks)
    got = [tuple(r) for r in negatives.mine(table, F.col("vec_id") % 50 == 0, rules=rules).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_negatives(rows, rules)))
    assert negatives.mine(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert negatives.mine(table.where("vec_id % 50 <> 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_vectors_too_long_for_exact_scores_raise(spark):
    table = spark.createDataFrame([(0, [1e12], 1), (1, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too long for exact"):
        negatives.mine(table, F.col("vec_id") % 50 == 0).count()


def test_hard_negatives_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    want = con.execute(queries.OP13_SQL)
    names = [d[0] for d in want.description]
    got = queries.op13_hard_negatives(spark, FOLDER).select(*names).collect()
    assert got and sorted(map(tuple, got)) == sorted(want.fetchall())


def test_rule_lines_are_well_formed():
    for block in license_rules.LICENSES.values():
        for line in filter(None, map(str.strip, block.splitlines())):
            kind, keyword, regex = line.split(" ", 2)
            assert kind in license_scan.KINDS and re.compile(license_scan.numbered(regex))
            assert kind == "tag" or keyword in re.sub("[^a-z0-9 ]", " ", regex.replace("?", "")).split(), line
