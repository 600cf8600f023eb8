"""WARC, permutation index, chat, URL filter, Jaccard join and the pipeline."""

from __future__ import annotations

import gzip
import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from labwh.llm import ann, chat, jaccard, queries, url_filter, warc
from labwh.llm.common import fresh_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_query_equals_its_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.oracles()[name])
    got = queries.QUERIES[name](spark, SF)
    assert set(got.columns) == set(want.columns)
    assert sorted(map(str, map(tuple, got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))


def test_archives_refer_copies_to_the_largest_page(spark):
    long, other = "é" * 600, "x" * 999
    rows = [(1, "http://a/\r\nX: y", long, 0), (5, None, long, 0), (3, "u", long, 0), (5, "twice", long, 0), (7, "u", other, 0),
            (8, "u", other, 0), (9, "u", None, 0), (10, "u", "", 0), (11, "u", "a\r\n\r\nb", 0), (None, "u", long, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int").repartition(3)
    folder = fresh_path(spark, "warc-test")
    got = warc.archive(pages, folder).collect()
    html = {(r[0], r[2]) for r in rows}
    assert len(got) == len(rows)
    for r in got:
        data = next((h or "").encode() for p, h in html if p == r.page_id)
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert r.record_type == ("revisit" if r.page_id in (1, 3) else "response")
        assert r.refers_to == (5 if r.page_id in (1, 3) else None)
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == data
    assert next(r.url for r in got if r.page_id == 1) == "http://a/%0D%0AX: y"
    # The same records, whether a file is read as one stream or member by member.
    path = folder.removeprefix("file://")
    import glob

    for whole in glob.glob(f"{path}/monolithic/*.gz"):
        members = whole.replace("monolithic", "normalised")
        assert gzip.open(whole).read() == gzip.open(members).read()
    assert warc.archive(pages.where("false"), fresh_path(spark, "warc-test")).count() == 0


def test_broken_archives_are_reported():
    data = gzip.compress(warc.record("response", [], b"abc"))
    assert list(warc.records(warc.inflate(iter([data, data])))) == [(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3", b"abc")] * 2
    with pytest.raises(ValueError):
        list(warc.records(warc.inflate(iter([data[:-12]]))))


def nearest(rows, q, k=10):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    d = np.sqrt(((x - dict(rows)[q]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
    return [(int(ids[i]), float(d[i])) for i in order]


def test_index_finds_what_brute_force_finds(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rnd.normal(size=(1500, 16)).astype(np.float32))]
    rows += [(2000 + i, rows[0][1]) for i in range(40)]  # copies of a query
    odd = [(100_000, None), (100_100, [0.0] * 16), (100_200, [float("nan")] * 16), (100_300, [1.0, None] * 8), (100_400, [1.0] * 3)]
    table = spark.createDataFrame([(i, v, 0, 1) for i, v in rows + odd], "vec_id long, embedding array<float>, rep int, score int")
    index = ann.PermutationIndex(pivots=64, sample=256, shard=400, block=7)
    got: dict = {}
    for r in ann.search(table, F.col("vec_id") % 100 == 0, index=index).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == {i for i, _ in rows if i % 100 == 0}
    hits = 0
    for q, found in got.items():
        assert sorted(found) == list(range(1, 11))
        hits += len({found[r][0] for r in found} & {i for i, _ in nearest(rows, q)})
        assert all(abs(s - np.sqrt(((np.array(dict(rows)[i], float) - dict(rows)[q]) ** 2).sum())) < 1e-9 for i, s in found.values())
    assert hits >= 0.9 * 10 * len(got)
    assert [got[0][r][0] for r in range(1, 11)] == list(range(2000, 2010))
    few = table.where("vec_id < 4")
    assert [r.vec_id for r in ann.search(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [i for i, _ in nearest(rows[:4], 0)]
    assert ann.search(table.where("false"), F.col("vec_id") == 0).count() == 0


def test_chat_round_trip_and_turn_order(spark):
    texts = ["plain", r"\### Assistant: </turn> ok", "<turn>user\n", "\\", "\\a\\\\b</turn", "", None, "<tu<turn>rn>"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t, "x") for i, t in enumerate(texts)]
    rows += [(2, 0, "assistant", "first", "x"), (2, 1, "a\nb", "odd role", "x"), (3, None, None, "t", "x"), (None, 0, "user", "u", "x"),
             (4, 0, "user", "same", "x"), (4, 0, "user", "same", "x"), (5, 0, "system", "s", "x"), (5, 1, "user", "u", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(4)
    got = {r.conv_id: r for r in chat.parse(chat.format_conversations(table)).collect()}
    for conv in (1, 2, 3, None, 4, 5):
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in got[conv].parsed] == [(r[2] or "", r[3] or "") for r in mine]
        assert "".join(s.text for s in got[conv].segments) == got[conv].formatted
        assert [s.text for s in got[conv].segments if s.loss] == [
            s.text for s, t in zip(got[conv].segments[1::3], got[conv].parsed) if t.role == "assistant"]
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: False, 3: False, None: False, 4: False, 5: False}
    assert chat.format_conversations(table.where("false")).count() == 0
    with pytest.raises(ValueError):
        chat.ChatTemplate(opening="a\\b")


def test_url_rules_and_model(spark):
    urls = [None, "", "no scheme", "HTTP://Ab.COM", "http://x.net/es/1?q", "a://xnet/es/", "http://www.example.com/en/a#b",
            "http://m.example.com/en/x", "http://example.com?x", "http://casino-win.example.org/en/9", "http://tionther.example.org/en/9",
            "http://a://b/c", "http://Ä.net/fr/€" + "y" * 50_000]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_filter.classify(pages, queries.URL_RULES).collect()}
    assert [(got[i].host, got[i].path) for i in (0, 1, 2, 3, 4, 8, 11)] == [
        ("", ""), ("", ""), ("", ""), ("ab.com", ""), ("x.net", "/es/1"), ("example.com", ""), ("a:", "//b/c")]
    assert [got[i].rule for i in range(10)] == [None, None, None, None, "net/es/", None, "www.example.com/en/", "example.com/en/", None, None]
    assert [got[i].verdict for i in (4, 6, 7, 9, 10, 12)] == ["block", "allow", "block", "block", "allow", "block"]
    held = [u for i, u in enumerate(url_filter.LABELLED) if i % 10 < 5]
    model = url_filter.fit(tuple(held))
    rest = [u for i, u in enumerate(url_filter.LABELLED) if i % 10 >= 5]
    table = spark.createDataFrame([(y, u) for u, y in rest], "page_id long, url string")
    right = sum((r.verdict == "block") == bool(r.page_id) for r in url_filter.classify(table, (), model).collect())
    assert right >= 0.7 * len(rest)


def blocked(spark, model, urls):
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r.page_id: r.verdict == "block" for r in url_filter.classify(table, (), model).collect()}


def test_url_table_shares_no_word_with_the_pages(spark):
    words = set(url_filter.UNWANTED_WORDS + url_filter.WANTED_WORDS)
    for size in ("sf0.001", "sf0.1"):
        urls = [r.url for r in spark.read.parquet(f"/root/testdata/{size}/pages.parquet").select("url").distinct().collect()]
        hosts = {url_filter.split_url(u)[0] for u in urls}
        labels = {h.removeprefix("www.").removeprefix("blog.").removeprefix("m.").split(".")[0] for h in hosts}
        assert not words & (labels | {w for h in labels for w in h.split("-")})
        given = "|".join(u for u, _ in url_filter.LABELLED)
        assert not [h for h in labels if len(h) > 5 and h in given]


def test_url_model_on_words_of_no_training_row(spark):
    right, n = Counter(), Counter()
    for fold in range(5):
        kept, held = [[[w for i, w in enumerate(words) if (i % 5 == fold) == out]
                       for words in (url_filter.WANTED_WORDS, url_filter.UNWANTED_WORDS)] for out in (False, True)]
        model = url_filter.fit(url_filter.labelled(kept[1], kept[0]))
        cases = [(label, side, f"http://www.{w}.com/en/1" if side == "host" else f"http://example.org/{w}/1")
                 for label, words in enumerate(held) for w in words for side in ("host", "path")]
        found = blocked(spark, model, [u for *_, u in cases])
        for i, (label, side, _) in enumerate(cases):
            right[side, label] += found[i] == bool(label)
            n[side, label] += 1
    share = {k: right[k] / n[k] for k in n}
    # Balanced accuracy; chance is 0.5.
    assert (share["host", 0] + share["host", 1]) / 2 >= 0.6 and (share["path", 0] + share["path", 1]) / 2 >= 0.55


def test_url_paths_are_judged_apart_from_hosts(spark):
    size = len(url_filter.fit().weights)
    text = "".join(map(chr, range(33, 127)))
    host, path = (url_filter._buckets("!!!" + text + text[::-1] + "~~~", salt, size) for salt in url_filter.SALTS.values())
    assert not host & path
    urls = ["http://example.org/casino/win", "http://example.org/cheap-pills/free-bets", "http://example.org/poker/jackpot",
            "http://example.org/", "http://example.org/en/1", "http://example.org/library/museum"]
    found = blocked(spark, None, urls)
    assert [found[i] for i in range(6)] == [True, True, True, False, False, False]


def brute_components(docs, percent=90, words=3):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return frozenset([tuple(w)] if 0 < len(w) < words else zip(*(w[i:] for i in range(words))))

    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least: dict = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs))


@pytest.mark.parametrize("percent, n", [(90, 3), (80, 5)])
def test_jaccard_join_equals_brute_force(spark, percent, n):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = [None, "", " \n", "W1 w2", "w1 W2"]
    for size in (1, 3, 9, 12, 20, 22, 30, 40, 50, 90, 200, 900):
        start = [rnd.choice(words) for _ in range(size)]
        for _ in range(14):
            w = list(start)
            for _ in range(rnd.randint(0, 1 + size // (60 if percent == 90 else 50))):
                at, kind = rnd.randrange(len(w)), rnd.random()
                if kind < 0.4:
                    w[at] = rnd.choice(words)
                elif kind < 0.7:
                    w.append(rnd.choice(words))
                elif len(w) > 1:
                    del w[rnd.choice((0, -1))]
            texts.append(" ".join(w).upper() if rnd.random() < 0.2 else "  ".join(w))
    docs = list(enumerate(texts))
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, key string").repartition(5)
    want = brute_components(docs, percent, n)
    for lists in ("blocks", "shingles"):
        got = jaccard.join(table, jaccard.Similarity(percent, n, lists=lists)).collect()
        assert sorted(map(tuple, got)) == want


@pytest.mark.parametrize("percent, n", [(90, 3), (80, 5)])
def test_all_links_equal_brute_force(spark, percent, n):
    rnd = random.Random(6)
    texts = [None, "", " ", "a b", "A b", "a b"]
    for _ in range(4):
        base = [f"w{rnd.randint(0, 200)}" for _ in range(rnd.choice([6, 20, 60, 90]))]
        for _ in range(12):  # near copies of one text, distinct and repeated
            near = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                near[rnd.randrange(len(near))] = f"v{rnd.randint(0, 9)}"
            texts.append(" ".join(near))
    sim = jaccard.Similarity(percent=percent, words=n)
    sets = [frozenset(sim.shingles(t).tolist()) for t in texts]
    brute = [sum(i != j and bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b) for j, b in enumerate(sets))
             for i, a in enumerate(sets)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.n_links) for r in jaccard.count_links(docs, sim).collect()}
    assert got == {i: (len(sets[i]), brute[i]) for i in range(len(texts))} and max(brute) > 3
    assert jaccard.count_links(docs.where("false"), sim).count() == 0


def test_jaccard_join_without_ids_or_rows(spark):
    schema = "doc_id long, text string"
    odd = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (4, "A b C d"), (None, "z"), (6, ""), (6, "")], schema)
    got = sorted(map(str, map(tuple, jaccard.join(odd).collect())))
    assert got == sorted(map(str, [(None, 2, 4), (None, 2, 4), (4, 2, 4), (None, 1, None), (6, 0, 6), (6, 0, 6)]))
    assert jaccard.join(spark.createDataFrame([], schema)).count() == 0


def test_a_task_lists_copies_once(spark):
    docs = spark.createDataFrame([(i, f"copied text number {i // 50}") for i in range(100)], "doc_id long, text string")
    sim = jaccard.Similarity()
    for made in (jaccard.list_entries(docs.coalesce(1), sim, 48), jaccard.full_sets(docs.coalesce(1), sim)):
        assert made.count() == made.distinct().count() and made.select("n", "k").distinct().count() == 2


def test_list_entries_carry_a_folded_parity(spark):
    rnd = random.Random(9)
    sim = jaccard.Similarity()
    for _ in range(50):
        a = {rnd.getrandbits(64) for _ in range(rnd.randint(1, 400))}
        b = {x for x in a if rnd.random() < 0.9} | {rnd.getrandbits(64) for _ in range(rnd.randint(0, 30))}
        fold = [sim.folded(np.array(sorted(x), np.uint64)) for x in (a, b)]
        assert sum(((x ^ y) & jaccard.M64).bit_count() for x, y in zip(*fold)) <= len(a ^ b)
    # Two unlike sets in one list go before any whole parity is fetched; two like ones stay.
    like = np.array(sorted(rnd.getrandbits(64) for _ in range(100)), np.uint64)
    unlike = np.array(sorted(rnd.getrandbits(64) for _ in range(100)), np.uint64)
    rows = [(key, 100, k, *sim.folded(s)) for key, k, s in ((1, 1, like), (1, 2, like), (2, 1, like), (2, 3, unlike))]
    listed = spark.createDataFrame(rows, "key long, n long, k long, q1 long, q2 long")
    assert {(r.key, r.k) for r in jaccard._with_partner(listed, sim, jaccard.FOLDS).collect()} == {(1, 1), (1, 2)}


def test_signatures_bound_the_difference_of_sets_of_any_size(spark):
    rnd = random.Random(10)
    sim, rows, want = jaccard.Similarity(percent=80), [], set()
    pairs = []
    for i in range(60):  # sizes near 512, 1024 and 2048, where one signature is twice as long
        a = {rnd.getrandbits(64) for _ in range(rnd.choice((1, 60, 500, 512, 1000, 1024, 2000)) + rnd.randint(0, 3))}
        keep = rnd.choice((1, 0.95, 0.9, 0.4))
        b = {x for x in a if rnd.random() < keep} | {rnd.getrandbits(64) for _ in range(rnd.randint(0, len(a) // 9))} or a
        sets = [np.array(sorted(x), np.uint64) for x in (a, b)]
        rows += [(len(x), 2 * i + j, sim.signature(x).tolist()) for j, x in enumerate(sets)]
        pairs.append((len(a), 2 * i, len(b), 2 * i + 1))
        if 100 * len(a & b) >= 80 * len(a | b):
            want.add(2 * i)
    classes = spark.createDataFrame(rows, "n long, k long, signature array<long>")
    assert len({len(s) for *_, s in rows}) > 2
    got = {r.ak for r in jaccard._alike(spark.createDataFrame(pairs, "an long, ak long, bn long, bk long"), classes, sim).collect()}
    large_and_unlike = {ak for an, ak, bn, _ in pairs if ak not in want and an > 1000 and 2 * bn < an}
    assert want and large_and_unlike and want <= got and not got & large_and_unlike


@pytest.mark.parametrize("lists", ["blocks", "shingles"])
def test_only_sets_of_alike_documents_are_fetched(spark, monkeypatch, lists):
    rnd = random.Random(11)
    word = lambda: f"w{rnd.getrandbits(40)}"
    shared = [word() for _ in range(1500)]  # a passage in long texts that are not alike
    texts = [" ".join(shared + [word() for _ in range(1500)]) for _ in range(6)]
    texts.append(texts[0] + " end")
    stored = []
    real = jaccard.staged

    def spy(df, stem):
        out = real(df, stem)
        stored.extend([out] if stem == "sets" else [])
        return out

    monkeypatch.setattr(jaccard, "staged", spy)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(tuple(r) for r in jaccard.join(docs, jaccard.Similarity(80, 5, lists=lists)).select("doc_id", "component_id").collect())
    assert got == [(i, i % 6) for i in range(7)]
    # Each of them once, though several turns compare.
    assert sorted(r.n for s in stored for r in s.collect()) == [2996, 2997]
    assert jaccard.count_links(docs, jaccard.Similarity(80, 5, lists=lists)).where("n_links = 1").count() == 2


def test_boundary_takes_the_cheaper_side():
    sim = jaccard.Similarity()
    assert 10 < sim.boundary({s: s for s in range(1, 48)}) < 48
    for size in range(1, 40):
        for b in sim.partners(size):
            shared = sim.needed(size, b)
            assert 100 * shared >= 90 * (size + b - shared) and 100 * (shared - 1) < 90 * (size + b - shared + 1)


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id: r.text for r in docs.collect()}
    found = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        found[name] = docs.collect()
        if i < 4:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
            assert all(ids[r.doc_id] == r.text for r in found[name])
    rules, model, distinct, mixed, packed = (found[n] for n, _ in corpus_pipeline.STAGES)
    assert {r.doc_id for r in rules} == {
        r.doc_id for r in queries.op9_quality_rules(spark, SF).where("kept").collect()}
    assert {r.doc_id for r in model} <= {r.doc_id for r in rules}
    # One document of each group stays, the one with the smallest id.
    assert sorted(r.doc_id for r in distinct) == sorted({c for *_, c in brute_components([(r.doc_id, r.text) for r in model], 80, 5)})
    size = sum(len(r.text.split()) for r in distinct)
    assert abs(sum(len(r.text.split()) for r in mixed) / size - 1.5) < 0.02
    assert {r.doc_id for r in packed} == {r.doc_id for r in mixed}
    assert sum(r.start == 0 for r in packed) == len(mixed)


def test_near_duplicates_without_ids_or_with_shared_ids(spark):
    rnd = random.Random(8)
    one, two, three, four = (" ".join(rnd.choice("abcdefghijklmnop") + str(rnd.randint(0, 99)) for _ in range(60)) for _ in range(4))
    rows = [(None, one, "en", "s"), (None, one + " end", "en", "s"), (None, one, "en", "s"),  # a group without ids
            (7, two, "en", "s"), (7, three, "en", "s"),  # different texts, one id
            (9, three + " end", "de", "s"), (7, two, None, "en"), (7, two, "en", None),
            (None, four, "en", "s"), (5, four + " end", "en", "s"),  # the one with an id stays
            (None, "", "en", "s"), (None, None, "en", "s"), (3, "", "en", "s"), (3, "", "en", "s")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == list(corpus_pipeline.COLUMNS)
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert len(kept) == 7
    assert sorted(t for d, t in kept if d == 7) == sorted([two, three])
    assert sum(d is None and (t or "").startswith(one) for d, t in kept) == 1
    assert (5, four + " end") in kept and (None, "") in kept and (None, None) in kept and kept.count((3, "")) == 1


PIPELINE_DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_mixed_keeps_rows_apart_that_differ_in_one_column(spark):
    words = " ".join(f"w{i}" for i in range(40))
    rows = [
        (1, words, "de", "a", 3), (1, words, "en", "a", 3), (1, words, None, "a", 3), (1, words, "de", "a", 4), (1, words, "de", "a", None),
        (2, None, None, "abc def", None), (2, "abc def", None, None, None), (None, words, "de", "a", 3), (3, "abc def", None, "a", 1),
        (3, "abc def", None, "a", 1),
    ]
    docs = spark.createDataFrame(rows, PIPELINE_DOCS)
    got = [tuple(r) for r in corpus_pipeline.mixed(spark, docs, "").collect()]
    assert set(got) <= set(rows) and (2, None, None, "abc def", None) not in got  # a row without words is not taken
    # The mix takes one and a half times all words of a source, a row twice at most.
    assert max(got.count(r) for r in got) <= 4
    for lang in ("de", "en", None):
        assert (1, words, lang, "a", 3) in got
    assert corpus_pipeline.mixed(spark, docs.limit(0), "").count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_odd_rows(spark, name, tmp_path):
    """NULL ids, texts and columns, repeated rows and an empty table pass every stage."""
    text = " ".join(f"word{i % 60} and" for i in range(300))
    rows = [(None, None, None, None, None), (None, None, None, None, None), (None, text, None, None, None), (7, "", "en", "s", 0)]
    rows += [(i % 3, text if i % 2 else f"{text} {i}", "en", "s", i) for i in range(12)]
    docs = spark.createDataFrame(rows, PIPELINE_DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    made = stage(spark, docs, str(tmp_path))
    found = made.collect()
    if name != corpus_pipeline.STAGES[-1][0]:
        assert made.columns == list(corpus_pipeline.COLUMNS)
        assert {tuple(r) for r in found} <= set(rows)
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_loss_text_is_cut_by_the_written_mask(spark):
    rows = [(1, 0, "user", "u\\<turn>é"), (1, 1, "assistant", "a </turn> 漢"), (1, 2, "user", ""), (1, 3, "assistant", None),
            (1, 3, "assistant", "\\a"), (None, None, "assistant", "x"), (2, 0, "tool", "t"), (3, 0, None, None)]
    table = spark.createDataFrame([(*r, "k") for r in rows], "conv_id long, turn long, role string, text string, loss string")
    for roles in (("assistant",), ("user",), ("user", "tool"), ()):
        template = chat.ChatTemplate(loss_roles=roles)
        made = chat.format_conversations(table, template)
        # The reader does not know the roles: it has the text and the spans only.
        found = made.select("conv_id", chat.under_mask(F.col("formatted"), F.col("loss_spans")).alias("t"), "formatted", "loss_spans")
        want = {}
        for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or 0, r[2] or "", r[3] or "")):
            want[conv] = want.get(conv, "") + ((text or "") if role in roles else "")
        for r in found.collect():
            assert r.t == want[r.conv_id]
            raw = r.formatted.encode()
            assert all(raw[s.start : s.start + s.length].decode() in r.formatted for s in r.loss_spans)
    assert made.limit(0).count() == 0


def test_fitting_rows_are_bounded_where_ids_are_not_unique(spark):
    from labwh.llm import langid

    texts = {"x": "lorem ipsum dolor sit amet", "y": "zażółć gęślą jaźń ćma"}
    every = spark.range(6000).select(
        F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("lang"), F.col("id").alias("turn"))
    docs = every.withColumn("text", F.concat(F.when(F.col("lang") == "x", texts["x"]).otherwise(texts["y"]), F.lit(" "), F.col("turn").cast("string")))
    seen = []
    solve = langid.solve
    langid.solve = lambda spectrum, sets, names, *rest: seen.append(len(sets)) or solve(spectrum, sets, names, *rest)
    try:
        model = langid.fit(docs, sample=400)
    finally:
        langid.solve = solve
    assert 0 < seen[0] <= 800
    got = langid.predict(docs.limit(20), model).join(docs.select("text").limit(0), F.lit(False), "left").count()
    assert got == 20
    with pytest.raises(ValueError, match="languages"):
        langid.fit(docs, max_languages=1)


def test_small_edge_tables_are_few_files(spark):
    from labwh.llm import graph

    links = spark.range(400).select(F.col("id").alias("u"), (F.col("id") + F.when(F.col("id") % 20 == 19, 0).otherwise(1)).alias("v"))
    settings = {"spark.sql.shuffle.partitions": "25", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    tables, write = [], graph.staged
    graph.staged = lambda df, stem: tables.append(write(df, stem)) or tables[-1]
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = {r.node: r.root for r in graph.components(links, 400).collect()}
    finally:
        graph.staged = write
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i // 20 * 20 for i in range(400)}
    assert len(tables) > 2
    assert all(len(t.inputFiles()) == 1 for t in tables)


def test_lists_of_archives_are_one_file_and_no_task_gets_two(spark):
    import glob

    pages = spark.range(500).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.col("id").cast("string").alias("html"))
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "25"}
    before = {k: spark.conf.get(k) for k in settings}
    dealt, normalise = [], warc.normalise
    warc.normalise = lambda files, folder: dealt.append(files) or normalise(files, folder)
    folder = fresh_path(spark, "warc-test")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = warc.archive(pages, folder).select("page_id").collect()
    finally:
        warc.normalise = normalise
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r.page_id for r in got) == list(range(500))
    path = folder.removeprefix("file://")
    assert len(glob.glob(f"{path}/normalised/*.gz")) > 10
    assert [len(glob.glob(f"{path}/{k}/*.parquet")) for k in ("written", "manifest")] == [1, 1]
    assert dealt[0].rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() == [1] * len(glob.glob(f"{path}/monolithic/*.gz"))
