"""Near duplicates, components, line chunks and decontamination against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from harness.compare import compare, duck
from odd_rows import ODD_ROWS, SF001
from marquee.llm import decontam, linechunks, minhash
from marquee.llm.common import bag_of_words
from marquee.llm.components import connected_components
from marquee.llm.queries import ORACLE, QUERIES

_rnd = random.Random(0)
VOCABULARY = sorted({"".join(_rnd.choices("abcdefghij", k=5)) for _ in range(4000)})


@pytest.mark.parametrize("name", ["op3_minhash", "op13_ngram_join"])
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SF001), name, QUERIES[name], ORACLE[name], SF001)
    assert r["columns_match"] and r["values_match"] and r["rows"] == r["oracle_rows"] > 0, r


def test_components_of_random_graphs(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7), (None, 1)]
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for u, v in edges:
        if u is not None:
            a, b = sorted((find(u), find(v)))
            parent[b] = a
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u int, v int")).collect()}
    assert got == {n: find(n) for u, v in edges if u is not None and u != v for n in (u, v)}
    assert connected_components(spark.createDataFrame([], "u int, v int")).collect() == []


def _families():
    """Originals with copies of copies: some similar enough to the original,
    some to another copy only, some to none; unrelated texts with a passage in
    common; exact copies."""
    rnd, rows = random.Random(9), []

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[rnd.randrange(len(words))] = rnd.choice(VOCABULARY)
        return words

    passage = rnd.choices(VOCABULARY, k=50)
    for _ in range(4):
        base = rnd.choices(VOCABULARY, k=rnd.choice([12, 60, 150]))
        family = [base]
        for _ in range(60):
            family.append(edited(rnd.choice(family), rnd.choice([0, 1, 1, 2, 4, 8])))
        rows += family
    rows += [passage + rnd.choices(VOCABULARY, k=rnd.choice([5, 12, 40])) for _ in range(80)]
    rows += [rnd.choices(VOCABULARY, k=rnd.randrange(1, 9)) for _ in range(40)]
    rnd.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("size, percent, block", [(3, 85, 1024), (5, 80, 16)])
def test_near_duplicates_of_families(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
    rows = _families()
    got = {r.doc_id: r for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=size, percent=percent).collect()}
    want = brute.components(rows, size, percent)
    assert [got[i].component_id for i, _ in rows] == want
    assert [got[i].kept for i, _ in rows] == [i == c for (i, _), c in zip(rows, want)]
    assert [got[i].n_shingles for i, _ in rows] == [len(brute.shingles(t, size)) for _, t in rows]


def test_near_duplicates_of_the_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents, size=3, percent=85).collect()}
    assert [got[i] for i, _ in rows] == brute.components(rows, 3, 85)


def test_near_duplicates_of_odd_rows(odd):
    got = sorted((tuple(r) for r in minhash.near_duplicates(odd(ODD_ROWS)).collect()), key=str)
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (None, 1, None, True), (None, 0, None, True), (4, 1, 4, True), (4, 1, 4, True), (5, 1, 5, True), (6, 1, 6, True), (7, 1, 4, False)]
    assert got == sorted(want, key=str)
    assert minhash.near_duplicates(odd([])).collect() == []


def _line_texts():
    rnd = random.Random(4)
    line = lambda n: " ".join(rnd.choices(VOCABULARY, k=n))
    passage, long = [line(12) for _ in range(9)], line(40)
    rows = []
    for i in range(60):
        lines = [line(rnd.randrange(0, 15)) for _ in range(rnd.randrange(0, 12))]
        at = rnd.randrange(len(lines) + 1)
        if i % 3 == 0:
            lines[at:at] = passage
        if i % 4 == 0:
            lines.insert(at, long)
        rows.append((rnd.choice([i, i, i, None]), "\n".join(lines)))
    return rows + rows[:5] + [(900, None), (901, ""), (902, "\n\n\n"), (903, "x" * 100_000), (904, "a b\n" * 3000)], passage, long


def test_line_chunks_against_brute_force(odd):
    rows, passage, long = _line_texts()
    out = linechunks.dedup_lines(odd(rows))
    assert out.columns[:9] == odd([]).columns and out.columns[9:] == ["lines_removed", "chunks_removed"]
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted(zip([i for i, _ in rows], brute.dedup(rows, linechunks)), key=str)
    left = [t for _, t in got if t]
    assert 1 <= sum(long in t for t in left) <= 2  # the first text and a row equal to it
    assert sum("\n".join(passage[2:7]) in t for t in left) <= 2
    assert linechunks.dedup_lines(odd([])).collect() == []


def test_line_chunks_of_the_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: r.text for r in linechunks.dedup_lines(documents).collect()}
    assert [got[i] for i, _ in rows] == brute.dedup(rows, linechunks)


def test_common_length():
    rnd = random.Random(6)
    for _ in range(200):
        a, b = ([rnd.randrange(6) for _ in range(rnd.randrange(1, 90))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        assert decontam.common_length(a, b) == row[-1]


def test_leaks_in_the_documents(spark, documents):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts, items = documents.select("doc_id", "text").collect(), bench.collect()
    want = {(d.doc_id, i.item_id) for d in texts for i in items if brute.contains_item(d.text, i.text, bag_of_words)}
    assert want and {(r.doc_id, r.item_id) for r in decontam.leaks(documents, bench).collect()} == want
    left = decontam.without_leaks(documents, bench)
    assert left.columns == documents.columns
    assert {r.doc_id for r in left.collect()} == {d.doc_id for d in texts} - {d for d, _ in want}


def _paraphrases():
    rnd = random.Random(8)
    items = [rnd.choices(VOCABULARY, k=rnd.randrange(15, 70)) for _ in range(30)]
    rows = []
    for i in range(300):
        words = rnd.choices(VOCABULARY, k=rnd.randrange(0, 300))
        if i < 120:
            item = list(items[i % 30])
            if i >= 60:  # one word in six is another
                for k in rnd.sample(range(len(item)), len(item) // 6):
                    item[k] = "changed"
            at = rnd.randrange(len(words) + 1)
            words[at:at] = item
        rows.append((i, " ".join(words).title()))
    return [(n, " ".join(w)) for n, w in enumerate(items)], rows


def test_paraphrases_are_found_and_clean_texts_are_not(spark):
    items, rows = _paraphrases()
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(i, i % 30) for i in range(120)}
    assert not got - want and len(got) >= 0.97 * len(want) and {(i, i % 30) for i in range(60)} <= got


def test_the_space_is_fitted_on_all_passages_of_all_texts(spark):
    rnd = random.Random(4)
    rows = [(i, [w for w in rnd.choices(range(40), k=rnd.randrange(1, 150))]) for i in range(12_000)]
    items = [decontam.Item(n, rnd.choices(range(40), k=30), []) for n in range(5)]
    idf = np.linspace(0.5, 3.0, 40)
    gram, passages = np.zeros((40, 40)), 0
    own, n_own = np.zeros((40, 40)), 0
    for words, out in [*((w, gram) for _, w in rows), *((i.words, own) for i in items)]:
        for a in range(0, len(words), 2 * decontam.HALF):
            x = np.bincount(words[a:a + 2 * decontam.HALF], minlength=40) * idf
            norm = np.sqrt((idf[words[a:a + 2 * decontam.HALF]] ** 2).sum())
            out += np.outer(x, x) / norm**2
            passages, n_own = passages + (out is gram), n_own + (out is own)
    values, vectors = np.linalg.eigh(gram / passages + own / n_own)
    packed = [(i, np.arange(len(w), dtype=np.int32).tobytes(), np.array(w, dtype=np.int32).tobytes()) for i, w in rows]
    tokens = spark.createDataFrame(packed, "doc_id long, pos binary, ids binary")
    got = decontam._fit(tokens, items, idf)
    # all 40 directions are kept, by falling value: each is that of all passages
    close = np.abs((got * vectors[:, ::-1]).sum(axis=0))
    assert got.shape == (40, 40) and close.min() > 1 - 1e-6


def test_pairs_of_words_sum_up_to_the_same_products():
    rnd = np.random.default_rng(6)
    pos, idf, right = np.unique(rnd.integers(0, 9_000, 5_000)), rnd.random(70) + 0.1, rnd.standard_normal((70, 9))
    ids, want, pairs = rnd.integers(0, 70, len(pos)), np.zeros((70, 9)), np.zeros((70, 70))
    assert decontam._gram_times(pos, ids, idf, right, want) == decontam._add_pairs(pos, ids, idf, pairs)
    assert np.allclose((pairs + pairs.T) @ right, want)


@pytest.mark.parametrize("strip", [7, 256])
def test_pairs_of_words_need_only_a_triangle(monkeypatch, strip):
    monkeypatch.setattr(decontam, "STRIP", strip)
    rnd = np.random.default_rng(8)
    pos, idf, right = np.unique(rnd.integers(0, 9_000, 5_000)), rnd.random(70) + 0.1, rnd.standard_normal((70, 9))
    ids, want, pairs = rnd.integers(0, 70, len(pos)), np.zeros((70, 9)), np.zeros(70 * 71 // 2)
    assert decontam._gram_times(pos, ids, idf, right, want) == decontam._add_pairs(pos, ids, idf, pairs)
    assert np.allclose(decontam._pairs_times(pairs, right), want)


@pytest.mark.parametrize("direct", [0, 1 << 21])
def test_shares_of_words_in_groups(monkeypatch, direct):
    monkeypatch.setattr(decontam, "DIRECT", direct)
    rnd = np.random.default_rng(7)
    idf, groups = rnd.random(90) + 0.1, [rnd.integers(0, 90, rnd.integers(1, 30)) for _ in range(50)]
    group, word = (x.ravel() for x in np.meshgrid(np.arange(50), np.arange(90), indexing="ij"))
    got = decontam.Shares.of(groups, idf).share(group, word).reshape(50, 90)
    for n, g in enumerate(groups):
        assert got[n].tolist() == [idf[w] / idf[np.unique(g)].sum() if w in g else 0.0 for w in range(90)]


def test_texts_are_joined_and_searched_some_at_once(monkeypatch):
    rnd = np.random.default_rng(8)
    pos = [np.arange(n, dtype=np.int32) for n in (5, 70, 1, 400, 30)]
    ids = [rnd.integers(0, 60, len(p)).astype(np.int32) for p in pos]
    items = [decontam.Item(1, ids[1][10:50].tolist(), []), decontam.Item(2, ids[3][100:140].tolist(), [])]
    idf, latent = rnd.random(60) + 0.5, rnd.standard_normal((60, 16)).astype(np.float32)
    space = decontam.Space(items, idf, latent, decontam.Shares.of([np.array(i.words) for i in items], idf), decontam._scales(items, idf, latent))
    whole = decontam._search_texts(space, pos, ids)
    monkeypatch.setattr(decontam, "JOINED", 80)
    runs = list(decontam._some_texts(pos, ids))
    assert [(a, [len(x) for x in p]) for a, p, _ in runs] == [(0, [5, 70, 1, 400]), (4, [30])] or max(len(p) for _, p, _ in runs) < 5
    found = [(a + n, *hit) for a, p, w in runs for n, *hit in decontam._search_texts(space, p, w)]
    assert {(f[0], f[1]) for f in found} == {(1, 1), (3, 2)} and len(whole) == len(found)
    assert all(x[:2] == y[:2] and np.allclose(x[2:], y[2:]) for x, y in zip(whole, found))
    assert list(decontam._some_texts([], [])) == []


def test_answers_decide_about_paraphrases(spark):
    question = " ".join(f"q{i}" for i in range(20))
    changed = " ".join(f"q{i}" if i % 4 else "other" for i in range(20))
    rest = [(10 + i, " ".join(random.Random(i).choices(VOCABULARY, k=60))) for i in range(20)]
    docs = spark.createDataFrame([(1, f"{changed} forty two"), (2, changed), (3, question), (4, f"{changed} two forty"), *rest], "doc_id long, text string")
    bench = spark.createDataFrame([(1, question, "Forty two")], "item_id long, text string, answer string")
    assert {r.doc_id for r in decontam.leaks(docs, bench, answer_col="answer").collect()} == {1, 3}


def test_leaks_of_odd_rows(spark, odd):
    item = "a benchmark item of some eight words here"
    docs = odd([*ODD_ROWS, (8, f"x {item} y"), (8, f"x {item} y"), (None, item)])
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "")], "item_id long, text string")
    assert sorted(((r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()), key=str) == [(8, 1), (8, 1), (None, 1)]
    assert decontam.without_leaks(docs, bench).count() == len(ODD_ROWS) - 2  # those with a null id go with the leak
    assert decontam.leaks(odd([]), bench).collect() == []
    assert decontam.leaks(docs, bench.limit(0)).collect() == []
