"""The n-gram join against comparing all pairs."""

import random
from collections import Counter

import pytest

import brute
from marquee.llm import ngramjoin
from marquee.llm.queries import QUERIES
from odd_rows import ODD_ROWS, SF001


def _links(rows, size, percent):
    """Documents that each row is linked to, by comparing all pairs."""
    sets = [brute.shingles(t, size) for _, t in rows]
    out = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if a and rows[i][0] is not None and rows[j][0] is not None and n and 100 * n >= percent * (len(a) + len(sets[j]) - n):
                out[i] += 1
                out[j] += 1
    return out


def _family(rng, words, copies, changes):
    """A text and copies of it with a few words changed each."""
    base = rng.choices(words, k=rng.randint(20, 220))
    out = [" ".join(base)]
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, changes)):
            text[rng.randrange(len(text))] = rng.choice(words)
        out.append(" ".join(text))
    return out


def _check(spark, rows, size, percent):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, entry int, digest string").repartition(7)
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in ngramjoin.ngram_join(df, size=size, percent=percent).collect())
    known = [(i if i is not None else 10**9, t) for i, t in rows]
    least = brute.components([(k, t if i is not None else None) for (i, t), (k, _) in zip(rows, known)], size, percent)
    want = Counter((i, len(brute.shingles(t, size)), c if i is not None else None, n) for (i, t), c, n in zip(rows, least, _links(rows, size, percent)))
    assert got == want


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (2, 60)])
def test_equal_to_all_pairs(spark, monkeypatch, size, percent):
    rng = random.Random(size * percent)
    words = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choices(words, k=60))
    texts = [t for _ in range(12) for t in _family(rng, words, rng.randint(1, 14), rng.choice([2, 4, 9]))]
    texts += _family(rng, words, 60, 3)
    texts += [" ".join(rng.choices(words, k=rng.randint(5, 40))) + " " + passage for _ in range(40)]  # share a passage
    texts += [" ".join(rng.choices("abc", k=rng.randint(0, 14))) for _ in range(150)]  # tiny sets
    texts += texts[:25] + ["A B c D", "a b C d"]
    rng.shuffle(texts)
    monkeypatch.setattr(ngramjoin, "LEAF_ROWS", 8)  # families of many leaves
    _check(spark, list(enumerate(texts, 1)), size, percent)


def test_odd_rows(spark):
    _check(spark, ODD_ROWS, 4, 85)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngramjoin.ngram_join(empty).count() == 0


def test_linked_sets_share_a_kept_entry():
    """r + 1 + s blocks: two linked sets agree in s + 1 of them at least."""
    import numpy as np

    rng = np.random.default_rng(3)
    for percent in (60, 80, 85, 95):
        ranges = ngramjoin.Ranges(percent)
        for _ in range(150):
            n = int(rng.integers(1, 700))
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            drop = int(rng.integers(0, max(1, n * (100 - percent) // percent)))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, int(rng.integers(0, 3)), dtype=np.uint64)]))
            shared = len(np.intersect1d(a, b))
            if not ngramjoin.enough(shared, len(a), len(b), percent) or np.array_equal(a, b):
                continue
            common = np.intersect1d(ranges.entries(a), ranges.entries(b))
            k = max(x for x in range(len(ranges.blocks)) if ranges.starts[x] <= min(len(a), len(b)))
            assert sum((common & 63) == k) >= ranges.spare[k] + 1


def test_bounds_never_fall_short():
    import numpy as np

    rng = np.random.default_rng(4)
    for _ in range(100):
        a = np.unique(rng.integers(0, 500, 200).astype(np.uint64) << np.uint64(40))
        b = np.unique(rng.integers(0, 500, 200).astype(np.uint64) << np.uint64(40))
        bound = np.minimum(ngramjoin.coarse_counts(a), ngramjoin.coarse_counts(b)).sum()
        assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b))


def test_query_against_all_pairs(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    least = brute.components(rows, 4, 85)
    want = {i: (len(brute.shingles(t, 4)), c, n) for (i, t), c, n in zip(rows, least, _links(rows, 4, 85))}
    out = QUERIES["op13_ngram_join"](spark, SF001)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in out.collect()} == want
