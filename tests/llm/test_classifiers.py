"""Language ID, quality and toxicity: parts against brute force, held-out accuracy."""

import itertools
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from odd_rows import ODD_ROWS, SF01
from marquee.llm import langid, quality, toxicity
from marquee.llm.common import held_out

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _model():
    rng = np.random.default_rng(0)
    pieces = ["▁", "a", "b", "ab", "ba", "▁a", "aba", "▁ab"]
    return langid.Model(["x", "y"], pieces, rng.random((len(pieces), 2)) / 4, np.ones(2) / 2)


def _segmentations(s, model):
    p = {q: model.probs[i] for i, q in enumerate(model.pieces)}
    for cuts in itertools.product([0, 1], repeat=len(s) - 1):
        parts, a = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(s[a:i])
                a = i
        parts.append(s[a:])
        known = [p.get(x) if x in p else (np.full(2, langid.UNKNOWN) if len(x) == 1 else None) for x in parts]
        if all(k is not None for k in known):
            yield parts, np.prod(known, axis=0)


@pytest.mark.parametrize("word", ["ab", "aba", "bab", "abzab", "aabbab"])
def test_forward_sums_all_segmentations(word):
    scorer = langid.Scorer(_model())
    total = sum(p for _, p in _segmentations("▁" + word, scorer.model))
    assert np.allclose(scorer.word_logs(word), np.log(total))
    want = Counter()
    for parts, p in _segmentations("▁" + word, scorer.model):
        for x in parts:
            if x in scorer.index:
                want[scorer.index[x]] += p[1] / total[1]
    got = Counter()
    for i, x in scorer.expected(word, 1):
        got[i] += x
    assert all(np.isclose(got[i], want[i]) for i in want | got)


def test_words_that_share_beginnings_score_as_alone():
    scorer = langid.Scorer(_model())
    words = sorted({"a", "ab", "aba", "abab", "abb", "b", "ba", "xab", "xx", "ab" * 16, "ab" * 17, "ab" * 300, "漢a", "漢b"})
    for word, logs in zip(words, scorer.words_logs(words), strict=True):
        np.testing.assert_allclose(logs, scorer.word_logs(word), rtol=1e-12)


def test_expected_counts_of_many_words_are_worked_out_together(monkeypatch):
    scorer = langid.Scorer(_model())
    words = ["a", "ab", "aba", "bab", "abzab", "aabbab", "zz", "a" * 32, "漢a", "a", "ba" * 20]
    lang, n, want = np.arange(len(words)) % 2, np.arange(len(words)) + 1.0, np.zeros((8, 2))
    for w, k, times in zip(words, lang.tolist(), n.tolist()):
        for i, x in scorer.expected(w, k):
            want[i, k] += times * x
    alone, got = [], np.zeros((8, 2))
    one = scorer.expected
    monkeypatch.setattr(scorer, "expected", lambda w, k: alone.append(w) or one(w, k))
    scorer.add_expected(words, lang, n, got)
    assert np.allclose(got, want, rtol=1e-12) and alone == ["ba" * 20]  # long words alone
    scorer.add_expected([], lang[:0], n[:0], got)
    assert np.allclose(got, want, rtol=1e-12)


def test_long_words_do_not_underflow():
    logs = langid.Scorer(_model()).word_logs("ab" * 20_000)
    assert all(np.isfinite(logs)) and logs[0] != logs[1]


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.train(docs.where(~held_out("doc_id")), PIECES, per_lang=150)
    rows = langid.predict(docs, model).join(docs.where(held_out("doc_id")).select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    kept = docs.where(langid.recognised(model, F.col("text"), 0.5)).count()
    assert kept == langid.predict(docs, model).where("score >= 0.5").count()


def test_language_is_learned_from_all_labelled_rows(spark):
    rows = spark.range(6_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("der die das x"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"), F.lit("de").alias("lang"))
    words = langid._word_counts(rows.select("lang", "text")).where("word = 'der'").first()["n"]
    probs = langid.train(rows, PIECES, rounds=1).probs
    few = langid.train(rows, PIECES, per_lang=2_000, rounds=1).probs
    assert words == 6_000 and not np.allclose(probs, few, rtol=0.01, atol=0)
    # all rows once more give the same shares of all pieces
    assert np.allclose(langid.train(rows.unionAll(rows), PIECES, rounds=1).probs, probs, rtol=1e-3, atol=1e-9)


def test_floor_is_taken_over_all_labelled_rows(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.train(docs, PIECES, per_lang=150)
    many = docs.select("text", "lang").crossJoin(spark.range(3).select("id")).select(F.when(F.col("id") == 0, F.col("text")).otherwise(F.lit("the house of the people")).alias("text"), "lang", "id")
    many = many.withColumn("doc_id", F.monotonically_increasing_id())
    scorer = langid.Scorer(model)
    fits = sorted(f for f in (langid.fit(scorer, r.text) for r in many.select("text").collect()) if f > -np.inf)
    low, mid = np.quantile(fits, [langid.STRAY, 0.5])
    assert abs(langid.floor(many, model) - (mid - langid.FAR * (mid - low))) < 0.01


def test_language_of_odd_rows(odd):
    none = langid.train(odd(ODD_ROWS), PIECES)  # no labelled row
    assert none.langs == []
    rows = langid.predict(odd(ODD_ROWS), none).collect()
    assert len(rows) == len(ODD_ROWS) and {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    known = odd([(1, "der die das"), (2, "the of and")]).withColumn("lang", F.expr("CASE doc_id WHEN 1 THEN 'de' ELSE 'en' END"))
    model = langid.train(known, PIECES)
    got = {r.doc_id: r.lang_pred for r in langid.predict(odd([(1, None), (2, "123 !"), (3, "die das"), (4, "the the and"), (5, "")]), model).collect()}
    assert got == {1: "und", 2: "und", 3: "de", 4: "en", 5: "und"}
    assert langid.predict(odd([]), model).collect() == []


def test_common_words_are_a_product_for_many_texts(monkeypatch):
    rng = np.random.default_rng(3)
    vectors = {i: toxicity.counted([*rng.choice(6, 4).tolist(), *rng.choice(300, 5).tolist()]) for i in range(900)}
    args = [f"t{i}" for i in range(300)], 1 + rng.random(300), vectors, {i: i % 2 for i in range(900)}, {0: 1.0, 1: 2.0}
    index = toxicity._build(*args)
    assert 0 < len(index.common) < 10 and not set(index.common.nonzero()[0]) - set(index.row)
    monkeypatch.setattr(toxicity, "COMMON", 0)  # without: all words have places
    plain = toxicity._build(*args)
    assert len(plain.common) == 0 and np.allclose(plain.curve, index.curve)
    texts = [index.vector(vectors[i]) for i in range(0, 900, 7)]
    for (near, cos), (ids, all_cos) in zip(index.nearest_of(texts), plain.nearest_of(texts), strict=True):
        assert near.tolist() == ids.tolist() and np.allclose(cos, all_cos)


def _counts(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines, dup, seen = (text or "").split("\n"), 0, set()
    for line in lines:
        dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_quality_counts(documents):
    texts = [None, "", " \n \n", "a a a a", "a b c a b c", "x\n\nx\n \n x", "é \x85 b", "#a |$"] + [r.text for r in documents.select("text").collect()]
    for t in texts:
        assert quality.text_counts(t)[:5] == _counts(t), t


def test_forest_scores_what_lies_apart_higher():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 3))
    forest = quality.grow(x)
    assert forest.scores(np.full((1, 3), 8.0))[0] > np.quantile(forest.scores(x), 0.999)
    assert quality.grow(np.zeros((0, 3))).scores(np.zeros((2, 3))).tolist() == [0, 0]


def test_quality_verdicts(spark, odd):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.judge(docs, labels).join(labels.where(held_out("doc_id")), "doc_id").where("not base_failed").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2
    out = quality.judge(odd(ODD_ROWS), labels.limit(0)).collect()
    assert len(out) == len(ODD_ROWS) and not any(r.kept for r in out if r.n_words < 50)
    assert quality.judge(odd([]), labels).collect() == []


def test_nearest_is_exact():
    rng = np.random.default_rng(2)
    terms = [f"t{i}" for i in range(30)]
    vectors = {i: toxicity.counted(rng.choice(30, rng.integers(1, 8)).tolist()) for i in range(1500)}
    labels = {i: int(rng.random() < 0.3) for i in vectors}
    ix = toxicity._build(terms, 1 + rng.random(30), vectors, labels, {0: 1.0, 1: 1.0}, np.arange(30) < 4)
    dense = np.zeros((len(ix.ids), 30))
    for n, i in enumerate(ix.ids.tolist()):
        t, w = ix.vector(vectors[i])
        dense[n, t] = w
    for _ in range(100):
        t, w = ix.vector(toxicity.counted(rng.choice(30, rng.integers(1, 8)).tolist()))
        cos = np.round(dense[:, t] @ w, 9)
        want = np.argsort(-cos, kind="stable")[:toxicity.NEIGHBOURS]
        near, got = ix.nearest(t, w)
        assert near.tolist() == want[cos[want] > 0].tolist()
        assert np.allclose(got, cos[near])


def test_a_copy_of_a_labelled_text_has_it_as_its_nearest(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    index = toxicity.fit(docs, labels.where(~held_out("doc_id")), per_class=300)
    text_of = {r.doc_id: r.text for r in docs.collect()}
    examples = docs.where(F.col("doc_id").isin(index.ids.tolist()))
    assert examples.count() == len(index.ids)
    for r in toxicity.score(examples, index).collect():
        assert r.near_cosines[0] > 1 - 1e-9 and Counter(toxicity.text_terms(text_of[r.near_ids[0]])) == Counter(toxicity.text_terms(text_of[r.doc_id]))
    for r in toxicity.score(docs, index).where("size(near_ids) = 0").collect():
        assert not toxicity.text_terms(text_of[r.doc_id])


def test_toxicity_held_out_by_language(spark):
    """On the larger folder: the smaller has one to four such rows of a language."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    index = toxicity.fit(docs, labels.where(~held_out("doc_id")))
    rows = toxicity.score(docs, index).join(labels.where(held_out("doc_id")), "doc_id").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    share = rows.groupby(["lang", "toxic"]).predicted.mean()
    for lang, least in (("en", 0.85), ("fr", 0.5), ("de", 0.5), ("es", 0.5)):
        assert share[lang, 1] >= least and share[lang, 0] < 0.1, lang


def test_toxicity_held_out(spark, odd):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    index = toxicity.fit(docs, labels.where(~held_out("doc_id")))
    rows = toxicity.score(docs, index).join(labels.where(held_out("doc_id")), "doc_id").collect()
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.05
    english = docs.where("lang = 'en'").select("doc_id")
    toxic = toxicity.score(docs.join(english, "doc_id", "left_semi"), index).join(labels.where(held_out("doc_id")).where("toxic = 1"), "doc_id").collect()
    assert np.mean([r.predicted for r in toxic]) > 0.8
    out = toxicity.score(odd(ODD_ROWS), index).collect()
    assert len(out) == len(ODD_ROWS) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.fit(docs, labels.where("toxic = 0")) is None
    assert {r.score for r in toxicity.score(odd(ODD_ROWS), None).collect()} == {0.0}
    assert toxicity.score(odd([]), index).collect() == []


@pytest.mark.parametrize("kept", [2, 1_000])
def test_a_word_is_looked_up_once_until_the_table_begins_anew(monkeypatch, kept):
    monkeypatch.setattr(toxicity, "WORD_TABLE", kept)
    texts = ["Horses, horse! horses' HORSES unknown unknowns", "größere Größe horse x", "", None, "unknown", "horse"]
    terms = sorted({w.decode("latin-1") for t in texts[:2] for w in toxicity.text_terms(t)} - {"unknown", "unkno*"})
    numbers = toxicity.Numbers(terms)
    for text in texts * 2:
        want = [terms.index(w.decode("latin-1")) for w in toxicity.text_terms(text) if w.decode("latin-1") in terms]
        assert sorted(numbers.of(text).tolist()) == sorted(want)
        assert len(numbers) <= kept
