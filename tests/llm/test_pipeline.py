"""The pipeline against brute force, stage by stage, at sf0.001."""

import hashlib
import os

import numpy as np
import public_tokenizers
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from odd_rows import SF001, SF01
from test_passages import _passages_by_hand as passages_by_hand
from marquee.llm import langid
from marquee.llm.common import bag_of_words, delete, held_out, scratch, stored


def _language(spark, rows, documents):
    known = documents.where(~held_out("doc_id"))
    model = langid.train(known, public_tokenizers.path("piece_bpe_32k.model"))
    scorer, floor = langid.Scorer(model), langid.floor(known, model)
    return [(i, t) for i, t in rows if langid.best_language(scorer, t)[1] >= corpus_pipeline.MIN_LANGUAGE_SCORE and langid.fit(scorer, t) >= floor]


def _without_passages(rows):
    """Each text without the passages of texts with smaller hashes; texts left
    without words go."""
    number = {t: np.uint64(xxhash.xxh64_intdigest(t.encode(), seed=42)).astype(np.int64).item() for _, t in rows}
    left = passages_by_hand([(number[t], t) for t in number])
    return [(i, left[number[t]][0]) for i, t in rows if not left[number[t]][1] or left[number[t]][0].strip()]


FOREIGN = ["Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.", "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt.", "xkqz vwpf zzgh qwlr jjtk bnmx plkj hgfd qqzx wvtr"]


def test_unknown_languages_and_random_letters_go(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = spark.createDataFrame([(10**9 + k, t) for k, t in enumerate(FOREIGN)], "doc_id long, text string")
    both = docs.unionByName(rows, allowMissingColumns=True)
    left = {r.doc_id for r in corpus_pipeline.language(spark, both, SF01).select("doc_id").collect()}
    assert not any(i >= 10**9 for i in left)
    assert len(left) >= 0.99 * docs.count()


def test_equal_texts_stay_equal_and_all_but_one_go(spark, documents):
    copies = documents.unionByName(documents.withColumn("doc_id", F.col("doc_id") + 10**6))
    left = corpus_pipeline.line_dedup(spark, copies, SF001)
    text = {r.doc_id: r.text for r in left.collect()}
    assert all(text.get(i) == text.get(i + 10**6) for i in text if i < 10**6)
    kept = [r.text for r in corpus_pipeline.near_dedup(spark, left, SF001).collect() if r.text and r.text.split()]
    assert len(kept) == len(set(kept))


def test_pipeline_against_brute_force(spark, documents):
    rows = sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    rows = _language(spark, rows, documents)
    rows = _without_passages(rows)
    rows = [r for r, c in zip(rows, brute.components(rows, 5, 80)) if r[0] == c]
    items = [r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(brute.contains_item(t, x, bag_of_words) for x in items)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, t in rows:
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF001).collect()}
    assert got == want


def test_stages_keep_the_columns_and_take_empty_tables(spark, documents):
    empty = documents.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, SF001).columns == documents.columns, name
        out = stage(spark, empty, SF001)
        assert out.columns == documents.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF001).count() == 0


def test_scratch_tables_go_and_others_stay(spark):
    def files(df):
        return df.inputFiles()[0].removeprefix("file:")

    before = stored(spark.range(5), "test-before")
    with scratch(spark):
        inner = files(stored(spark.range(5), "test-inner"))
        assert os.path.exists(inner)
    assert not os.path.exists(inner) and before.count() == 5
    path = os.path.dirname(files(before))
    delete(spark, path)
    delete(spark, path)  # no folder, no error
    assert not os.path.exists(path)
