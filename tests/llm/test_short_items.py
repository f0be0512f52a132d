"""Benchmark items of few words in real texts, whole and reworded."""

import random

from pyspark.sql import functions as F

from odd_rows import SF01
from marquee.llm import decontam
from marquee.llm.common import bag_of_words


def test_short_items_in_real_texts_are_found(spark):
    rnd = random.Random(13)
    docs, bench = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    bench = bench.withColumn("answer", F.lit("zzanswer zzgiven"))
    items = [(r.item_id, bag_of_words(r.text)) for r in bench.orderBy("item_id").collect()]
    items = [(i, words) for i, words in items if len(words) < 24]
    texts = [bag_of_words(r.text) for r in docs.orderBy("doc_id").limit(400).collect()]
    texts = [t for t in texts if 150 <= len(t) <= 600]
    pool, rows, want = [w for t in texts for w in t], [], set()
    for copy in range(12):
        for i, words in items:
            part = list(words)
            if copy % 2:  # one word in three is another
                for k in rnd.sample(range(len(part)), len(part) // 3):
                    part[k] = rnd.choice(pool)
            text, row = rnd.choice(texts), len(rows)
            at = rnd.randrange(len(text))
            rows.append((1_000_000 + row, b" ".join([*text[:at], *part, b"zzanswer zzgiven", *text[at:]]).decode()))
            want.add((1_000_000 + row, i))
    planted = docs.select("doc_id", "text").unionAll(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(planted, bench, answer_col="answer").collect()}
    assert len(want) > 400 and not want - got, f"{len(want - got)} of {len(want)} not found"
