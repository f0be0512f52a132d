"""The corpus pipeline: language ID, line dedup, near duplicates, benchmark
decontamination, tokens.

Each stage takes the documents that its predecessor kept; all but the last
return the columns of documents. ``ORACLE_SQL`` is None, as SQL cannot express
the language model, the latent space or the merges; ``tests/llm`` holds a
brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from marquee.llm import bpe, decontam, langid, linechunks, minhash
from marquee.llm.common import delete, fresh_path, held_out, scratch, ship_code, stored

#: Least posterior of the predicted language.
MIN_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters, those that could
    as well be of another language, and those whose words fit none of the
    learned languages go. Texts are judged once, for the floor and for what stays."""
    ship_code(spark)
    model = langid.train(docs.where(~held_out("doc_id")), public_tokenizers.path("piece_bpe_32k.model"))
    rows = stored(docs.withColumn("__judged", langid.judgement(model, F.col("text"))), "pipeline-judged")
    floor = langid.floor_of(rows.where(~held_out("doc_id") & F.col("lang").isNotNull()).select("__judged.fit"))
    return rows.where((F.col("__judged.posterior") >= MIN_LANGUAGE_SCORE) & (F.col("__judged.fit") >= floor)).select(*(F.col(f"`{c}`") for c in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of lines that stand elsewhere too;
    equal texts stay equal, for the next stage to find. Documents that had
    nothing else go."""
    out = linechunks.dedup_passages(docs, copies_alike=True).where((F.col("lines_removed") == 0) | F.col("text").rlike(r"\S"))
    return out.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    ship_code(spark)
    gone = minhash.near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("__gone"), "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    ship_code(spark)
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    ship_code(spark)
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language ID", language), ("line dedup", line_dedup), ("near duplicates", near_dedup), ("decontamination", decontaminate), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read
    again by the next. What a stage stored on its way is deleted once its result
    is written, and so is its input."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for n, (name, stage) in enumerate(STAGES[:-1]):
        path = fresh_path(spark, f"pipeline-{n}")
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
