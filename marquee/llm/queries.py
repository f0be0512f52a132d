"""Registered queries of the thirteen operators, and the SQL of those that SQL can
express. Each reads its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, chat, decontam, divergence, interaction, langid, linechunks, minhash, ngramjoin, quality, tokenfiles, toxicity, urlrules
from marquee.llm.common import fresh_path, held_out, ship_code, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship_code(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~held_out("doc_id")), public_tokenizers.path("piece_bpe_32k.model"))
    return langid.predict(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85)


CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(0, 2, 1, 1).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return chat.read_back(stored(chat.format_rows(rows.unionByName(control)), "chat-formatted"))


def op5_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linechunks.dedup_passages(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", F.length("text").cast("long").alias("n_chars_left"), "lines_removed", "chunks_removed")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_path(spark, "tokens")
    tokenfiles.write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), out, end_id=2)
    return tokenfiles.read_token_files(spark, out)


#: host, path, verdict
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge_urls(_table(spark, sf_dir, "pages"), rules)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    index = toxicity.fit(docs, labels.where(~held_out("doc_id")))
    out = toxicity.score(docs, index, cut=0.3)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "near_ids", "near_cosines")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(_table(spark, sf_dir, "documents"), min_docs=30, top=50)


def op12_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.ngram_join(_table(spark, sf_dir, "documents"), size=4, percent=85)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_bpe, op2_langid, op3_minhash, op4_chat, op5_line_chunks, op6_quality, op7_decontam, op8_token_files, op9_url_rules, op10_toxicity, op11_divergence, op12_interaction, op13_ngram_join, pipeline)}

CHAT_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
  UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
escaped AS (
  SELECT *, replace(replace(role, '&', '&amp;'), '<|', '&lt;|') AS r0, replace(replace(text, '&', '&amp;'), '<|', '&lt;|') AS t1 FROM rows),
sized AS (SELECT *, replace(r0, chr(10), '&nl;') AS r1 FROM escaped)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(length(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant')), 0) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(r1) + length(t1) + {len(chat.OPEN) + len(chat.CLOSE) + 2}) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def _url_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, row_number() OVER () AS n, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM cut),
urls AS (
  SELECT page_id, n, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM parts),
rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
fits AS (
  SELECT n, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS best
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(rule_verdict, '{urlrules.DEFAULT}') AS verdict
FROM urls LEFT JOIN (SELECT * FROM fits WHERE best = 1) f USING (n)
"""


DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
tokens AS (
  SELECT n, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
cells AS (SELECT lang, source, term, count(DISTINCT n) AS docs, count(*) AS c FROM tokens GROUP BY lang, source, term),
kept AS (SELECT lang, term, CAST(sum(c) AS HUGEINT) AS c FROM cells GROUP BY lang, term HAVING sum(docs) >= 30),
vocabulary AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
  SELECT g.lang, g.source, k.term, CAST(coalesce(x.c, 0) AS HUGEINT) AS c FROM groups g JOIN kept k USING (lang) LEFT JOIN cells x USING (lang, source, term)),
totals AS (SELECT lang, source, CAST(sum(c) AS HUGEINT) AS n FROM counts GROUP BY lang, source),
shares AS (
  SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 5)) // (n + 5 * v.v) AS p FROM counts JOIN totals t USING (lang, source) JOIN (SELECT lang, v FROM vocabulary) v USING (lang)),
of_lang AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 5)) // (n + 5 * v) AS q FROM kept JOIN vocabulary USING (lang)),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(far.f, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
over AS (
  SELECT lang, source, term AS item, CAST(p - q AS BIGINT) AS value FROM shares JOIN of_lang USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM over)
WHERE rank <= 50
"""

INTERACTION_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
firsts AS (SELECT text, min(doc_id) AS first FROM docs GROUP BY text),
failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
    CASE WHEN len(words) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
  FROM docs JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
masks AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad FROM failed GROUP BY part, fails),
letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS l, substr(filter_order, 1, step - 1) AS before FROM orders, generate_series(1, 5) t(step)),
counted AS (
  SELECT part, filter_order, CAST(step AS INT) AS step, l,
    CAST(coalesce(sum(n) FILTER (WHERE fails = translate(fails, before || l, '')), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (WHERE contains(fails, l) AND fails = translate(fails, before, '')), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (WHERE contains(fails, l) AND fails <> translate(fails, before, '')), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (WHERE fails = l), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (WHERE contains(fails, l) AND fails = translate(fails, before, '')), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(bad) FILTER (WHERE contains(fails, l) AND fails = translate(fails, before, '')), 0) AS BIGINT) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, l)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
FROM counted
"""

def _links_sql(size: int, percent: int, columns: str) -> str:
    """Sets of shingles, pairs by shared shingles, components by reachability;
    documents with equal sets are one class, named by its smallest id."""
    return rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) < {size} THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i:i + {size - 1}], ' ') FOR i IN range(1, len(w) - {size - 2})]) END AS s
  FROM docs WHERE len(w) > 0),
named AS MATERIALIZED (SELECT doc_id, len(s) AS n, min(doc_id) OVER (PARTITION BY md5(array_to_string(list_sort(s), chr(10)))) AS id, s FROM shingled),
classes AS MATERIALIZED (SELECT id, any_value(n) AS n, count(*) AS docs, any_value(s) AS s FROM named GROUP BY id),
items AS MATERIALIZED (SELECT id, n, unnest(s) AS shingle FROM classes),
pairs AS MATERIALIZED (
  SELECT a.id AS u, b.id AS v FROM items a JOIN items b USING (shingle)
  WHERE a.id < b.id AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
links AS MATERIALIZED (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
least_of AS (SELECT u AS id, min(v) AS far FROM reach GROUP BY u),
linked AS (SELECT u AS id, sum(c.docs) AS others FROM links JOIN classes c ON c.id = v GROUP BY u)
SELECT d.doc_id, CAST(coalesce(x.n, 0) AS BIGINT) AS n_shingles, coalesce(least(x.id, far), x.id, d.doc_id) AS component_id, {columns}
FROM docs d LEFT JOIN named x USING (doc_id) LEFT JOIN least_of ON least_of.id = x.id LEFT JOIN linked ON linked.id = x.id LEFT JOIN classes c ON c.id = x.id
"""


KEPT = "coalesce(least(x.id, far), x.id, d.doc_id) = d.doc_id AS kept"
N_LINKS = "CAST(coalesce(others, 0) + coalesce(c.docs - 1, 0) AS BIGINT) AS n_links"
ORACLE = {"op3_minhash": _links_sql(3, 85, KEPT), "op13_ngram_join": _links_sql(4, 85, N_LINKS), "op4_chat": CHAT_SQL, "op9_url_rules": _url_sql(), "op11_divergence": DIVERGENCE_SQL, "op12_interaction": INTERACTION_SQL}
