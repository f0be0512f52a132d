"""Source divergence audit with in-mapper stripes.

Each task folds whole documents into hash stripes: for every language and term
the number of documents that hold it and its occurrences by source. A task whose
tables are full spills its stripes and begins anew. Stripes of one (language,
term) are merged by key after one shuffle. The merged stripes then give all
divergences at once: a stripe is a term's row in the table of terms by sources,
so one pass over the stripes adds up the distances of every pair of sources and
finds each source's most over-used terms.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import spread, stored, uncollected, utf8

#: Entries that a task's tables hold before it spills them.
SPILL_ENTRIES = 400_000
#: Cells (terms times sources) of one slot of merged stripes, on average, and of
#: one block of them in memory.
SLOT_CELLS, BLOCK_CELLS = 1 << 18, 1 << 20
#: Probabilities are whole numbers of 1 / SCALE; PRIOR occurrences are added to each term.
SCALE, PRIOR = 1_000_000_000, 5

#: ASCII letters, lower-cased, and all bytes of other characters stay; the other
#: ASCII characters part the terms.
TERM_BYTES = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters and of characters beyond ASCII, A-Z lower-cased."""
    return utf8(text).lower().translate(TERM_BYTES).split() if text else []


STRIPE = "lang string, term string, stripe array<struct<source string, docs long, n long>>"
STRIPE_TYPE = pa.list_(pa.struct([("source", pa.string()), ("docs", pa.int64()), ("n", pa.int64())]))


class _Tables:
    """One task's counts: documents and occurrences of each term by group."""

    def __init__(self) -> None:
        self.docs: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.n: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.entries = 0

    def add(self, group: tuple[str, str], found: list[bytes]) -> None:
        docs = self.docs[group]
        before = len(docs)
        docs.update(set(found))
        self.n[group].update(found)
        self.entries += len(docs) - before

    def stripes(self) -> Iterator[pa.RecordBatch]:
        """The tables turned into stripes, one language after the other."""
        for lang in sorted({g[0] for g in self.docs}):
            sources = sorted(s for l, s in self.docs if l == lang)
            stripe = defaultdict(list)
            for s in sources:
                n = self.n[lang, s]
                for term, d in self.docs[lang, s].items():
                    stripe[term].append({"source": s, "docs": d, "n": n[term]})
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(stripe), pa.string()), pa.array([t.decode("utf-8", "replace") for t in stripe], pa.string()),
                                              pa.array(list(stripe.values()), STRIPE_TYPE)], ["lang", "term", "stripe"])


def mapped_stripes(docs: DataFrame) -> DataFrame:
    """Stripes of each task from rows ``lang, source, text``; a (language, term)
    has one row for each task and spill that met it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _Tables()
        with uncollected():
            for b in batches:
                for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text"))):
                    found = terms(text)
                    if found:
                        tables.add((lang, source), found)
                    if tables.entries >= SPILL_ENTRIES:
                        yield from tables.stripes()
                        tables = _Tables()
            yield from tables.stripes()

    return docs.select("lang", "source", "text").mapInArrow(run, STRIPE)


def merged_stripes(docs: DataFrame, min_docs: int) -> DataFrame:
    """``lang, term, stripe``: one stripe per term that at least ``min_docs``
    documents of the language hold. Stripes cross one shuffle, by (lang, term);
    both groupings after it keep that partitioning."""
    parts = mapped_stripes(docs).repartition("lang", "term")
    cells = parts.select("lang", "term", F.inline("stripe")).groupBy("lang", "term", "source").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    whole = cells.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("stripe"))
    return whole.where(F.col("docs") >= min_docs).select("lang", "term", "stripe")


def _shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / total), exact: long division with three
    digits at a time, so that no step leaves 64 bits while a total is below 9e15."""
    rest = counts + PRIOR
    out, rest = rest // total, rest % total
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


PARTIAL = "lang string, source string, part string, item string, value long"


def _slot_divergences(stripes: pa.Table, head: dict, top: int) -> list[tuple]:
    """Partial distances of each pair of sources, and each source's best terms,
    over the stripes of one slot of a language."""
    lang, sources = head["of_lang"], head["sources"]
    number = {s: i for i, s in enumerate(sources)}
    n = np.array([*head["totals"], sum(head["totals"])], dtype=np.int64)
    total = n + PRIOR * head["terms"]
    pairs = np.zeros((len(sources), len(sources)), dtype=np.int64)
    best: list[list] = [[] for _ in sources]
    names, stripe = stripes.column("term").to_pylist(), stripes.column("stripe").combine_chunks()
    rows = np.repeat(np.arange(len(names)), stripe.value_lengths().to_numpy())
    flat = stripe.flatten()
    cols = np.array([number[s] for s in flat.field("source").to_pylist()], dtype=int)
    values = flat.field("n").to_numpy()
    step = max(1, BLOCK_CELLS // (len(sources) + 1))
    for a in range(0, len(names), step):
        p, q = np.searchsorted(rows, [a, a + step])
        counts = np.zeros((min(step, len(names) - a), len(sources) + 1), dtype=np.int64)
        counts[rows[p:q] - a, cols[p:q]] = values[p:q]
        counts[:, -1] = counts[:, :-1].sum(axis=1)
        share = _shares(counts, total)
        for i in range(len(sources)):
            pairs[i, i + 1:] += np.abs(share[:, i + 1:-1] - share[:, i:i + 1]).sum(axis=0)
            over = share[:, i] - share[:, -1]
            for k in np.nonzero((over > 0) & (counts[:, i] > 0))[0]:
                best[i].append((-int(over[k]), names[a + k]))
            best[i] = heapq.nsmallest(top, best[i])
    out = [(lang, sources[i], "pair", sources[j], int(pairs[i, j])) for i in range(len(sources)) for j in range(i + 1, len(sources))]
    return out + [(lang, sources[i], "term", t, -v) for i, found in enumerate(best) for v, t in found]


def divergences(docs: DataFrame, min_docs: int = 30, top: int = 50, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (language, source).

    With p the smoothed share of a kept term in a group, as whole numbers of
    1e-9: part ``pair`` is the distance to each other source of the language,
    summed over all kept terms; part ``term`` the ``top`` terms whose share in the
    group exceeds that in the language most. Ranks go by value, then item in
    UTF-8 order, so ties have one result.

    Null text, language and source count as ''. A group without terms has its
    pairs; a language that keeps no term has pairs of value 0. Rows that repeat
    count each; other columns are not read; an empty table gives no rows. Sums
    are exact while a language has fewer than 9e15 terms.

    Every task holds one block of stripes and a square of the sources of one
    language, as many numbers as the result has."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    groups = stored(docs.select("lang", "source").distinct(), "divergence-groups")
    merged = stored(merged_stripes(docs, min_docs), "divergence-stripes")

    totals = merged.select("lang", F.inline("stripe")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    vocabulary = merged.groupBy("lang").agg(F.count("*").alias("terms"), F.sum(F.size("stripe")).alias("cells"))
    listed = groups.join(totals, ["lang", "source"], "left").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", F.coalesce("n", F.lit(0)).alias("n")))).alias("g"))
    head = listed.join(vocabulary, "lang").select("lang", F.col("g.source").alias("sources"), F.col("g.n").alias("totals"), "terms")
    head = stored(head, "divergence-head")
    cells = vocabulary.agg(F.coalesce(F.sum("cells"), F.lit(0))).first()[0]
    slots = 1 + cells // SLOT_CELLS

    slotted = merged.withColumn("slot", F.pmod(F.xxhash64("term"), F.lit(slots)).cast("int"))
    heads = spread(slotted.select("lang", F.col("slot").alias("of_slot")).distinct().join(head, "lang").withColumnRenamed("lang", "of_lang"))

    def run(key: tuple, stripes: pa.Table, heads: pa.Table) -> pa.Table:
        rows = _slot_divergences(stripes, heads.to_pylist()[0], top) if stripes.num_rows and heads.num_rows else []
        types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
        cols = list(zip(*rows)) or [()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=["lang", "source", "part", "item", "value"])

    partial = stored(slotted.groupBy("lang", "slot").cogroup(heads.groupBy("of_lang", "of_slot")).applyInArrow(run, PARTIAL), "divergence-partial")

    found = partial.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ordered = groups.join(groups.withColumnRenamed("source", "item"), "lang").where("source < item")
    half = ordered.join(found, ["lang", "source", "item"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))
    both = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    best = partial.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(best.select(*pairs.columns))
