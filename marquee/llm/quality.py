"""Quality rules judged by an isolation forest over rule statistics.

Fixed rules fail a text outright (too few words, mostly repeated word windows).
The others are judged by a forest of random trees over the rules' statistics:
each tree splits a few hundred rows at random columns and values until they are
alone, and a text that is alone after few splits is anomalous. The score above
which a text is dropped comes from the labelled rows.

The trees are built from a bounded sample of the statistics; statistics, scores
and the threshold cover every row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import held_out, over_batches, stored, unit_hash, utf8

MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: Trees, and the rows that each is built from.
TREES, TREE_ROWS = 100, 256
#: Share of the good labelled rows that the threshold may drop, how many it may
#: drop of few, and the score from which rows are dropped where no row is
#: labelled bad.
MAX_GOOD_DROPPED, FEW, DEFAULT_THRESHOLD = 0.003, 3, 0.75
BINS = 1000
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = b"0123456789"
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits", "n_punctuation", "n_bytes"]
#: The limits of the statistical rules. The last two are lower limits.
LIMITS = {"symbols": 0.1, "punctuation": 0.08, "upper": 0.2, "digits": 0.15, "dup_lines": 0.3, "repeats": 0.2, "long_words": 10.0, "short_words": 3.0, "few_distinct": 0.1}
FEATURES = list(LIMITS)


def text_counts(text: str | None) -> tuple[int, ...]:
    """The numbers named in ``COUNTS`` for one text (null: none of anything)."""
    text = text or ""
    raw = utf8(text)
    words, lines = raw.split(), raw.split(b"\n")
    seen: set[bytes] = set()
    dup = 0
    for line in lines:
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    repeated = 0
    if len(ids) > 3:
        _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
        _, place, count = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
        twice = count[place] > 1
        covered = np.zeros(len(ids), dtype=bool)
        for k in range(3):
            covered[k:len(ids) - 2 + k] |= twice
        repeated = int(covered.sum())
    left = [len(raw) - len(raw.translate(None, kind)) for kind in (UPPER, DIGITS, PUNCTUATION)]
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dup, repeated, len(lines), len(numbers), *left, len(raw))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``COUNTS`` (long) of every row."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [text_counts(t) for t in b.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COUNTS)))], ["doc_id", *COUNTS])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return over_batches(rows, run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """Rows of ``FEATURES``: how far each statistic lies past the rule's limit,
    so that ordinary texts are alike (0) whatever their length or language."""
    words, lines, raw = (np.maximum(c[k], 1) for k in ("n_words", "n_lines", "n_bytes"))
    length = c["word_chars"] / words
    shares = {"symbols": c["n_symbols"] / words, "punctuation": c["n_punctuation"] / raw, "upper": c["n_upper"] / raw, "digits": c["n_digits"] / raw, "dup_lines": c["n_dup_lines"] / lines, "repeats": c["n_repeat_words"] / words, "long_words": length}
    past = [np.maximum(shares[k] - LIMITS[k], 0) for k in FEATURES[:-2]]
    return np.stack([*past, np.maximum(LIMITS["short_words"] - length, 0), np.maximum(LIMITS["few_distinct"] - c["n_distinct"] / words, 0)], axis=1)


def mean_path(n: int) -> float:
    """Mean depth at which one of n rows is alone in a random tree."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Each tree as arrays over its nodes; leaves have column -1 and their
    path length in ``value``."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    rows: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1, higher for rows that are alone sooner."""
        if not self.trees:
            return np.zeros(len(x))
        total = np.zeros(len(x))
        for column, value, child in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                col = column[at]
                inner = col >= 0
                if not inner.any():
                    break
                right = x[np.arange(len(x)), np.maximum(col, 0)] >= value[at]
                at = np.where(inner, child[at] + right, at)
            total += value[at]
        return 2.0 ** (-total / len(self.trees) / max(mean_path(self.rows), 1e-9))


def grow(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """A forest from the rows of ``x``."""
    rng, out = np.random.default_rng(seed), []
    rows = min(rows, len(x))
    deepest = math.ceil(math.log2(max(rows, 2)))
    for _ in range(trees if rows else 0):
        column, value, child = [-1], [0.0], [0]
        todo = [(0, x[rng.choice(len(x), rows, replace=False)], 0)]
        while todo:
            node, part, depth = todo.pop()
            spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0))
            if depth >= deepest or len(part) < 2 or not len(spread):
                value[node] = depth + mean_path(len(part))
                continue
            c = int(rng.choice(spread))
            low, high = part[:, c].min(), part[:, c].max()
            cut = rng.uniform(low, high)
            cut = cut if cut > low else high
            column[node], value[node], child[node] = c, cut, len(column)
            for side in (part[part[:, c] < cut], part[part[:, c] >= cut]):
                todo.append((len(column), side, depth + 1))
                column.append(-1)
                value.append(0.0)
                child.append(0)
        out.append((np.array(column), np.array(value), np.array(child)))
    return Forest(out, rows)


def _scored(stats: DataFrame, forest: Forest) -> DataFrame:
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        c = {n: b.column(n).to_numpy(zero_copy_only=False) for n in COUNTS}
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.scores(features(c)))], [*b.schema.names, "anomaly"])

    return over_batches(stats, run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", anomaly double")


def _base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def threshold(scored: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> float:
    """The score that best tells labelled bad rows from good ones among those
    that the fixed rules pass, dropping at most ``MAX_GOOD_DROPPED`` (or
    ``FEW``) of the good. From a histogram of ``BINS`` scores, counted over all labelled rows
    that are not held out."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("label")).where(F.col("label").isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.min("label").alias("label"))
    rows = scored.where(~_base_failed()).select("doc_id", F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"))
    counts = rows.join(known, "doc_id").groupBy("bin", (F.col("label") > 0).alias("good")).count().collect()
    good, bad = np.zeros(BINS + 2), np.zeros(BINS + 2)
    for r in counts:
        (good if r["good"] else bad)[min(r["bin"], BINS) + 1] += r["count"]
    if not bad.sum() or not good.sum():
        return DEFAULT_THRESHOLD
    lost, caught = 1 - good.cumsum() / good.sum(), 1 - bad.cumsum() / bad.sum()  # by dropping from bin i on
    allowed = lost <= max(MAX_GOOD_DROPPED, FEW / good.sum())
    best = int(np.argmax(np.where(allowed, caught - lost, -1)))
    return best / BINS if caught[best] > lost[best] else DEFAULT_THRESHOLD


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Statistics, ``anomaly``, ``base_failed`` and ``kept`` for every row.

    Null and empty texts have no words and fail the fixed rules. Repeated rows
    repeat; null ids are judged like others. Without labelled rows the
    threshold is ``DEFAULT_THRESHOLD``; with an empty table the result is empty.
    """
    stats = stored(statistics(docs, id_col, text_col), "quality-statistics")
    passed = stats.where(~_base_failed()).withColumn("draw", unit_hash("doc_id", *COUNTS))
    # only about twice the rows needed are ordered, whatever the number of partitions
    near = passed.where(F.col("draw") < 2.0 * TREES * TREE_ROWS / max(passed.count(), 1))
    sample = near.orderBy("draw", "doc_id").limit(TREES * TREE_ROWS).select(*COUNTS).toPandas()
    forest = grow(features({c: sample[c].to_numpy(dtype=np.int64) for c in COUNTS}))
    scored = _scored(stats, forest)
    limit = threshold(scored, labels, id_col, label_col)
    failed = _base_failed()
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("anomaly") < limit))
