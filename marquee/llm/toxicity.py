"""Toxicity by the nearest labelled examples.

Texts are TF-IDF vectors over all words, and beginnings of words, that occur in
the labelled examples. The words that tell the labels apart make up a fixed
share of a vector's length, the others the rest: they weigh more, and none is
left out. The index holds the examples as an inverted index, but for the
commonest words, whose weights are rows of a matrix: a product gives what they add
to the cosines of some texts with all examples, the postings of a text's other
words give the rest, so that the search is exact. The neighbours vote with
weights that fall with their distance; the vote becomes a probability through a
monotone curve fitted on the examples' own leave-one-out votes. The neighbours
are the evidence.

Examples come from a bounded sample of the labelled rows (a hash of the id
draws it); document frequencies are counted over all documents, and every
document is scored, whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import bag_of_words, over_batches, stored, unit_hash, utf8

#: Examples drawn per class, in expectation.
PER_CLASS = 2_000
#: Examples that a word must occur in to be tested for telling the labels apart.
MIN_EXAMPLES = 3
#: A word tells them apart if its likelihood ratio is this many times (as a
#: power of e) what the luckiest of all tested words would have.
MARGIN = 3.0
#: Share of a squared vector that telling words make up, where a text has both.
EMPHASIS = 0.8
NEIGHBOURS = 25
#: A word in more than one in this many examples is common, at most so many words
#: are; texts whose products with the common words' weights are made at once.
SHARE_COMMON, COMMON, TOGETHER = 12, 768, 64
#: Bytes of a word's beginning that are a term of their own, as inflected words
#: share them.
BEGINNING = 5
CURVE_BINS = 40
#: Texts whose result a task keeps for their copies, and words whose terms it
#: keeps, before it begins anew.
COPY_TABLE, WORD_TABLE = 20_000, 1 << 18

Terms = tuple[np.ndarray, np.ndarray]


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers begin[0], begin[0] + 1, ... of all ranges, one after another."""
    before = np.cumsum(size) - size
    return np.repeat(begin - before, size) + np.arange(int(size.sum()))


def counted(numbers: Sequence[int] | np.ndarray) -> Terms:
    """Different term numbers and how often each stands there."""
    t, n = np.unique(np.asarray(numbers, dtype=np.int64), return_counts=True)
    return t, n


class Numbers(dict):
    """For a word, the number of its term and of its beginning's, each plus one (0:
    none), in the upper and lower half of an integer; looked up once a word."""

    def __init__(self, terms: Sequence[str]):
        super().__init__()
        self.number = {t.encode("latin-1"): i for i, t in enumerate(terms, 1)}

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_TABLE:
            self.clear()
        get = self.number.get
        both = self[word] = get(word, 0) << 32 | (get(word[:BEGINNING] + b"*", 0) if len(word) > BEGINNING else 0)
        return both

    def of(self, text: str | None) -> np.ndarray:
        """The numbers of those of the text's terms that have one."""
        words = bag_of_words(text)
        found = list(map(self.get, words))  # faster than one by one where few words are new
        both = np.array([self[w] if b is None else b for w, b in zip(words, found)] if None in found else found, dtype=np.int64)
        numbers = np.concatenate([both >> 32, both & 0xFFFFFFFF])
        return numbers[numbers > 0] - 1


@dataclass
class Index:
    """The postings of term t are ``first[t]`` to ``first[t + 1]``: examples ``who``
    and weights ``weight``. Common terms have no postings but a row of ``common``
    (``row[t]``, else -1): their weight in each example."""

    terms: list[str]
    idf: np.ndarray
    telling: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    first: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int64))
    who: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    row: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    common: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    curve: list[tuple[float, float]] = field(default_factory=list)
    empty_score: float = 0.0

    def vector(self, counts: Terms) -> Terms:
        """Term numbers and unit-length TF-IDF weights."""
        t, n = counts
        w = (1 + np.log(n)) * self.idf[t]
        told = self.telling[t]
        for part, share in ((told, EMPHASIS), (~told, 1 - EMPHASIS)):
            if part.any():
                w[part] *= np.sqrt((share if told.any() and not told.all() else 1.0) / (w[part] ** 2).sum())
        return t, w

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest positive cosine (equal ones: lowest number
        first), without example ``without``."""
        return next(self.nearest_of([(t, w)], k, [without]))

    def nearest_of(self, vectors: Sequence[Terms], k: int = NEIGHBOURS, without: Sequence[int] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each of the vectors."""
        for a in range(0, len(vectors), TOGETHER):
            some = vectors[a:a + TOGETHER]
            left, rest = np.zeros((len(some), len(self.common))), []
            for n, (t, w) in enumerate(some):
                row = self.row[t]
                held = row >= 0
                left[n, row[held]] = w[held]
                rest.append((t[~held], w[~held]))
            for n, cos in enumerate(left @ self.common):
                yield self._nearest(cos, *rest[n], k, without[a + n] if without else -1)

    def _nearest(self, cos: np.ndarray, t: np.ndarray, w: np.ndarray, k: int, without: int) -> tuple[np.ndarray, np.ndarray]:
        """``nearest`` of a vector, given its cosines by its common terms, and its
        other terms."""
        sizes = self.first[t + 1] - self.first[t]
        found = _ranges(self.first[t], sizes)
        cos += np.bincount(self.who[found], np.repeat(w, sizes) * self.weight[found], len(cos))
        if without >= 0:
            cos[without] = 0
        cos_of = np.round(cos, 9)
        near = np.flatnonzero(cos_of >= np.partition(cos_of, -k)[-k]) if len(cos) > k else np.arange(len(cos))
        best = near[np.argsort(-cos_of[near], kind="stable")[:k]]
        best = best[cos[best] > 0]
        return best, np.minimum(cos[best], 1.0)

    def vote(self, near: np.ndarray, cos: np.ndarray) -> float:
        """Share of toxic examples among the neighbours, weighted by closeness
        and by how many labelled rows each stands for."""
        w = self.weights[near] / (1.05 - cos)
        return float((w * self.labels[near]).sum() / w.sum())

    def score(self, vote: float) -> float:
        xs, ys = zip(*self.curve)
        return float(np.interp(vote, xs, ys))


def _monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[tuple[float, float]]:
    """Points of a rising curve through the votes' toxic shares: means over
    bins, neighbours pooled where they would fall."""
    bins = np.minimum((x * CURVE_BINS).astype(int), CURVE_BINS - 1)
    pools: list[list[float]] = []  # weight, weighted x, weighted y
    for b in np.unique(bins):
        m = bins == b
        pools.append([w[m].sum(), (w[m] * x[m]).sum(), (w[m] * y[m]).sum()])
        while len(pools) > 1 and pools[-2][2] / pools[-2][0] >= pools[-1][2] / pools[-1][0]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    return [(px / n, py / n) for n, px, py in pools]


def text_terms(text: str | None) -> list[bytes]:
    """The words of a text and the beginnings of the longer ones."""
    words = bag_of_words(text)
    return words + [w[:BEGINNING] + b"*" for w in words if len(w) > BEGINNING]


def _words(rows: DataFrame) -> DataFrame:
    """``id, label, word, n, context`` of each text's terms; the context is a
    hash of the words around the first occurrence."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        terms, who, label, n, context = [], [], [], [], []
        for i, y, text in zip(*(c.to_pylist() for c in b.columns)):
            words = bag_of_words(text)
            around = {}
            for k in range(len(words) - 1, -1, -1):
                near = xxhash.xxh3_64_intdigest(b" ".join(words[max(k - 1, 0):k] + words[k + 1:k + 2])) >> 1
                around[words[k]] = near
                if len(words[k]) > BEGINNING:
                    around[words[k][:BEGINNING] + b"*"] = near
            found = Counter(text_terms(text))
            terms.extend(w.decode("latin-1") for w in found)
            n.extend(found.values())
            context.extend(around[w] for w in found)
            who.extend([i] * len(found))
            label.extend([y] * len(found))
        return pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(label, pa.int32()), pa.array(terms, pa.string()), pa.array(n, pa.int32()), pa.array(context, pa.int64())], ["id", "label", "word", "n", "context"])

    return over_batches(rows, run, "id long, label int, word string, n int, context long")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> Index | None:
    """Build the index from the labelled documents given (the caller leaves out
    what is held out). Null labels and ids are left out; a document with several
    labels counts as toxic if any says so. None if a class has no example.

    At most about ``per_class`` documents of each class are drawn; weights make
    up for the share drawn.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null").groupBy("id").agg(F.max(F.when(F.col("label") > 0, 1).otherwise(0)).alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    if len(sizes) < 2:
        return None
    share = {k: min(1.0, per_class / n) for k, n in sizes.items()}
    drawn = known.where(unit_hash("id") < F.when(F.col("label") == 1, share[1]).otherwise(share[0]))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(drawn), "id").select("id", "label", "text")  # bounded: about 2 * per_class rows
    found = stored(_words(rows), "toxicity-words")
    totals = {r["label"]: r["n"] for r in found.groupBy("label").agg(F.countDistinct("id").alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    if not pos or not neg:
        return None
    # copies of one text are one place of its words: what counts is different surroundings
    places = found.select("word", "label", "context").distinct()
    per_word = places.groupBy("word").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q"))
    p, q, total = F.col("p"), F.col("q"), pos + neg

    def part(n, of) -> Column:
        return F.when(n > 0, n * F.log(n * float(total) / of)).otherwise(0.0)

    here, away = (p + q).cast("double"), (total - p - q).cast("double")
    ratio = part(p, here * pos) + part(q, here * neg) + part(pos - p, away * pos) + part(neg - q, away * neg)
    tested = per_word.where(p + q >= MIN_EXAMPLES)
    least = float(np.log(max(tested.count(), 1))) + MARGIN
    telling = {r["word"] for r in tested.where((p * neg > q * pos) & (ratio >= least)).select("word").collect()}
    # the drawn examples' terms: what the index is made of
    rows = found.groupBy("id", "label", "word").agg(F.max("n").alias("n")).orderBy("id", "word").toArrow()
    words = rows.column("word").combine_chunks().dictionary_encode()
    terms = words.dictionary.to_pylist()
    n_docs, df = _frequencies(docs.select(F.col(text_col).cast("string").alias("text")), terms)
    who, n, label = (rows.column(c).to_numpy() for c in ("id", "n", "label"))
    starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
    term = words.indices.to_numpy().astype(np.int64)
    cut = list(zip(starts.tolist(), [*starts[1:].tolist(), len(who)]))
    vectors = {int(who[a]): (term[a:b], n[a:b]) for a, b in cut}
    label_of = {int(who[a]): int(label[a]) for a, _ in cut}
    return _build(terms, np.log((n_docs + 1) / (df + 1)) + 1, vectors, label_of, {k: 1 / s for k, s in share.items()}, np.array([t in telling for t in terms], dtype=bool))


def _frequencies(texts: DataFrame, terms: list[str]) -> tuple[int, np.ndarray]:
    """Number of all texts, and of those that hold each of the index's terms:
    one row a task and term is shuffled, one a term reaches the driver."""
    shared = texts.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, docs = Numbers(shared.value), 0
        sums = np.zeros(len(numbers.number), dtype=np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                docs += 1
                sums[np.unique(numbers.of(text))] += 1
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, held], pa.int64()), pa.array(np.r_[docs, sums[held]], pa.int64())], ["term", "n"])

    df, total = np.zeros(len(terms)), 0
    out = texts.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    for t, n in zip(out.column("term").to_pylist(), out.column("n").to_pylist()):
        if t < 0:
            total = n
        else:
            df[t] = n
    return total, df


def _build(terms: list[str], idf: np.ndarray, vectors: dict[int, Terms], label_of: dict[int, int], weight: dict[int, float], telling: np.ndarray | None = None) -> Index:
    """The index over all examples that hold a term, like ones side by side; then
    its curve, from the postings of all terms, and the matrix of the common ones."""
    telling = np.zeros(len(terms), dtype=bool) if telling is None else telling
    rank = np.argsort(np.argsort(idf, kind="stable"))

    def likeness(i: int) -> tuple:
        t = vectors[i][0]
        return sorted(t[telling[t]].tolist()), np.sort(rank[t])[:4].tolist(), i

    order = sorted(vectors, key=likeness)
    index = Index(terms, idf, telling, np.array(order, dtype=np.int64), np.array([label_of[i] for i in order], dtype=float), np.array([weight[label_of[i]] for i in order]))
    sparse = [index.vector(vectors[i]) for i in order]
    term, x = (np.concatenate(c) for c in zip(*sparse))
    who = np.repeat(np.arange(len(order)), [len(t) for t, _ in sparse])
    by_term = np.argsort(term, kind="stable")  # examples stay in order
    term, index.who, index.weight = term[by_term], who[by_term], x[by_term]
    index.row, index.common = np.full(len(terms), -1, dtype=np.int64), np.zeros((0, len(order)))
    index.first = np.searchsorted(term, np.arange(len(terms) + 1))
    votes, has = np.zeros(len(order)), np.zeros(len(order), dtype=bool)
    for n, (near, cos) in enumerate(index.nearest_of(sparse, without=range(len(order)))):
        has[n] = len(near) > 0
        if has[n]:
            votes[n] = index.vote(near, cos)
    index.curve = _monotone(votes[has], index.labels[has], index.weights[has]) if has.any() else [(0.0, 0.0), (1.0, 1.0)]
    index.empty_score = float((index.weights * index.labels).sum() / index.weights.sum())
    held = np.bincount(term, minlength=len(terms))
    common = np.argsort(-held, kind="stable")[:COMMON]
    common = common[held[common] * SHARE_COMMON > len(order)]
    index.row[common] = np.arange(len(common))
    index.common = np.zeros((len(common), len(order)))
    row = index.row[term]
    index.common[row[row >= 0], index.who[row >= 0]] = index.weight[row >= 0]
    index.who, index.weight = index.who[row < 0], index.weight[row < 0]
    index.first = np.searchsorted(term[row < 0], np.arange(len(terms) + 1))
    return index


def score(docs: DataFrame, index: Index | None, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted, near_ids, near_cosines`` for every row.

    Texts without any of the index's words (null and empty ones too) have no
    neighbours and score as the share of toxic examples; without an index all
    score 0. Equal cosines go to the example first in the index. Repeated rows
    repeat, other columns are not read, texts are read whole; no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: Index | None = shared.value
        terms = Numbers(ix.terms if ix else [])
        nothing = (ix.empty_score if ix else 0.0, [], [])
        known: dict[bytes, tuple[float, list, list]] = {}
        for b in batches:
            out, texts = [], b.column(1).to_pylist()
            for a in range(0, len(texts), TOGETHER):
                if len(known) >= COPY_TABLE:
                    known.clear()
                digests, fresh = [xxhash.xxh3_128_digest(utf8(text)) for text in texts[a:a + TOGETHER]], {}
                for text, digest in zip(texts[a:], digests):
                    if digest not in known:
                        known[digest] = nothing
                        numbers = terms.of(text)
                        if len(numbers):
                            fresh[digest] = ix.vector(counted(numbers))
                for digest, (near, cos) in zip(fresh, ix.nearest_of(list(fresh.values())) if ix else ()):
                    if len(near):
                        known[digest] = (ix.score(ix.vote(near, cos)), ix.ids[near].tolist(), cos.tolist())
                out += map(known.__getitem__, digests)
            scores = [x[0] for x in out]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= cut) for s in scores], pa.int32()), pa.array([x[1] for x in out], pa.list_(pa.int64())), pa.array([x[2] for x in out], pa.list_(pa.float64()))], ["doc_id", "score", "predicted", "near_ids", "near_cosines"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int, near_ids array<long>, near_cosines array<double>")
