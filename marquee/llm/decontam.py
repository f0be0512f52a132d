"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into overlapping windows of words, as TF-IDF vectors over the
benchmark's vocabulary. A randomised SVD of corpus and benchmark passages,
computed on Spark, gives a latent space; windows whose cosine with a benchmark
passage is high are candidates. Around each candidate the longest common
subsequence of words with the item is measured: nearly whole items are leaks, and
paraphrases (most words in order) are if the item's answer, or without one its
rarest words, stand there too. Before that, the weighted share of the words of
the item's own window (or of the whole item) in the text's window and its
neighbours weeds out candidates that are close in the latent space alone.

The benchmark is taken in blocks of items; only a block's vocabulary, latent
vectors and items are sent to the tasks. Document frequencies, the latent space
and the search cover every text, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import bag_of_words, over_batches, spread, stored

#: Words of the items of one block, in expectation (a longer item is a block of
#: its own size).
BLOCK_WORDS = 40_000
#: Words per half window; a window is two halves, windows begin at every half.
#: Shorter items are looked for in windows of shorter halves, the longest that
#: are no longer than the item, so that the text around it does not dilute it.
HALF = 24
HALVES = (6, 12, HALF)
RANK, OVERSAMPLE = 128, 16
#: Least cosine of a candidate in the latent space, and the least weighted share
#: of the words of an item, or of its window that matched, that the text's window
#: and its neighbours must hold.
MIN_COSINE, MIN_OVERLAP = 0.35, 0.55
#: Least share of an item's words in common, in order, for a paraphrase and for
#: a leak without further checks.
MIN_COMMON, VERBATIM = 0.6, 0.85
#: Share of an item's words that count as its rarest, and how many of those a
#: paraphrase must hold.
RAREST, RAREST_FOUND = 0.3, 0.6
#: Occurrences, windows, and occurrences of one sum, worked on at once.
SLICE, TOGETHER, SUMMED = 10_000, 4_096, 256
#: Occurrences of the texts joined at once, in expectation (a longer text alone).
JOINED = 1 << 16
#: Words up to which a task sums the products of all pairs of words in a table, and
#: rows of it that are multiplied at once.
DENSE, STRIP = 4_096, 256
#: Texts of a batch that are made Python strings at once.
READ = 512
#: Slots up to which a table of shares has one for each group and word.
DIRECT = 1 << 21
#: A large odd number, whose products with keys spread over the slots of a table.
ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Item:
    item_id: int
    words: list[int]
    answer: list[int]


@dataclass
class Shares:
    """What share of the weight of a group of words each of its words has."""

    size: int
    keys: np.ndarray  # group number times words, plus word; last -1, which is none
    shares: np.ndarray  # of each key, or of each slot if direct
    slots: np.ndarray  # number of the key in each slot; a key is in the first slot that was free from its own on
    direct: bool  # whether each possible key has a slot

    @staticmethod
    def of(groups: list[np.ndarray], idf: np.ndarray) -> Shares:
        kinds = [np.unique(g) for g in groups]
        keys = np.concatenate([n * len(idf) + k for n, k in enumerate(kinds)])
        shares = np.concatenate([*(idf[k] / idf[k].sum() for k in kinds), [0.0]])
        if len(groups) * len(idf) <= DIRECT:
            table = np.zeros(len(groups) * len(idf))
            table[keys] = shares[:-1]
            return Shares(len(idf), keys, table, np.zeros(0, dtype=np.int32), True)
        slots = np.full(1 << (8 * len(keys)).bit_length(), len(keys), dtype=np.int32)
        out = Shares(len(idf), np.r_[keys, -1], shares, slots, False)
        left, slot = np.arange(len(keys)), out._slot(keys)
        while len(left):
            free = slots[slot] == len(keys)
            slots[slot[free]] = left[free]
            again = slots[slot] != left
            left, slot = left[again], (slot[again] + 1) % len(slots)
        return out

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * ODD) >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def share(self, group: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Share of each word in its group's weight, 0 for words it lacks."""
        key = group.astype(np.int64, copy=False) * self.size + word
        if self.direct:
            return self.shares[key]
        slot = self._slot(key)
        at = self.slots[slot]
        other = np.flatnonzero((self.keys[at] != key) & (at < len(self.keys) - 1))
        while len(other):  # another key's slot: the next one
            slot[other] = (slot[other] + 1) % len(self.slots)
            at[other] = self.slots[slot[other]]
            other = other[(self.keys[at[other]] != key[other]) & (at[other] < len(self.keys) - 1)]
        return self.shares[at]


@dataclass
class Scale:
    """The windows of the items that are looked for with one length of windows."""

    half: int
    queries: np.ndarray  # unit latent vectors of the items' windows
    owner: np.ndarray  # item number of each
    of_windows: Shares  # in the order of queries
    part: np.ndarray  # whether each window is less than its whole item


@dataclass
class Space:
    """``latent[t]``: weight times latent vector of word t."""

    items: list[Item]
    idf: np.ndarray
    latent: np.ndarray
    of_items: Shares
    scales: list[Scale]  # by half


def _tokens(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """``doc_id, pos, ids``: places and numbers of the vocabulary's words in
    each text that has any (32-bit, packed)."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        get, pos, ids = shared.value.get, [], []
        for a in range(0, b.num_rows, READ):
            for text in b.column(1).slice(a, READ).to_pylist():
                all_ids = np.array([get(w, -1) for w in bag_of_words(text)], dtype=np.int32)
                at = np.flatnonzero(all_ids >= 0).astype(np.int32)
                pos.append(at.tobytes())
                ids.append(all_ids[at].tobytes())
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(pos, pa.binary()), pa.array(ids, pa.binary())], ["doc_id", "pos", "ids"])

    return over_batches(docs, run, "doc_id long, pos binary, ids binary").where(F.length("ids") > 0)


def _ints(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype=np.int32) for x in column]


def _vector_sums(rows: DataFrame) -> dict[int, np.ndarray]:
    """Sum of the vectors (``v``, packed 64-bit floats) of each ``key``, added
    up on Spark; one row per key reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1)):
                x = np.frombuffer(v.as_buffer(), dtype=np.float64)
                sums[k] = sums[k] + x if k in sums else x
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["key", "v"])

    total = rows.repartition("key").mapInArrow(run, "key int, v binary")
    return {r["key"]: np.frombuffer(r["v"], dtype=np.float64) for r in total.toLocalIterator()}


def _joined(pos: list[np.ndarray], ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Several texts as one: places, words, and where each text begins. Texts
    begin at whole windows, with at least a half window between them."""
    lengths = [(int(p[-1]) // (2 * HALF) + 2) * 2 * HALF for p in pos]
    begin = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return np.concatenate([p + b for p, b in zip(pos, begin.tolist())]), np.concatenate(ids), begin


def _some_texts(pos: list[np.ndarray], ids: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray], list[np.ndarray]]]:
    """The texts in runs of about ``JOINED`` words: number of the first one, places
    and words. So a task's memory grows with no batch's size."""
    a, words = 0, 0
    for b, x in enumerate(ids, 1):
        words += len(x)
        if words >= JOINED or b == len(ids):
            yield a, pos[a:b], ids[a:b]
            a, words = b, 0


def _starts(groups: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])


def _half_sums(pos: np.ndarray, ids: np.ndarray, vectors: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The half windows of ``length`` words that hold words, and the sums of
    their words' vectors, as products of small 0-1 matrices with the words'
    vectors."""
    half = pos // length
    starts = _starts(half)
    ends = np.r_[starts[1:], len(pos)]
    number = np.repeat(np.arange(len(starts)), ends - starts)
    out = np.empty((len(starts), vectors.shape[1]), dtype=vectors.dtype)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + SUMMED)))
        p, q = starts[a], ends[b - 1]
        member = np.zeros((b - a, q - p), dtype=vectors.dtype)
        member[number[p:q] - a, np.arange(q - p)] = 1
        out[a:b] = member @ vectors[ids[p:q]]
        a = b
    return half[starts], out


def _doubled(halves: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for half windows of twice the length."""
    starts = _starts(halves // 2)
    return halves[starts] // 2, np.add.reduceat(sums, starts, axis=0)


def _windows(halves: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Each half window plus the next one, where there is one."""
    out = sums.copy()
    if len(halves) > 1:
        near = np.flatnonzero(halves[1:] == halves[:-1] + 1)
        out[near] += sums[near + 1]
    return out


def _document_counts(tokens: DataFrame, size: int) -> np.ndarray:
    """In how many rows each word occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, dtype=np.int64)
        for b in batches:
            for ids in _ints(b.column(0)):
                sums[np.unique(ids)] += 1
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at])], ["key", "n"])

    out = np.zeros(size)
    for r in tokens.select("ids").mapInArrow(run, "key int, n long").groupBy("key").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["key"]] = r["n"]
    return out


def _passages(pos: np.ndarray, ids: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Separate passages of two half windows: where each begins, and each
    word's weight, scaled so that a passage has unit length."""
    starts = _starts(pos // (2 * HALF))
    w = idf[ids]
    norm = np.sqrt(np.add.reduceat(w * w, starts))
    return starts, w / np.maximum(np.repeat(norm, np.diff(np.r_[starts, len(pos)])), 1e-9)


def _gram_times(pos: np.ndarray, ids: np.ndarray, idf: np.ndarray, right: np.ndarray, out: np.ndarray) -> int:
    """Add A'A ``right`` to ``out`` for the passages A of some texts; how many."""
    starts, w = _passages(pos, ids, idf)
    ends, a = np.r_[starts[1:], len(pos)], 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + SLICE)))
        p, q = starts[a], ends[b - 1]
        y = np.add.reduceat(w[p:q, None] * right[ids[p:q]], starts[a:b] - p, axis=0)
        back = w[p:q, None] * np.repeat(y, ends[a:b] - starts[a:b], axis=0)
        order = np.argsort(ids[p:q], kind="stable")
        words = ids[p:q][order]
        first = _starts(words)
        out[words[first]] += np.add.reduceat(back[order], first, axis=0)
        a = b
    return len(starts)


def _rows_from(size: int) -> np.ndarray:
    """Where row i of a table of pairs i <= j, row after row, would have its word 0:
    pair i, j is at ``_rows_from(size)[i] + j`` of ``size * (size + 1) // 2``."""
    i = np.arange(size, dtype=np.int64)
    return i * size - i * (i + 1) // 2


def _add_pairs(pos: np.ndarray, ids: np.ndarray, idf: np.ndarray, out: np.ndarray) -> int:
    """Add to ``out``, at pair i <= j, the products of the weights of each two places
    of a passage, words i and j there, once, of each place with itself half: ``out``
    plus its transpose is A'A for the passages A. ``out`` is a square or the rows of its
    upper triangle, one after another. How many passages."""
    rows, flat = np.arange(len(idf)) * len(idf) if out.ndim == 2 else _rows_from(len(idf)), out.reshape(-1)
    idf = idf.astype(np.float64)  # an unpickled dtype, equal but not the same, makes add.at slow
    starts, w = _passages(pos, ids, idf)
    ends, a = np.r_[starts[1:], len(pos)], 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + SLICE)))
        low, high = starts[a], ends[b - 1]
        end = np.repeat(ends[a:b], ends[a:b] - starts[a:b]) - low
        order = np.argsort(end * len(idf) + ids[low:high])  # each passage's words in order, so that i <= j
        word, weight = ids[low:high][order].astype(np.int64), w[low:high][order]
        at = np.arange(high - low)
        n = end - at  # a place meets itself and those after it
        own = np.cumsum(n) - n
        other = np.arange(n.sum()) - np.repeat(own - at, n)
        product = np.repeat(weight, n) * weight[other]
        product[own] /= 2
        np.add.at(flat, np.repeat(rows[word], n) + word[other], product)
        a = b
    return len(starts)


def _pairs_times(pairs: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The sums of ``_add_pairs`` and their transpose, times ``right``: some rows of
    the triangle at once."""
    size, rows, out = len(right), _rows_from(len(right)), np.zeros_like(right)
    for a in range(0, size, STRIP):
        b = min(size, a + STRIP)
        strip = np.zeros((b - a, size - a))
        for i in range(a, b):
            strip[i - a, i - a:] = pairs[rows[i] + i:rows[i] + size]
        out[a:b] += strip @ right[a:]
        out[a:] += strip.T @ right[a:b]
    return out


def _fit(tokens: DataFrame, items: list[Item], idf: np.ndarray) -> np.ndarray:
    """Right singular vectors of the passages of all documents and of all items,
    both groups with equal weight."""
    size, width = len(idf), min(len(idf), RANK + OVERSAMPLE)
    sc = tokens.sparkSession.sparkContext
    own_pos, own_ids, _ = _joined([np.arange(len(i.words)) for i in items], [np.array(i.words) for i in items])

    def gram(right: np.ndarray) -> np.ndarray:
        shared = sc.broadcast((right, idf))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            right, weight = shared.value
            sums, rows = np.zeros(size * (size + 1) // 2 if size <= DENSE else right.shape), 0
            for b in batches:
                for _, pos, ids in _some_texts(_ints(b.column(0)), _ints(b.column(1))):
                    pos, ids, _ = _joined(pos, ids)
                    rows += _add_pairs(pos, ids, weight, sums) if size <= DENSE else _gram_times(pos, ids, weight, right, sums)
            if size <= DENSE:
                sums = _pairs_times(sums, right)
            at = np.flatnonzero(sums.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int32()), pa.array([np.array([rows], dtype=np.float64).tobytes(), *(x.tobytes() for x in sums[at])], pa.binary())], ["key", "v"])

        sums = _vector_sums(tokens.select("pos", "ids").mapInArrow(run, "key int, v binary"))
        rows = float(sums.pop(-1, np.zeros(1))[0])
        corpus = np.zeros((size, right.shape[1]))
        for k, v in sums.items():
            corpus[k] = v
        mine = np.zeros_like(corpus)
        passages = _gram_times(own_pos, own_ids, idf, right, mine)
        return corpus / max(rows, 1.0) + mine / passages

    basis, _ = np.linalg.qr(gram(np.random.default_rng(11).standard_normal((size, width))))
    small = basis.T @ gram(basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-values)[:RANK]
    return basis @ vectors[:, best[values[best] > 1e-12]]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def common_length(item: list[int], words: list[int]) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for w in words:
        u = v & masks.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def _holds(words: list[int], part: list[int]) -> bool:
    return any(words[i:i + len(part)] == part for i in range(len(words) - len(part) + 1))


def _judge(item: Item, idf: np.ndarray, pos: np.ndarray, ids: np.ndarray, known: float = 0.0) -> tuple[float, bool]:
    """Share of the item's words in common with a place (the vocabulary's words
    there and where they stand), and whether it is a leak; a share that cannot
    be more than ``known`` is not worked out."""
    words = ids.tolist()
    here = set(words)
    bound = sum(w in here for w in item.words) / len(item.words)
    if bound < MIN_COMMON or bound <= known:  # no subsequence can be longer
        return bound, False
    share = common_length(item.words, words) / len(item.words)
    if share >= VERBATIM or share < MIN_COMMON:
        return share, share >= VERBATIM
    if item.answer:
        near = np.full(int(pos[-1] - pos[0]) + 1, -1)
        near[pos - pos[0]] = ids
        return share, _holds(near.tolist(), item.answer)
    kinds = sorted(set(item.words), key=lambda w: (-idf[w], w))
    rare = kinds[:max(1, round(RAREST * len(kinds)))]
    return share, len(here.intersection(rare)) >= RAREST_FOUND * len(rare)


def _candidates(space: Space, pos: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """First place of a window, item number and cosine, for all windows that
    are close to an item and hold enough of its words, or of those of the item's
    window."""
    length = space.scales[0].half
    halves, sums = _half_sums(pos, ids, space.latent, length)
    for scale in space.scales:
        while length < scale.half:
            length, (halves, sums) = 2 * length, _doubled(halves, sums)
        yield from _close(space, scale, pos, ids, halves, sums)


def _held(shares: Shares, group: np.ndarray, ids: np.ndarray, p: np.ndarray, r: np.ndarray) -> np.ndarray:
    """What share of its group's weight each place (words p to r) holds."""
    size = r - p
    begin = np.cumsum(size) - size
    at = np.arange(size.sum()) - np.repeat(begin - p, size)
    return np.add.reduceat(shares.share(np.repeat(group, size), ids[at]), begin)


def _close(space: Space, scale: Scale, pos: np.ndarray, ids: np.ndarray, halves: np.ndarray, sums: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """The candidates of one scale."""
    for a in range(0, len(halves), TOGETHER):
        b = min(len(halves), a + TOGETHER)
        cos = _unit(_windows(halves[a:b + 1], sums[a:b + 1])[:b - a]) @ scale.queries.T
        w, q = np.nonzero(cos >= MIN_COSINE)
        low, high = np.searchsorted(pos, halves[a:b] * scale.half - HALF), np.searchsorted(pos, halves[a:b] * scale.half + 2 * scale.half + HALF)
        for k in range(0, len(w), TOGETHER):
            first, item, near = halves[a + w[k:k + TOGETHER]] * scale.half, scale.owner[q[k:k + TOGETHER]], cos[w[k:k + TOGETHER], q[k:k + TOGETHER]]
            p, r = low[w[k:k + TOGETHER]], high[w[k:k + TOGETHER]]
            held = _held(scale.of_windows, q[k:k + TOGETHER], ids, p, r)
            part = np.flatnonzero(scale.part[q[k:k + TOGETHER]])
            if len(part):
                held[part] = np.maximum(held[part], _held(space.of_items, item[part], ids, p[part], r[part]))
            for n in np.flatnonzero(held >= MIN_OVERLAP):
                yield int(first[n]), int(item[n]), float(near[n])


def _search_texts(space: Space, pos: list[np.ndarray], ids: list[np.ndarray]) -> list[tuple[int, int, float, float, int]]:
    """Leaks in some texts: text number, item id, cosine and share in common of
    the best window, and its first word."""
    place, words, begin = _joined(pos, ids)
    found: dict[tuple[int, int], tuple[float, float, int]] = {}
    for first, n, cos in sorted(_candidates(space, place, words), key=lambda c: -c[2]):
        item, text = space.items[n], int(np.searchsorted(begin, first, "right")) - 1
        low, high = max(first - len(item.words), int(begin[text])), min(first + 2 * HALF + len(item.words), int(begin[text + 1]))
        p, r = np.searchsorted(place, [low, high])
        share, leak = _judge(item, space.idf, place[p:r], words[p:r], found.get((text, n), (0.0, 0.0, 0))[0])
        if leak and share > found.get((text, n), (0.0, 0.0, 0))[0]:  # equal shares: the first has the largest cosine
            found[text, n] = (share, cos, first - int(begin[text]))
    return [(text, space.items[n].item_id, min(c, 1.0), s, f) for (text, n), (s, c, f) in sorted(found.items())]


def _scales(items: list[Item], idf: np.ndarray, latent: np.ndarray) -> list[Scale]:
    """The items' windows, by the half that fits each item."""
    out = []
    fits = [max([h for h in HALVES if h <= len(i.words)], default=HALVES[0]) for i in items]
    for half in sorted(set(fits)):
        queries, owner, windows, part = [], [], [], []
        for n, i in enumerate(items):
            if fits[n] == half:
                halves, sums = _half_sums(np.arange(len(i.words)), np.array(i.words), latent, half)
                w = _windows(halves, sums)
                w = w[:max(1, len(w) - 1)]  # the last half alone is in the window before it
                queries.append(w)
                owner += [n] * len(w)
                part += [2 * half < len(i.words)] * len(w)
                windows += [np.array(i.words[h * half:(h + 2) * half]) for h in halves[:len(w)]]
        out.append(Scale(half, _unit(np.concatenate(queries)), np.array(owner), Shares.of(windows, idf), np.array(part)))
    return out


def _search(tokens: DataFrame, space: Space) -> DataFrame:
    shared = tokens.sparkSession.sparkContext.broadcast(space)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        docs = b.column(0).to_pylist()
        rows = [(docs[a + n], *hit) for a, pos, ids in _some_texts(_ints(b.column(1)), _ints(b.column(2))) for n, *hit in _search_texts(shared.value, pos, ids)]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["doc_id", "item_id", "cosine", "common", "first_word"])

    return over_batches(spread(tokens), run, LEAK)


LEAK = "doc_id long, item_id long, cosine double, common double, first_word long"


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """``doc_id, item_id, cosine, common, first_word``: the benchmark items found
    in each text, once each, with the best window's cosine and place and the
    share of the item's words found there in order.

    Words are compared in lower case and without ASCII punctuation. Items and
    texts without words are in nothing; rows with a null id are searched and
    reported under null; repeated rows are reported again; repeated items count
    once per distinct row. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    bench = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"), answer.alias("answer")).distinct()
    words = F.size(F.split(F.concat_ws(" ", "text", "answer"), r"\s+"))
    n_words, n_docs = bench.agg(F.sum(words)).first()[0] or 0, docs.count()
    blocks = -(-n_words // BLOCK_WORDS)
    out = spark.createDataFrame([], T.StructType([T.StructField(c, k) for c, k in (("doc_id", T.LongType()), ("item_id", T.LongType()), ("cosine", T.DoubleType()), ("common", T.DoubleType()), ("first_word", T.LongType()))]))
    for block in range(blocks):
        rows = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()  # about BLOCK_WORDS words
        number: dict[bytes, int] = {}

        def ids(text: str | None) -> list[int]:
            return [number.setdefault(w, len(number)) for w in bag_of_words(text)]

        items = [Item(r["item_id"], ids(r["text"]), ids(r["answer"])) for r in sorted(rows, key=lambda r: (r["item_id"] or 0, r["text"] or ""))]
        items = [i for i in items if i.words]
        if not items:
            continue
        tokens = stored(_tokens(docs, number), "decontam-tokens")
        idf = np.log((n_docs + 1) / (_document_counts(tokens, len(number)) + 1)) + 1e-3
        latent = (idf[:, None] * _fit(tokens, items, idf)).astype(np.float32)
        out = out.unionAll(_search(tokens, Space(items, idf, latent, Shares.of([np.array(i.words) for i in items], idf), _scales(items, idf, latent))))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **names: str) -> DataFrame:
    """The rows of ``docs`` whose id no leak is reported for, all their columns."""
    found = leaks(docs, benchmark, id_col, **names).select(F.col("doc_id").alias("__leaked")).distinct()
    return docs.join(found, docs[id_col].cast("long").eqNullSafe(F.col("__leaked")), "left_anti")
