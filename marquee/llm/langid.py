"""Language identification by segmentation-marginalised unigrams.

A fixed public vocabulary of pieces is given; for each language the model holds
one probability per piece. A word's likelihood is the sum over all ways to cut
it into pieces of the product of their probabilities, found by a forward pass;
a text's is the product over its words. The prediction is the language with the
largest posterior.

The probabilities come from expected piece counts (forward and backward passes)
over the word counts of the training rows, starting from equal probabilities.
Counting and the passes run on Spark; what reaches the driver is one number for
each language and piece of the fixed vocabulary.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import over_batches, spread, stored, uncollected, unit_hash

UND = "und"
START = "▁"  # the vocabulary's mark for the start of a word
LETTERS = re.compile(r"[^\W\d_]+")
#: Share of a piece's probability that does not depend on the language, and the
#: probability of a character outside the vocabulary.
SHARED, UNKNOWN = 0.02, 1e-7
WORD_TABLE = 350_000
#: Characters of texts whose new words are learned together; letters of a word up
#: to which no product of probabilities gets too small for a double; likelihoods
#: at the places of words whose passes are made at once.
TOGETHER, SHORT, PLACES = 1 << 20, 32, 1 << 20
#: More than any code point, and a large odd number, whose products with keys spread
#: over the slots of a table.
CODES, ODD = 0x110000, np.uint64(0x9E3779B97F4A7C15)
#: Share of the labelled rows whose fit may be lower than what counts as usual.
STRAY = 0.01
#: Decimal places to which fits are told apart where their quantiles are taken, and
#: the lowest fit (rows below count as that): so many values are there at most.
FIT_PLACES, FIT_LEAST = 4, -100.0
#: How many times that share's distance from the median a text may lie below it.
#: Texts of the learned languages with words that training lacks lie within four,
#: other languages and random letters beyond twelve.
FAR = 8
SCALE = float(1 << 20)


def pieces_of(path: str) -> list[str]:
    """The vocabulary's text pieces, without control and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


@dataclass
class Model:
    """``probs[i, l]``: probability of piece ``i`` in language ``langs[l]``."""

    langs: list[str]
    pieces: list[str]
    probs: np.ndarray
    prior: np.ndarray

    @cached_property
    def trie(self) -> Trie:
        return Trie(self.pieces)


class Trie:
    """The beginnings of all pieces, in a table by beginning and next character."""

    def __init__(self, pieces: list[str]):
        number = {"": 0}
        for p in pieces:
            for k in range(1, len(p) + 1):
                number.setdefault(p[:k], len(number))
        self.longest = max(map(len, pieces), default=1)
        self.unknown = len(pieces)
        self.piece = np.full(len(number) + 1, -1, dtype=np.int32)  # of each beginning; the last one is none
        self.piece[[number[p] for p in pieces]] = np.arange(len(pieces))
        keys = np.array([number[b[:-1]] * CODES + ord(b[-1]) for b in number if b], dtype=np.int64)
        self.bits = (4 * len(keys) + 1).bit_length()
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.nodes = np.full(1 << self.bits, -1, dtype=np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] < 0
            self.keys[slot[free]], self.nodes[slot[free]] = keys[left[free]], left[free] + 1
            again = self.keys[slot] != keys[left]
            left, slot = left[again], (slot[again] + 1) & (len(self.keys) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * ODD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def next(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The beginnings one character longer; -1 where no piece begins so."""
        key = node * CODES + code
        slot = self._slot(key)
        found = self.keys[slot]
        other = np.flatnonzero((found != key) & (found >= 0))
        while len(other):  # another key's slot: the next one
            slot[other] = (slot[other] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[other]]
            other = other[(found != key[other]) & (found >= 0)]
        return self.nodes[slot].astype(np.int64)

    def arcs(self, words: list[str]) -> Arcs:
        """All pieces within the words, each word with its ``START``; a character
        that is no piece is an arc of its own."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + len(START)
        codes = np.frombuffer("".join([START + w for w in words]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        end = np.cumsum(lengths)
        first, last = (end - lengths)[word], end[word]
        at, node = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64)
        starts, pieces = [], []
        for k in range(self.longest):
            node = self.next(node, codes[at + k])
            piece = self.piece[node]
            if k == 0:
                piece[piece < 0] = self.unknown
            held = piece >= 0
            starts.append(at[held])
            pieces.append(piece[held])
            on = (node >= 0) & (at + k + 1 < last[at])
            at, node = at[on], node[on]
        start, piece = np.concatenate(starts), np.concatenate(pieces)
        size = np.repeat(np.arange(1, len(starts) + 1), [len(x) for x in starts])
        key = (start - first[start] + size) * (self.longest + 1) + size
        order = np.argsort(key.astype(np.uint16) if key.max(initial=0) < 1 << 16 else key, kind="stable")
        start, size, key = start[order], size[order], key[order]
        cuts = [*np.flatnonzero(np.r_[True, key[1:] != key[:-1]]).tolist(), len(key)] if len(key) else [0]
        begin = start + word[start]
        return Arcs(word[start], begin, begin + size, piece[order], cuts, end - lengths + np.arange(len(words)), end + np.arange(len(words)))


@dataclass
class Arcs:
    """Pieces within words, whose places (one more than a word has characters) are
    numbered through: shorter ends first, and between two ``cuts`` all of one end
    and one size, so that no two of them begin or end at the same place."""

    word: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    cuts: list[int]
    first: np.ndarray  # first and last place of each word
    last: np.ndarray

    def ahead(self, p: np.ndarray) -> np.ndarray:
        """Forward pass, with the probabilities of each arc."""
        out = np.zeros((int(self.last[-1]) + 1, *p.shape[1:]))
        out[self.first] = 1.0
        for a, b in zip(self.cuts, self.cuts[1:]):
            out[self.end[a:b]] += out[self.begin[a:b]] * p[a:b]
        return out

    def back(self, p: np.ndarray) -> np.ndarray:
        """Backward pass."""
        out = np.zeros((int(self.last[-1]) + 1, *p.shape[1:]))
        out[self.last] = 1.0
        for a, b in zip(self.cuts[-2::-1], self.cuts[:0:-1]):
            out[self.begin[a:b]] += out[self.end[a:b]] * p[a:b]
        return out


class Scorer:
    """Forward pass over words, with a bounded table of words seen."""

    def __init__(self, model: Model):
        self.model = model
        self.index = {p: i for i, p in enumerate(model.pieces)}
        self.longest = max(map(len, model.pieces), default=1)
        self.probs = np.concatenate([model.probs, np.full((1, len(model.langs)), UNKNOWN)])
        self.unknown = (UNKNOWN,) * len(model.langs)
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.langs)))
        self.old_rows, self.old_table = self.rows, self.table

    @cached_property
    def pieces(self) -> dict[str, tuple | None]:
        """Each piece's probabilities, for long words; None for what only begins pieces."""
        out: dict[str, tuple | None] = {p[:k]: None for p in self.model.pieces for k in range(1, len(p))}
        out.update(zip(self.model.pieces, map(tuple, self.model.probs.tolist()), strict=True))
        return out

    def arcs(self, s: str, i: int) -> Iterator[tuple[int, str | None, tuple]]:
        """Pieces that start at ``i``: end, piece, probabilities. A character
        outside the vocabulary is an arc of its own."""
        known = False
        for j in range(i + 1, len(s) + 1):
            p = self.pieces.get(s[i:j], ())
            if p:
                known = known or j == i + 1
                yield j, s[i:j], p
            elif p is not None:
                break
        if not known:
            yield i + 1, None, self.unknown

    def word_logs(self, word: str) -> list[float]:
        """Log likelihood of a word in each language."""
        s = START + word
        get, nothing, n = self.pieces.get, (), len(s)
        at: list = [None] * (n + 1)
        at[0], off = [1.0] * len(self.model.langs), 0.0
        for i in range(n):
            a = at[i]
            if not i & 7 and max(a) < 1e-120:  # long words: scale what lies ahead
                top = max(a)
                if top <= 0:
                    return [-1e6] * len(a)
                for j in range(i, min(n, i + self.longest) + 1):
                    if at[j] is not None:
                        at[j] = [x / top for x in at[j]]
                off, a = off + math.log(top), at[i]
            j, p = i + 1, get(s[i], nothing)
            b = at[j]
            q = p or self.unknown  # a character outside the vocabulary
            at[j] = [x * y for x, y in zip(a, q)] if b is None else [z + x * y for z, x, y in zip(b, a, q)]
            while (p or p is None) and j < n:
                j += 1
                p = get(s[i:j], nothing)
                if p:
                    b = at[j]
                    at[j] = [x * y for x, y in zip(a, p)] if b is None else [z + x * y for z, x, y in zip(b, a, p)]
            at[i] = None
        return [off + math.log(x) if x > 0 else -1e6 for x in at[n]]

    def words_logs(self, words: list[str]) -> np.ndarray:
        """``word_logs`` of each word, a row a word; the passes of those that are
        not long are made together."""
        out = np.empty((len(words), len(self.model.langs)))
        for n, w in enumerate(words):
            if len(w) > SHORT:
                out[n] = self.word_logs(w)
        for part in _parts(words, PLACES // max(1, len(self.model.langs))):
            arcs = self.model.trie.arcs([words[n] for n in part])
            found = arcs.ahead(self.probs[arcs.piece])[arcs.last]
            out[part] = np.where(found > 0, np.log(np.where(found > 0, found, 1.0)), -1e6)
        return out

    def learn(self, words: set[str]) -> None:
        """Rows of the table for words that have none."""
        if len(self.rows) > WORD_TABLE:  # words in use move over to the new table
            self.old_rows, self.old_table = self.rows, self.table
            self.rows, self.table = {}, np.zeros((WORD_TABLE // 4, len(self.model.langs)))
        new = words.difference(self.rows)
        again = list(new.intersection(self.old_rows)) if self.old_rows is not self.rows else []
        fresh = list(new.difference(again))
        n = len(self.rows)
        while n + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        if again:
            self.table[n:n + len(again)] = self.old_table[[self.old_rows[w] for w in again]]
        if fresh:
            self.table[n + len(again):n + len(new)] = self.words_logs(fresh)
        self.rows.update(zip(again + fresh, range(n, n + len(new))))

    def logs_of(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, int] | None]:
        """For each text its words' log likelihoods (a row a word) and how many
        letters and words it has; None if it has no letters."""
        at = 0
        while at < len(texts):
            cut, size = [], 0
            while at < len(texts) and size < TOGETHER:
                text = texts[at] or ""
                cut.append(LETTERS.findall(text.lower()))
                size, at = size + len(text), at + 1
            self.learn(set().union(*cut))
            get = self.rows.__getitem__
            for words in cut:
                yield (self.table[list(map(get, words))], sum(map(len, words)) + len(words)) if words else None

    def expected(self, word: str, lang: int) -> Iterator[tuple[int, float]]:
        """Expected count of each piece in a word, given its language."""
        s, n = START + word, len(word) + len(START)
        arcs = [[(j, piece, p[lang]) for j, piece, p in self.arcs(s, i)] for i in range(n)]
        ahead, back = [0.0] * (n + 1), [0.0] * (n + 1)
        ahead[0] = back[n] = 1.0
        for i in range(n):
            for j, _, p in arcs[i]:
                ahead[j] += ahead[i] * p
        if ahead[n] <= 0:  # too long for its probability to be a number
            return
        for i in range(n - 1, -1, -1):
            back[i] = sum(p * back[j] for j, _, p in arcs[i])
        for i in range(n):
            for j, piece, p in arcs[i]:
                if piece is not None:
                    yield self.index[piece], ahead[i] * p * back[j] / ahead[n]


    def add_expected(self, words: list[str], lang: np.ndarray, n: np.ndarray, sums: np.ndarray) -> None:
        """Add the expected counts of ``n`` times each word, given its language's
        number, to ``sums`` (piece, language)."""
        for k, w in enumerate(words):
            if len(w) > SHORT:
                for i, x in self.expected(w, lang[k]):
                    sums[i, lang[k]] += n[k] * x
        for part in _parts(words, PLACES // 8):
            arcs, spoken, times = self.model.trie.arcs([words[k] for k in part]), lang[part], n[part]
            p = self.probs[arcs.piece, spoken[arcs.word]]
            ahead, back = arcs.ahead(p), arcs.back(p)
            total = ahead[arcs.last]
            share = np.divide(times, total, out=np.zeros(len(total)), where=total > 0)
            known = np.flatnonzero(arcs.piece < len(sums))
            word, piece = arcs.word[known], arcs.piece[known].astype(np.int64)
            x = ahead[arcs.begin[known]] * p[known] * back[arcs.end[known]] * share[word]
            sums += np.bincount(piece * sums.shape[1] + spoken[word], x, sums.size).reshape(sums.shape)


def _parts(words: list[str], places: int) -> Iterator[list[int]]:
    """The numbers of the words that are not long, some ``places`` characters at once."""
    part, size = [], 0
    for k, w in enumerate(words):
        if len(w) <= SHORT:
            part.append(k)
            size += len(w) + 2
            if size >= places:
                yield part
                part, size = [], 0
    if part:
        yield part


def _word_counts(rows: DataFrame) -> DataFrame:
    """``lang, word, n`` of the rows' texts."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[str, Counter] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            found.setdefault(lang, Counter()).update(LETTERS.findall((text or "").lower()))
        langs = pa.array([lang for lang, words in found.items() for _ in range(len(words))], pa.string())
        words = pa.array([w for words in found.values() for w in words], pa.string())
        return pa.RecordBatch.from_arrays([langs, words, pa.array([n for words in found.values() for n in words.values()], pa.int64())], ["lang", "word", "n"])

    return over_batches(rows, run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _expected_counts(words: DataFrame, model: Model) -> np.ndarray:
    """Expected count of each piece in each language, summed over all words."""
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        lang_no = {lang: i for i, lang in enumerate(scorer.model.langs)}
        sums = np.zeros(scorer.model.probs.shape)
        for b in batches:
            if b.num_rows:
                lang = np.array([lang_no[x] for x in b.column(0).to_pylist()], dtype=np.int64)
                scorer.add_expected(b.column(1).to_pylist(), lang, b.column(2).to_numpy().astype(np.float64), sums)
        piece, lang = np.nonzero(sums)
        whole = np.rint(sums[piece, lang] * SCALE).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(whole)], ["piece", "lang", "n"])

    out = np.zeros_like(model.probs)
    total = words.mapInArrow(run, "piece int, lang int, n long").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
    for r in total.toLocalIterator():  # at most one row per piece of the fixed vocabulary and language
        out[r["piece"], r["lang"]] = r["n"] / SCALE
    return out


def train(rows: DataFrame, vocabulary: str, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", per_lang: int | None = None, rounds: int = 2) -> Model:
    """Learn a model from the rows whose language is not null.

    ``vocabulary`` is a sentencepiece model file whose pieces are used as they
    are. All rows are learned from, or with ``per_lang`` at most about that many
    documents of each language, drawn by a hash of the id, so that the draw does
    not depend on the layout. Without any labelled row the model knows no language.
    """
    pieces = pieces_of(vocabulary)
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id")).where(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    langs = sorted(sizes)
    if not langs:
        return Model([], pieces, np.zeros((len(pieces), 0)), np.zeros(0))
    if per_lang is not None:
        share = F.element_at(F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, per_lang / sizes[k])))]), F.col("lang"))
        rows = rows.where(unit_hash("id") < share)
    words = spread(stored(_word_counts(rows.select("lang", "text")), "langid-words"))
    model = Model(langs, pieces, np.full((len(pieces), len(langs)), 1.0 / len(pieces)), np.ones(len(langs)) / len(langs))
    for _ in range(rounds):
        counts = _expected_counts(words, model)
        own = counts / np.maximum(counts.sum(axis=0), 1.0)
        both = (own.mean(axis=1, keepdims=True) + 1.0 / len(pieces)) / 2
        model.probs = (1 - SHARED) * own + SHARED * both
    return model


def judged(scorer: Scorer, texts: list[str | None]) -> Iterator[tuple[str, float, float]]:
    """For each text the language with the largest posterior, that posterior, and
    its fit: the mean log likelihood of its letters, each word in the language
    that fits it best (so a text of several learned languages fits well). Without
    letters ``und``, 0 and minus infinity."""
    langs = scorer.model.langs
    for found in scorer.logs_of(texts) if langs else (None for _ in texts):
        if found is None:
            yield UND, 0.0, -math.inf
            continue
        logs, letters = found[0].sum(axis=0), found[1]
        k = int(logs.argmax())
        yield langs[k], float(1.0 / np.exp(logs - logs[k]).sum()), float(found[0].max(axis=1).sum() / letters)


def best_language(scorer: Scorer, text: str | None) -> tuple[str, float]:
    """The language of one text, and its posterior."""
    lang, posterior, _ = next(judged(scorer, [text]))
    return lang, posterior


def fit(scorer: Scorer, text: str | None) -> float:
    """The fit of one text."""
    return next(judged(scorer, [text]))[2]


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row.

    ``score`` is the posterior of the predicted language with equal priors.
    Null and empty texts, and texts without a letter, are ``und`` with score 0,
    as is every text if the model knows no language. Equal posteriors take the
    first language by name. Repeated rows repeat; no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            with uncollected():
                found = list(judged(scorer, b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _, _ in found], pa.string()), pa.array([y for _, y, _ in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def judgement(model: Model, text: Column) -> Column:
    """``posterior`` and ``fit`` of a text (see :func:`judged`), as a struct."""
    scorers: dict[int, Scorer] = {}

    @F.pandas_udf("posterior double, fit double")
    def told(texts: pd.Series) -> pd.DataFrame:
        scorer = scorers.get(0) or scorers.setdefault(0, Scorer(model))
        return pd.DataFrame([(p, f) for _, p, f in judged(scorer, list(texts))], columns=["posterior", "fit"], dtype=float)

    return told(text.cast("string"))


def floor_of(fits: DataFrame) -> float:
    """The fit below which a text is of no learned language, from the column
    ``fit`` of all labelled rows: ``FAR`` times as far below their median as
    their ``STRAY`` quantile is. Minus infinity without rows that have letters.
    The quantiles come from counts of the fits by their ``FIT_PLACES``."""
    counts = fits.where("fit > double('-Infinity')").groupBy(F.round(F.greatest("fit", F.lit(FIT_LEAST)), FIT_PLACES).alias("fit")).agg(F.count("*").alias("n"))
    at = counts.agg(F.percentile("fit", F.array(F.lit(STRAY), F.lit(0.5)), F.col("n")).alias("p")).first()["p"]
    return at[1] - FAR * (at[1] - at[0]) if at else -math.inf


def floor(rows: DataFrame, model: Model, lang_col: str = "lang", text_col: str = "text") -> float:
    """:func:`floor_of` the rows whose language is not null."""
    return floor_of(rows.where(F.col(lang_col).isNotNull()).select(judgement(model, F.col(text_col))["fit"].alias("fit")))


def recognised(model: Model, text: Column, least: float, floor: float = -math.inf) -> Column:
    """Whether a text has a language whose posterior is at least ``least``, and
    a fit of ``floor`` or more."""
    found = judgement(model, text)
    return (found["posterior"] >= least) & (found["fit"] >= floor)
