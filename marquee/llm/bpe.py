"""BPE encoding and decoding by dynamic programming over prefixes.

Merging pairs by rank gives every prefix of a word exactly one last token. For
each prefix in turn, a suffix automaton over the vocabulary yields the tokens
that end there, longest first; the token whose pair with the last token of the
shorter prefix is one that merging would leave alone is stored. Following the
stored tokens back from the end gives the ids.

A pair is left alone when no merge can ever happen across its boundary. Merging
builds each token along a fixed tree, so only the chain of tokens ending at the
boundary on the left and the chain beginning there on the right meet; a merge of
a left and a right link fires when it ranks before both links' own next merges
(on the left strictly, as the leftmost of equal merges goes first).

Words are independent of each other, so each distinct word is encoded once per
worker and then taken from a bounded table. Where no word goes across a blank or
depends on it, what stands between two blanks is looked up first, and cut into
words only where it is new.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import over_batches

#: Words and tested pairs kept per worker before a table is emptied and filled
#: anew (a matter of memory only, never of results).
WORD_TABLE, PAIR_TABLE = 600_000, 200_000
#: Characters up to which what stands between two blanks is kept in the words' table.
CHUNK = 40
#: Characters compared with the tokenizers library's tables at once.
TRIED = 1 << 14

# How byte-level vocabularies spell bytes as characters, and the
# pattern that cuts text into words where the tokenizer file names none.
PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
# Patterns whose matches hold no blank and do not depend on what is beside them:
# literals, classes of letters and numbers, and classes of all but blanks and those.
_CLASS = r"(?:'\w+|\[?(?:\\p\{[LN]\})+\]?\+?|\[\^\\s(?:\\p\{[LN]\})*\]\+?)"
BETWEEN_BLANKS = re.compile(f"{_CLASS}(?:\\|{_CLASS})*")
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(1)
def byte_chars() -> dict[int, str]:
    """Byte to character: printable bytes are themselves, the others take the
    characters from 256 on in order."""
    others = (b for b in range(256) if b not in set(PRINTABLE))
    return {b: chr(b) for b in PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(1)
def new_characters() -> tuple[dict[int, str], re.Pattern]:
    """Letters and numbers to this pattern library that the tokenizers library,
    whose Unicode tables differ, takes for plain symbols: a symbol to put in
    place of each, and a pattern that finds them."""
    from tokenizers import Regex, pre_tokenizers

    letter = regex.compile(r"[\p{L}\p{N}]")
    young = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn" and letter.match(c)]
    theirs = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]"), "removed", invert=True)
    same = {t for t, _ in theirs.pre_tokenize_str("".join(young))}
    codes = sorted(ord(c) for c in young if c not in same)
    ranges: list[list[int]] = []
    for c in codes:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    inside = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)
    return dict.fromkeys(codes, "☃"), re.compile(f"[{inside}]" if inside else r"(?!)")


@lru_cache(1)
def other_characters() -> re.Pattern:
    """Finds the characters that the tokenizers library, whose Unicode tables
    differ, lower-cases, composes or orders otherwise than Python."""
    from tokenizers import normalizers

    found = set()
    for first in range(0x80, 0x110000, TRIED):
        every = [chr(i) for i in range(first, min(first + TRIED, 0x110000)) if not 0xD800 <= i < 0xE000 and unicodedata.category(chr(i)) != "Co"]
        if not every:
            continue
        lower = normalizers.Lowercase().normalize_str("\n".join(every)).split("\n")
        found.update(c for c, theirs in zip(every, lower, strict=True) if theirs != c.lower())
        # a mark of a low and one of a high class tell where a character is put among marks
        tries = "\n".join(f"{c}a{c}\u0334a\u0301{c}\u0334" for c in every)
        ours, theirs = unicodedata.normalize("NFC", tries), normalizers.NFC().normalize_str(tries)
        if ours != theirs:
            found.update(c for c, a, b in zip(every, ours.split("\n"), theirs.split("\n"), strict=True) if a != b)
    return re.compile("[" + "".join(map(re.escape, sorted(found))) + "]" if found else r"(?!)")


class SuffixAutomaton:
    """Of a set of tokens (strings of symbols): reading text symbol by symbol,
    which tokens end here. Each token is the longest string of its state, so
    the tokens ending at a place lie on the chain of suffix links."""

    def __init__(self, tokens: dict[str, int]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = {t: self._add(t) for t in tokens}
        own = [-1] * len(self.next)
        for t, state in ends.items():
            own[state] = tokens[t]
        # per state: its token (or -1), and the nearest state below it with a token (or -1)
        self.own, self.below = own, [-1] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[s]
            self.below[s] = up if own[up] >= 0 else self.below[up]

    def _clone(self, p: int, q: int, c: str) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _add(self, token: str) -> int:
        last = 0
        for c in token:
            p = last
            if c in self.next[p]:
                q = self.next[p][c]
                last = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
                continue
            new = len(self.next)
            self.next.append({})
            self.link.append(0)
            self.length.append(self.length[p] + 1)
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
            last = new
        return last


class BpeCodec:
    """Encoder and decoder of a ``tokenizers`` JSON file with a BPE model over
    byte-level characters (with or without an end-of-word mark)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError(f"{path}: not a plain BPE model")
        self.vocab: dict[str, int] = model["vocab"]
        self._read_text_rules(spec)
        suffix = model.get("end_of_word_suffix") or ""
        self._read_merges([tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]], suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        texts = {i: t for t, i in (self.vocab | self.special).items()}
        self.token_text = [texts.get(i, "").encode() for i in range(max(texts) + 1)]
        kind = (spec.get("decoder") or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"{path}: decoder {kind}")
        self.joins_with_blank = kind is None
        if kind == "ByteLevel":
            back = {c: b for b, c in byte_chars().items()}
            self.token_text = [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in (texts.get(i, "") for i in range(len(self.token_text)))]
        self.words: dict[str, bytes] = {}

    # ---- text to words

    def _read_text_rules(self, spec: dict) -> None:
        steps = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
        steps = steps["normalizers"] if steps["type"] == "Sequence" else [steps]
        self.nfc = self.lower = False
        self.replace: list[tuple[regex.Pattern, str]] = []
        for s in steps:
            if s["type"] == "NFC":
                self.nfc = True
            elif s["type"] == "Lowercase":
                self.lower = True
            elif s["type"] == "Replace" and "Regex" in s["pattern"]:
                self.replace.append((regex.compile(s["pattern"]["Regex"]), s["content"]))
            else:
                raise ValueError(f"normalizer {s['type']}")
        pre = spec["pre_tokenizer"]
        split = next((p for p in pre.get("pretokenizers", []) if p["type"] == "Split"), None)
        if split and not (split["behavior"] == "Removed" and split["invert"]):
            raise ValueError("only a Split that keeps its matches")
        pattern = split["pattern"]["Regex"] if split else BYTE_LEVEL_PATTERN
        self.split = regex.compile(pattern)
        self.drops_blanks = split is not None and regex.compile(pattern).search(" \n\t") is None
        # also: a run of letters is one word
        self.cuts_at_blanks = split is not None and BETWEEN_BLANKS.fullmatch(pattern) is not None and self.split.findall("ab ab,") == ["ab", "ab", ","]

    def segments(self, text: str) -> Iterable[str | int]:
        """The text's parts between special strings, in normal form; ids for the
        special strings."""
        if self.special_split is None or "<|" not in text and not self.special_split.search(text):
            yield self._normal(text)
            return
        for i, part in enumerate(self.special_split.split(text)):
            if i % 2:
                yield self.special[part]
            elif part:
                yield self._normal(part)

    def _normal(self, text: str) -> str:
        theirs = (self.nfc or self.lower) and not text.isascii() and other_characters().search(text)
        if theirs:
            text = self._normalised(text)
        elif self.nfc and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if not self.drops_blanks:  # where blanks are dropped, their kind makes no difference
            for pattern, by in self.replace:
                text = pattern.sub(by, text)
        if self.lower and not theirs:  # character by character: no special last sigma
            text = text.replace("Σ", "σ").lower()
        return text

    def _cut(self, text: str) -> list[str]:
        """Words of a text in normal form."""
        new, pattern = new_characters()
        if text.isascii() or not pattern.search(text):
            return self.split.findall(text)
        return [text[m.start():m.end()] for m in self.split.finditer(text.translate(new))]

    def _normalised(self, text: str) -> str:
        """Normal form and lower case by the tokenizers library's own tables."""
        from tokenizers import normalizers

        for used, step in ((self.nfc, normalizers.NFC), (self.lower, normalizers.Lowercase)):
            text = step().normalize_str(text) if used else text
        return text

    # ---- words to ids

    def _read_merges(self, merges: list[tuple[str, str]], suffix: str) -> None:
        """Tokens as strings of symbols: one per byte, and another 256 for a
        byte that ends a word."""
        back = {c: b for b, c in byte_chars().items()}

        def symbols(token: str) -> str | None:
            body = token.removesuffix(suffix) if suffix else token
            if not body or any(c not in back for c in body):
                return None
            out = "".join(chr(back[c]) for c in body)
            return out[:-1] + chr(ord(out[-1]) + 256) if body != token else out

        self.marks_end = bool(suffix)
        forms = {token: symbols(token) for token in self.vocab}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # id: left, right, rank
        for rank, (a, b) in enumerate(merges):
            pair, whole = (self.vocab[a], self.vocab[b]), self.vocab[a + b]
            if pair not in self.rank:
                self.rank[pair] = rank
            if whole not in self.parts:
                self.parts[whole] = (*pair, rank)
        self.left_chain: dict[int, list[tuple[int, float]]] = {}
        self.right_chain: dict[int, list[tuple[int, float]]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        tokens = {}
        for token, i in self.vocab.items():
            if forms[token] is None:
                continue
            if i in self.parts:
                left, right, rank = self.parts[i]
                if not self._apart(left, right, rank):  # merging would not arrive at this token
                    continue
            elif len(forms[token]) > 1:
                continue
            tokens[forms[token]] = i
        missing = {chr(b) for b in range(512 if suffix else 256)} - tokens.keys()
        if missing:
            raise ValueError(f"{len(missing)} bytes are no tokens")
        self.symbols = {i: len(form) for form, i in tokens.items()}
        self.automaton = SuffixAutomaton(tokens)

    def _chain(self, token: int, side: int, known: dict) -> list[tuple[int, float]]:
        """The tokens at the boundary while ``token`` is built, with the rank of
        the merge that ends each; side 1: at its end, 0: at its beginning."""
        chain = known.get(token)
        if chain is None:
            chain, until, t = [], float("inf"), token
            while True:
                chain.append((t, until))
                if t not in self.parts:
                    break
                until, t = self.parts[t][2], self.parts[t][side]
            known[token] = chain
        return chain

    def _apart(self, a: int, b: int, before: float = float("inf")) -> bool:
        """No merge across the boundary of a and b (that ranks before ``before``)."""
        rank = self.rank
        for x, x_until in self._chain(a, 1, self.left_chain):
            for y, y_until in self._chain(b, 0, self.right_chain):
                r = rank.get((x, y))
                if r is not None and r < before and r < x_until and r <= y_until:
                    return False
        return True

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word."""
        raw = word.encode("utf-8", "surrogatepass").decode("latin-1")
        if self.marks_end:
            raw = raw[:-1] + chr(ord(raw[-1]) + 256)
        a, pairs = self.automaton, self.pairs
        step, own, below, length, link = a.next, a.own, a.below, a.length, a.link
        if len(pairs) > PAIR_TABLE:
            pairs.clear()
        known, last = pairs.get, [-1] * (len(raw) + 1)
        state = matched = 0
        for end, c in enumerate(raw, 1):
            to = step[state].get(c)
            while to is None:
                state = link[state]
                matched = length[state]
                to = step[state].get(c)
            state = to
            matched += 1
            s = state if matched == length[state] and own[state] >= 0 else below[state]
            while True:
                t, begin = own[s], end - length[s]
                if begin == 0:
                    break
                pair = (last[begin], t)
                fits = known(pair)
                if fits is None:
                    fits = pairs[pair] = self._apart(*pair)
                if fits:
                    break
                s = below[s]
            last[end] = t
        out, end = [], len(raw)
        while end:
            t = last[end]
            out.append(t)
            end -= self.symbols[t]
        out.reverse()
        return out

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; null gives none."""
        if not text:
            return b""
        out: list[bytes] = []
        for part in self.segments(text):
            if isinstance(part, int):
                out.append(np.array([part], dtype="<u4").tobytes())
            elif self.cuts_at_blanks:
                chunks = part.replace("\n", " ").split(" ")
                ids = list(map(self.words.get, chunks))
                if None in ids:
                    ids = [self._chunk(c) if i is None else i for c, i in zip(chunks, ids, strict=True)]
                out.extend(ids)
            else:
                out.extend(map(self._word, self._cut(part)))
        return b"".join(out)

    def _chunk(self, chunk: str) -> bytes:
        """Ids of what stands between two blanks."""
        if chunk.isascii() and chunk.isalpha():
            return self._word(chunk)
        if chunk.isascii() and chunk[:-1].isalpha() and not chunk[-1].isalnum():
            cut = [chunk[:-1], *self._cut(chunk[-1])]
        else:
            cut = self._cut(chunk)
        ids = b"".join(map(self._word, cut))
        if len(chunk) <= CHUNK:
            self._keep(chunk, ids)
        return ids

    def _keep(self, word: str, ids: bytes) -> None:
        if len(self.words) >= WORD_TABLE:
            self.words.clear()
        self.words[word] = ids

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            found = self.encode_word(word)
            ids = struct.pack(f"<{len(found)}I", *found)
            self._keep(word, ids)
        return ids

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), dtype="<u4").tolist()

    def decode_bytes(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text (special tokens kept)."""
        parts = map(self.token_text.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())
        if self.joins_with_blank:
            return b" ".join(parts)
        return b"".join(parts).decode("utf-8", "replace").encode()

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(np.array(list(ids), dtype="<u4").tobytes()).decode()


@lru_cache(4)
def codec(path: str) -> BpeCodec:
    """One codec per worker and file."""
    return BpeCodec(path)


OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encode and decode every text: ``doc_id, n_tokens, ids_sha256,
    decoded_sha256`` and, with ``keep_ids``, ``ids`` (little-endian unsigned
    32-bit) and ``decoded``.

    ``path`` is the tokenizer's JSON file, present on every node. One row per
    input row, in place (no shuffle). Null and empty texts have no tokens, a
    null id stays null, repeated rows repeat, other columns are not read.
    """

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(path)
        ids = [c.encode_bytes(t) for t in b.column(1).to_pylist()]
        texts = [c.decode_bytes(i) for i in ids]
        cols = [b.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_ids:
            cols += [pa.array(ids, pa.binary()), pa.array([t.decode() for t in texts], pa.string())]
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(cols, names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return over_batches(rows, run, OUT + (", ids binary, decoded string" if keep_ids else ""))
