"""Token files: flat unsigned integers with 64-bit document offsets.

``write_token_files`` range-partitions the documents by id, encodes each
partition and writes it as three flat little-endian files:

* ``ids-NNNNN.bin``: the token ids, each text's followed by the end id;
* ``offsets-NNNNN.bin``: signed 64-bit, where each document begins in its
  partition's ids, and their total last;
* ``docs-NNNNN.bin``: pairs of signed 64-bit: the document's id, and 1, or 0 for
  a null id.

``manifest.json`` gives the integer type and, per partition, how many documents
and ids it has and its base: the prefix sum of the ids before it. A document's
place in the whole is base plus offset. ``read_token_files`` maps the files into
memory (or reads ranges of them, in a store that has no local paths).

A task writes under a name of its own and renames at the end, so a task that
runs twice leaves the same files.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import uncollected

#: Words kept per worker; then words in use move over to a new table.
WORD_TABLE = 600_000
#: Strings given to the library in one call.
CALL = 8_192
#: Texts encoded together, and their characters (one text at least).
TOGETHER, TOGETHER_CHARS = 8_192, 8 << 20
#: Stands before the first word of a text, in whose place no blank is; regular
#: texts have none.
FIRST = "\x1f"
#: Signs that the library cuts off behind a letter, always.
SIGNS = ".,;:!?&$%*#|"


def is_regular(text: str) -> bool:
    """Whether all blanks are single spaces or line breaks between other
    characters; texts that are not so are encoded in one piece."""
    if text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
        return False
    return text.replace("\n", "").isprintable()  # of all kinds of blank, the space alone is printable


def gathered(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs of ``pool`` that begin at ``start``, one behind the other."""
    ends = np.cumsum(length)
    return pool[np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]


class Parts:
    """Ids of the parts of texts, in one array: a word stands for itself behind a
    blank, or, if it begins with a line break or ``FIRST``, for itself."""

    def __init__(self, dtype: np.dtype):
        self.rows: dict[str, int] = {}
        self.pool, self.used = np.zeros(1 << 16, dtype=dtype), 0
        self.start, self.length = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)

    def add(self, words: list[str], ids: np.ndarray, length: np.ndarray) -> None:
        n, m = len(self.rows), len(self.rows) + len(words)
        while m > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.start[n:m], self.length[n:m] = self.used + np.cumsum(length) - length, length
        self.used += len(ids)
        self.rows.update(zip(words, range(n, m), strict=True))

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where the words' ids begin, and how many they are."""
        rows = np.fromiter(map(self.rows.__getitem__, words), dtype=np.int64, count=len(words))
        return self.start[rows], self.length[rows]


class TextEncoder:
    """Ids of texts by the tokenizers library.

    The library's byte-level pattern never joins a character to what stands
    before a lone blank, nor to a lone newline on either side, so the parts
    between them encode alike wherever they occur: each distinct part is given
    to the library once, many parts in one string, cut again at the ids whose
    tokens begin with a blank or line break. Other kinds of tokenizers get whole
    texts.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        pre = spec.get("pre_tokenizer") or {}
        self.by_part = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocabulary.values(), default=0) < 1 << 16 else "<u4")
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.begins[[i for token, i in vocabulary.items() if token[:1] in ("\u0120", "\u010a")]] = True  # blank and line break, as the byte-level alphabet writes them
        self.known = self.old = Parts(self.dtype)
        self.signs: dict[str, np.ndarray] = {}

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        calls = (texts[k:k + CALL] for k in range(0, len(texts), CALL))
        return [np.array(e.ids, dtype=self.dtype) for c in calls for e in self.tokenizer.encode_batch_fast(c, add_special_tokens=False)]

    def _parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, one behind the other, and how many each has."""
        first, inner = ([p for p in parts if (p[0] == FIRST) == x] for x in (True, False))
        alone = self._library([p[1:] for p in first])
        ids, length = [*alone], [np.array([len(x) for x in alone], dtype=np.int64)]
        groups = [inner[k:k + CALL] for k in range(0, len(inner), CALL)]
        texts = [[p if p[0] == "\n" else " " + p for p in g] for g in groups]
        for group, found in zip(texts, self._library(["".join(g) for g in texts]), strict=True):
            at = np.flatnonzero(self.begins[found])
            size = np.diff(at, append=len(found))
            if len(at) != len(group) or at[0]:  # added tokens that look like a beginning
                each = self._library(group)
                found, size = np.concatenate(each), np.array([len(x) for x in each], dtype=np.int64)
            ids.append(found)
            length.append(size)
        parts[:] = first + inner
        return np.concatenate(ids) if ids else np.zeros(0, dtype=self.dtype), np.concatenate(length)

    def _learn(self, new: set[str]) -> None:
        """Add parts to the table; a word with signs behind it is the word's ids
        and the signs' ids."""
        known = self.known
        again = list(new.intersection(self.old.rows)) if self.old is not known else []
        if again:
            start, length = self.old.of(again)
            known.add(again, gathered(self.old.pool, start, length), length)
        signed = {}
        for p in new.difference(again):
            word = p.rstrip(SIGNS)
            if word != p and word[-1:].isalpha():
                signed[p] = word
        plain = list(new.difference(again, signed).union(signed.values()).difference(known.rows))
        if plain:
            ids, length = self._parts(plain)
            known.add(plain, ids, length)
        if signed:
            signs = list({p[len(w):] for p, w in signed.items()}.difference(self.signs))
            self.signs.update(zip(signs, self._library(signs), strict=True))
            behind = [self.signs[p[len(w):]] for p, w in signed.items()]
            start, length = known.of(list(signed.values()))
            more = np.fromiter(map(len, behind), dtype=np.int64, count=len(behind))
            # word, signs, word, signs ... as runs of one array
            pool = np.concatenate([known.pool[:known.used], *behind])
            runs = np.stack([start, known.used + np.cumsum(more) - more], axis=1).ravel()
            known.add(list(signed), gathered(pool, runs, np.stack([length, more], axis=1).ravel()), length + more)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes of ``dtype``."""
        out: list[bytes] = [b""] * len(texts)
        regular = [i for i, t in enumerate(texts) if t and self.by_part and is_regular(t)]
        whole = sorted({i for i, t in enumerate(texts) if t}.difference(regular))
        for i, ids in zip(whole, self._library([texts[i] for i in whole]), strict=True):
            out[i] = ids.tobytes()
        if not regular:
            return out
        if len(self.known.rows) > WORD_TABLE:  # words in use move over to the new table
            self.old, self.known = self.known, Parts(self.dtype)
        cut = pc.split_pattern(pc.replace_substring(pa.array([FIRST + texts[i] for i in regular], pa.large_string()), "\n", " \n"), " ")
        words = cut.flatten().dictionary_encode()
        distinct = words.dictionary.to_pylist()
        new = set(distinct).difference(self.known.rows)
        if new:
            self._learn(new)
        start, length = self.known.of(distinct)
        which = words.indices.to_numpy()
        each = length[which]
        ids = gathered(self.known.pool, start[which], each)
        ends = np.concatenate([[0], np.cumsum(each)])[cut.offsets.to_numpy()]
        for i, a, b in zip(regular, ends[:-1].tolist(), ends[1:].tolist()):
            out[i] = ids[a:b].tobytes()
        return out


def groups_of(sizes: Iterable[int]) -> Iterator[tuple[int, int]]:
    """Begin and end of runs of texts that are encoded together."""
    begin, total, at = 0, 0, -1
    for at, size in enumerate(sizes):
        if at > begin and (total + size > TOGETHER_CHARS or at - begin == TOGETHER):
            yield begin, at
            begin, total = at, 0
        total += size
    if at >= begin:
        yield begin, at + 1


@lru_cache(2)
def encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def _files(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _put(uri: str, name: str, chunks: Iterable[bytes], attempt: int) -> None:
    """Write a file whole or not at all."""
    store, top = _files(uri)
    part, final = f"{top}/.{name}.{attempt}", f"{top}/{name}"
    with store.open_output_stream(part) as f:
        for c in chunks:
            f.write(c)
    try:
        store.move(part, final)
    except OSError:  # stores that do not rename over a file
        store.delete_file(final)
        store.move(part, final)


def write_token_files(docs: DataFrame, tokenizer: str, out: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> dict:
    """Encode all texts, append ``end_id`` to each, write the files under ``out``
    (a folder that all nodes share) in ascending id order; returns the manifest.

    Null and empty texts have the end id alone; null ids come first; rows with
    one id come in order of their text and are all written; an empty table
    gives a manifest without partitions. Other columns are not read. What
    reaches the driver is a row per partition.
    """
    spark = docs.sparkSession
    store, top = _files(out)
    store.create_dir(top, recursive=True)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, ctx = encoder(tokenizer), TaskContext.get()
        part, attempt = ctx.partitionId(), ctx.taskAttemptId()
        end, width = np.array([end_id], dtype=enc.dtype).tobytes(), enc.dtype.itemsize
        offsets, ids, at = array("q", [0]), array("q"), 0

        def chunks() -> Iterator[bytes]:
            nonlocal at
            for b in batches:
                ids.extend(x for d in b.column(0).to_pylist() for x in (d or 0, int(d is not None)))
                for k, m in groups_of(pc.binary_length(b.column(1).fill_null("")).to_pylist()):
                    for e in enc.encode([t or "" for t in b.column(1).slice(k, m - k).to_pylist()]):
                        at += len(e) // width + 1
                        offsets.append(at)
                        yield e + end

        with uncollected():
            _put(out, f"ids-{part:05d}.bin", chunks(), attempt)
        _put(out, f"offsets-{part:05d}.bin", [np.frombuffer(offsets, dtype=np.int64).astype("<i8").tobytes()], attempt)
        _put(out, f"docs-{part:05d}.bin", [np.array(ids, dtype="<i8").tobytes()], attempt)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(offsets) - 1], pa.int64()), pa.array([at], pa.int64()), pa.array([enc.dtype.str])], ["part", "docs", "ids", "dtype"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sorted_rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    done = sorted(sorted_rows.mapInArrow(run, "part int, docs long, ids long, dtype string").collect())
    base, parts = 0, []
    for r in done:
        if r["docs"]:
            parts.append({"part": r["part"], "docs": r["docs"], "ids": r["ids"], "base": base})
            base += r["ids"]
    manifest = {"dtype": done[0]["dtype"] if done else "<u2", "end_id": end_id, "ids": base, "parts": parts}
    _put(out, "manifest.json", [json.dumps(manifest).encode()], 0)
    return manifest


def read_manifest(out: str) -> dict:
    store, top = _files(out)
    with store.open_input_stream(f"{top}/manifest.json") as f:
        return json.loads(f.read())


def _range_reader(uri: str, name: str, dtype: str) -> Callable[[int, int], np.ndarray]:
    """Elements from a to b of a flat file: mapped where it has a local path."""
    store, top = _files(uri)
    path, kind = f"{top}/{name}", np.dtype(dtype)
    if isinstance(store, pafs.LocalFileSystem):
        whole = np.memmap(path, dtype=kind, mode="r")
        return lambda a, b: whole[a:b]
    f = store.open_input_file(path)
    return lambda a, b: np.frombuffer(f.read_at((b - a) * kind.itemsize, a * kind.itemsize), dtype=kind)


def read_token_files(spark: SparkSession, out: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files
    alone, one task per partition; ``with_ids`` adds the ids as an array.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is that of
    the ids as little-endian unsigned 32-bit integers.
    """
    manifest = read_manifest(out)
    parts, dtype = {i: p for i, p in enumerate(manifest["parts"])}, manifest["dtype"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i in (x for b in batches for x in b.column(0).to_pylist()):
            p = parts[i]
            name = f"-{p['part']:05d}.bin"
            ids = _range_reader(out, "ids" + name, dtype)
            offsets, docs = _range_reader(out, "offsets" + name, "<i8"), _range_reader(out, "docs" + name, "<i8")
            for a in range(0, p["docs"], 1000):
                b = min(a + 1000, p["docs"])
                at = offsets(a, b + 1)
                who = docs(2 * a, 2 * b).reshape(-1, 2)
                each = [np.ascontiguousarray(ids(int(x), int(y)), dtype="<u4") for x, y in zip(at[:-1], at[1:])]
                cols = [pa.array(np.array(who[:, 0]), pa.int64(), mask=who[:, 1] == 0), pa.array(at[:-1] + p["base"]), pa.array(np.diff(at)), pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([x.astype(np.int64) for x in each], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return spark.range(0, len(parts), 1, max(1, len(parts))).mapInArrow(run, schema)
