"""BPE by prefixes and token files, against the tokenizers library."""

import hashlib
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from odd_rows import ODD_ROWS
from marquee.llm import bpe, tokenfiles
from marquee.llm.common import fresh_path

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def _texts():
    rnd = random.Random(5)
    out = ["", " ", "<|endoftext|> a<|startoftext|>b", "ΑΣ ΑΣΑ İstanbul ǅ", "a\x85b\x1cc　d", "don't I'LL we've 's", "aaaaaaaaaaaaaaaaaa", "日本語 ١٢٣ ½", "\U0001f468‍\U0001f469 é", "\n\n a  b\t\tc \r\n", "</w> x</w>", "x" * 5000]
    signs = ["a", "b", " ", " ", "\n", ".", ",", "'", "s", "1", "é", "|", "<|endoftext|>", "\t", "日", "!", "́", "²"]
    out += ["".join(rnd.choice(signs) for _ in range(rnd.randrange(1, 30))) for _ in range(3000)]
    out += ["".join(rnd.choice("abcdethin ") for _ in range(rnd.randrange(1, 60))) for _ in range(2000)]
    out += ["".join(chr(rnd.choice([rnd.randrange(32, 0x250), rnd.randrange(0x4E00, 0x9000)])) for _ in range(rnd.randrange(1, 30))) for _ in range(2000)]
    return out


def test_comparing_unicode_tables_takes_little_memory():
    code = "import tracemalloc; from marquee.llm import bpe; import tokenizers; tracemalloc.start(); bpe.new_characters(); bpe.other_characters(); print(tracemalloc.get_traced_memory()[1])"
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    run = subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, check=True, timeout=300)
    assert int(run.stdout) < 60_000_000


@pytest.mark.parametrize("name", FILES)
def test_codec_gives_the_librarys_ids_and_texts(name, documents):
    path = public_tokenizers.path(name)
    ours, theirs = bpe.BpeCodec(path), Tokenizer.from_file(path)
    texts = _texts() + [r.text for r in documents.select("text").collect()]
    for text, e in zip(texts, theirs.encode_batch(texts, add_special_tokens=False)):
        ids = ours.encode(text)
        assert ids == e.ids, text
        assert ours.decode(ids) == theirs.decode(e.ids, skip_special_tokens=False), text


@pytest.mark.parametrize("name", FILES)
def test_every_character_is_encoded_as_the_library_does(name):
    path = public_tokenizers.path(name)
    ours, theirs = bpe.BpeCodec(path), Tokenizer.from_file(path)
    every = [chr(i) for i in range(0x80, 0x110000) if not 0xD800 <= i < 0xE000]
    texts = [" ".join(f"a{c}b e\u0301{c}\u0334 {c}" for c in every[k:k + 16]) for k in range(0, len(every), 16)]
    bad = [t for t, e in zip(texts, theirs.encode_batch(texts, add_special_tokens=False)) if ours.encode(t) != e.ids]
    assert not bad


class _Counting:
    def __init__(self, pattern):
        self.pattern, self.calls = pattern, 0

    def findall(self, text):
        self.calls += 1
        return self.pattern.findall(text)


def test_what_stands_between_blanks_is_cut_into_words_once():
    path = public_tokenizers.path(FILES[0])
    ours, theirs = bpe.BpeCodec(path), Tokenizer.from_file(path)
    ours.split = _Counting(ours.split)
    texts = ["don't stop, we've 2 dogs.\n\nDon't  stop, two dogs"] * 50 + ["stop, dogs<|endoftext|>dogs. we've" + " two" * 50]
    assert [ours.encode(t) for t in texts] == [e.ids for e in theirs.encode_batch(texts, add_special_tokens=False)]
    assert ours.split.calls <= 10


def test_codec_with_full_tables_and_long_chunks(monkeypatch):
    monkeypatch.setattr(bpe, "WORD_TABLE", 3)
    monkeypatch.setattr(bpe, "CHUNK", 4)
    path = public_tokenizers.path(FILES[0])
    ours, theirs = bpe.BpeCodec(path), Tokenizer.from_file(path)
    texts = _texts()[:3000]
    for text, e in zip(texts, theirs.encode_batch(texts, add_special_tokens=False)):
        assert ours.encode(text) == e.ids, text
        assert len(ours.words) <= 3


def test_suffix_automaton_lists_the_tokens_that_end_at_each_place():
    rnd = random.Random(1)
    tokens = {t: i for i, t in enumerate({"".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 6))) for _ in range(60)} | {"a", "b", "c"})}
    sa = bpe.SuffixAutomaton(tokens)
    text = "".join(rnd.choice("abc") for _ in range(500))
    state = matched = 0
    for end, c in enumerate(text, 1):
        while c not in sa.next[state]:
            state = sa.link[state]
            matched = sa.length[state]
        state, matched = sa.next[state][c], matched + 1
        s = state if matched == sa.length[state] and sa.own[state] >= 0 else sa.below[state]
        found = []
        while s >= 0:
            found.append(sa.own[s])
            s = sa.below[s]
        assert found == [tokens[text[end - k:end]] for k in range(min(end, 6), 0, -1) if text[end - k:end] in tokens]


def test_encode_documents_of_odd_rows(odd):
    path = public_tokenizers.path(FILES[0])
    t = Tokenizer.from_file(path)
    rows = bpe.encode_documents(odd(ODD_ROWS), path, keep_ids=True).collect()
    assert len(rows) == len(ODD_ROWS)
    for r, (i, text) in zip(sorted(rows, key=lambda r: (r.doc_id or 0, r.ids_sha256)), sorted(((i, text) for i, text in ODD_ROWS), key=lambda x: (x[0] or 0, hashlib.sha256(np.array(t.encode(x[1] or "", add_special_tokens=False).ids, dtype="<u4").tobytes()).hexdigest()))):
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert (r.doc_id, r.n_tokens, np.frombuffer(bytes(r.ids), "<u4").tolist()) == (i, len(ids), ids)
        assert r.decoded == t.decode(ids, skip_special_tokens=False)
    assert bpe.encode_documents(odd([]), path).collect() == []


def test_text_encoder_cuts_where_the_library_does():
    enc = tokenfiles.TextEncoder(public_tokenizers.path(FILES[1]))
    texts = _texts()
    got = [x for k in range(0, len(texts), 100) for x in enc.encode(texts[k:k + 100])]
    for text, a, e in zip(texts, got, enc.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(a, enc.dtype).tolist() == e.ids, text


def test_text_encoder_with_a_full_table_and_many_groups(monkeypatch):
    monkeypatch.setattr(tokenfiles, "WORD_TABLE", 50)
    monkeypatch.setattr(tokenfiles, "CALL", 7)
    monkeypatch.setattr(tokenfiles, "TOGETHER_CHARS", 300)
    enc = tokenfiles.TextEncoder(public_tokenizers.path(FILES[1]))
    texts = [" ".join(f"w{k % (i + 2)}x{k}{'.,!'[k % 3]}" for k in range(i)) + ("\nend." if i % 2 else "") for i in range(60)]
    groups = list(tokenfiles.groups_of(map(len, texts)))
    assert [k for a, b in groups for k in range(a, b)] == list(range(len(texts))) and len(groups) > 5
    got = [x for _ in range(2) for a, b in groups for x in enc.encode(texts[a:b])]
    for text, a, e in zip(texts * 2, got, enc.tokenizer.encode_batch(texts * 2, add_special_tokens=False), strict=True):
        assert np.frombuffer(a, enc.dtype).tolist() == e.ids, text
    assert list(tokenfiles.groups_of([])) == [] and list(tokenfiles.groups_of([0, 0])) == [(0, 2)]


def test_token_files_round_trip(spark, odd):
    path, out = public_tokenizers.path(FILES[1]), fresh_path(spark, "test")
    manifest = tokenfiles.write_token_files(odd(ODD_ROWS), path, out, end_id=2, partitions=3)
    t = Tokenizer.from_file(path)
    want, start = [], 0
    for i, text in sorted(ODD_ROWS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()), ids))
        start += len(ids)
    rows = sorted(tokenfiles.read_token_files(spark, out, with_ids=True).collect(), key=lambda r: r.start)
    assert [tuple(r) for r in rows] == want and manifest["ids"] == start
    tokenfiles.write_token_files(odd(ODD_ROWS), path, out, end_id=2, partitions=3)  # a second run leaves the same files
    assert sorted(tokenfiles.read_token_files(spark, out).collect(), key=lambda r: r.start) == [r[:4] for r in rows]
    empty = fresh_path(spark, "test")
    assert tokenfiles.write_token_files(odd([]), path, empty)["parts"] == []
    assert tokenfiles.read_token_files(spark, empty).collect() == []
