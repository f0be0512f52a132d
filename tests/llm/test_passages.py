"""Repeated passages of lines, wherever they begin and end."""

import random

import pytest

from marquee.llm import linechunks

_rnd = random.Random(1)
WORDS = sorted({"".join(_rnd.choices("abcdefghij", k=5)) for _ in range(4000)})


def _passages_by_hand(rows):
    """New text of each (id, text), ids all different: two neighbouring lines
    with words, long lines, and lines next to a blank one, if seen before."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines = text.split("\n")
        words = [len(x.split()) for x in lines]
        worded = [k for k, n in enumerate(words) if n]
        spans = [(a, b) for a, b in zip(worded, worded[1:])] + [(k, k) for k in worded if words[k] >= linechunks.LONG_LINE]
        spans += [(k, k + 1) for k in range(len(lines) - 1) if (words[k] == 0) != (words[k + 1] == 0) and words[k] + words[k + 1] >= linechunks.BESIDE_BLANK]
        gone = set()
        for a, b in sorted(spans):
            part = tuple(lines[a:b + 1])
            if part in seen:
                gone.update(range(a, b + 1))
            seen.add(part)
        runs = sum(k - 1 not in gone for k in gone)
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone), runs)
    return out


@pytest.mark.parametrize("n", range(2, 9))
def test_passages_of_few_short_lines_go_whole(spark, n):
    rnd = random.Random(n)
    line = lambda: " ".join(rnd.choices(WORDS, k=15))
    passage = [line() for _ in range(n)]
    rows = [(i, "\n".join([line() for _ in range(rnd.randrange(1, 6))] + passage + [line() for _ in range(rnd.randrange(1, 6))])) for i in range(30)]
    got = {r.doc_id: (r.text, r.lines_removed) for r in linechunks.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        left = [x for x in text.split("\n") if i == 0 or x not in passage]
        assert got[i] == ("\n".join(left), 0 if i == 0 else n)


def test_passages_of_the_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.text, r.lines_removed, r.chunks_removed) for r in linechunks.dedup_passages(documents).collect()}
    assert got == _passages_by_hand(rows)


def test_passages_of_odd_rows(odd):
    rows = [(1, None), (1, ""), (2, "\n\n\n"), (3, "x" * 100_000), (4, "a b\n" * 3000), (5, "one a\n\ntwo b\nthree"), (5, "one a\n\ntwo b\nthree"), (6, "one a\n\ntwo b\nfour"), (None, "null first\nthree"), (7, "x\nnull first\nthree\ny")]
    out = linechunks.dedup_passages(odd(rows))
    assert out.columns[:9] == odd([]).columns and out.columns[9:] == ["lines_removed", "chunks_removed"]
    got = sorted(((r.doc_id, r.text, r.lines_removed, r.chunks_removed) for r in out.collect()), key=str)
    want = [(i, t, 0, 0) for i, t in rows if i not in (4, 6, 7)] + [(4, "a b\n", 2999, 1), (6, "four", 3, 1), (7, "x\ny", 2, 1)]
    assert got == sorted(want, key=str)
    assert linechunks.dedup_passages(odd([])).collect() == []
