"""Benchmark items of many words."""

import random

from marquee.llm import decontam

_rnd = random.Random(2)
WORDS = sorted({"".join(_rnd.choices("abcdefghij", k=5)) for _ in range(4000)})
LENGTHS = [40, 150, 200, 300, 500, 1000, 2000]


def _rows():
    """Verbatim copies of each item, copies with one word in six changed, and
    texts without any."""
    rnd = random.Random(12)
    items = [rnd.choices(WORDS, k=n) for n in LENGTHS]
    rows = []
    for n, item in enumerate(items):
        for copy in range(6):
            words, part = rnd.choices(WORDS, k=300), list(item)
            if copy >= 3:
                for k in rnd.sample(range(len(part)), len(part) // 6):
                    part[k] = "changed"
            at = rnd.randrange(len(words))
            rows.append((10 * n + copy, " ".join(words[:at] + part + words[at:])))
    rows += [(1000 + i, " ".join(rnd.choices(WORDS, k=400))) for i in range(40)]
    return [(n, " ".join(i)) for n, i in enumerate(items)], rows


def test_long_items_are_found(spark):
    items, rows = _rows()
    out = decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in out} == {(10 * n + copy, n) for n in range(len(LENGTHS)) for copy in range(6)}
    assert all(r.common == 1 for r in out if r.doc_id % 10 < 3)
