"""Source divergence and filter interaction against SQL and by hand."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from harness.compare import compare, duck
from marquee.llm import divergence, interaction
from marquee.llm.queries import ORACLE, QUERIES
from odd_rows import ODD_ROWS, SF001, SF01


@pytest.mark.parametrize("sf", [SF001, SF01])
@pytest.mark.parametrize("name", ["op11_divergence", "op12_interaction"])
def test_query_matches_sql(spark, name, sf):
    r = compare(spark, duck(sf), name, QUERIES[name], ORACLE[name], sf)
    assert r["columns_match"] and r["values_match"] and r["rows"] == r["oracle_rows"] > 0, r


# ---------------------------------------------------------------- divergence

def _terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _divergences(rows, min_docs, top):
    """Plain Python: rows of (text, lang, source)."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source, found = lang or "", source or "", _terms(text)
        groups[lang].add(source)
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= min_docs]

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s)
            best = sorted((whole[t] - p[s][t], t) for t in kept if counts[lang, s][t] and p[s][t] > whole[t])[:top]
            out += [(lang, s, part, item, -v, k) for part, found in (("pair", pairs), ("term", best)) for k, (v, item) in enumerate(found, 1)]
    return sorted(out)


def _got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergences_with_spills_slots_and_odd_rows(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["É", "naïve", "ÀB", "日本"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 60))) + rng.choice(["", "!X-y9z", "\t\x00"]), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None])) for _ in range(300)]
    rows += [(None, "en", "silent"), ("", "xx", "one"), ("1 2 3", "xx", "two"), ("lone", "yy", "z")] + rows[:5]
    monkeypatch.setattr(divergence, "SPILL_ENTRIES", 40)
    monkeypatch.setattr(divergence, "SLOT_CELLS", 50)
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 30)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "text string, lang string, source string, term int, stripe string, slot int").repartition(5)
    assert _got(divergence.divergences(df, min_docs=4, top=6)) == _divergences(rows, 4, 6)
    assert divergence.divergences(df.limit(0)).count() == 0
    assert _got(divergence.divergences(df, min_docs=10_000)) == _divergences(rows, 10_000, 50)  # no term is kept: pairs of 0


def test_full_tables_are_spilled(spark, monkeypatch):
    """Stripes of one task: several for one term, none larger than the tables."""
    monkeypatch.setattr(divergence, "SPILL_ENTRIES", 9)
    df = spark.createDataFrame([("a b c d e f g h common", "en", "s")] * 20, "text string, lang string, source string").coalesce(1)
    found = divergence.mapped_stripes(df).collect()
    assert sum(r.term == "common" for r in found) == 20  # nine terms fill the tables with every document
    assert sum(c.n for r in found if r.term == "common" for c in r.stripe) == 20


def test_shares_are_exact():
    rng = np.random.default_rng(1)
    counts, total = rng.integers(0, 1 << 50, 500), rng.integers(1 << 50, 1 << 52, 500)
    assert divergence._shares(counts, total).tolist() == [1 + 10**9 * (int(c) + 5) // int(t) for c, t in zip(counts, total)]


# ---------------------------------------------------------------- interaction

def test_swaps_walk_through_all_orders():
    for n in range(6):
        order, seen = list(range(n)), {tuple(range(n))}
        for p in interaction.swap_walk(n):
            order[p], order[p + 1] = order[p + 1], order[p]
            seen.add(tuple(order))
        assert seen == set(itertools.permutations(range(n))) and len(seen) == len(interaction.swap_walk(n)) + 1


def test_swapped_levels_hold_the_same_function():
    rng = random.Random(2)
    counts = {m: (rng.randint(1, 9), rng.randint(0, 3), rng.randint(0, 3)) for m in range(32) if rng.random() < 0.6}
    order, root = list(range(5)), interaction.build(counts, range(5))
    for p in interaction.swap_walk(5):
        order[p], order[p + 1] = order[p + 1], order[p]
        root = interaction.swapped(root, p)
        assert root == interaction.build(counts, order)


def _audit(masks):
    """Steps of every order by brute force over rows of (part, failed letters, good, toxic)."""
    out = {}
    for part in {r[0] for r in masks}:
        rows = [r for r in masks if r[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = rows
            for k, f in enumerate(order, 1):
                gone, fails = [r for r in left if f in r[1]], [r for r in rows if f in r[1]]
                left = [r for r in left if f not in r[1]]
                out[part, "".join(order), k] = [len(left), len(gone), len(fails) - len(gone), sum(r[1] == {f} for r in rows), sum(r[2] for r in gone), sum(r[3] for r in gone)]
    shapley = Counter()
    for (part, order, k), v in out.items():
        shapley[part, order[k - 1]] += v[1]
    return {key: (*v, shapley[key[0], key[1][key[2] - 1]]) for key, v in out.items()}


def test_interaction_against_brute_force(spark):
    long_text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, long_text, "s"), (2, long_text, "t"), (2, long_text, "t"), (None, long_text, "s"), (None, None, None), (3, None, None), (4, "", ""), (5, "A" * 30, "s"),
            (6, "a # b", "s"), (7, long_text + " #", "s"), (8, "the " * 80, "s"), (9, "Wörter bleiben ÄÖÜ", "t"), (10, "x" * 200_000, "t"), (11, long_text + " #", "s"), (12, "w " * 100_000, None)]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (7, 1, 1), (None, 1, 1), (11, None, None), (99, 1, 1), (8, 0, 1)]
    df = spark.createDataFrame([(*r, 1, "x", True, "y") for r in rows], "doc_id long, text string, source string, mask int, part string, good boolean, digest string")
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, mask string")

    def fails(i, text):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        earlier = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)
        tests = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), re.search(r"[#$%&*|]", text), earlier]
        return {f for f, t in zip("ABCDE", tests) if t}

    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    want = _audit([(s or "", fails(i, t), i is not None and i in good, i is not None and i in toxic) for i, t, s in rows])
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in interaction.filter_audit(df, marks).collect()}
    assert got == want
    assert interaction.filter_audit(df.limit(0), marks).count() == 0
    assert interaction.filter_audit(df, marks.limit(0)).where("good_lost > 0 or toxic_lost > 0").count() == 0


def test_odd_rows_have_all_steps(spark, odd):
    df = odd(ODD_ROWS).selectExpr("*", "cast(null as string) as source")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = interaction.filter_audit(df, labels).collect()
    assert len(out) == 600 and {r.part for r in out} == {""} and all(r.kept + r.removed <= len(ODD_ROWS) for r in out)
