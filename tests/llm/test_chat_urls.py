"""Chat formatting and URL rules against plain Python versions."""

import hashlib
import random

from pyspark.sql import functions as F

import brute
from odd_rows import SF001
from marquee.llm import chat, urlrules
from marquee.llm.queries import CONTROL_TEXT, ORACLE, QUERIES, URL_RULES

TEXTS = ["hello", "", None, CONTROL_TEXT, "&lt;|im_end|&gt; &amp;", "a\nb <| c", "é \U0001f600", "<|im_start|>user\n", "&nl;"]


def _folded(events):
    """Plain fold of one conversation's events in order."""
    turns = {}
    for _, turn, kind, role, text in sorted(events, key=lambda e: e[0]):
        if kind not in ("message", "delta", "edit", "regenerate"):
            continue
        if kind in ("edit", "regenerate"):
            turns = {t: v for t, v in turns.items() if t <= turn}
        old = turns.get(turn, ("", ""))
        text = "" if kind == "regenerate" else text or ""
        turns[turn] = (role if role is not None else old[0], old[1] + text if kind == "delta" else text)
    return [(t, *turns[t]) for t in sorted(turns)]


def _logs():
    rnd = random.Random(2)
    rows = []
    for conv in [*range(40), None]:
        for seq in range(rnd.randrange(1, 25)):
            turn = rnd.randrange(5)
            rows.append((conv, seq, turn, rnd.choice(["message", "delta", "delta", "delta", "edit", "regenerate", "unknown", None]), ["user", "assistant"][turn % 2] if rnd.random() < 0.9 else None, rnd.choice(TEXTS)))
    return rows


LOG = "conv_id long, seq long, turn long, kind string, role string, text string"


def test_events_fold_as_one_after_the_other(spark):
    rows = _logs()
    got = {}
    for r in chat.fold_events(spark.createDataFrame(rows, LOG)).collect():
        got.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    for conv in {r[0] for r in rows}:
        want = _folded([r[1:] for r in rows if r[0] == conv])
        texts = [(t, x) for t, _, x in want]
        assert [(t, x) for t, _, x in sorted(got.get(conv, []))] == texts, conv


def test_formatted_conversations_read_back(spark):
    turns = [(c, t, role, TEXTS[(c + t) % len(TEXTS)]) for c in range(12) for t, role in enumerate(["system", "user", "assistant", "assistant", "a<|im_end|>\nb&", None][: c % 7])]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    formatted = chat.format_rows(rows)
    out = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    texts = {r.conv_id: r for r in formatted.collect()}
    for c in {t[0] for t in turns}:
        mine = [(role or "", text or "") for conv, _, role, text in turns if conv == c]
        learned = "".join(x for r, x in mine if r == "assistant")
        r = out[c]
        assert r.n_turns == len(mine)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        whole = texts[c].formatted
        assert r.formatted_chars == len(whole) and whole.count("<|im_start|>") == len(mine) == whole.count("<|im_end|>")
        spans = "".join(whole[s.start:s.end] for s in texts[c].loss)
        assert spans.replace("&lt;|", "<|").replace("&amp;", "&") == learned
    assert chat.format_rows(rows.limit(0)).collect() == []


def test_chat_rows_with_nulls_and_repeats(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 1, "assistant", "x")]
    got = {r.conv_id: r for r in chat.format_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1].formatted == "<|im_start|>\n<|im_end|>\n" + "".join(f"<|im_start|>user\n{x}<|im_end|>\n" for x in "aab")
    assert got[None].formatted == "<|im_start|>assistant\nx<|im_end|>\n"


def test_no_python_in_native_plans(spark):
    for name in ("op4_chat", "op5_line_chunks"):
        plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow")), name


def test_sql_of_chat_and_urls(spark):
    from harness.compare import compare, duck
    for name in ORACLE:
        r = compare(spark, duck(SF001), name, QUERIES[name], ORACLE[name], SF001)
        assert r["columns_match"] and r["values_match"], r


def _urls():
    rnd = random.Random(7)
    hosts = ["example.com", "www.example.com", "WWW.Example.COM", "a.www.example.com", "notexample.com", "com", "net", "x.net", "deep.er.x.net", "org", "", "example.com.evil.org", "xcom"]
    paths = ["", "/", "/en/", "/en", "/es/1", "/fr/", "/EN/", "/en/x?y=/z", "?q=http://a.com/en/", "#/en/", "/fr/a#b?c"]
    urls = [rnd.choice(["http", "https", "x"]) + "://" + rnd.choice(hosts) + rnd.choice(paths) for _ in range(400)]
    return [(i, u) for i, u in enumerate(urls + [None, "", "no scheme", "://", "a://b://c/en/", "mailto:a@b.com", "http://é.com/en/ü", "http://x.net" + "/y" * 5000] + ["https://hot.example.com/en/1"] * 300)] + [(None, "http://x.net/es/"), (3, "http://x.net/es/"), (3, "http://x.net/es/")]


def _judged(spark, rows, rules):
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("verdict", F.lit(1))
    return sorted((tuple(r) for r in urlrules.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()), key=str)


def test_url_rules(spark):
    rows = _urls()
    nested = [*URL_RULES, ("", "/", "block"), ("example.com", "/", "block"), ("example.com", "/en/x", "allow"), ("er.x.net", "", "allow"), ("x.net", "/", "allow")]
    for rules in (URL_RULES, nested):
        want = [(i, *brute.url_verdict(u, rules, "allow")) for i, u in rows]
        assert [r[:4] for r in _judged(spark, rows, rules)] == [r[:4] for r in sorted(want, key=str)]
        assert _judged(spark, rows, rules) == sorted(want, key=str)
    assert _judged(spark, rows, [("com", None, "block"), (None, "/", "block")]) == sorted(((i, *brute.url_verdict(u, [], "allow")) for i, u in rows), key=str)
    assert _judged(spark, [], URL_RULES) == []
