"""Shuffle budget of the headline queries, as their physical plans show it.

    python -m harness.plan_report [sf_dir] > PLANS.md

The catalogue is derived from the driver's tables and written to Parquet
once, and the collections are built and stored once, as ``bench.py`` does.
Plans are then taken with automatic broadcasts off
(``autoBroadcastJoinThreshold=-1``), which is how joins of large tables plan.
Broadcasts that remain are the explicit ones, of top-k keys. The plans are
static (adaptive execution off while planning, so Spark's exchange-reuse rule
shows a sub-plan used twice as one shuffle plus a ``ReusedExchange``); at
runtime adaptive execution may still turn a small side into a broadcast,
coalesce partitions or split a skewed one. Nothing is executed apart from
the two writes.
"""

from __future__ import annotations

import os
import re
import sys


def _plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def summarize(df) -> dict[str, object]:
    text = _plan_text(df)
    lines = text.splitlines()

    def count(pattern: str) -> int:
        return sum(1 for line in lines if re.search(pattern, line))

    shuffles = [m.group(1) for line in lines for m in [re.search(r"(?<!Broadcast)Exchange (\w+)\(", line)] if m]
    kinds: dict[str, int] = {}
    for s in shuffles:
        kinds[s] = kinds.get(s, 0) + 1
    return {
        "shuffles": ", ".join(f"{n}× {k}" for k, n in sorted(kinds.items())) or "none",
        "reused": count(r"ReusedExchange"),
        "broadcasts": count(r"BroadcastExchange"),
        "joins": ", ".join(sorted({m.group(0) for line in lines
                                   for m in [re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
                                                       r"BroadcastNestedLoopJoin|CartesianProduct)", line)] if m}))
                 or "none",
        "aggregates": count(r"(HashAggregate|ObjectHashAggregate|SortAggregate)\("),
        "windows": count(r"\bWindow \["),
        "group_limits": count(r"WindowGroupLimit"),
        "top_k": count(r"TakeOrderedAndProject"),
    }


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import marquee as M
    from harness.session import local_session
    from marquee.plans import flat
    from marquee.sources.fixtures import catalogue_from_driver_tables

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    base = spark.sparkContext.getCheckpointDir() + "/plans"  # the session's shared folder
    M.write_catalogue(catalogue_from_driver_tables(spark, sf_dir), f"{base}/catalogue")
    cat = M.load_catalogue(spark, f"{base}/catalogue", fmt="parquet")
    colls, _ = M.build_collections(cat)
    M.write_partitioned_collections(cat, f"{base}/collections")
    stored = M.read_partitioned_collections(spark, f"{base}/collections")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan, with exchange reuse applied

    who, pattern = "Person 7", "series 12"
    rows = {
        "N1 credits per title": M.principals_by_title(cat),
        "N5 titles, one pass (build_titles)": M.build_titles(cat),
        "N4 people": M.people_collection(cat),
        "Q2 rating per genre": M.rating_per_genre(colls.movies),
        "Q3 actor importance (flat)": flat.actor_importance(cat),
        "Q3 actor importance (stored)": M.actor_importance(M.titles(stored)),
        "Q4 titles up to credit (flat)": flat.titles_up_to_credit(cat, who),
        "Q5 titles credited (flat)": flat.titles_credited(cat, who),
        "Q6 credits per person (flat)": flat.credits_per_person(cat),
        "Q6 credits per person (stored)": M.credits_per_person(stored.movies, stored.tvSeries),
        "Q7 top series episodes (flat)": flat.top_series_episodes(cat),
        "Q7 top series episodes (stored)": M.top_series_episodes(stored.tvSeries),
        "Q8 top episodes of (flat)": flat.top_episodes_of(cat, "Series 12"),
        "Q9 top rated (flat)": flat.top_rated(cat),
        "Q9 top rated (stored)": M.top_rated(stored.movies),
        "Q10 episode runtime (flat)": flat.episode_runtime_per_series(cat),
        "Q11 people with titles (flat)": flat.people_with_titles(cat),
        "Q11 people with titles (stored)": M.people_with_titles(stored),
        "Q12 search titles (flat)": flat.search_titles(cat, pattern),
    }
    cols = ["shuffles", "reused", "broadcasts", "joins", "aggregates", "windows", "group_limits", "top_k"]
    print("| Query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, df in rows.items():
        s = summarize(df)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
