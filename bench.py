"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Two families are timed, each query run to completion with the ``noop`` sink
(full execution, nothing collected):

* ``s4_write_catalogue``: derive the five catalogue tables from the driver's
  tables and write them as Parquet once (as a deployment converts the
  catalogue dump once);
* ``<q>``: from that flat catalogue — credit/episode-level and selective
  queries read the flat rows directly (``plans.flat``), the others run over
  lazily built collections;
* ``<q>_stored``: the same query over the collections written by
  ``n5_build_partitioned`` (one job for all titles, one for people), the
  build-once / query-many pattern of the document store.

Each query runs once to warm up, then ``BENCH_RUNS`` times (default 3); the
median is reported. ``value`` is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import marquee as M  # noqa: E402
from harness.session import local_session  # noqa: E402
from marquee.plans import flat  # noqa: E402
from marquee.sources.fixtures import catalogue_from_driver_tables  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


# Parameters of the parameterised queries (values that exist in the test catalogue).
DIRECTOR, SERIES_TITLE, PATTERN = "Person 7", "Series 12", "series 12"


def _queries(colls):
    return {
        "q1_titles_view": lambda: M.titles(colls),
        "q2_rating_per_genre": lambda: M.rating_per_genre(colls.movies),
        "q3_actor_importance": lambda: M.actor_importance(M.titles(colls)),
        "q6_credits_per_person": lambda: M.credits_per_person(colls.movies, colls.tvSeries),
        "q7_top_series_episodes": lambda: M.top_series_episodes(colls.tvSeries),
        "q10_episode_runtime_per_series": lambda: M.episode_runtime_per_series(colls.tvSeries),
        "q11_people_with_titles": lambda: M.people_with_titles(colls),
        "q4_titles_up_to_credit": lambda: M.titles_up_to_credit(colls.movies, DIRECTOR),
        "q5_titles_credited": lambda: M.titles_credited(colls.movies, DIRECTOR),
        "q8_top_episodes_of": lambda: M.top_episodes_of(colls.tvSeries, SERIES_TITLE),
        "q9_top_rated": lambda: M.top_rated(colls.movies),
        "q12_search_titles": lambda: M.search_titles(colls.tvSeries, PATTERN),
    }


def _queries_from_tables(cat, colls):
    return {
        "q1_titles_view": lambda: M.build_titles(cat),
        "q2_rating_per_genre": lambda: M.rating_per_genre(colls.movies),
        "q3_actor_importance": lambda: flat.actor_importance(cat),
        "q6_credits_per_person": lambda: flat.credits_per_person(cat),
        "q7_top_series_episodes": lambda: flat.top_series_episodes(cat),
        "q10_episode_runtime_per_series": lambda: flat.episode_runtime_per_series(cat),
        "q11_people_with_titles": lambda: flat.people_with_titles(cat),
        "q4_titles_up_to_credit": lambda: flat.titles_up_to_credit(cat, DIRECTOR),
        "q5_titles_credited": lambda: flat.titles_credited(cat, DIRECTOR),
        "q8_top_episodes_of": lambda: flat.top_episodes_of(cat, SERIES_TITLE),
        "q9_top_rated": lambda: flat.top_rated(cat),
        "q12_search_titles": lambda: flat.search_titles(cat, PATTERN),
    }


def _time(fn, runs: int) -> float:
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    out_base = spark.sparkContext.getCheckpointDir() + "/bench"  # the session's shared folder

    results: dict[str, float] = {}
    derived = catalogue_from_driver_tables(spark, sf_dir)
    written: dict[str, list[str]] = {"catalogue": [], "partitioned": []}

    def fresh(kind: str) -> str:  # every run writes to its own new directory
        path = f"{out_base}/{kind}-{len(written[kind])}"
        written[kind].append(path)
        return path

    results["s4_write_catalogue"] = _time(lambda: M.write_catalogue(derived, fresh("catalogue")), runs)
    cat = M.load_catalogue(spark, written["catalogue"][0], fmt="parquet")
    colls, _ = M.build_collections(cat)  # lazy

    for name, q in _queries_from_tables(cat, colls).items():
        results[name] = _time(lambda: _run(q()), runs)

    results["n5_build_partitioned"] = _time(
        lambda: M.write_partitioned_collections(cat, fresh("partitioned")), runs)
    stored = M.read_partitioned_collections(spark, written["partitioned"][0])
    for name, q in _queries(stored).items():
        results[f"{name}_stored"] = _time(lambda: _run(q()), runs)

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
