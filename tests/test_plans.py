"""Plan checks: pushdown, pruning, shuffle placement, join shapes."""

import pytest

import marquee as M
from marquee.functions.arrays import asc
from marquee.plans import flat
from marquee.sources.fixtures import catalogue_from_driver_tables

from catalogue_rows import SF001


def _plan(df) -> str:
    """The formatted physical plan (node list plus untruncated scan details)."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    cat = catalogue_from_driver_tables(spark, SF001)
    colls, shared = M.build_collections(cat)
    base = str(tmp_path_factory.mktemp("stored"))
    M.write_collections(colls, base, shared=shared)
    return cat, colls, M.read_collections(spark, base)


def test_nested_filters_reach_the_scan(built):
    _, _, stored = built
    plan = _plan(M.top_rated(stored.movies))
    assert "GreaterThanOrEqual(rating.averageRating,9.0)" in plan
    assert "GreaterThanOrEqual(rating.numVotes,1000)" in plan
    assert "TakeOrderedAndProject" in plan


def test_stored_queries_read_only_needed_leaves(built):
    _, _, stored = built
    plan = _plan(M.actor_importance(M.titles(stored)))
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert len(schemas) == 3
    for line in schemas:
        assert "people:array<struct<name:string,category:string>>" in line, line
        assert "rating:struct<averageRating:double>" in line, line
    plan = _plan(M.episode_runtime_per_series(stored.tvSeries))
    assert "episodes:array<struct<runtime:int>>" in plan


def test_credit_test_reads_two_leaves(built):
    _, _, stored = built
    plan = _plan(M.titles_credited(stored.movies, "Person 7"))
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert len(schemas) == 1 and "people:array<struct<name:string,category:string>>" in schemas[0], schemas


def test_no_shuffle_after_series_top_k(built):
    _, colls, _ = built
    plan = _plan(M.top_series_episodes(colls.tvSeries))
    tree = plan[: plan.index("\n\n(")]  # the node tree, before the node details
    top = tree[: tree.index("TakeOrderedAndProject")]
    assert "Exchange" not in top


def test_lookup_in_array_is_an_equi_join(built):
    cat, colls, _ = built
    for df in (M.people_with_titles(colls), flat.people_with_titles(cat)):
        plan = _plan(df)
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_unused_nested_people_are_not_built(built):
    _, colls, _ = built
    # Q2 never reads ``people``: the left join of the credit aggregate is removed.
    assert "ObjectHashAggregate" not in _plan(M.rating_per_genre(colls.movies))


def test_credit_counts_use_hash_aggregation_on_the_credit_stream(built):
    _, _, stored = built
    plan = _plan(M.credits_per_person(stored.movies, stored.tvSeries))
    tree = plan[: plan.index("\n\n(")]
    # node details: partial and final hash aggregates keyed by (person, name); the
    # plan also holds the test catalogue's own aggregates, which are keyed otherwise
    nodes = plan.split("\n\n(")[1:]
    by_person = [n for n in nodes if n.split("\n")[0].split(") ")[1].startswith("HashAggregate")
                 and "Keys [2]: [nconst#" in n and "primaryName#" in n.split("Keys [2]:")[1].split("\n")[0]]
    assert len(by_person) == 2
    # the string ``max`` runs as a sort aggregate only after the per-person partials
    assert tree.count("SortAggregate") == 2


def test_flat_routes_do_not_nest(built):
    cat, _, _ = built
    for df in (flat.actor_importance(cat), flat.credits_per_person(cat), flat.episode_runtime_per_series(cat)):
        assert "Generate" not in _plan(df)


def test_selective_flat_routes_nest_only_what_they_return(built):
    cat, _, _ = built
    for df in (flat.titles_credited(cat, "Person 7"), flat.top_episodes_of(cat, "Series 12")):
        assert "ObjectHashAggregate" not in _plan(df)  # no collect_list at all
    plan = _plan(flat.top_rated(cat))
    tree = plan[: plan.index("\n\n(")]
    # the credits are semi-joined to the broadcast top-k keys before being nested
    assert "BroadcastHashJoin LeftSemi" in tree or "Join LeftSemi" in tree


def test_flat_episode_top_k_limits_before_the_shuffle(built):
    cat, _, _ = built
    tree = _plan(flat.top_series_episodes(cat))
    tree = tree[: tree.index("\n\n(")]
    # the episodes are limited within (series, part) before they meet by series
    assert tree.count("WindowGroupLimit") >= 3


def test_flat_credit_queries_reduce_per_person_before_the_people_join(built):
    import re

    cat, _, _ = built
    for df, keys in ((flat.credits_per_person(cat), r"nconst#\d+L?\]"),
                     (flat.actor_importance(cat), r"nconst#\d+L?\]")):
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        join = next(i for i, line in enumerate(lines) if re.search(r"Join \[nconst#\d+L?\], \[nconst#", line))
        agg = next(i for i, line in enumerate(lines) if re.search(r"HashAggregate\(keys=\[" + keys, line))
        assert join < agg  # the aggregate sits below (feeds) the join with the people table


BIG = 50_000_000


def test_no_broadcast_is_forced(spark, built):
    cat, _, _ = built
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2048")
    try:
        for df in (flat.top_rated(cat, k=BIG), flat.top_series_episodes(cat, n_series=BIG)):
            assert "BroadcastExchange" not in _plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_best_children_ranks_in_parts_whatever_the_limit(built):
    cat, _, _ = built
    rows = cat.title_episode.select("tconst", "parentTconst", "seasonNumber")
    plan = _plan(flat.best_children(rows, "parentTconst", 5000, [asc("seasonNumber"), asc("tconst")]))
    shuffles = [line for line in plan.splitlines() if line.startswith("Arguments: hashpartitioning(parentTconst")]
    assert len(shuffles) == 2 and sum("_bucket" in line for line in shuffles) == 1, shuffles
    got = flat.best_children(rows, "parentTconst", 2, [asc("seasonNumber"), asc("tconst")]).collect()
    by_parent = {}
    for r in sorted(rows.collect(), key=lambda r: (r.parentTconst or "", r.seasonNumber is not None, r.seasonNumber or 0, r.tconst)):
        by_parent.setdefault(r.parentTconst, []).append(r.tconst)
    assert sorted(r.tconst for r in got) == sorted(t for v in by_parent.values() for t in v[:2])


def test_unified_titles_nest_credits_once(built):
    cat, _, _ = built
    plan = _plan(M.build_titles(cat))
    tree = plan[: plan.index("\n\n(")]
    assert tree.count("ObjectHashAggregate") == 4  # credits and episodes, partial and final


def test_search_reads_the_credits(spark):
    from harness.registry import QUERIES
    assert "lineitem" in _plan(QUERIES["search_titles"](spark, SF001))


def test_people_with_titles_drops_ids_of_nobody_first(built):
    cat, _, _ = built
    plan = _plan(flat.people_with_titles(cat))
    tree = plan[: plan.index("\n\n(")]
    assert "LeftSemi" in plan and tree.index("ObjectHashAggregate") < tree.index("Semi" if "Semi" in tree else "Join")
