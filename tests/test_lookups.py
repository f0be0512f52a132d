"""Lookup collections: fewer rows read, the same answers."""

import pytest
from pyspark.sql import functions as F

import marquee as M
from marquee.plans.collections import build_collections
from marquee.sources.collections import read_collections
from marquee.sources.fixtures import catalogue_from_driver_tables
from marquee.sources.lookups import credit_index, read_credit_index, titles_credited_by_index, with_ids, write_lookup_collections

from catalogue_rows import SF01


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """(plainly written collections, lookup collections, credit index)"""
    base = str(tmp_path_factory.mktemp("lookups"))
    colls, shared = build_collections(catalogue_from_driver_tables(spark, SF01))
    M.write_collections(colls, f"{base}/plain", shared=shared)
    plain = read_collections(spark, f"{base}/plain")
    write_lookup_collections(plain, f"{base}/lookup", partitions=4, row_group=25_600, distinct=1000)
    return plain, read_collections(spark, f"{base}/lookup"), read_credit_index(spark, f"{base}/lookup")


@pytest.fixture
def scanned(spark):
    """Rows of a query, and how many rows its scans gave."""
    saved = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")

    def run(df):
        rows = df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        return rows, sum(s.metrics().apply("numOutputRows").value() for s in scans if "FileSourceScan" in s.getClass().getName())

    yield run
    spark.conf.set("spark.sql.adaptive.enabled", saved)


def _same(a, b):
    return a.exceptAll(b.select(*a.columns)).count() == 0 and b.select(*a.columns).exceptAll(a).count() == 0


def test_collections_are_equal(stored):
    plain, lookup, credits = stored
    for name, df in plain.items().items():
        assert _same(df, getattr(lookup, name)), name
    assert _same(credit_index(plain.movies), credits)


@pytest.mark.parametrize("title", ["Series 12", "Series 777", "No such series"])
def test_q8_reads_the_row_groups_of_its_title(stored, scanned, title):
    plain, lookup, _ = stored
    want, all_rows = scanned(M.top_episodes_of(plain.tvSeries, title))
    got, few_rows = scanned(M.top_episodes_of(lookup.tvSeries, title))
    assert got == want
    assert few_rows <= 200  # two row groups of 100 at most
    assert all_rows == plain.tvSeries.count() > 1000 or not want


def test_q5_reads_the_row_groups_of_its_ids(spark, stored, scanned):
    plain, lookup, credits = stored
    few = credits.where("category = 'director'").groupBy("name").count().where("count < 30").orderBy("count", "name").first().name
    want, all_rows = scanned(M.titles_credited(plain.movies, few))
    got, few_rows = scanned(titles_credited_by_index(lookup.movies, credits, few))
    assert got == want and 0 < len(got)
    # a sorted result scans twice (ranges, then rows); one row group of 100 per id at most
    assert all_rows == 2 * plain.movies.count() and few_rows <= 2 * 100 * (len(got) + 1) < all_rows
    ids, index_rows = scanned(credits.where((F.col("name") == few) & (F.col("category") == "director")).select("tconst"))
    assert len(ids) == len(got) and index_rows < credits.count() / 4
    for none in ("Person X", None):
        assert titles_credited_by_index(lookup.movies, credits, none).collect() == []


def test_bloom_filters_skip_what_statistics_cannot(spark, stored, scanned):
    """Movies lie in the order of ``tconst``, so every row group spans the titles."""
    plain, lookup, _ = stored
    title = plain.movies.groupBy("title").count().orderBy("count", "title").first().title
    hit, rows = scanned(lookup.movies.where(F.col("title") == title).select("tconst"))
    want, all_rows = scanned(plain.movies.where(F.col("title") == title).select("tconst"))
    assert sorted(hit) == sorted(want) != [] and all_rows == plain.movies.count() and rows < all_rows / 4
    assert scanned(lookup.movies.where("title = 'Title X'").select("tconst"))[1] <= 200


@pytest.mark.parametrize("most", [0, 3, 1000])
def test_any_number_of_ids(spark, stored, most):
    _, lookup, credits = stored
    ids = credits.where("category = 'actor'").select("tconst").unionAll(spark.sql("SELECT CAST(NULL AS STRING)"))
    want = lookup.movies.join(ids.distinct(), "tconst", "left_semi")
    assert _same(want, with_ids(lookup.movies, ids.limit(ids.count()), most=most))
    assert with_ids(lookup.movies, ids.limit(0), most=most).count() == 0


def test_credits_are_nested_once_for_all_lookup_collections(spark, monkeypatch):
    from harness import stored
    from marquee.sources import lookups

    plans, write = {}, lookups.write_clustered

    def noted(df, target, *args, **kwargs):
        plans[target.rsplit("/", 1)[-1]] = df._jdf.queryExecution().optimizedPlan().toString()
        write(df, target, *args, **kwargs)

    monkeypatch.setattr(lookups, "write_clustered", noted)
    stored.lookup_collections(spark, "/root/testdata/sf0.001")
    # credits are numbered by a window, before they are nested: the stored ones are read
    assert {"movies", "shorts", "tvSeries", "people", "movieCredits"} <= plans.keys()
    assert not [name for name, plan in plans.items() if "Window" in plan]
    assert "Join" not in plans["movieCredits"]
