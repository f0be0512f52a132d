"""Every registered query against its DuckDB oracle at sf0.01 (row count,
column names, exact multiset of rows), plus result invariants."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from harness.compare import compare, duck

from harness.oracle import ORACLE
from harness.registry import QUERIES

from catalogue_rows import SF001, SF01


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_result_can_be_written(spark, tmp_path, name):
    df = QUERIES[name](spark, SF001)
    names = [c.lower() for c in df.columns]
    assert len(names) == len(set(names)), df.columns
    df.limit(5).write.parquet(str(tmp_path / "out"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF01)
    assert r["columns_match"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["actorName", "overallAvgRating", "totalTitles", "weightedImportance", "pos",
                          "titleType", "avgRating", "numTitles"]


def test_invariants(spark):
    credits = QUERIES["credits_per_person"](spark, SF01)
    assert credits.filter(F.col("movieCount") + F.col("tvSeriesCount") != F.col("overallCount")).count() == 0
    actors = QUERIES["actor_importance"](spark, SF01)
    sums = actors.groupBy("actorName", "totalTitles").agg(F.sum("numTitles").alias("s"))
    assert sums.filter(F.col("s") != F.col("totalTitles")).count() == 0
    assert QUERIES["titles_view"](spark, SF01).count() == 11521  # movies + shorts + series


def test_nest_then_unwind_gives_back_the_credits(spark):
    principals = QUERIES["principals_by_title"](spark, SF001)
    from marquee.sources.fixtures import catalogue_from_driver_tables
    flat_credits = catalogue_from_driver_tables(spark, SF001).title_principals
    assert principals.count() == flat_credits.count()
    back = principals.select("tconst", "ordering", "nconst", "category", "job", "characters")
    assert back.exceptAll(flat_credits).count() == 0 and flat_credits.exceptAll(back).count() == 0
