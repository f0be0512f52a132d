"""Named tables, permanent views, and overwrites that a failed job cannot harm."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

import marquee as M
from marquee.plans.collections import build_titles
from marquee.plans.views import create_views, people_with_titles, titles
from marquee.sources import swap
from marquee.sources.collections import (
    drop_old_versions, location_of, read_collections, replace_partitions, write_collection, write_collections,
)
from marquee.sources.fixtures import catalogue_from_driver_tables

from catalogue_rows import SF001


@pytest.fixture(scope="module")
def colls(spark):
    return M.build_collections(catalogue_from_driver_tables(spark, SF001))[0]


@pytest.fixture
def database(spark, tmp_path):
    name = f"catalogue_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _breaking(df):
    """``df`` whose job writes some files and then fails."""
    return df.repartition(4).withColumn("title", F.when(F.spark_partition_id() < 3, F.col("title")).otherwise(
        F.raise_error(F.lit("cut short")).cast("string")))


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


def test_collections_as_tables_by_name(spark, colls, database):
    write_collections(colls, database, table=True)
    assert {t.name.lower() for t in spark.catalog.listTables(database) if not t.isTemporary} == {"movies", "tvseries", "shorts", "people"}
    back = read_collections(spark, database, table=True)
    for name, df in colls.items().items():
        assert _same(df, getattr(back, name)), name
    assert spark.sql(f"SELECT count(*) FROM {database}.movies WHERE rating.averageRating >= 5").first()[0] > 0


def test_tables_take_new_columns_appends_and_partitions(spark, colls, database):
    name = f"{database}.movies"
    for mode, want in (("overwrite", 1), ("append", 2), ("overwrite", 1)):
        write_collection(colls.movies, name, table=True, mode=mode)
        assert spark.table(name).count() == want * colls.movies.count()
    write_collection(colls.movies.withColumn("extra", F.lit(1)), name, table=True)
    assert "extra" in spark.table(name).columns
    write_collection(colls.movies, name, table=True, partition_by=["year"])
    write_collection(colls.movies.where("year > 1995"), name, table=True, partition_by=["year"])
    assert spark.table(name).agg(F.min("year")).first()[0] > 1995
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        write_collection(colls.movies, name, table=True, mode="error")


def test_failed_overwrite_of_a_table_changes_nothing(spark, colls, database):
    name = f"{database}.movies"
    write_collection(colls.movies, name, table=True)
    before = location_of(spark, name)
    with pytest.raises(Exception, match="cut short"):
        write_collection(_breaking(colls.movies), name, table=True)
    assert location_of(spark, name) == before and _same(colls.movies, spark.table(name))


def test_table_replaces_itself_and_drops_old_versions(spark, colls, database):
    name = f"{database}.movies"
    write_collection(colls.movies, name, table=True)
    half = spark.table(name).where("isAdult = 0")
    write_collection(half, name, table=True)  # reads the table that it replaces
    assert _same(colls.movies.where("isAdult = 0"), spark.table(name))
    assert drop_old_versions(spark, name) == 1 and drop_old_versions(spark, name) == 0
    assert _same(colls.movies.where("isAdult = 0"), spark.table(name))


def test_failed_overwrite_of_files_changes_nothing(spark, colls, tmp_path):
    path = str(tmp_path / "movies")
    write_collection(colls.movies, path)
    before = _files(path)
    with pytest.raises(Exception, match="cut short"):
        write_collection(_breaking(colls.movies), path)
    assert _files(path) == before and _same(colls.movies, spark.read.parquet(path))
    write_collection(spark.read.parquet(path).where("isAdult = 0"), path)  # reads the files that it replaces
    assert _same(colls.movies.where("isAdult = 0"), spark.read.parquet(path))
    assert [f for f in os.listdir(tmp_path) if ".old-" in f] == []


def test_swap_is_undone_or_restored(spark, tmp_path):
    old, target = str(tmp_path / "kept"), str(tmp_path / "c")
    spark.range(3).write.parquet(target)
    with pytest.raises(Exception):
        swap.swap_in(spark, str(tmp_path / "missing"), target)  # the new folder is not there
    assert spark.read.parquet(target).count() == 3
    swap.rename(spark, target, f"{target}.old-1")  # a driver lost between the two renames
    assert swap.restore(spark, target) and not swap.restore(spark, target)
    assert spark.read.parquet(target).count() == 3 and swap.listed(spark, old) == []


def test_one_title_type_is_rewritten_alone(spark, tmp_path):
    docs = build_titles(catalogue_from_driver_tables(spark, SF001))
    path = str(tmp_path / "titles")
    write_collection(docs, path, partition_by=["titleType"])
    before = _files(f"{path}/titleType=tvSeries")
    movies = docs.where("titleType = 'movies'").withColumn("title", F.upper("title"))
    with pytest.raises(Exception, match="cut short"):
        replace_partitions(_breaking(movies), path, ["titleType"])
    assert _same(docs, spark.read.parquet(path))
    replace_partitions(movies, path, ["titleType"])
    assert _files(f"{path}/titleType=tvSeries") == before
    assert _same(docs.where("titleType <> 'movies'").unionByName(movies), spark.read.parquet(path))
    replace_partitions(spark.read.parquet(path).where("titleType = 'short' and isAdult = 0"), path, ["titleType"])
    assert _same(docs.where("titleType = 'short' and isAdult = 0"), spark.read.parquet(path).where("titleType = 'short'"))


def test_permanent_views_outlive_the_session(spark, colls, database):
    write_collections(colls, database, table=True)
    create_views(spark, database)
    for name in ("titles", "peopleWithTitles", "movies", "tvSeries", "shorts", "people"):
        spark.catalog.dropTempView(name)
    other = spark.newSession()
    assert other.table(f"{database}.titles").columns == titles(colls).columns
    assert _same(titles(colls), spark.table(f"{database}.titles"))
    assert other.table(f"{database}.peopleWithTitles").columns == people_with_titles(colls).columns
    assert _same(people_with_titles(colls), spark.table(f"{database}.peopleWithTitles"))
    assert other.sql(f"SELECT count(*) FROM {database}.titles").first()[0] == titles(colls).count()
    # a view follows its tables, and a query through it reads only the leaves that it needs
    write_collection(spark.table(f"{database}.shorts").limit(0), f"{database}.shorts", table=True)
    assert spark.table(f"{database}.titles").where("titleType = 'short'").count() == 0
    plan = spark.table(f"{database}.titles").select("rating.averageRating")._jdf.queryExecution().executedPlan().toString()
    assert "people" not in plan.split("ReadSchema")[1]
