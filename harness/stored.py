"""Registered queries over stored collections: named tables, permanent views and
lookup collections, written for the run to the folder that the session shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

import marquee as M
from marquee.plans.collections import principals_by_title
from marquee.plans.views import create_views
from marquee.sources.collections import Collections, read_collections, write_collections
from marquee.sources.fixtures import catalogue_from_driver_tables
from marquee.sources.schemas import FILE_NAMES, NULL_TOKEN
from marquee.sources.tables import read_table_checked
from marquee.sources.lookups import read_credit_index, titles_credited_by_index, write_lookup_collections


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; only where the session names
    none, below a temporary one that becomes its checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-ckpt-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/marquee/{uuid.uuid4().hex}"


def _collections(spark: SparkSession, sf_dir: str) -> tuple[Collections, list[DataFrame]]:
    return M.build_collections(catalogue_from_driver_tables(spark, sf_dir))


def named_collections(spark: SparkSession, sf_dir: str) -> str:
    """The four collections as tables of a new database, with permanent views;
    its name."""
    database = f"marquee_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(spark)}'")
    colls, shared = _collections(spark, sf_dir)
    write_collections(colls, database, shared=shared, table=True)
    create_views(spark, database)
    return database


def named_view(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    return spark.table(f"{named_collections(spark, sf_dir)}.{view}")


def lookup_collections(spark: SparkSession, sf_dir: str) -> tuple[Collections, DataFrame]:
    """The collections in lookup order, read back, and the credit index. The
    credits are nested once for all of them."""
    base = shared_folder(spark)
    colls, _ = M.build_collections(catalogue_from_driver_tables(spark, sf_dir), cut_lineage=True)
    write_lookup_collections(colls, base)
    return read_collections(spark, base), read_credit_index(spark, base)


def titles_credited_indexed(spark: SparkSession, sf_dir: str, name: str, category: str) -> DataFrame:
    colls, credits = lookup_collections(spark, sf_dir)
    return titles_credited_by_index(colls.movies, credits, name, category)


def top_episodes_clustered(spark: SparkSession, sf_dir: str, title: str) -> DataFrame:
    return M.top_episodes_of(lookup_collections(spark, sf_dir)[0].tvSeries, title)


def titles_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The titles written as a text table with its header, and read back with its
    lines checked; refused lines, of which there are none, would be null rows."""
    path = f"{shared_folder(spark)}/{FILE_NAMES['title_basics']}"
    titles = catalogue_from_driver_tables(spark, sf_dir).title_basics
    titles.write.options(sep="\t", header=True, nullValue=NULL_TOKEN, quote="", emptyValue="").csv(path)
    kept, refused = read_table_checked(spark, "title_basics", path)
    return kept.unionByName(refused.select(), allowMissingColumns=True)


def principals_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return principals_by_title(catalogue_from_driver_tables(spark, sf_dir), salted=True)


def people_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.people_collection(catalogue_from_driver_tables(spark, sf_dir), salted=True)
