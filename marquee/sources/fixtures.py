"""Derive a full-size catalogue from the driver's TPC-H-style tables.

Mapping: orders become movies, shorts and episodes (by order status),
customers become series, suppliers become people, line items become credits.
The expressions plant nulls, unknown ids, duplicate credits and blanks so that
every edge case of the nesting code appears at every scale. No row is dropped:
ids outside the catalogue (``nx``, ``tx``) plant the unknown ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.sources.tables import Catalogue


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(name) for name, e in exprs.items()])


def number_within(df: DataFrame, key: str, order: Sequence[str], name: str, width: int = 1 << 16) -> DataFrame:
    """``row_number() OVER (PARTITION BY key ORDER BY order)`` as ``name``,
    computed so that no key's rows have to meet in one task.

    A plain window sends every row of a key to one task, so one title holding
    a third of all credits would be numbered by a single task. Here each key
    is cut into buckets ``floor(order[0] / width)``. The bucket only grows
    with the leading sort column, so the buckets of a key follow each other
    in sort order. Rows are numbered within (key, bucket), which shuffles on
    both and spreads a hot key over many tasks. The number of rows of the
    same key in earlier buckets is then added. Those counts come from a
    per-(key, bucket) count with map-side partials, and their running sums
    run over one row per bucket, not per row.

    ``order`` must order a key's rows totally; ``key`` and ``order[0]`` (an
    integer column) must not be null. When its values are distinct within a key, as for the
    credits here, a bucket holds at most ``width`` rows. Everything is a pure
    function of the data, with no partition ids and no sampling, so a task
    re-run after an executor loss computes the same numbers.
    """
    bucket = F.floor(F.col(order[0]) / F.lit(width))
    rows = df.withColumn("_b", bucket)
    local = rows.withColumn("_n", F.row_number().over(Window.partitionBy(key, "_b").orderBy(*order)))
    sizes = rows.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(key).orderBy(F.col("_b").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select(key, "_b", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off"))
    # Joined on the window's own shuffle keys, so the rows are not shuffled again.
    numbered = local.join(offsets, [key, "_b"])
    return numbered.select(*df.columns, (F.col("_n") + F.col("_off")).alias(name))

def title_basics(orders: DataFrame, customer: DataFrame) -> DataFrame:
    from_orders = _select(orders, {
        "tconst": "concat('tt', o_orderkey)",
        "titleType": "CASE o_orderstatus WHEN 'F' THEN 'movie' WHEN 'P' THEN 'short' ELSE 'tvEpisode' END",
        "primaryTitle": "concat('Title ', o_orderkey % 4000)",
        "originalTitle": "concat('Original ', o_orderkey)",
        "isAdult": "CAST(CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS INT)",
        "startYear": "CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INT) END",
        "endYear": "CAST(NULL AS INT)",
        "runtimeMinutes": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(20 + o_orderkey % 160 AS INT) END",
        "genres": "CASE WHEN o_orderkey % 20 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN substr(o_orderpriority, 3)"
                  " ELSE concat(substr(o_orderpriority, 3), ',G', o_orderkey % 7) END",
    })
    from_customers = _select(customer, {
        "tconst": "concat('tc', c_custkey)",
        "titleType": "'tvSeries'",
        "primaryTitle": "concat('Series ', c_custkey % 1400)",
        "originalTitle": "c_name",
        "isAdult": "CAST(0 AS INT)",
        "startYear": "CAST(1950 + c_custkey % 70 AS INT)",
        "endYear": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(1955 + c_custkey % 70 AS INT) END",
        "runtimeMinutes": "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(20 + c_custkey % 60 AS INT) END",
        "genres": "CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE c_mktsegment END",
    })
    return from_orders.unionByName(from_customers)


def name_basics(supplier: DataFrame) -> DataFrame:
    return _select(supplier, {
        "nconst": "concat(CASE WHEN s_suppkey % 17 = 5 THEN 'nx' ELSE 'nm' END, s_suppkey)",
        "primaryName": "concat('Person ', s_suppkey % 95)",
        "birthYear": "CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE CAST(1900 + s_suppkey % 100 AS INT) END",
        "deathYear": "CASE WHEN s_suppkey % 3 = 0 THEN CAST(1980 + s_suppkey % 40 AS INT) ELSE NULL END",
        "primaryProfession": "CASE WHEN s_suppkey % 9 = 0 THEN NULL WHEN s_suppkey % 2 = 0 THEN 'actor'"
                             " ELSE 'actor,director' END",
        "knownForTitles": "CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN s_suppkey % 10 = 1 THEN concat('tt', s_suppkey)"
                          " ELSE concat('tt', s_suppkey * 7, ', tt', s_suppkey * 13, ',tt99999999') END",
    })


def title_episode(orders: DataFrame) -> DataFrame:
    return _select(orders.filter("o_orderstatus NOT IN ('F', 'P')"), {
        "tconst": "concat('tt', o_orderkey)",
        "parentTconst": "CASE WHEN o_orderkey % 100 = 0 THEN NULL WHEN o_custkey % 11 = 0 THEN concat('tx', o_custkey)"
                        " ELSE concat('tc', o_custkey) END",
        "seasonNumber": "CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE CAST(year(o_orderdate) - 1991 AS INT) END",
        "episodeNumber": "CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE CAST(month(o_orderdate) AS INT) END",
    })


def title_principals(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    credits = _select(lineitem, {
        "tconst": "concat('tt', l_orderkey)",
        "a": "CAST(l_linenumber AS BIGINT)",
        "b": "l_partkey",
        "d": "l_suppkey",
        "nconst": "concat('nm', l_suppkey)",
        "c": "l_partkey % 5",
    }).unionByName(_select(orders, {
        "tconst": "concat(CASE WHEN o_orderkey % 4 = 0 THEN 'tc' ELSE 'tx' END, o_custkey)",
        "a": "o_orderkey",
        "b": "CAST(0 AS BIGINT)",
        "d": "CAST(0 AS BIGINT)",
        "nconst": "concat('nm', o_orderkey % 100)",
        "c": "o_orderkey % 5",
    }))
    # Credit order within a title: row_number over (a, b, d), split over many tasks for a hot title.
    numbered = number_within(credits, "tconst", ["a", "b", "d"], "_rn")
    return numbered.select(
        "tconst",
        F.col("_rn").cast("int").alias("ordering"),
        "nconst",
        F.expr("CASE c WHEN 0 THEN 'actor' WHEN 1 THEN 'actress' WHEN 2 THEN 'director'"
               " WHEN 3 THEN 'writer' ELSE 'producer' END").alias("category"),
        F.expr("CASE c WHEN 3 THEN 'screenplay' ELSE NULL END").alias("job"),
        F.expr("CASE WHEN c < 2 THEN concat('[\"Role ', nconst, '\"]') ELSE NULL END").alias("characters"),
    )


def title_ratings(orders: DataFrame, customer: DataFrame) -> DataFrame:
    return _select(orders, {
        "tconst": "concat(CASE WHEN o_orderkey % 5 = 0 THEN 'tx' ELSE 'tt' END, o_orderkey)",
        "averageRating": "CAST(10 + o_orderkey * 7919 % 91 AS DOUBLE) / 10",
        "numVotes": "CAST(o_orderkey * 104729 % 20000 AS INT)",
    }).unionByName(_select(customer, {
        "tconst": "concat(CASE WHEN c_custkey % 5 = 0 THEN 'txc' ELSE 'tc' END, c_custkey)",
        "averageRating": "CAST(10 + c_custkey * 7919 % 91 AS DOUBLE) / 10",
        "numVotes": "CAST(c_custkey * 104729 % 20000 AS INT)",
    }))


def catalogue_from_driver_tables(spark: SparkSession, sf_dir: str) -> Catalogue:
    orders = _read(spark, sf_dir, "orders")
    customer = _read(spark, sf_dir, "customer")
    return Catalogue(
        title_basics=title_basics(orders, customer),
        name_basics=name_basics(_read(spark, sf_dir, "supplier")),
        title_episode=title_episode(orders),
        title_principals=title_principals(_read(spark, sf_dir, "lineitem"), orders),
        title_ratings=title_ratings(orders, customer),
    )
