"""Stored collections for point lookups: rows in the order of a key, small row
groups, Bloom filters, and an index of credits.

A filter on a key column then reads the row groups whose smallest and largest
key enclose the value and whose Bloom filter may hold it; the others are
skipped. Fields inside arrays have no such statistics that a filter on them
could use, so the credits get an index of their own, one row per title, person
and category, in the order of names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.plans.queries import _by_rating
from marquee.sources.collections import Collections, read_collection, write_collection

#: Ids that a lookup pushes into the scan as values; more are joined.
MOST_IDS = 256
#: Values of one IN list that Spark pushes to Parquet one by one
#: (``spark.sql.parquet.pushdown.inFilterThreshold``).
IN_LIST = 10
#: Bytes of a row group: small enough that one key touches little data.
ROW_GROUP = 8 << 20


def write_clustered(df: DataFrame, target: str, keys: Sequence[str], bloom: Sequence[str] = (), partitions: int | None = None,
                    row_group: int = ROW_GROUP, distinct: int = 1_000_000, **kwargs) -> None:
    """Write a collection as Parquet in the order of ``keys``.

    Rows are cut into files by ranges of all keys and sorted within them, so end
    ``keys`` in a unique one: then a value that many rows share spreads over
    files. Columns in ``bloom`` (top level or fields of structs) get Bloom
    filters sized for ``distinct`` values a row group. ``kwargs`` go to
    :func:`write_collection`."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    options = {"parquet.block.size": str(row_group), "parquet.block.row.count.limit": str(max(100, row_group // 256))}
    for c in bloom:
        options |= {f"parquet.bloom.filter.enabled#{c}": "true", f"parquet.bloom.filter.expected.ndv#{c}": str(distinct)}
    write_collection(ordered, target, options=options | kwargs.pop("options", {}), **kwargs)


def credit_index(titles: DataFrame) -> DataFrame:
    """``name, nconst, category, tconst``: who is credited on what, each once."""
    credit = F.explode(F.arrays_zip(*[F.col(f"people.{f}").alias(f) for f in ("name", "nconst", "category")]))
    return titles.select("tconst", credit.alias("p")).select("p.name", "p.nconst", "p.category", "tconst").distinct()


def write_lookup_collections(colls: Collections, base: str, **kwargs) -> None:
    """The four collections and the movies' credit index below ``base``, each in
    the order in which it is looked up: movies and shorts by ``tconst``, series
    by ``title``, people by ``nconst``, credits by ``name``. The index is made of
    the movies as written, so that they are not built again for it."""
    for name, df in (("movies", colls.movies), ("shorts", colls.shorts)):
        write_clustered(df, f"{base}/{name}", ["tconst"], ["tconst", "title"], **kwargs)
    write_clustered(colls.tvSeries, f"{base}/tvSeries", ["title", "tconst"], ["title", "tconst"], **kwargs)
    write_clustered(colls.people, f"{base}/people", ["nconst"], ["nconst", "primaryName"], **kwargs)
    write_clustered(credit_index(read_collection(colls.movies.sparkSession, f"{base}/movies", kwargs.get("fmt", "parquet"))), f"{base}/movieCredits", ["name", "category", "tconst"], ["name", "nconst"], **kwargs)


def read_credit_index(spark: SparkSession, base: str) -> DataFrame:
    return read_collection(spark, f"{base}/movieCredits")


def with_ids(df: DataFrame, ids: DataFrame, key: str = "tconst", most: int = MOST_IDS) -> DataFrame:
    """The rows of ``df`` whose ``key`` is among ``ids`` (its one column).

    Up to ``most`` ids are looked up first and pushed into the scan as values, in
    lists short enough that row groups are skipped by them; more ids than that
    are semi-joined. Either way all matches are given; only ``most`` + 1 ids ever
    reach the driver. Null ids match nothing."""
    ids = ids.where(F.col(ids.columns[0]).isNotNull()).distinct()
    found = sorted(r[0] for r in ids.limit(most + 1).collect())
    if len(found) > most:
        return df.join(ids.withColumnRenamed(ids.columns[0], key), key, "left_semi").select(*df.columns)
    if not found:
        return df.where(F.lit(False))
    lists: list[Column] = [F.col(key).isin(found[i:i + IN_LIST]) for i in range(0, len(found), IN_LIST)]
    return df.where(reduce(lambda a, b: a | b, lists))


def titles_credited_by_index(movies: DataFrame, credits: DataFrame, name: str, category: str = "director",
                             most: int = MOST_IDS) -> DataFrame:
    """Q5 over stored lookup collections: the credit index gives the ids of the
    person's titles, and only row groups that hold them are read of ``movies``;
    no credit array is. Rows are those of ``titles_credited``."""
    ids = credits.where((F.col("name") == name) & (F.col("category") == category)).select("tconst")
    return with_ids(movies.drop("people"), ids, "tconst", most).orderBy(*_by_rating())
