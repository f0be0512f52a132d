"""Sinks and sources for the nested document collections.

A collection is a DataFrame with nested struct/array columns. The default
store is Parquet: columnar, so a query that touches ``rating.averageRating``
reads that leaf only, and filters on nested fields reach the scan. Any other
Spark data source (``json``, ``orc``, a document-store connector the user has
on the classpath) passes through ``fmt``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, fields

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from marquee.sources.swap import swap_in

FILE_FORMATS = ("parquet", "json", "orc", "avro")


@dataclass(frozen=True)
class Collections:
    movies: DataFrame
    tvSeries: DataFrame
    shorts: DataFrame
    people: DataFrame

    def items(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def write_collection(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partitions: int | None = None,
    partition_by: list[str] | None = None,
    options: dict[str, str] | None = None,
    table: bool = False,
) -> None:
    """Write one collection.

    ``target`` is a path for file formats and ``database.collection`` for a
    connector format. With ``table`` it names a table of the session catalog
    instead (see :func:`write_table`). ``partitions`` repartitions first (round
    robin) to set the number of output files / writer tasks; by default the
    plan's own partitioning is kept.

    Overwriting files writes the new ones beside the old and swaps them in when
    the job has succeeded, so a job that fails, or that reads the collection it
    replaces, leaves it as it was.
    """
    out = df.repartition(partitions) if partitions else df
    if table:
        write_table(out, target, fmt, mode, partition_by, options)
        return
    writer = out.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if options:
        writer = writer.options(**options)
    if fmt not in FILE_FORMATS:
        database, _, collection = target.rpartition(".")
        if database:
            writer = writer.option("database", database)
        writer.option("collection", collection).mode(mode).save()
    elif mode == "overwrite":
        aside = f"{target.rstrip('/')}.new-{uuid.uuid4().hex}"
        writer.mode("error").save(aside)
        swap_in(df.sparkSession, aside, target)
    else:
        writer.mode(mode).save(target)


def replace_partitions(df: DataFrame, target: str, partition_by: list[str], fmt: str = "parquet",
                       options: dict[str, str] | None = None) -> None:
    """Rewrite only those partitions of a stored collection that ``df`` has rows
    of (one title type of ``titles``, say); the files of all others stay as they
    are. New files replace a partition when the whole job has succeeded.

    ``df`` may read the collection it replaces a part of, as Spark stages the
    files; an empty ``df`` changes nothing."""
    df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partition_by).options(**(options or {})).save(target)


def _quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def write_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, options: dict[str, str] | None = None) -> None:
    """Write ``df`` as the table ``database.collection`` of the session catalog.

    The database is made where it is missing. Overwriting writes a folder of its
    own below the database's location and then points the table to it, one
    change in the catalog: readers see all of the old table or all of the new
    one, and a failed job changes nothing. The old folder stays for readers that
    have begun; :func:`drop_old_versions` removes such folders. A table whose
    columns change is made anew. ``mode`` is that of Spark's writer otherwise.
    """
    spark = df.sparkSession
    database, _, collection = name.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    whole, exists = f"{database}.{collection}", spark.catalog.tableExists(f"{database}.{collection}")
    if exists and mode != "overwrite":
        df.write.format(fmt).mode(mode).partitionBy(*(partition_by or [])).options(**(options or {})).saveAsTable(whole)
        return
    place = f"{versions_of(spark, whole)}/{uuid.uuid4().hex}"
    df.write.format(fmt).mode("error").partitionBy(*(partition_by or [])).options(**(options or {})).save(place)
    if exists and _same_layout(spark, whole, df, fmt, partition_by):
        spark.sql(f"ALTER TABLE {_quoted(whole)} SET LOCATION '{place}'")
    else:
        if exists:
            spark.sql(f"DROP TABLE {_quoted(whole)}")
        spark.catalog.createTable(whole, path=place, source=fmt)
    if partition_by:
        spark.catalog.recoverPartitions(whole)
    spark.catalog.refreshTable(whole)


def versions_of(spark: SparkSession, name: str) -> str:
    """The folder that holds the versions of a table written by :func:`write_table`."""
    database, _, collection = name.rpartition(".")
    base = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{base.rstrip('/')}/{collection}.versions"


def _same_layout(spark: SparkSession, name: str, df: DataFrame, fmt: str, partition_by: list[str] | None) -> bool:
    """Whether the table has the columns of ``df``, its format, and no partitions
    (those are in the catalog, and would go on pointing to the old files)."""
    if partition_by or any(c.isPartition for c in spark.catalog.listColumns(name)):
        return False
    rows = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").collect()}
    there = spark.table(name).schema
    return rows.get("Provider", "").lower() == fmt and [(f.name, f.dataType.simpleString()) for f in there] == [
        (f.name, f.dataType.simpleString()) for f in df.schema]


def location_of(spark: SparkSession, name: str) -> str:
    """The folder that a table points to now."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").where("col_name = 'Location'").collect()
    return rows[0].data_type


def drop_old_versions(spark: SparkSession, name: str) -> int:
    """Delete the folders of a table's replaced versions, once nobody reads them;
    gives their number."""
    from marquee.sources.swap import delete, listed

    keep = location_of(spark, name).rstrip("/").rsplit("/", 1)[-1]
    old = [p for p in listed(spark, versions_of(spark, name)) if p.rstrip("/").rsplit("/", 1)[-1] != keep]
    for p in old:
        delete(spark, p)
    return len(old)


def read_collection(spark: SparkSession, target: str, fmt: str = "parquet", schema=None, table: bool = False) -> DataFrame:
    """Read one collection: a path, a connector's ``database.collection``, or with
    ``table`` a table of the session catalog."""
    if table:
        return spark.table(target)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt in FILE_FORMATS:
        return reader.load(target)
    database, _, collection = target.rpartition(".")
    if database:
        reader = reader.option("database", database)
    return reader.option("collection", collection).load()


def write_collections(
    colls: Collections,
    base: str,
    fmt: str = "parquet",
    shared: list[DataFrame] | None = None,
    **kwargs,
) -> None:
    """Write all four collections under ``base``: a folder, or a database of
    tables (``table=True``) or of a connector.

    ``shared`` are sub-plans used by several collections (the nested credits
    of all titles); they are persisted for the duration of the four writes so
    they are computed once, and released after. Persisted blocks lost with an
    executor are recomputed from lineage.
    """
    shared = shared or []
    for df in shared:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, df in colls.items().items():
            target = f"{base}/{name}" if fmt in FILE_FORMATS and not kwargs.get("table") else f"{base}.{name}"
            write_collection(df, target, fmt=fmt, **kwargs)
    finally:
        for df in shared:
            df.unpersist()


def read_collections(spark: SparkSession, base: str, fmt: str = "parquet", table: bool = False) -> Collections:
    names = [f.name for f in fields(Collections)]
    files = fmt in FILE_FORMATS and not table
    return Collections(**{
        n: read_collection(spark, f"{base}/{n}" if files else f"{base}.{n}", fmt, table=table) for n in names
    })
