"""Readers for the five flat catalogue tables (tab-separated text or Parquet)."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.schemas import FILE_NAMES, KEYS, NULL_TOKEN, SCHEMAS


@dataclass(frozen=True)
class Catalogue:
    """The five input tables, as lazy DataFrames."""

    title_basics: DataFrame
    name_basics: DataFrame
    title_episode: DataFrame
    title_principals: DataFrame
    title_ratings: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "tsv") -> DataFrame:
    """Read one catalogue table with its declared schema.

    Text files: tab separator, header line, ``\\N`` as null, and quoting turned
    off, so a field that starts with ``"`` keeps its tabs as separators and its
    quotes as data. A malformed number becomes null (PERMISSIVE). Gzipped
    files are read as they are; they are not splittable, so convert them once
    with :func:`write_catalogue` before repeated use.
    """
    schema = SCHEMAS[name]
    if fmt == "tsv":
        return (
            spark.read.schema(schema)
            .option("sep", "\t")
            .option("header", True)
            .option("nullValue", NULL_TOKEN)
            .option("quote", "")
            .option("mode", "PERMISSIVE")
            .csv(path)
        )
    return spark.read.schema(schema).format(fmt).load(path)


def header_of(name: str) -> str:
    """The first line that a text file of the table must have."""
    return "\t".join(SCHEMAS[name].names)


def files_without_header(spark: SparkSession, name: str, path: str) -> DataFrame:
    """``file``: text files of one table that do not hold its header line, with all
    columns by name and in order. Reading by position would take such a file's
    columns for others without a word."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), (F.col("value") == header_of(name)).alias("is_header"))
    return lines.groupBy("file").agg(F.max("is_header").alias("found")).where(~F.col("found")).select("file")


def read_table_checked(spark: SparkSession, name: str, path: str) -> tuple[DataFrame, DataFrame]:
    """One text table split into kept rows and refused lines.

    Kept rows are those of :func:`read_table`. Refused are lines with a malformed
    number, with too few or too many fields, or without the table's key, as
    ``table, file, line, reason``; nothing is dropped, so kept and refused
    together are all lines but the header. A file without the header line raises
    ``ValueError`` at once. Both results are lazy and parse each line whole, so
    that a row is kept or refused whatever columns a query reads."""
    bad = [r.file for r in files_without_header(spark, name, path).orderBy("file").limit(10).collect()]
    if bad:
        raise ValueError(f"{name}: no header line {header_of(name)!r} in {', '.join(bad)}")
    schema = SCHEMAS[name]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", `_refused` string"
    options = {"sep": "\t", "nullValue": NULL_TOKEN, "quote": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_refused"}
    lines = spark.read.text(path).where(F.col("value") != header_of(name)).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    rows = lines.withColumn("row", F.from_csv("line", ddl, options))
    malformed, no_key = F.col("row._refused").isNotNull(), F.col(f"row.{KEYS[name]}").isNull()
    reason = F.when(malformed, "malformed").when(no_key, "no key")
    kept = rows.where(reason.isNull()).select(*[F.col(f"row.{f.name}").alias(f.name) for f in schema])
    refused = rows.where(reason.isNotNull()).select(F.lit(name).alias("table"), "file", "line", reason.alias("reason"))
    return kept, refused


def load_catalogue_checked(spark: SparkSession, base: str, suffix: str = "") -> tuple[Catalogue, DataFrame]:
    """All five text tables below ``base`` as :func:`load_catalogue` finds them,
    without their refused lines, and those of all tables in one DataFrame."""
    split = {n: read_table_checked(spark, n, f"{base}/{FILE_NAMES[n]}{suffix}") for n in SCHEMAS}
    refused = None
    for _, lines in split.values():
        refused = lines if refused is None else refused.unionByName(lines)
    return Catalogue(**{n: kept for n, (kept, _) in split.items()}), refused


def load_catalogue(spark: SparkSession, base: str, fmt: str = "tsv", suffix: str = "") -> Catalogue:
    """Load all five tables from ``base``.

    Text tables are the files ``<base>/title.basics.tsv`` and so on, with
    ``suffix=".gz"`` their gzipped forms; other formats are read from
    ``<base>/<table name>``. Paths are exact, so a folder that holds both forms
    is read once; a missing file is Spark's PATH_NOT_FOUND error.
    """
    paths = {
        name: (f"{base}/{FILE_NAMES[name]}{suffix}" if fmt == "tsv" else f"{base}/{name}")
        for name in SCHEMAS
    }
    return Catalogue(**{name: read_table(spark, name, p, fmt) for name, p in paths.items()})


def write_catalogue(cat: Catalogue, base: str, partitions: int | None = None) -> None:
    """Persist the catalogue as Parquet (one directory per table).

    Converting compressed text once gives splittable, column-pruned,
    filter-pushed reads for every later job.
    """
    for name, df in cat.tables().items():
        out = df.repartition(partitions) if partitions else df
        out.write.mode("overwrite").parquet(f"{base}/{name}")


def check_keys(cat: Catalogue) -> DataFrame:
    """Count rows with a null key per table (declared non-null, not enforced by readers)."""
    parts = [
        df.select(F.lit(name).alias("table"), F.count_if(F.col(KEYS[name]).isNull()).alias("null_keys"))
        for name, df in cat.tables().items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
