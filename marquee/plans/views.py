"""Views over the collections: ``titles`` (all title documents in one shape)
and ``peopleWithTitles`` (each person with every title crediting them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.arrays import concat_arrays
from marquee.operators.nesting import attach_grouped, invert_array, lookup_in_array
from marquee.operators.sets import union_with
from marquee.sources.collections import Collections

# The tag each collection carries in the ``titles`` view.
VIEW_TAGS = {"tvSeries": "tvSeries", "shorts": "short", "movies": "movies"}


def _as_series_shape(df: DataFrame, tag: str) -> DataFrame:
    """``year`` becomes ``startYear``, plus the ``titleType`` tag."""
    if "year" in df.columns:
        df = df.withColumn("startYear", F.col("year")).drop("year")
    return df.withColumn("titleType", F.lit(tag))


def titles(colls: Collections) -> DataFrame:
    """Q1: series, then shorts, then movies, in the series' shape; ``endYear``
    and ``episodes`` are null for shorts and movies. Union only: no shuffle."""
    series = _as_series_shape(colls.tvSeries, VIEW_TAGS["tvSeries"])
    shorts = _as_series_shape(colls.shorts, VIEW_TAGS["shorts"])
    movies = _as_series_shape(colls.movies, VIEW_TAGS["movies"])
    return union_with(series, shorts, movies).select(*series.columns)


def people_with_titles(colls: Collections) -> DataFrame:
    """Q11: people plus ``allTitles[]`` = movies, then series, then shorts
    whose ``people`` contain the person (each title once, by tconst within a
    collection); people with no title get ``[]``.

    A per-person scan of every collection becomes one inverted index over the
    credit arrays and one equi join on ``nconst``.
    """
    def fields(df: DataFrame, year_col: str, has_end: bool) -> list:
        return [
            F.col("tconst"),
            F.col("title"),
            F.col(year_col).alias("startYear"),
            (F.col("endYear") if has_end else F.lit(None).cast("int")).alias("endYear"),
        ]

    sources = [
        (colls.movies, "people.nconst", fields(colls.movies, "year", False)),
        (colls.tvSeries, "people.nconst", fields(colls.tvSeries, "startYear", True)),
        (colls.shorts, "people.nconst", fields(colls.shorts, "year", False)),
    ]
    return lookup_in_array(colls.people, "nconst", sources, "allTitles", order_by=["tconst"])


def people_with_titles_over(people: DataFrame, all_titles: DataFrame) -> DataFrame:
    """Q11 over the unified ``titles`` documents: the same rows as over the
    three collections, with the credits nested once."""
    rank = F.create_map(*[F.lit(x) for kv in {"movies": 0, "tvSeries": 1, "short": 2}.items() for x in kv])
    fields = [rank[F.col("titleType")].alias("_src"), F.col("tconst"), F.col("title"), F.col("startYear"), F.col("endYear")]
    pairs = invert_array(all_titles, "people.nconst", fields, "nconst")
    return attach_grouped(people, "nconst", pairs, "allTitles", ["tconst"])


def people_with_title_lists(colls: Collections) -> DataFrame:
    """Q11 as separate lists per collection (``movieTitles``, ``seriesTitles``,
    ``shortTitles``) joined into ``allTitles``."""
    out = colls.people
    lists = []
    for name, df, year, end in (("movieTitles", colls.movies, "year", None), ("seriesTitles", colls.tvSeries, "startYear", "endYear"),
                                ("shortTitles", colls.shorts, "year", None)):
        end_year = (F.col(end) if end else F.lit(None).cast("int")).alias("endYear")
        fields = [F.col("tconst"), F.col("title"), F.col(year).alias("startYear"), end_year]
        out = lookup_in_array(out, "nconst", [(df, "people.nconst", fields)], name, order_by=["tconst"])
        lists.append(name)
    return out.withColumn("allTitles", concat_arrays(*lists)).drop(*lists)


def register_views(spark: SparkSession, colls: Collections) -> None:
    """Expose the collections and both views to SQL as temp views."""
    for name, df in colls.items().items():
        df.createOrReplaceTempView(name)
    titles(colls).createOrReplaceTempView("titles")
    people_with_titles(colls).createOrReplaceTempView("peopleWithTitles")


def create_views(spark: SparkSession, database: str) -> None:
    """Permanent views ``titles`` and ``peopleWithTitles`` in ``database``, over
    its tables ``movies``, ``tvSeries``, ``shorts`` and ``people`` (as
    ``write_collections(..., table=True)`` writes them).

    They live in the session catalog: any session that shares it reads them by
    name, with the rows and columns of :func:`titles` and
    :func:`people_with_titles`, and sees what the tables hold then. Catalyst
    plans through them, so a query reads only the leaves that it needs. Views that
    exist are replaced."""
    db = f"`{database}`"
    series = spark.table(f"{database}.tvSeries").columns

    def shaped(table: str, tag: str) -> str:
        there = spark.table(f"{database}.{table}").columns
        cols = ["year AS startYear" if c == "startYear" and "year" in there else c if c in there else f"NULL AS {c}" for c in series]
        return f"SELECT {', '.join(cols)}, '{tag}' AS titleType FROM {db}.{table}"

    parts = " UNION ALL ".join(shaped(t, VIEW_TAGS[t]) for t in ("tvSeries", "shorts", "movies"))
    spark.sql(f"CREATE OR REPLACE VIEW {db}.titles AS {parts}")

    def pairs(rank: int, table: str, year: str, end: str) -> str:
        return (f"SELECT explode(array_distinct(people.nconst)) AS nconst, {rank} AS source, tconst, title, {year} AS startYear, "
                f"{end} AS endYear FROM {db}.{table}")

    rows = " UNION ALL ".join((pairs(0, "movies", "year", "CAST(NULL AS INT)"), pairs(1, "tvSeries", "startYear", "endYear"),
                               pairs(2, "shorts", "year", "CAST(NULL AS INT)")))
    spark.sql(f"""
        CREATE OR REPLACE VIEW {db}.peopleWithTitles AS
        WITH pairs AS ({rows}),
        known AS (SELECT * FROM pairs WHERE nconst IS NOT NULL AND nconst IN (SELECT nconst FROM {db}.people)),
        grouped AS (
          SELECT nconst AS id, transform(sort_array(collect_set(struct(source, tconst, title, startYear, endYear))),
            x -> struct(x.tconst AS tconst, x.title AS title, x.startYear AS startYear, x.endYear AS endYear)) AS allTitles
          FROM known GROUP BY nconst)
        SELECT p.*, coalesce(g.allTitles, CAST(array() AS ARRAY<STRUCT<tconst: STRING, title: STRING, startYear: INT, endYear: INT>>)) AS allTitles
        FROM {db}.people p LEFT JOIN grouped g ON p.nconst = g.id""")
