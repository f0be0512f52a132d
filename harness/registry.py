"""Registered queries: each runs the library on the catalogue derived from
the driver's tables at ``sf_dir`` and returns a flat DataFrame.

Nested results are flattened with ``posexplode_outer`` so element order is
checked too (``pos`` is the 0-based index; null when the array is null or
empty). Scalar lists become their comma-joined text. Where two arrays of a
document are checked at once, each becomes a digest of all its elements in
order. Averages come from exact sums and are compared as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import marquee as M
from harness import stored
from marquee.functions.arrays import top_k_elements
from marquee.plans.collections import PEOPLE_FIELDS, principals_by_title, title_collection, title_rows, with_episodes
from marquee.plans import flat
from marquee.plans.queries import EPISODE_RANK, credits_per_person_over, rating_per_genre_of_doubles
from marquee.plans.views import people_with_title_lists, people_with_titles_over
from marquee.sources.collections import Collections
from marquee.sources.fixtures import catalogue_from_driver_tables

# Parameters of the parameterised queries, as run by the check.
DIRECTOR = "Person 7"
SERIES_TITLE = "Series 12"
SEARCH_PATTERN = "SERIES 12"

TITLE_SCALARS = ["tconst", "title", "originalTitle", "isAdult"]


def _colls(spark: SparkSession, sf_dir: str) -> Collections:
    return M.build_collections(catalogue_from_driver_tables(spark, sf_dir))[0]


def _digest(arr: str, fields: list[str]) -> Column:
    """md5 over all fields of all elements in order; null for a null array."""
    def text(e: Column) -> Column:
        parts = []
        for f in fields:
            x = e
            for name in f.split("."):
                x = x[name]
            parts.append(F.coalesce(x.cast("string"), F.lit("~")))
        return F.concat_ws("|", *parts)

    return F.when(F.size(arr) > 0, F.md5(F.array_join(F.transform(arr, text), ";"))).alias(f"{arr}_md5")


EPISODE_PATHS = ["Title", "isAdult", "year", "runtime", "ordering.Season", "ordering.Episode", "rating.numVotes",
                 "rating.averageRating"]


def _contents() -> list[Column]:
    """Sizes and digests of a document's ``people`` and ``episodes``."""
    return [_size("people").alias("people_count"), _digest("people", PEOPLE_FIELDS),
            _size("episodes").alias("episode_count"), _digest("episodes", EPISODE_PATHS)]


def _joined(c: str) -> Column:
    return F.array_join(F.col(c), ",").alias(c)


def _size(c: str) -> Column:
    """Array length, null for a null array whatever ``sizeOfNull`` says."""
    return F.when(F.col(c).isNotNull(), F.size(c))


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.build_titles(catalogue_from_driver_tables(spark, sf_dir))


def _rating() -> list[Column]:
    return [F.col("rating.numVotes").alias("numVotes"), F.col("rating.averageRating").alias("averageRating")]


def _explode(df: DataFrame, keep: list, arr: str, fields: list[Column]) -> DataFrame:
    """``keep`` columns, ``pos`` and ``fields`` of each element (as ``e``)."""
    base = df.select(*keep, F.posexplode_outer(arr).alias("pos", "e"))
    kept = [c for c in base.columns if c not in ("pos", "e")]
    return base.select(*kept, "pos", *fields)


def people_cols() -> list[Column]:
    return [F.col(f"e.{f}").alias(f) for f in PEOPLE_FIELDS]


def episode_cols() -> list[Column]:
    return [
    F.col("e.Title").alias("ep_title"),
    F.col("e.isAdult").alias("ep_isAdult"),
    F.col("e.year").alias("ep_year"),
    F.col("e.runtime").alias("runtime"),
    F.col("e.ordering.Season").alias("Season"),
    F.col("e.ordering.Episode").alias("Episode"),
    F.col("e.rating.numVotes").alias("ep_numVotes"),
    F.col("e.rating.averageRating").alias("ep_averageRating"),
    ]


def _short_doc_cols() -> list:
    return [*TITLE_SCALARS, "year", "runtimeMinutes", _joined("genres"), *_rating()]


def _series_doc_cols() -> list:
    return [*TITLE_SCALARS, "startYear", "endYear", "runtimeMinutes", _joined("genres"), *_rating()]


# ---------------------------------------------------------------- collections

def q_principals_by_title(spark, sf_dir, salted: bool = False):
    people = stored.principals_salted(spark, sf_dir) if salted else principals_by_title(catalogue_from_driver_tables(spark, sf_dir))
    return _explode(people, ["tconst"], "people", people_cols())


def q_principals_in_parts(spark, sf_dir):
    """Titles with more than one in 16,384 of all credits are put together from parts."""
    people = principals_by_title(catalogue_from_driver_tables(spark, sf_dir), in_parts=16_384)
    return _explode(people, ["tconst"], "people", people_cols())


def _title_docs(type_: str):
    def run(spark, sf_dir):
        df = title_collection(catalogue_from_driver_tables(spark, sf_dir), type_)
        return _explode(df, _short_doc_cols(), "people", people_cols())
    return run


def q_tv_series(spark, sf_dir):
    return _explode(_colls(spark, sf_dir).tvSeries, _series_doc_cols(), "episodes", episode_cols())


def q_tv_series_people(spark, sf_dir):
    series = title_collection(catalogue_from_driver_tables(spark, sf_dir), "tvSeries")
    return _explode(series, ["tconst"], "people", people_cols())


def q_people(spark, sf_dir, salted: bool = False):
    df = stored.people_salted(spark, sf_dir) if salted else _colls(spark, sf_dir).people
    keep = ["nconst", "primaryName", "birthYear", "deathYear", _joined("primaryProfession")]
    return _explode(df, keep, "mainTitles",
                    [F.col("e.tconst").alias("tconst"), F.col("e.title").alias("title"), F.col("e.year").alias("year")])


# ---------------------------------------------------------------- views

def _view_cols(t: DataFrame) -> DataFrame:
    return t.select(
        "tconst", "titleType", "title", "originalTitle", "isAdult", "startYear", "endYear", "runtimeMinutes",
        _joined("genres"), *_rating(), *_contents(),
    )


def q_titles_view(spark, sf_dir):
    """Q1, all titles built at once: one credit aggregation."""
    return _view_cols(_titles(spark, sf_dir))


def q_titles_view_from_tables(spark, sf_dir):
    """Q1 as the three collections split off that build and put together again."""
    movies, series, shorts = M.split_titles(_titles(spark, sf_dir))
    return _view_cols(M.titles(Collections(movies, series, shorts, series)))


def q_view_titles_sql(spark, sf_dir):
    """S9, S10: the view by name, in SQL."""
    M.register_views(spark, _colls(spark, sf_dir))
    return _view_cols(spark.table("titles"))


def q_people_with_titles(spark, sf_dir, from_tables: bool = False):
    cat = catalogue_from_driver_tables(spark, sf_dir)
    if from_tables:
        return _people_titles(flat.people_with_titles(cat))
    return _people_titles(people_with_titles_over(M.people_collection(cat), M.build_titles(cat)))


def q_people_with_title_lists(spark, sf_dir):
    """Q11 over the collections, as one list per collection concatenated."""
    return _people_titles(people_with_title_lists(_colls(spark, sf_dir)))


def q_people_with_titles_of_collections(spark, sf_dir):
    """Q11 over the three collections."""
    return _people_titles(M.people_with_titles(_colls(spark, sf_dir)))


def _people_titles(df: DataFrame) -> DataFrame:
    keep = ["nconst", "primaryName", "birthYear", "deathYear", _joined("primaryProfession")]
    return _explode(df, keep, "allTitles", [F.col(f"e.{f}").alias(f) for f in ("tconst", "title", "startYear", "endYear")])


# ---------------------------------------------------------------- queries

def q_rating_per_genre(spark, sf_dir):
    df = M.rating_per_genre(_colls(spark, sf_dir).movies)
    return df.select("genre", "avgRating", "totalMovies")


def q_rating_per_genre_of_doubles(spark, sf_dir):
    """A4, A6 over the ratings as doubles, in bins of exact whole numbers."""
    return rating_per_genre_of_doubles(_colls(spark, sf_dir).movies)


def _actor_importance(by: str, from_tables: bool = False):
    def run(spark, sf_dir):
        if from_tables:
            df = flat.actor_importance(catalogue_from_driver_tables(spark, sf_dir), k=10, by=by)
        else:
            df = M.actor_importance(_titles(spark, sf_dir), k=10, by=by)
        return _explode(df, ["actorName", "overallAvgRating", "totalTitles", "weightedImportance"],
                        "perTitleType",
                        [F.col("e.titleType").alias("titleType"), F.col("e.avgRating").alias("avgRating"),
                         F.col("e.numTitles").alias("numTitles")])
    return run


def q_titles_up_to_credit(spark, sf_dir, from_tables: bool = False):
    if from_tables:
        df = flat.titles_up_to_credit(catalogue_from_driver_tables(spark, sf_dir), DIRECTOR, "director")
    else:
        df = M.titles_up_to_credit(_colls(spark, sf_dir).movies, DIRECTOR, "director")
    return _explode(df, ["tconst", "title", *_rating()], "people", people_cols())


def q_titles_credited(spark, sf_dir, from_tables: bool = False):
    if from_tables:
        df = flat.titles_credited(catalogue_from_driver_tables(spark, sf_dir), DIRECTOR, "director")
    else:
        df = M.titles_credited(_colls(spark, sf_dir).movies, DIRECTOR, "director")
    return df.select(*_short_doc_cols())


def q_credits_per_person(spark, sf_dir, from_tables: bool = False):
    if from_tables:
        df = flat.credits_per_person(catalogue_from_driver_tables(spark, sf_dir))
    else:
        df = credits_per_person_over(_titles(spark, sf_dir))
    return df.select("nconst", "primaryName", "movieCount", "tvSeriesCount", "overallCount", "avgRating")


def q_top_series_episodes(spark, sf_dir, from_tables: bool = False):
    if from_tables:
        df = flat.top_series_episodes(catalogue_from_driver_tables(spark, sf_dir))
    else:
        df = M.top_series_episodes(_colls(spark, sf_dir).tvSeries)
    return _explode(df, _series_doc_cols(), "episodes", episode_cols())


def q_top_episodes_of(spark, sf_dir, from_tables: bool = False):
    if from_tables:
        return flat.top_episodes_of(catalogue_from_driver_tables(spark, sf_dir), SERIES_TITLE)
    return M.top_episodes_of(_colls(spark, sf_dir).tvSeries, SERIES_TITLE)


def q_top_rated(spark, sf_dir, from_tables: bool = False):
    if from_tables:
        df = flat.top_rated(catalogue_from_driver_tables(spark, sf_dir))
    else:
        df = M.top_rated(_colls(spark, sf_dir).movies)
    return _explode(df, _short_doc_cols(), "people", people_cols())


def q_episode_runtime_per_series(spark, sf_dir, from_tables: bool = False):
    if from_tables:
        df = flat.episode_runtime_per_series(catalogue_from_driver_tables(spark, sf_dir))
    else:
        df = M.episode_runtime_per_series(_colls(spark, sf_dir).tvSeries)
    return df.select("title", "avgEpisodeRuntime", "episodeCount")


def q_search_titles(spark, sf_dir, from_tables: bool = False):
    if from_tables:
        df = flat.search_titles(catalogue_from_driver_tables(spark, sf_dir), SEARCH_PATTERN)
    else:
        df = M.search_titles(_colls(spark, sf_dir).tvSeries, SEARCH_PATTERN)
    return df.select(*_series_doc_cols(), *_contents())


def q_credits_per_person_of_collections(spark, sf_dir):
    """Q6 over the movies and series collections."""
    colls = _colls(spark, sf_dir)
    df = M.credits_per_person(colls.movies, colls.tvSeries)
    return df.select("nconst", "primaryName", "movieCount", "tvSeriesCount", "overallCount", "avgRating")


def q_movies_characters_list(spark, sf_dir):
    """C18: credits with their characters parsed into lists."""
    cat = catalogue_from_driver_tables(spark, sf_dir)
    rows = title_rows(cat, "movie")
    people = principals_by_title(cat, titles=rows, characters_as_list=True)
    characters = F.array_join("e.characters", "|").alias("characters")
    return _explode(title_collection(cat, "movie", people, rows), ["tconst"], "people",
                    [F.col("e.ordering").alias("ordering"), F.col("e.nconst").alias("nconst"), characters])


# ---------------------------------------------------------------- stored collections

def q_titles_named_view(spark, sf_dir):
    """S6-S10: the permanent view over tables of the catalog, by name."""
    return _view_cols(stored.named_view(spark, sf_dir, "titles"))


def q_people_with_titles_named_view(spark, sf_dir):
    return _people_titles(stored.named_view(spark, sf_dir, "peopleWithTitles"))


def q_titles_credited_indexed(spark, sf_dir):
    """Q5 by the credit index and the ids that it gives."""
    return stored.titles_credited_indexed(spark, sf_dir, DIRECTOR, "director").select(*_short_doc_cols())


def q_top_episodes_of_clustered(spark, sf_dir):
    """Q8 over series stored in the order of their titles."""
    return stored.top_episodes_clustered(spark, sf_dir, SERIES_TITLE)


# ---------------------------------------------------------------- single operators

def q_top_k_elements(spark, sf_dir):
    """T5 over every series (no series limit): its 3 best episodes."""
    series = _colls(spark, sf_dir).tvSeries
    df = series.select("tconst", top_k_elements("episodes", 3, *EPISODE_RANK).alias("episodes"))
    return _explode(df, ["tconst"], "episodes", episode_cols())


def q_episodes_by_season(spark, sf_dir):
    """N3 with episodes ordered by season and episode number."""
    cat = catalogue_from_driver_tables(spark, sf_dir)
    series = with_episodes(title_collection(cat, "tvSeries"), cat, order_by="season_episode")
    return _explode(series, ["tconst"], "episodes", episode_cols())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "principals_by_title": q_principals_by_title,
    "movies": _title_docs("movie"),
    "shorts": _title_docs("short"),
    "tv_series": q_tv_series,
    "tv_series_people": q_tv_series_people,
    "people": q_people,
    "titles_view": q_titles_view,
    "people_with_titles": q_people_with_titles,
    "rating_per_genre": q_rating_per_genre,
    "actor_importance": _actor_importance("name"),
    "actor_importance_by_id": _actor_importance("nconst"),
    "titles_up_to_credit": q_titles_up_to_credit,
    "titles_credited": q_titles_credited,
    "credits_per_person": q_credits_per_person,
    "top_series_episodes": q_top_series_episodes,
    "top_episodes_of": q_top_episodes_of,
    "top_rated": q_top_rated,
    "episode_runtime_per_series": q_episode_runtime_per_series,
    "search_titles": q_search_titles,
    "top_k_elements": q_top_k_elements,
    "actor_importance_from_tables": _actor_importance("name", from_tables=True),
    "credits_per_person_from_tables": lambda spark, sf_dir: q_credits_per_person(spark, sf_dir, True),
    "people_with_titles_from_tables": lambda spark, sf_dir: q_people_with_titles(spark, sf_dir, True),
    "top_series_episodes_from_tables": lambda spark, sf_dir: q_top_series_episodes(spark, sf_dir, True),
    "titles_view_from_tables": q_titles_view_from_tables,
    "view_titles_sql": q_view_titles_sql,
    "movies_characters_list": q_movies_characters_list,
    "people_with_title_lists": q_people_with_title_lists,
    "people_with_titles_of_collections": q_people_with_titles_of_collections,
    "credits_per_person_of_collections": q_credits_per_person_of_collections,
    "titles_up_to_credit_from_tables": lambda spark, sf_dir: q_titles_up_to_credit(spark, sf_dir, True),
    "titles_credited_from_tables": lambda spark, sf_dir: q_titles_credited(spark, sf_dir, True),
    "top_episodes_of_from_tables": lambda spark, sf_dir: q_top_episodes_of(spark, sf_dir, True),
    "top_rated_from_tables": lambda spark, sf_dir: q_top_rated(spark, sf_dir, True),
    "search_titles_from_tables": lambda spark, sf_dir: q_search_titles(spark, sf_dir, True),
    "episode_runtime_per_series_from_tables":
        lambda spark, sf_dir: q_episode_runtime_per_series(spark, sf_dir, True),
    "episodes_by_season": q_episodes_by_season,
    "titles_named_view": q_titles_named_view,
    "people_with_titles_named_view": q_people_with_titles_named_view,
    "titles_credited_indexed": q_titles_credited_indexed,
    "top_episodes_of_clustered": q_top_episodes_of_clustered,
    "principals_by_title_in_parts": q_principals_in_parts,
    "principals_by_title_salted": lambda spark, sf_dir: q_principals_by_title(spark, sf_dir, True),
    "rating_per_genre_of_doubles": q_rating_per_genre_of_doubles,
    "title_basics_from_text": stored.titles_from_text,
    "people_salted": lambda spark, sf_dir: q_people(spark, sf_dir, True),
}
