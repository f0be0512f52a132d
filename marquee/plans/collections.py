"""Build the four document collections from the flat catalogue.

movies, shorts: one document per title with its credits (``people``, sorted
by ``ordering``) and its ``rating`` struct. tvSeries: the same plus
``episodes``. people: one document per person with ``mainTitles`` resolved
from the known-for list.

Everything is lazy; :func:`build_collections` returns DataFrames and the shared
credit aggregate, and ``sources.collections.write_collections`` runs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.arrays import asc, parse_characters, split_list
from marquee.operators.joins import left_join_salted, left_join_spread_nulls
from marquee.operators.nesting import collect_sorted, collect_sorted_in_parts, embed_children, lookup_array, nest
from marquee.sources.collections import Collections, read_collection, write_collection
from marquee.sources.tables import Catalogue

# The title types that get a collection, and their collection names.
TITLE_TYPES = {"movie": "movies", "tvSeries": "tvSeries", "short": "shorts"}

# Fields of one credit inside a title's ``people`` array, in document order.
PEOPLE_FIELDS = [
    "ordering", "name", "category", "job", "characters",
    "nconst", "birthYear", "deathYear", "primaryProfession",
]

# Columns of the movies and shorts collections, in document order.
SHORT_COLUMNS = ["tconst", "title", "originalTitle", "isAdult", "year", "runtimeMinutes", "genres", "people", "rating"]

# Fields of one episode inside a series' ``episodes`` array, in document order.
EPISODE_FIELDS = ["Title", "isAdult", "year", "runtime", "ordering", "rating"]


def credits_with_people(cat: Catalogue, titles: DataFrame | None = None, characters_as_list: bool = False,
                        credits: DataFrame | None = None, salted: bool = False) -> DataFrame:
    """Flat credits (one row per title × person), enriched with the person's
    name and dates. Unknown people keep the credit with null details.

    ``titles`` restricts credits to those titles (a left semi join), so credits
    of titles no collection keeps (episodes) are never aggregated. ``credits``
    replaces the catalogue's credit table by a selection of it. Credits
    without a person id are spread over the join's shuffle rather than
    piling into the partition of the null key. ``salted`` spreads people with a
    large share of all credits likewise, at the price of counting credits per
    person first.
    """
    credits = cat.title_principals if credits is None else credits
    if titles is not None:
        credits = credits.join(titles.select("tconst"), "tconst", "left_semi")
    names = cat.name_basics.select(
        "nconst", F.col("primaryName").alias("name"), "birthYear", "deathYear", "primaryProfession"
    )
    join = left_join_salted if salted else left_join_spread_nulls
    out = join(credits, names, "nconst", spread_by=["tconst", "ordering"])
    if characters_as_list:
        out = out.withColumn("characters", parse_characters("characters"))
    return out.select("tconst", *PEOPLE_FIELDS)


def principals_by_title(cat: Catalogue, titles: DataFrame | None = None, characters_as_list: bool = False,
                        salted: bool = False, in_parts: int | None = None) -> DataFrame:
    """N1: ``tconst, people[]`` with credits sorted by ordering.

    ``in_parts`` sorts the credits of a title with more than one in ``in_parts``
    of all credits in parts (:func:`collect_sorted_in_parts`)."""
    rows = credits_with_people(cat, titles, characters_as_list, salted=salted)
    if in_parts:
        return collect_sorted_in_parts(rows, "tconst", PEOPLE_FIELDS, "people", slots=in_parts)
    return collect_sorted(rows, "tconst", PEOPLE_FIELDS, "people")


def with_rating(df: DataFrame, ratings: DataFrame, key: str = "tconst") -> DataFrame:
    """Left-join ratings and nest them as ``rating{numVotes, averageRating}``.
    Unrated rows get a struct of two nulls, never a null struct."""
    joined = df.join(ratings.select(F.col("tconst").alias(key), "numVotes", "averageRating"), key, "left")
    return nest(joined, "rating", ["numVotes", "averageRating"])


def title_rows(cat: Catalogue, title_type: str) -> DataFrame:
    """Title columns of one type, renamed to the collection's field names."""
    t = cat.title_basics.filter(F.col("titleType") == title_type).withColumnRenamed("primaryTitle", "title")
    if title_type == "tvSeries":
        t = t.drop("titleType")
    else:
        t = t.withColumnRenamed("startYear", "year").drop("titleType", "endYear")
    return t.withColumn("genres", split_list("genres"))


def title_collection(cat: Catalogue, title_type: str, people: DataFrame | None = None,
                     rows: DataFrame | None = None) -> DataFrame:
    """N2: the movies / tvSeries / shorts collection (without episodes).

    ``rows`` builds documents for a selection of :func:`title_rows` only;
    credits are then nested for those titles alone."""
    t = title_rows(cat, title_type) if rows is None else rows
    if people is None:
        people = principals_by_title(cat, titles=t)
    return with_rating(t.join(people, "tconst", "left"), cat.title_ratings)


def episode_rows(cat: Catalogue, parents: DataFrame | None = None) -> DataFrame:
    """One row per episode with its parent key and document fields.

    ``parents`` (a ``parentTconst`` column) keeps only those parents'
    episodes. It applies to the episode table itself, before the episodes
    look up their titles and ratings, so a selective query shuffles only the
    selected episodes."""
    episodes = cat.title_episode.filter(F.col("parentTconst").isNotNull())
    if parents is not None:
        episodes = episodes.join(parents.select("parentTconst"), "parentTconst", "left_semi")
    details = episodes.join(
        cat.title_basics.select(
            "tconst",
            F.col("primaryTitle").alias("Title"),
            "isAdult",
            F.col("startYear").alias("year"),
            F.col("runtimeMinutes").alias("runtime"),
        ),
        "tconst",
        "left",
    )
    details = with_rating(details, cat.title_ratings)
    return details.select(
        "parentTconst",
        "Title",
        "isAdult",
        "year",
        "runtime",
        F.struct(F.col("seasonNumber").alias("Season"), F.col("episodeNumber").alias("Episode")).alias("ordering"),
        "rating",
    )


def with_episodes(series: DataFrame, cat: Catalogue, order_by: str = "title",
                  only_given_series: bool = False) -> DataFrame:
    """N3: add ``episodes[]`` to series. Episodes sort by their whole struct,
    which starts with ``Title`` (``order_by="title"``), or by season and
    episode number (``"season_episode"``). Episodes without a series parent
    are dropped. ``only_given_series`` nests just the episodes of ``series``
    (worth it when ``series`` is a selection); they are selected before they
    look up their titles and ratings."""
    keys = None
    if order_by == "season_episode":
        keys = [asc("ordering.Season"), asc("ordering.Episode"), asc("Title"), asc("year"), asc("runtime"),
                asc("isAdult"), asc("rating.numVotes"), asc("rating.averageRating")]
    elif order_by != "title":
        raise ValueError(f"order_by must be 'title' or 'season_episode', not {order_by!r}")
    parents = series.select(F.col("tconst").alias("parentTconst")) if only_given_series else None
    return embed_children(series, episode_rows(cat, parents), "tconst", "parentTconst", EPISODE_FIELDS, "episodes",
                          keys)


def people_collection(cat: Catalogue, salted: bool = False) -> DataFrame:
    """N4: people with ``primaryProfession[]`` and ``mainTitles[]``
    (tconst, title, year) in known-for order; unknown ids keep null title and
    year; people with no known-for list get null."""
    people = cat.name_basics.withColumn("primaryProfession", split_list("primaryProfession"))
    lookup = cat.title_basics.select("tconst", F.col("primaryTitle").alias("title"), F.col("startYear").alias("year"))
    return lookup_array(people, "nconst", "knownForTitles", lookup, "tconst", ["title", "year"], "mainTitles",
                        salted=salted)


def build_collections(cat: Catalogue, episode_order: str = "title", characters_as_list: bool = False,
                      cut_lineage: bool = False) -> tuple[Collections, list[DataFrame]]:
    """N5: all four collections, plus the sub-plans they share.

    Credits are nested once, for the titles of the three collection types
    only, and that aggregate feeds all three title collections; pass the
    returned shared list to ``write_collections`` to compute it once.
    ``characters_as_list`` stores each credit's characters as a parsed list
    instead of the JSON text of the source.

    ``cut_lineage`` instead writes that aggregate once (eagerly) to the
    session's checkpoint directory — the shared folder named by
    ``spark.checkpoint.dir`` on a cluster — and builds the collections from
    the written copy: losing an executor during the later writes then costs
    a re-read, not a re-run of the credit shuffle. Nothing is left to persist.
    """
    kept = cat.title_basics.filter(F.col("titleType").isin(*TITLE_TYPES))
    people = principals_by_title(cat, titles=kept, characters_as_list=characters_as_list)
    shared = [people]
    if cut_lineage:
        people, shared = people.checkpoint(eager=True), []
    movies = title_collection(cat, "movie", people)
    series = with_episodes(title_collection(cat, "tvSeries", people), cat, episode_order)
    shorts = title_collection(cat, "short", people)
    return Collections(movies, series, shorts, people_collection(cat)), shared


# The tag of each title type in the unified ``titles`` documents.
TITLE_TAGS = {"movie": "movies", "short": "short", "tvSeries": "tvSeries"}


def build_titles(cat: Catalogue, episode_order: str = "title", characters_as_list: bool = False) -> DataFrame:
    """All movie, short and series documents in one DataFrame, in the shape
    of the ``titles`` view (series fields plus ``titleType``): one scan of
    the titles, one credit aggregation, one ratings join, one episode
    aggregation. Written with ``partition_by=["titleType"]`` it is the whole
    title side of N5 in a single job; :func:`split_titles` gives back the
    three collections (with partition pruning when read from storage).
    Episodes attach to series only."""
    tag = F.create_map(*[F.lit(x) for kv in TITLE_TAGS.items() for x in kv])[F.col("titleType")]
    rows = cat.title_basics.filter(F.col("titleType").isin(*TITLE_TAGS)).select(
        "tconst",
        F.col("primaryTitle").alias("title"),
        "originalTitle",
        "isAdult",
        "startYear",
        F.when(F.col("titleType") == "tvSeries", F.col("endYear")).alias("endYear"),
        "runtimeMinutes",
        split_list("genres").alias("genres"),
        tag.alias("titleType"),
    )
    people = principals_by_title(cat, titles=rows, characters_as_list=characters_as_list)
    docs = with_rating(rows.join(people, "tconst", "left"), cat.title_ratings)
    docs = with_episodes(docs, cat, episode_order)
    is_series = F.col("titleType") == TITLE_TAGS["tvSeries"]
    return docs.select(
        "tconst", "title", "originalTitle", "isAdult", "startYear", "endYear", "runtimeMinutes", "genres",
        "people", "rating", F.when(is_series, F.col("episodes")).alias("episodes"), "titleType",
    )


def split_titles(titles: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(movies, tvSeries, shorts) in their collection shapes, from
    :func:`build_titles` output or its stored copy."""
    def kind(type_: str) -> DataFrame:
        return titles.filter(F.col("titleType") == TITLE_TAGS[type_]).drop("titleType")

    series = kind("tvSeries")
    movies, shorts = (kind(t).withColumnRenamed("startYear", "year").select(*SHORT_COLUMNS)
                      for t in ("movie", "short"))
    return movies, series, shorts


def write_partitioned_collections(cat: Catalogue, base: str, episode_order: str = "title",
                                  characters_as_list: bool = False, **kwargs) -> None:
    """N5 in two jobs: ``<base>/titles`` (all title documents, partitioned
    by ``titleType``) and ``<base>/people``. ``kwargs`` go to
    ``write_collection`` (format, partitions, options)."""
    write_collection(build_titles(cat, episode_order, characters_as_list), f"{base}/titles",
                     partition_by=["titleType"], **kwargs)
    write_collection(people_collection(cat), f"{base}/people", **kwargs)


def read_partitioned_collections(spark, base: str, fmt: str = "parquet") -> Collections:
    """The four collections from :func:`write_partitioned_collections`
    output; each title collection reads only its own partition."""
    movies, series, shorts = split_titles(read_collection(spark, f"{base}/titles", fmt))
    return Collections(movies, series, shorts, read_collection(spark, f"{base}/people", fmt))
