"""The credit- and episode-level queries straight from the flat catalogue.

Unwinding a collection right after nesting it gives back the rows it was
nested from. So when a query over a collection starts by exploding
``people`` or ``episodes`` and the collections are not stored yet, the same
rows come from a join of the flat tables. That skips the per-title
``collect_list``, the array sort, and the join of nested arrays. It also
means a title with a huge credit list is never materialised as one row; its
credits stay spread over the join's partitions (and AQE splits a skewed join
partition).

Each query here returns exactly what its counterpart in ``plans.queries``
returns from collections, and both routes are checked against the same
oracle. Where the flat tables allow more, the plan differs: credit and
episode queries (Q3, Q6, Q10) reduce rows per person or per parent with
map-side partials before the lookup joins, and top-k queries (Q7, Q9) rank
narrow rows and look up their winners (see PLANS.md).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.arrays import exact_mean, exact_sum, sort_column
from marquee.operators.nesting import attach_grouped, collect_sorted, embed_children
from marquee.plans.collections import (
    EPISODE_FIELDS, PEOPLE_FIELDS, SHORT_COLUMNS, credits_with_people, episode_rows, people_collection,
    principals_by_title, title_collection, title_rows, with_rating,
)
from marquee.plans import queries as Q
from marquee.plans.queries import (
    ACTING, EPISODE_RANK, best_series, credit_count_order, rank_per_actor, with_top_episodes,
)
from marquee.plans.views import VIEW_TAGS
from marquee.sources.tables import Catalogue

# Tags of the title types as the ``titles`` view writes them.
TYPE_TAGS = {"movie": VIEW_TAGS["movies"], "short": VIEW_TAGS["shorts"], "tvSeries": VIEW_TAGS["tvSeries"]}


def rated_titles(cat: Catalogue, types: list[str]) -> DataFrame:
    """``tconst, titleType, rating`` of rated titles of the given types."""
    titles = cat.title_basics.filter(F.col("titleType").isin(*types)).select("tconst", "titleType")
    ratings = cat.title_ratings.filter(F.col("averageRating").isNotNull()).select(
        "tconst", F.col("averageRating").alias("rating")
    )
    return titles.join(ratings, "tconst")


def acting_per_person(cat: Catalogue) -> DataFrame:
    """Q3 input from the flat tables, reduced per person and title type:
    ``nconst`` and, for each title type, the sum and count of the ratings of
    the person's acting credits on rated titles. The credits cross one shuffle,
    to meet their titles. They are then reduced with map-side partials, so a
    person holding a third of all credits becomes a handful of rows per task.
    Only those rows look up the person's name."""
    credits = cat.title_principals.filter(F.col("category").isin(*ACTING)).select("tconst", "nconst")
    rows = credits.join(rated_titles(cat, list(TYPE_TAGS)), "tconst")
    tag = F.create_map(*[F.lit(x) for kv in TYPE_TAGS.items() for x in kv])[F.col("titleType")]
    return rows.select("nconst", tag.alias("titleType"), F.col("rating").alias("r")).groupBy("nconst").agg(
        *Q.sums_per_type())


def actor_importance(cat: Catalogue, k: int = 10, by: str = "name") -> DataFrame:
    """Q3 over the ``titles`` view, computed from the flat tables. Credits of
    unknown people (no id, or an id without a person) form the null-name
    group, as on the view."""
    per = acting_per_person(cat)
    if by == "name":
        names = cat.name_basics.select("nconst", F.col("primaryName").alias("actorName"))
        per = per.join(names, "nconst", "left")
    elif by == "nconst":
        per = per.withColumn("actorName", F.col("nconst"))
    else:
        raise ValueError(f"by must be 'name' or 'nconst', not {by!r}")
    per_actor = per.groupBy("actorName").agg(*Q.sums_of_sums())
    return rank_per_actor(per_actor, k)


def credits_per_person(cat: Catalogue) -> DataFrame:
    """Q6 over movies and series, computed from the flat tables. Credits meet
    their rated titles, are counted per person with map-side partials, and
    only then look up the person's name (one row per person)."""
    rows = cat.title_principals.select("tconst", "nconst").join(rated_titles(cat, ["movie", "tvSeries"]), "tconst")
    per = rows.groupBy("nconst").agg(
        F.count_if(F.col("titleType") == "movie").alias("movieCount"),
        F.count_if(F.col("titleType") == "tvSeries").alias("tvSeriesCount"),
        F.count(F.lit(1)).alias("overallCount"),
        exact_sum("rating").alias("_sum"),
        F.count("rating").alias("_n"),
    )
    named = per.join(cat.name_basics.select("nconst", "primaryName"), "nconst", "left")
    return named.select(
        "nconst", "primaryName", "movieCount", "tvSeriesCount", "overallCount",
        exact_mean(F.col("_sum"), F.col("_n")).alias("avgRating"),
    ).orderBy(*credit_count_order())


def title_pairs(cat: Catalogue) -> DataFrame:
    """Q11 input: (person, title) for every credit on a movie, series or short,
    with the title's source rank (movies 0, series 1, shorts 2) and fields."""
    rank = F.create_map(*[F.lit(x) for kv in {"movie": 0, "tvSeries": 1, "short": 2}.items() for x in kv])
    titles = cat.title_basics.filter(F.col("titleType").isin(*TYPE_TAGS)).select(
        "tconst",
        rank[F.col("titleType")].alias("_src"),
        F.col("primaryTitle").alias("title"),
        "startYear",
        F.when(F.col("titleType") == "tvSeries", F.col("endYear")).alias("endYear"),
    )
    credits = cat.title_principals.filter(F.col("nconst").isNotNull()).select("tconst", "nconst")
    return credits.join(titles, "tconst").select("nconst", "_src", "tconst", "title", "startYear", "endYear")


def people_with_titles(cat: Catalogue) -> DataFrame:
    """Q11 (``peopleWithTitles`` view), computed from the flat tables."""
    return attach_grouped(people_collection(cat), "nconst", title_pairs(cat), "allTitles", order_by=["tconst"])


def episode_runtime_per_series(cat: Catalogue) -> DataFrame:
    """Q10, computed from the flat tables. Episodes meet their own runtime
    (their only shuffle) and are reduced per parent with map-side partials:
    runtime sum, runtime count and episode count. So a series with a third
    of all episodes is combined before the shuffle. Only those rows meet the
    series titles; same-named series then merge, and the mean is the sum
    over the count, as on the collections."""
    eps = cat.title_episode.filter(F.col("parentTconst").isNotNull()).select("tconst", "parentTconst")
    runtimes = cat.title_basics.select("tconst", F.col("runtimeMinutes").alias("runtime"))
    per_parent = eps.join(runtimes, "tconst", "left").groupBy("parentTconst").agg(
        F.sum("runtime").alias("_sum"), F.count("runtime").alias("_n"), F.count(F.lit(1)).alias("_eps"))
    series = cat.title_basics.filter(F.col("titleType") == "tvSeries").select(
        F.col("tconst").alias("parentTconst"), F.col("primaryTitle").alias("title"))
    per_title = per_parent.join(series, "parentTconst").groupBy("title").agg(
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("avgEpisodeRuntime"),
        F.sum("_eps").alias("episodeCount"))
    return per_title.orderBy(*Q.runtime_order())


#: Parts that one parent's rows are ranked in before they meet.
BUCKETS = 64


def best_children(rows: DataFrame, parent_key: str, n: int, keys=EPISODE_RANK) -> DataFrame:
    """The ``n`` best rows of each parent by ``keys``, as rows.

    Rows are first ranked within (parent, one of ``BUCKETS`` by a hash of the
    row), and each bucket keeps ``n``; then the parent's kept rows are ranked. So
    a parent with a third of all rows is spread over many tasks, and the last
    one holds at most ``n`` times ``BUCKETS`` rows of it, whatever ``n`` is."""
    order = [sort_column(k) for k in keys]
    bucket = F.pmod(F.xxhash64(*rows.columns), F.lit(BUCKETS))
    for by in ([parent_key, "_bucket"], [parent_key]):
        w = Window.partitionBy(*by).orderBy(*order)
        rows = (rows if "_bucket" in rows.columns else rows.withColumn("_bucket", bucket)).withColumn(
            "_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
    return rows.drop("_bucket")


def _rated_ids(cat: Catalogue, title_type: str) -> DataFrame:
    """``tconst, rating`` of the titles of one type: the narrow rows a top-k
    ranks on, so the wide title rows are never shuffled just to be ranked."""
    ids = cat.title_basics.filter(F.col("titleType") == title_type).select("tconst")
    return with_rating(ids, cat.title_ratings)


def top_series_episodes(cat: Catalogue, min_votes: int = 10000, n_series: int = 10,
                        n_episodes: int = 10) -> DataFrame:
    """Q7 from the flat tables: pick the best series first, then nest only
    the best ``n_episodes`` episodes of those series.

    The series are ranked on their ids and ratings alone. The chosen keys are
    a top-k result whose row limit Catalyst knows, so it broadcasts them where
    they are small and shuffles them where ``n_series`` is huge. They carry their
    ``rating`` and select the series rows and the episodes. Episodes are ranked as rows
    (:func:`best_children`), so the nested arrays never hold more than
    ``n_episodes`` elements."""
    ranked = best_series(_rated_ids(cat, "tvSeries"), min_votes, n_series)  # tconst, rating
    best = title_rows(cat, "tvSeries").join(ranked, "tconst")
    parents = ranked.select(F.col("tconst").alias("parentTconst"))
    eps = best_children(episode_rows(cat, parents), "parentTconst", n_episodes)
    return with_top_episodes(embed_children(best, eps, "tconst", "parentTconst", EPISODE_FIELDS, "episodes"),
                             n_episodes)


def _movie_rows(cat: Catalogue) -> DataFrame:
    """Movie documents without ``people``: title fields and ``rating``."""
    return with_rating(title_rows(cat, "movie"), cat.title_ratings)


def top_rated(cat: Catalogue, min_rating: float = 9.0, min_votes: int = 1000, k: int = 10) -> DataFrame:
    """Q9 from the flat tables: rank movies on their ids and ratings alone,
    then build documents, credits included, for the ``k`` winners only. The
    winners carry their ``rating`` and select the movie rows and the credits;
    Catalyst knows their limit and broadcasts them where ``k`` is small."""
    ranked = Q.top_rated(_rated_ids(cat, "movie"), min_rating, min_votes, k)  # tconst, rating
    best = title_rows(cat, "movie").join(ranked, "tconst")
    people = principals_by_title(cat, titles=ranked.select("tconst"))
    return best.join(people, "tconst", "left").select(*SHORT_COLUMNS).orderBy(
        F.desc_nulls_last("rating.averageRating"), F.desc_nulls_last("rating.numVotes"), F.asc("tconst"))


def _credited_titles(cat: Catalogue, name: str, category: str) -> DataFrame:
    """``tconst, ordering`` of credits of a person called ``name`` in
    ``category`` (the same credit carries both)."""
    people = cat.name_basics.filter(F.col("primaryName") == name).select("nconst")
    credits = cat.title_principals.filter(F.col("category") == category)
    return credits.join(people, "nconst", "left_semi").select("tconst", "ordering")


def titles_credited(cat: Catalogue, name: str, category: str = "director") -> DataFrame:
    """Q5 from the flat tables: a semi join of movies to the person's
    credits; no credit list is nested at all. The semi join comes before the
    ratings join, so only the person's movies look up their rating, and at
    runtime both joins can broadcast their small side."""
    hits = title_rows(cat, "movie").join(_credited_titles(cat, name, category), "tconst", "left_semi")
    return with_rating(hits, cat.title_ratings).orderBy(*Q._by_rating())


def titles_up_to_credit(cat: Catalogue, name: str, category: str = "director") -> DataFrame:
    """Q4 from the flat tables: per matched movie the cut (lowest matching
    ordering), then only the credits at or above it are nested.

    The cuts are restricted to movies by their ids alone, the credits meet
    them in one join, and the cut applies before the people join, so only
    kept credits look up their person. A matched movie keeps at least its
    matching credit, so an inner join of the movie rows with the nested
    credits gives exactly the matched movies, and the movie rows are planned
    once."""
    cuts = _credited_titles(cat, name, category).groupBy("tconst").agg(F.min("ordering").alias("_cut"))
    movie_ids = cat.title_basics.filter(F.col("titleType") == "movie").select("tconst")
    cuts = cuts.join(movie_ids, "tconst", "left_semi")
    kept = cat.title_principals.join(cuts, "tconst").filter(
        F.col("ordering").isNull() | (F.col("ordering") <= F.col("_cut"))).drop("_cut")
    people = collect_sorted(credits_with_people(cat, credits=kept), "tconst", PEOPLE_FIELDS, "people")
    return _movie_rows(cat).join(people, "tconst").select("tconst", "title", "rating", "people").orderBy(
        *Q._by_rating())


def top_episodes_of(cat: Catalogue, title: str, k: int = 10) -> DataFrame:
    """Q8 from the flat tables: the episodes of the series with that title,
    ranked directly; nothing is nested."""
    series = cat.title_basics.filter((F.col("titleType") == "tvSeries") & (F.col("primaryTitle") == title))
    eps = episode_rows(cat, series.select(F.col("tconst").alias("parentTconst")))
    return Q.best_episodes(eps.select(F.struct(*EPISODE_FIELDS).alias("e")), k)


def search_titles(cat: Catalogue, pattern: str) -> DataFrame:
    """Q12 from the flat tables: match series titles first, then build full
    documents (credits and episodes) for the matches only. The episodes are
    restricted by the matched rows' ids, not by the built documents, so the
    credit nesting is planned once."""
    rows = title_rows(cat, "tvSeries").filter(F.col("title").rlike("(?i)" + pattern))
    eps = episode_rows(cat, rows.select(F.col("tconst").alias("parentTconst")))
    return embed_children(title_collection(cat, "tvSeries", rows=rows), eps, "tconst", "parentTconst",
                          EPISODE_FIELDS, "episodes")
