"""marquee: nested catalogue collections and document-style queries on Spark.

Flat title/people/episode/credit/rating tables go in; nested collections
(movies, tvSeries, shorts, people) and analytic queries over them come out.
Every operator is a lazy DataFrame function built from Spark's own
expressions, so Catalyst and adaptive execution plan the whole query.
"""

from marquee.sources.tables import Catalogue, load_catalogue, load_catalogue_checked, read_table, read_table_checked, write_catalogue
from marquee.sources.collections import Collections, read_collection, read_collections, replace_partitions, write_collection, write_collections
from marquee.sources.lookups import read_credit_index, titles_credited_by_index, write_lookup_collections
from marquee.plans.collections import (
    build_collections, build_titles, people_collection, principals_by_title, read_partitioned_collections,
    split_titles, title_collection, with_episodes, write_partitioned_collections,
)
from marquee.plans.views import create_views, people_with_titles, register_views, titles
from marquee.plans.queries import (
    actor_importance, credits_per_person, episode_runtime_per_series, rating_per_genre, search_titles,
    titles_credited, titles_up_to_credit, top_episodes_of, top_rated, top_series_episodes,
)

__all__ = [
    "Catalogue", "Collections", "load_catalogue", "read_table", "write_catalogue",
    "read_collection", "read_collections", "write_collection", "write_collections",
    "build_collections", "build_titles", "split_titles", "write_partitioned_collections",
    "read_partitioned_collections", "people_collection", "principals_by_title", "title_collection", "with_episodes",
    "people_with_titles", "create_views", "register_views", "titles", "load_catalogue_checked", "read_table_checked",
    "replace_partitions", "read_credit_index", "titles_credited_by_index", "write_lookup_collections",
    "actor_importance", "credits_per_person", "episode_runtime_per_series", "rating_per_genre",
    "search_titles", "titles_credited", "titles_up_to_credit", "top_episodes_of", "top_rated",
    "top_series_episodes",
]
