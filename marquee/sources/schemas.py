"""Declared schemas of the five flat catalogue tables.

Columns bind by position when reading delimited text, so the order below is
the order of the columns in the files.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# The null token of the tab-separated catalogue files.
NULL_TOKEN = "\\N"


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype(), True) for name, dtype in fields])


# The columns of the public tables, in file order.
TITLE_BASICS = _schema(
    ("tconst", StringType),
    ("titleType", StringType),
    ("primaryTitle", StringType),
    ("originalTitle", StringType),
    ("isAdult", IntegerType),
    ("startYear", IntegerType),
    ("endYear", IntegerType),
    ("runtimeMinutes", IntegerType),
    ("genres", StringType),
)

NAME_BASICS = _schema(
    ("nconst", StringType),
    ("primaryName", StringType),
    ("birthYear", IntegerType),
    ("deathYear", IntegerType),
    ("primaryProfession", StringType),
    ("knownForTitles", StringType),
)

TITLE_EPISODE = _schema(
    ("tconst", StringType),
    ("parentTconst", StringType),
    ("seasonNumber", IntegerType),
    ("episodeNumber", IntegerType),
)

TITLE_PRINCIPALS = _schema(
    ("tconst", StringType),
    ("ordering", IntegerType),
    ("nconst", StringType),
    ("category", StringType),
    ("job", StringType),
    ("characters", StringType),
)

TITLE_RATINGS = _schema(
    ("tconst", StringType),
    ("averageRating", DoubleType),
    ("numVotes", IntegerType),
)

SCHEMAS: dict[str, StructType] = {
    "title_basics": TITLE_BASICS,
    "name_basics": NAME_BASICS,
    "title_episode": TITLE_EPISODE,
    "title_principals": TITLE_PRINCIPALS,
    "title_ratings": TITLE_RATINGS,
}

# Key column of each table. Readers report every column as nullable, so key
# checks are an explicit step (see ``tables.check_keys``).
KEYS: dict[str, str] = {
    "title_basics": "tconst",
    "name_basics": "nconst",
    "title_episode": "tconst",
    "title_principals": "tconst",
    "title_ratings": "tconst",
}

# File names of the public catalogue dump.
FILE_NAMES: dict[str, str] = {
    "title_basics": "title.basics.tsv",
    "name_basics": "name.basics.tsv",
    "title_episode": "title.episode.tsv",
    "title_principals": "title.principals.tsv",
    "title_ratings": "title.ratings.tsv",
}
