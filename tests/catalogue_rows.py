"""Small catalogues from literal rows, and the driver's folders."""

from marquee.sources.schemas import SCHEMAS
from marquee.sources.tables import Catalogue

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def make_catalogue(spark, title_basics=(), name_basics=(), title_episode=(), title_principals=(),
                   title_ratings=()) -> Catalogue:
    """A catalogue from literal rows (tuples in schema column order)."""
    rows = dict(title_basics=title_basics, name_basics=name_basics, title_episode=title_episode,
                title_principals=title_principals, title_ratings=title_ratings)
    return Catalogue(**{n: spark.createDataFrame(list(r), SCHEMAS[n]) for n, r in rows.items()})


def T(tconst, kind, title, year=2000, end=None, runtime=90, genres="Drama", adult=0):
    """A title_basics row."""
    return (tconst, kind, title, "Orig " + title, adult, year, end, runtime, genres)
