"""Averages do not depend on how the rows lie: equal groups have equal bytes and
fall back to the tie-break in every layout."""

import struct

import pytest
from pyspark.sql import functions as F

import marquee as M
from marquee.plans import flat
from marquee.plans.queries import rating_per_genre
from marquee.sources.tables import Catalogue

from catalogue_rows import T, make_catalogue

N = 3000


def _ratings(i):
    return round(1 + (i * 7919 % 91) / 10, 1)


@pytest.fixture(scope="module")
def cat(spark):
    """Two genres, and two actors, with the same ratings in different order."""
    titles = [T(f"tt{g}{i}", "movie", f"M{i}", genres=g) for g in "AB" for i in range(N)]
    ratings = [(f"tt{g}{i}", _ratings(i if g == "A" else N - 1 - i), 10) for g in "AB" for i in range(N)]
    credits = [(f"tt{g}{i}", 1, f"nm{g}", "actor", None, None) for g in "AB" for i in range(N)]
    people = [("nmA", "Ann", 1970, None, "actor", None), ("nmB", "Bob", 1970, None, "actor", None)]
    return make_catalogue(spark, titles, people, (), credits, ratings)


def _bits(x):
    return struct.pack("<d", x)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_equal_groups_are_equal_in_any_layout(spark, cat, parts):
    dealt = Catalogue(**{n: df.repartition(parts) for n, df in cat.tables().items()})
    genres = rating_per_genre(M.title_collection(dealt, "movie")).collect()
    assert [r.genre for r in genres] == ["A", "B"] and len({_bits(r.avgRating) for r in genres}) == 1
    assert genres[0].avgRating == sum(round(_ratings(i) * 10) for i in range(N)) / 10 / N
    for actors in (flat.actor_importance(dealt), M.actor_importance(M.build_titles(dealt))):
        rows = actors.collect()
        assert [r.actorName for r in rows] == ["Ann", "Bob"]
        assert len({_bits(r.weightedImportance) for r in rows}) == 1
    people = flat.credits_per_person(dealt).collect()
    assert [r.nconst for r in people] == ["nmA", "nmB"] and len({_bits(r.avgRating) for r in people}) == 1


def _doubles():
    """Groups of doubles of all sizes, signs and digits."""
    import random

    rng = random.Random(11)

    def one():
        kind = rng.random()
        if kind < 0.3:
            return rng.uniform(-10, 10)
        if kind < 0.5:
            return rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(-300, 300)
        if kind < 0.6:
            return rng.choice([-1, 1]) * 2.0 ** rng.randint(-1000, 1000)
        return rng.choice([7.12345, 10_000.5, 1e16, -1e16, 1.0, 1e-8, 5e-324, 1e-310, 0.0, -0.0, 0.1, None])

    return [(g, one()) for g in range(60) for _ in range(rng.randint(1, 120))]


@pytest.mark.parametrize("parts", [1, 5, 32])
def test_sums_of_any_doubles_are_the_nearest_ones(spark, parts):
    import math

    from marquee.operators import exact_means, exact_sums

    rows = _doubles()
    values = {}
    for g, v in rows:
        values.setdefault(g, []).extend([v] if v is not None else [])
    df = spark.createDataFrame(rows, "g int, v double").repartition(parts)
    got = {r.g: (r["sum"], r.n) for r in exact_sums(df, ["g"], "v").collect()}
    assert got == {g: (math.fsum(v) if v else None, len(v)) for g, v in values.items()}
    means = {r.g: r["mean"] for r in exact_means(df, ["g"], "v").collect()}
    assert means == {g: math.fsum(v) / len(v) if v else None for g, v in values.items()}


def test_sums_of_special_doubles(spark):
    import math

    from marquee.operators import exact_sums

    inf, nan = float("inf"), float("nan")
    rows = [(0, 1e308), (0, 1e308), (1, None), (2, nan), (2, 1.0), (3, inf), (3, -1e308), (4, inf), (4, -inf), (5, 0.0), (5, -0.0), (6, 1e308), (6, 1e308), (6, -1e308), (None, 2.5)]
    got = {r.g: (r["sum"], r.n) for r in exact_sums(spark.createDataFrame(rows, "g int, v double"), ["g"], "v").collect()}
    assert math.isnan(got.pop(2)[0]) and math.isnan(got.pop(4)[0])
    assert got == {0: (inf, 2), 1: (None, 0), 3: (inf, 2), 5: (0.0, 2), 6: (1e308, 3), None: (2.5, 1)}
    assert exact_sums(spark.createDataFrame([], "g int, v double"), ["g"], "v").count() == 0


def test_sums_are_reduced_before_the_shuffle(spark):
    """A hot group sends its bins, not its rows."""
    from marquee.operators import exact_sums

    df = spark.range(20000, numPartitions=4).select((F.col("id") % 1).cast("string").alias("g"), (F.col("id") / 7).alias("v"))
    plan = exact_sums(df, ["g"], "v")._jdf.queryExecution().executedPlan().toString()
    first = plan.rindex("Exchange hashpartitioning(g")  # printed from the top: the partial lies below the first shuffle
    assert "partial_sum" in plan[first:]


def test_lost_digits_raise(spark):
    from marquee.functions.arrays import exact_sum

    for bad in (7.12345, 10_000.0):
        df = spark.createDataFrame([("A", 1.5), ("A", bad)], "g string, r double")
        with pytest.raises(Exception, match="not exact as a rating"):
            df.groupBy("g").agg(exact_sum("r")).collect()
    df = spark.createDataFrame([("A", 1.5), ("A", None), ("A", 9999.9999)], "g string, r double")
    assert float(df.groupBy("g").agg(exact_sum("r").alias("s")).first().s) == 10001.4999
