"""DataFrame operators: nest/unwind, grouping into arrays, lookups, unions."""

import pytest
from pyspark.sql import functions as F

from marquee.functions import asc, desc
from marquee.operators import (
    collect_sorted, embed_children, invert_array, lookup_array, lookup_in_array, nest, top_k, union_with, unwind,
)


def test_nest_appends_struct_and_drops_fields(spark):
    df = spark.createDataFrame([(1, 10, 2.5)], "k int, numVotes int, averageRating double")
    out = nest(df, "rating", ["numVotes", "averageRating"])
    assert out.columns == ["k", "rating"]
    assert out.first().rating.asDict() == {"numVotes": 10, "averageRating": 2.5}


def test_nest_of_nulls_is_a_struct_not_null(spark):
    df = spark.createDataFrame([(1, None, None)], "k int, numVotes int, averageRating double")
    out = nest(df, "rating", ["numVotes", "averageRating"])
    assert out.filter(F.col("rating").isNull()).count() == 0


def test_unwind_drops_null_and_empty(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, None), (3, [])], "k int, g array<string>")
    assert sorted((r.k, r.g) for r in unwind(df, "g").collect()) == [(1, "a"), (1, "b")]
    pos = unwind(df, "g", as_name="genre", position="i")
    assert sorted((r.k, r.i, r.genre) for r in pos.collect()) == [(1, 0, "a"), (1, 1, "b")]


def test_collect_sorted_natural_and_keyed(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, 3, "a"), (2, 1, "x")], "k int, o int, t string")
    nat = {r.k: [e.o for e in r.arr] for r in collect_sorted(df, "k", ["o", "t"], "arr").collect()}
    assert nat == {1: [1, 2, 3], 2: [1]}
    keyed = {r.k: [e.t for e in r.arr] for r in collect_sorted(df, "k", ["o", "t"], "arr", [asc("t")]).collect()}
    assert keyed == {1: ["a", "b", "z"], 2: ["x"]}


def test_embed_children_drops_orphans_and_null_parents(spark):
    parents = spark.createDataFrame([("p1",), ("p2",)], "id string")
    kids = spark.createDataFrame([("p1", "b"), ("p1", "a"), (None, "c"), ("zz", "d")], "parent string, v string")
    out = {r.id: r.kids for r in embed_children(parents, kids, "id", "parent", ["v"], "kids").collect()}
    assert [k.v for k in out["p1"]] == ["a", "b"]
    assert out["p2"] is None


def test_lookup_array_keeps_order_unknown_ids_and_null_lists(spark):
    people = spark.createDataFrame([("n1", "t2, t1,t9"), ("n2", None)], "nconst string, known string")
    titles = spark.createDataFrame([("t1", "One", 2001), ("t2", "Two", 2002)], "tconst string, title string, year int")
    out = {r.nconst: r.main for r in
           lookup_array(people, "nconst", "known", titles, "tconst", ["title", "year"], "main").collect()}
    assert [(m.tconst, m.title, m.year) for m in out["n1"]] == [("t2", "Two", 2002), ("t1", "One", 2001),
                                                                   ("t9", None, None)]
    assert out["n2"] is None


def test_invert_array_counts_each_key_once_per_row(spark):
    docs = spark.createDataFrame([("t1", ["n1", "n1", None, "n2"])], "tconst string, ids array<string>")
    got = sorted(tuple(r) for r in invert_array(docs, "ids", [F.col("tconst")], "nconst").collect())
    assert got == [("n1", "t1"), ("n2", "t1")]


def test_lookup_in_array_sources_in_order_and_empty_for_none(spark):
    people = spark.createDataFrame([("n1",), ("n2",), ("n3",)], "nconst string")
    movies = spark.createDataFrame([("m2", ["n1"]), ("m1", ["n1", "n1"])], "tconst string, cast array<string>")
    shows = spark.createDataFrame([("s1", ["n2", "n1"]), ("s2", None)], "tconst string, cast array<string>")
    out = {r.nconst: [t.tconst for t in r.titles] for r in lookup_in_array(
        people, "nconst",
        [(movies, "cast", [F.col("tconst")]), (shows, "cast", [F.col("tconst")])],
        "titles", order_by=["tconst"]).collect()}
    assert out == {"n1": ["m1", "m2", "s1"], "n2": ["s1"], "n3": []}


def test_union_with_missing_columns(spark):
    a = spark.createDataFrame([(1, ["x"])], "k int, eps array<string>")
    b = spark.createDataFrame([(2,)], "k int")
    out = {r.k: r.eps for r in union_with(a, b).collect()}
    assert out == {1: ["x"], 2: None}


def test_top_k_is_take_ordered(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    out = top_k(df, 3, F.desc("v"), "id")
    assert [r.id for r in out.collect()] == [6, 13, 20]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()
    assert desc("x").nulls_last and not asc("x").nulls_last


def test_left_join_spread_nulls(spark):
    from marquee.operators import left_join_spread_nulls
    left = spark.createDataFrame([("t1", 1, "n1"), ("t1", 2, None), ("t2", 1, None), ("t3", 1, "n9")],
                                 "tconst string, ordering int, nconst string")
    right = spark.createDataFrame([("n1", "Ann")], "nconst string, name string")
    out = left_join_spread_nulls(left, right, "nconst", ["tconst", "ordering"])
    assert out.columns == left.join(right, "nconst", "left").columns
    assert sorted(out.collect(), key=lambda r: (r.tconst, r.ordering)) == sorted(
        left.join(right, "nconst", "left").collect(), key=lambda r: (r.tconst, r.ordering))
    assert out.filter("nconst IS NULL AND name IS NOT NULL").count() == 0


def test_characters_as_list(spark):
    from catalogue_rows import T, make_catalogue
    import marquee as M
    cat = make_catalogue(spark, title_basics=[T("tt1", "movie", "A")],
                         title_principals=[("tt1", 1, "nm1", "actor", None, '["A \\"B\\"","C"]'),
                                           ("tt1", 2, None, "actor", None, "bad")])
    colls, _ = M.build_collections(cat, characters_as_list=True)
    people = colls.movies.first().people
    assert people[0].characters == ['A "B"', "C"] and people[1].characters is None


def test_unwind_keeps_other_columns(spark):
    df = spark.sql("SELECT named_struct('b', array(1, 2)) AS a, 5 AS b")
    with pytest.raises(ValueError, match="as_name"):
        unwind(df, "a.b")
    assert [(r.b, r.x) for r in unwind(df, "a.b", as_name="x").collect()] == [(5, 1), (5, 2)]
