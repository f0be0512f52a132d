"""Column functions: splitting, JSON lists, array predicates, sorts, rounding."""

from pyspark.sql import functions as F

from marquee.functions import (
    asc, concat_arrays, desc, elem_match, elements_where, field_min, parse_characters, round_half_even,
    sort_elements, split_list, top_k_elements,
)

PEOPLE = "array<struct<ordering:int,name:string,category:string>>"


def _people(spark, rows):
    return spark.createDataFrame(rows, f"id int, people {PEOPLE}")


def test_split_list_null_and_empty(spark):
    df = spark.createDataFrame([("a,b",), (None,), ("",)], "s string")
    got = [r.x for r in df.select(split_list("s").alias("x")).collect()]
    assert got == [["a", "b"], None, [""]]


def test_parse_characters(spark):
    df = spark.createDataFrame([('["A \\"B\\"","C"]',), ("bad",), (None,)], "c string")
    got = [r.x for r in df.select(parse_characters("c").alias("x")).collect()]
    assert got == [['A "B"', "C"], None, None]


def test_elem_match_needs_both_conditions_on_one_element(spark):
    df = _people(spark, [
        (1, [(1, "Ann", "director")]),
        (2, [(1, "Ann", "actor"), (2, "Bob", "director")]),  # conditions on different elements
        (3, None),
        (4, []),
    ])
    hit = df.filter(elem_match("people", lambda p: (p["name"] == "Ann") & (p["category"] == "director")))
    assert [r.id for r in hit.collect()] == [1]


def test_field_named_like_a_column_method_needs_brackets(spark):
    # ``p.name`` is the Column.name method, not the field; ``p["name"]`` is the field.
    df = _people(spark, [(1, [(1, "Ann", "director")])])
    assert df.filter(elem_match("people", lambda p: p["name"] == "Ann")).count() == 1


def test_field_min_over_matching_elements(spark):
    df = _people(spark, [
        (1, [(3, "Ann", "director"), (1, "Bob", "actor"), (2, "Ann", "director")]),
        (2, [(1, "Bob", "actor")]),
    ])
    got = df.select("id", field_min("people", "ordering", lambda p: p["name"] == "Ann").alias("m"))
    assert {r.id: r.m for r in got.collect()} == {1: 2, 2: None}


def test_elements_where(spark):
    df = _people(spark, [(1, [(3, "Ann", "director"), (1, "Bob", "actor")])])
    got = df.select(elements_where("people", lambda p: p["ordering"] <= 2).alias("x")).first().x
    assert [p.name for p in got] == ["Bob"]


def test_concat_arrays_treats_null_as_empty(spark):
    df = spark.createDataFrame([(["a"], None, ["b"])], "x array<string>, y array<string>, z array<string>")
    assert df.select(concat_arrays("x", "y", "z").alias("c")).first().c == ["a", "b"]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.125,), (2.5,), (6.825,), (3.5,)], "x double")
    got = [r.r for r in df.select(round_half_even("x", 2).alias("r")).collect()]
    assert got == [0.12, 2.5, 6.82, 3.5]
    got0 = [r.r for r in df.select(round_half_even("x", 0).alias("r")).collect()]
    assert got0 == [0.0, 2.0, 7.0, 4.0]


EPS = "array<struct<t:string,r:double,v:int>>"


def test_sort_elements_directions_and_nulls(spark):
    df = spark.createDataFrame([([("a", 5.0, 1), ("b", None, 9), ("c", 7.0, 2), ("d", 5.0, 3), ("e", 5.0, None)],)],
                               f"e {EPS}")
    got = df.select(sort_elements("e", desc("r"), desc("v"), asc("t")).alias("s")).first().s
    # rating desc with nulls last; votes desc with nulls last
    assert [x.t for x in got] == ["c", "d", "a", "e", "b"]
    got = df.select(sort_elements("e", asc("r"), asc("t")).alias("s")).first().s
    assert [x.t for x in got] == ["b", "a", "d", "e", "c"]  # nulls first ascending


def test_top_k_elements_short_and_null_arrays(spark):
    df = spark.createDataFrame([([("a", 1.0, 1), ("b", 3.0, 1)],), (None,), ([],)], f"e {EPS}")
    got = [r.s for r in df.select(top_k_elements("e", 10, desc("r")).alias("s")).collect()]
    assert [x.t for x in got[0]] == ["b", "a"]
    assert got[1] is None and got[2] == []


def test_sort_elements_without_keys_is_natural_order(spark):
    df = spark.createDataFrame([(["b", None, "a"],)], "x array<string>")
    assert df.select(sort_elements("x").alias("s")).first().s == [None, "a", "b"]
    assert df.select(F.size("x").alias("n")).first().n == 3
