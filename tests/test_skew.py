"""Skewed inputs: null join keys spread over partitions; a hot person
counted exactly."""

from collections import Counter

from pyspark.sql import functions as F

from marquee.operators import left_join_spread_nulls
from marquee.plans import flat
from marquee.sources.fixtures import catalogue_from_driver_tables

from catalogue_rows import SF001


def test_null_keys_spread_over_the_shuffle(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force a shuffled join
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep every shuffle partition
    try:
        left = spark.range(2000).select(
            F.col("id").cast("string").alias("tconst"),
            F.lit(1).alias("ordering"),
            F.when(F.col("id") % 10 == 0, F.concat(F.lit("n"), (F.col("id") % 7).cast("string"))).alias("nconst"),
        )
        right = spark.range(7).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("nconst"),
                                      F.lit("x").alias("name"))
        out = left_join_spread_nulls(left, right, "nconst", ["tconst", "ordering"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        parts = out.filter("nconst IS NULL").select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1  # 1800 null-key rows do not share one partition
        plain = left.join(right, "nconst", "left")
        assert plain.filter("nconst IS NULL").select(F.spark_partition_id()).distinct().count() == 1
        assert out.count() == 2000 and out.filter("name IS NOT NULL").count() == 200
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_hot_person_counts_exactly(spark):
    cat = catalogue_from_driver_tables(spark, SF001)
    # a third of all credits move to one person
    principals = cat.title_principals.withColumn(
        "nconst", F.when(F.abs(F.hash("tconst", "ordering")) % 3 == 0, F.lit("nm1")).otherwise(F.col("nconst")))
    hot = cat.__class__(**{**cat.tables(), "title_principals": principals})
    got = {r.nconst: (r.movieCount, r.tvSeriesCount, r.overallCount) for r in flat.credits_per_person(hot).collect()}

    kinds = {r.tconst: r.titleType for r in cat.title_basics.select("tconst", "titleType").collect()}
    rated = {r.tconst for r in cat.title_ratings.filter("averageRating IS NOT NULL").select("tconst").collect()}
    want = Counter()
    for r in principals.select("tconst", "nconst").collect():
        kind = kinds.get(r.tconst)
        if r.tconst in rated and kind in ("movie", "tvSeries"):
            want[(r.nconst, kind)] += 1
    people = {n for n, _ in want}
    assert set(got) == people
    for n in people:
        m, s = want[(n, "movie")], want[(n, "tvSeries")]
        assert got[n] == (m, s, m + s), n
    assert got["nm1"][2] > sum(v[2] for k, v in got.items() if k != "nm1") / 10


def test_credit_numbering_splits_a_hot_title(spark):
    from pyspark.sql import Window

    from marquee.sources.fixtures import number_within

    # a third of all rows share one key; the leading sort column is distinct within a key
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("k"),
        (F.col("id") * 7919 % 30011).alias("a"),
        F.col("id").alias("b"),
    )
    got = number_within(df, "k", ["a", "b"], "rn", width=512)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("a", "b")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # the hot key is numbered in many (key, bucket) groups, each at most `width` rows
    groups = df.filter("k = 'hot'").groupBy(F.floor(F.col("a") / 512)).count()
    assert groups.count() > 20 and groups.agg(F.max("count")).first()[0] <= 512


def test_fixture_credits_shuffled_once(spark):
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalogue_from_driver_tables(spark, SF001).title_principals._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    import re

    # the credit window is partitioned by (title, bucket), never by the title alone
    specs = re.findall(r"row_number\(\) windowspecdefinition\(([^)]*?), a#", plan)
    assert specs and all(re.fullmatch(r"tconst#\d+, _b#\d+L?", s) for s in specs), specs
    # the credit rows cross one shuffle (on title and bucket) before the join with the offsets
    assert re.search(r"SortMergeJoin \[tconst#\d+, _b#\d+L?\]", plan)


def test_hot_person_join_is_split_by_adaptive_execution(spark):
    from marquee.plans.collections import credits_with_people

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",  # people too large to broadcast
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",  # scaled down from 256 MB
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    saved = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        cat = catalogue_from_driver_tables(spark, SF001)
        principals = cat.title_principals.withColumn(
            "nconst", F.when(F.abs(F.hash("tconst", "ordering")) % 3 == 0, F.lit("nm1")).otherwise(F.col("nconst")))
        hot = cat.__class__(**{**cat.tables(), "title_principals": principals})
        df = credits_with_people(hot)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan  # the hot person's partition is split over several tasks
    assert len(rows) == principals.count()  # every credit kept once
    want = principals.filter("nconst = 'nm1'").count()
    assert sum(r.nconst == "nm1" for r in rows) == want and want > len(rows) / 4


def _rows_per_task(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_salted_join_spreads_a_hot_key(spark):
    """A third of the rows on one non-null key, another third on null, below any
    size at which AQE would split: no task gets more than three times the median."""
    from marquee.operators import left_join_salted

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    saved = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(30000).select(
            F.col("id").alias("row"),
            F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("n"), (F.col("id") % 2000).cast("string"))).alias("k"))
        right = spark.range(2000).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v")).unionAll(
            spark.sql("SELECT 'hot', -1L UNION ALL SELECT 'hot', -2L UNION ALL SELECT NULL, -3L"))
        plain, salted = left.join(right, "k", "left"), left_join_salted(left, right, "k", ["row"])
        assert salted.columns == plain.columns
        assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
        tasks = _rows_per_task(salted)
        assert len(tasks) == 16 and tasks[-1] <= 3 * tasks[8]
        assert _rows_per_task(plain)[-1] > 3 * _rows_per_task(plain)[len(_rows_per_task(plain)) // 2]
        empty = left.limit(0)
        assert left_join_salted(empty, right, "k", ["row"]).count() == 0
        assert left_join_salted(left, right.limit(0), "k", ["row"]).where("v is null").count() == 30000
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_salted_collections_are_equal(spark):
    from marquee.plans.collections import people_collection, principals_by_title

    cat = catalogue_from_driver_tables(spark, SF001)
    principals = cat.title_principals.withColumn(
        "nconst", F.when(F.abs(F.hash("tconst", "ordering")) % 3 == 0, F.lit("nm1")).otherwise(F.col("nconst")))
    names = cat.name_basics.withColumn("knownForTitles", F.when(F.abs(F.hash("nconst")) % 3 == 0, F.lit("")).otherwise(F.col("knownForTitles")))
    hot = cat.__class__(**{**cat.tables(), "title_principals": principals, "name_basics": names})
    for build in (principals_by_title, people_collection):
        a, b = build(hot), build(hot, salted=True)
        assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_hot_document_is_sorted_in_parts(spark):
    """A third of the rows in one document, a third under null: the same arrays,
    and no task sorts more than a small share of them."""
    from marquee.operators import collect_sorted, collect_sorted_in_parts

    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("t"), (F.col("id") % 500).cast("string")))
        rows = spark.range(30000).select(
            key.alias("k"), F.when(F.col("id") % 11 > 0, F.pmod(F.hash("id"), F.lit(900))).alias("ordering"),
            F.concat(F.lit("n"), F.pmod(F.hash("id"), F.lit(7000)).cast("string")).alias("name"))
        plain = collect_sorted(rows, "k", ["ordering", "name"], "items")
        parts = collect_sorted_in_parts(rows, "k", ["ordering", "name"], "items")
        assert parts.schema == plain.schema
        assert {r.k: r["items"] for r in parts.collect()} == {r.k: r["items"] for r in plain.collect()}
        lines = parts._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert any("Aggregate [k#" in x and "_part#" in x for x in lines)
        for odd in (rows.limit(0), rows.limit(1), rows.limit(0).unionAll(spark.sql("SELECT 'x', 1, 'n' FROM range(3000)").toDF("k", "ordering", "name"))):
            a, b = (f(odd, "k", ["ordering", "name"], "items").collect() for f in (collect_sorted, collect_sorted_in_parts))
            assert sorted(map(str, a)) == sorted(map(str, b))
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_parts_of_a_hot_document_are_even(spark):
    """The begins that a draw gives cut a hot key's elements into parts of like size."""
    from unittest import mock

    from marquee.operators import nesting

    rows = spark.range(40000).select(F.lit("hot").alias("k"), F.pmod(F.hash("id"), F.lit(10**9)).alias("ordering"))
    sizes = []
    flatten = F.flatten

    def seen(arrays):
        sizes.append(arrays)
        return flatten(F.array(F.transform("_all", lambda p: F.struct(F.size(p["_items"]).alias("ordering")))))

    with mock.patch.object(nesting.F, "flatten", seen):
        got = [x["ordering"] for x in nesting.collect_sorted_in_parts(rows, "k", ["ordering"], "items", slots=16).first()["items"]]
    assert sizes and sum(got) == 40000 and len(got) == 16 and max(got) <= 3 * sorted(got)[8]


def test_principals_in_parts_are_equal(spark):
    from marquee.plans.collections import principals_by_title

    cat = catalogue_from_driver_tables(spark, SF001)
    hot = F.when(F.abs(F.hash("tconst", "ordering")) % 3 == 0, F.lit("tt1")).otherwise(F.col("tconst"))
    cat = cat.__class__(**{**cat.tables(), "title_principals": cat.title_principals.withColumn("tconst", hot)})
    a, b = principals_by_title(cat), principals_by_title(cat, in_parts=64)
    assert a.schema == b.schema and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
