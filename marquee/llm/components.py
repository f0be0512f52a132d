"""Connected components of a large graph, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest among it and its neighbours."""
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionAll(moved).distinct()


def _print_of(edges: DataFrame) -> tuple:
    """What tells whether two edge tables hold the same rows: one row."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.bit_xor(F.xxhash64("v", "u"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that has an edge; ``root`` is the smallest
    node of its component.

    ``edges`` has columns ``u`` and ``v`` of one orderable type, in any direction,
    repeats and loops allowed, nulls left out. Rounds grow with the logarithm of
    the longest path; each is written to the shared folder, so that a lost
    executor costs one round at most. An edge table that is empty gives no rows.
    """
    loops = edges.where("u is not null and v is not null")
    now = stored(loops.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    before = _print_of(now)
    while before[0]:
        now = stored(_small_star(_large_star(now)), "components")
        after = _print_of(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
