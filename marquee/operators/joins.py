"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A prefix no real key starts with, for join keys that must match nothing.
_NO_MATCH = "\u0000"


def left_join_spread_nulls(left: DataFrame, right: DataFrame, key: str, spread_by: Sequence[str]) -> DataFrame:
    """``left`` LEFT JOIN ``right`` USING (``key``), where left rows with a
    null key are spread over the shuffle instead of all hashing to the one
    partition of null.

    A null key never matches, so such rows are given a join key built from
    ``spread_by`` (columns that vary across those rows) behind a prefix no
    real key has: they still match nothing and keep null right-hand columns,
    but now land on many partitions. The key is a pure function of the row,
    so a task re-run after an executor loss sends every row to the same place.
    Output columns are those of ``left.join(right, key, "left")``.
    """
    salted = F.coalesce(
        F.col(key),
        F.concat(F.lit(_NO_MATCH), F.concat_ws("\u0001", *[F.col(c).cast("string") for c in spread_by])),
    )
    lhs = left.withColumn("_jk", salted)
    rhs = right.withColumnRenamed(key, "_jk")
    joined = lhs.join(rhs, "_jk", "left").drop("_jk")
    right_cols = [c for c in right.columns if c != key]
    return joined.select(key, *[c for c in left.columns if c != key], *right_cols)


def left_join_salted(left: DataFrame, right: DataFrame, key: str, spread_by: Sequence[str], slots: int = 64) -> DataFrame:
    """``left`` LEFT JOIN ``right`` USING (``key``), where no key of ``left``,
    null included, has to be joined in one task.

    A key with more than one in ``slots`` of the left rows is heavy, so there are
    fewer than ``slots`` of them: a count with map-side partials finds them, and
    that bounded list is broadcast. Left rows of a heavy key are dealt by a hash
    of ``spread_by`` (columns that vary across them) over as many salts as the
    key has ``slots``-ths of the rows, and the right rows of that key are repeated
    once per salt: less than two times ``slots`` repeats in all for a right side
    with unique keys. All other rows have one salt. Null keys match nothing and
    are spread alike. The salt is a function of the row, so a task that runs again
    sends each row to the same place.

    AQE splits a hot partition only above its size threshold and only where both
    sides are plain shuffles; this join needs neither. ``left`` is read twice.
    Output columns are those of ``left.join(right, key, "left")``."""
    counts = left.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hk")).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_t"))
    heavy = counts.where(F.col("_n") * slots > total.scalar())
    heavy = F.broadcast(heavy.select("_hk", F.ceil(F.col("_n") * slots / total.scalar()).cast("int").alias("_salts")))
    dealt = F.xxhash64(*spread_by)
    salt = F.when(F.col(key).isNull(), F.pmod(dealt, F.lit(slots))).when(F.col("_salts").isNotNull(), F.pmod(dealt, "_salts")).otherwise(0)
    lhs = left.join(heavy, F.col(key) == F.col("_hk"), "left").withColumn("_salt", salt.cast("int")).drop("_hk", "_salts")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    rhs = right.join(heavy, F.col(key) == F.col("_hk"), "left").withColumn("_salt", each).drop("_hk", "_salts")
    return lhs.join(rhs, [key, "_salt"], "left").drop("_salt")
