"""Set operators over collections with differing shapes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_with(df: DataFrame, *others: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Union-all by column name. With ``allow_missing`` a column absent on one
    side is null there (a document without the field). No dedup, no shuffle."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), others, df)
