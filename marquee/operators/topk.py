"""Global top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First ``k`` rows under ``order``. Planned as ``TakeOrderedAndProject``:
    each task keeps its own k best rows, only k rows per task move, no full
    sort. ``order`` must end in a unique key for a deterministic answer."""
    return df.orderBy(*order).limit(k)
