"""Deterministic top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(spec) -> Column:
    """'x' -> x asc nulls last, '-x' -> x desc nulls last, Column as is."""
    if isinstance(spec, Column):
        return spec
    if spec.startswith("-"):
        return F.col(spec[1:]).desc_nulls_last()
    return F.col(spec).asc_nulls_last()


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """First ``k`` rows by ``order``; callers end ``order`` with a unique key
    so ties never depend on partitioning.  Plans as TakeOrderedAndProject:
    each partition keeps its own k best rows, one task merges them."""
    return df.orderBy(*[_order(o) for o in order]).limit(k)


def top_keys(df: DataFrame, key: str, k: int, *order) -> DataFrame:
    """The key column of the top-k rows: at most ``k`` rows, safe to broadcast."""
    return F.broadcast(top_k(df, k, *order).select(key))
