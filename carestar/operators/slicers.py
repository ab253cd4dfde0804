"""Slicer selections and cohorts as pushed-down filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def selection_filter(selection: dict[str, list] | None) -> Column:
    """OR inside a dimension, AND across dimensions; a dimension with an
    empty selection (or no selection at all) does not filter."""
    conds = [F.col(dim).isin(list(values)) for dim, values in (selection or {}).items() if values]
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def apply_slicers(df: DataFrame, selection: dict[str, list] | None) -> DataFrame:
    """Filter a BI table by a slicer selection.  The predicate is a plain
    ``IN`` conjunction, so it reaches the Parquet scan as pushed filters and
    prunes partitions when a partition column is sliced."""
    return df.filter(selection_filter(selection))


def contains_ci(col: str, term: str) -> Column:
    """Case-insensitive substring match; NULL never matches."""
    return F.coalesce(F.lower(F.col(col)).contains(term.lower()), F.lit(False))


def in_cohort(df: DataFrame, key: str, cohort: DataFrame, cohort_key: str) -> DataFrame:
    """Rows whose key belongs to a cohort (a semi join; the cohort is not
    collected anywhere, and AQE broadcasts it only when it is measured small)."""
    c = cohort.select(F.col(cohort_key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return df.join(c, key, "left_semi")
