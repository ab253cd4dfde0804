"""Exact median of a numeric column without gathering the column in one task.

``percentile``/``median`` keep a map of every distinct value and merge it
in one task.  Here the values (scaled to integers, e.g. cents) are located
by a radix descent over 21-bit digits: at each level the candidate values
are counted per bucket (``v >> shift``) inside the one or two buckets that
held the middle ranks at the level above, a running count inside each
parent bucket gives every bucket's first global rank, and the buckets that
hold the middle ranks become the next level's parents.  At the last level
(shift 0) the buckets are the values themselves.

Every count is a distributed, map-side combined aggregate; each window is
partitioned by its parent bucket and spans at most 2^21 buckets (a few MB of
(bucket, count) pairs; the top level at most 2^22 for the full 64-bit range);
the parents carried between levels are at most two rows (broadcast).  The
values are scanned once per level: three levels for 64-bit integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVEL_SHIFTS = (42, 21, 0)


def _holds(rank: Column, start: Column, count: Column) -> Column:
    return (rank >= start) & (rank < start + count)


def _targets(counts: DataFrame) -> DataFrame:
    hit = (_holds(F.col("r1"), F.col("start"), F.col("c"))
           | _holds(F.col("r2"), F.col("start"), F.col("c")))
    return counts.filter(hit).select(F.col("b").alias("pb"), "start", "c", "r1", "r2")


def exact_median_scaled(df: DataFrame, value: Column | str, scale: int = 100) -> DataFrame:
    """One row, column ``median``: the interpolated median of ``value``,
    computed on ``round(value * scale)`` integers and returned in
    ``1/scale`` units as a double (exact for .5 midpoints)."""
    v = F.col(value) if isinstance(value, str) else value
    vals = (df.select(F.round(v * scale).cast("long").alias("v")).filter(F.col("v").isNotNull()))

    # Top level: buckets of the highest digit (one bucket for |v| < 2^42).
    top = LEVEL_SHIFTS[0]
    counts = vals.groupBy(F.shiftright("v", top).alias("b")).agg(F.count(F.lit(1)).alias("c"))
    every = Window.partitionBy()
    run = every.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = (counts.withColumn("start", F.sum("c").over(run) - F.col("c"))
              .withColumn("n", F.sum("c").over(every))
              .withColumn("r1", F.floor((F.col("n") - 1) / 2))
              .withColumn("r2", F.floor(F.col("n") / 2)))
    parents = _targets(counts)

    prev = top
    for shift in LEVEL_SHIFTS[1:]:
        # Values inside the (at most two) parent buckets, counted per child bucket.
        cand = (vals.withColumn("pb", F.shiftright("v", prev))
                .join(F.broadcast(parents.select("pb", F.col("start").alias("pstart"), "r1", "r2")),
                      "pb"))
        counts = (cand.groupBy("pb", F.shiftright("v", shift).alias("b"), "pstart", "r1", "r2")
                  .agg(F.count(F.lit(1)).alias("c")))
        inside = Window.partitionBy("pb").orderBy("b").rowsBetween(Window.unboundedPreceding,
                                                                   Window.currentRow)
        counts = counts.withColumn("start", F.col("pstart") + F.sum("c").over(inside) - F.col("c"))
        parents = _targets(counts)
        prev = shift

    # Last level: ``pb`` is the value itself.
    picked = parents.agg(
        F.max(F.when(_holds(F.col("r1"), F.col("start"), F.col("c")), F.col("pb"))).alias("v1"),
        F.max(F.when(_holds(F.col("r2"), F.col("start"), F.col("c")), F.col("pb"))).alias("v2"))
    return picked.select(((F.col("v1") + F.col("v2")) / F.lit(2.0)).alias("median"))


def round_scaled(m: Column, scale: int, places: int = 2) -> Column:
    """A median in 1/scale units (an integer or .5, exact in a double) as a
    value rounded half-up to ``places``; the division runs in decimal."""
    return F.round(m.cast("decimal(38,1)") / F.lit(scale).cast("decimal(20,0)"),
                   places).cast("double")
