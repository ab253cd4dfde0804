"""Positions in a whole-table order, without gathering the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestar.session import ensure_checkpoint_dir

_ROWS = 1 << 33  # rows a partition's running number leaves room for


def written_once(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder: everything that reads it
    sees the same rows in the same partitions, also after a lost executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def positions(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with each row's position (from 1) in ``order``, which must be
    total for the positions to be determined.

    Ranges of the order go to tasks, each sorts and numbers its own range
    (no task sees more), and the ranges' sizes, one row per range, give the
    numbers before each."""
    placed = written_once(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_range"),
                F.monotonically_increasing_id().alias("_at"))
        .withColumn("_at", F.col("_at") % _ROWS))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
               .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return placed.join(F.broadcast(offsets), "_range").select(  # a row per range
        *df.columns, (F.col("_before") + F.col("_at") + 1).cast("long").alias(name))
