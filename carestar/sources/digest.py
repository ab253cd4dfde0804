"""Content digests: one row per table that says whether two copies hold the
same rows, whatever their order, files or partitions.

A row becomes text (columns by lower-case name, decimals and doubles with
six places, times to the second, NULL as ``~``), the text's MD5 a number of
60 bits, and the table the sum of these numbers and its row count.  Halves of
30 bits are summed as whole numbers and put together at the end.  Sums are
combined per task, so a digest moves one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DecimalType, DoubleType, FloatType, TimestampNTZType,
                               TimestampType)

HALF = 1 << 30


def _text(name: str, kind) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(kind, DecimalType) and kind.scale <= 6 and kind.precision - kind.scale <= 32:
        # the digits as they are, filled up to six places
        c = F.concat(c.cast("string"), F.lit("0" * (6 - kind.scale) if kind.scale else ".000000"))
    elif isinstance(kind, (DecimalType, DoubleType, FloatType)):
        c = c.cast("decimal(38,6)")
    elif isinstance(kind, (TimestampType, TimestampNTZType)):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(c.cast("string"), F.lit("~"))


def content_digest(name: str, df: DataFrame) -> DataFrame:
    """table_name, row_count, content."""
    fields = sorted(df.schema.fields, key=lambda f: f.name.lower())
    row = F.concat_ws("|", *[_text(f.name, f.dataType) for f in fields])
    number = F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("bigint")
    high, low = F.shiftright("_n", 30), F.col("_n").bitwiseAND(HALF - 1)
    whole = (F.col("_high").cast("decimal(20,0)") * F.lit(HALF).cast("decimal(10,0)")
             + F.col("_low").cast("decimal(20,0)"))
    return df.select(number.alias("_n")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(high).alias("_high"), F.sum(low).alias("_low")).select(
        F.lit(name).alias("table_name"), "row_count",
        F.coalesce(whole.cast("decimal(38,0)"), F.lit(0)).cast("string").alias("content"))
