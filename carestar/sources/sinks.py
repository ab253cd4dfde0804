"""Sinks: Parquet / CSV tables, gzip JSON Lines, one-document JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: str | list[str] | None = None) -> None:
    """Overwrite a Parquet table (idempotent re-runs, Q1b)."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        # rebalance: partition-clustered files of a reasonable size (AQE splits hot values)
        w = (df.hint("rebalance", *cols).write.mode("overwrite")
             .option("partitionOverwriteMode", "static").partitionBy(*cols))
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header + comma CSV, one file per task (no single-writer funnel)."""
    (df.write.mode("overwrite").option("header", True).option("delimiter", ",")
     .option("escape", '"')  # quotes inside a field are doubled
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss")
     .option("dateFormat", "yyyy-MM-dd").csv(path))


def write_gzip_json(df: DataFrame, path: str) -> None:
    """JSON Lines, gzip-compressed; NULL fields are written as ``null``."""
    (df.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", "false")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").json(path))


def write_document(doc: DataFrame, path: str, column: str = "document") -> None:
    """A one-row, one-column JSON text frame as a single text file."""
    doc.select(F.col(column)).coalesce(1).write.mode("overwrite").text(path)


def write_parts(parts: DataFrame, path: str) -> None:
    """A document in ordered parts (dimension, part, items) as JSON Lines
    under ``parts``, and a ``manifest`` with every dimension's number of
    parts: a list of any length is written by many tasks."""
    written = f"{path}/parts"
    parts.write.mode("overwrite").option("compression", "none").json(written)
    back = parts.sparkSession.read.schema(parts.schema).json(written)
    (back.groupBy("dimension").agg(F.count(F.lit(1)).alias("parts"))
     .write.mode("overwrite").json(f"{path}/manifest"))
