"""Append newly arrived raw CSV files to the Parquet raw zone."""

from __future__ import annotations

import posixpath

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from carestar.session import ensure_checkpoint_dir
from carestar.sources.csvscan import text_schema
from carestar.sources.ingest import _exists, typed_by_name


def ingest_new_files(spark: SparkSession, csv_dir: str, schema: StructType, out_dir: str,
                     name: str, max_files_per_trigger: int = 1000) -> int:
    """Run one ``availableNow`` micro-batch cycle over ``csv_dir`` and return
    the number of rows appended.  Already ingested files are skipped (the
    file-source log in the checkpoint); a failed run resumes where it left."""
    ckpt = posixpath.join(ensure_checkpoint_dir(spark), "carestar-streams", name)
    # Files are read as text in their header's column order (taken from the
    # files already there; later drops share the export format), then typed
    # by column name like the batch ingest.  A drop is small and may arrive
    # while the stream starts, so each is parsed as a whole (``multiLine``).
    text = (spark.readStream.schema(text_schema(spark, csv_dir)).option("header", True)
            .option("escape", '"').option("multiLine", True).option("enforceSchema", False)
            .option("maxFilesPerTrigger", max_files_per_trigger).csv(csv_dir))
    stream = typed_by_name(text, schema)
    before = spark.read.parquet(out_dir).count() if _exists(spark, out_dir) else 0
    q = (stream.writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", ckpt).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    after = spark.read.parquet(out_dir).count() if _exists(spark, out_dir) else 0
    return after - before  # progress reports keep the last batches only
