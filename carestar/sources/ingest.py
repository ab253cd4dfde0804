"""L0: load the raw claims CSV files with explicit schemas into Parquet.

Each known table has a ``StructType`` (ids and codes as strings, money as
decimals) applied by header name; values that do not parse are kept as NULL
with the failing column names in ``_corrupt_record`` instead of failing the
load.  Tables without a schema take the types that all their values fit.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from carestar.operators.counts import row_counts
from carestar.sources import schemas
from carestar.sources.concurrent import run_concurrently
from carestar.sources.csvscan import infer_types, read_csv, text_schema, typed
from carestar.sources.tables import RAW_NAMES, RawTables

# Rows of a compressed CSV file, which one task has to read, at most.
FILE_ROWS = 250_000

CORRUPT = "_corrupt_record"
MALFORMED = "_malformed"


def typed_by_name(text: DataFrame, schema: StructType) -> DataFrame:
    """Text columns (named by the file header) -> the schema's columns picked
    by name and ``try_cast`` to their types.  A value that does not parse
    becomes NULL and its column name is listed in ``_corrupt_record``; a
    schema column missing from the file is NULL."""
    present = set(text.columns)
    cols, failed = [], []
    for f in schema.fields:
        if f.name not in present:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        src = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType):
            cols.append(src.alias(f.name))
            continue
        typed = src.try_cast(f.dataType)
        cols.append(typed.alias(f.name))
        failed.append(F.when(typed.isNull() & src.isNotNull() & (F.trim(src) != ""),
                             F.lit(f.name)))
    if MALFORMED in present:
        failed.append(F.when(F.col(MALFORMED).isNotNull(), F.lit("<fields>")))
    return text.select(*cols, F.nullif(F.concat_ws(",", *failed), F.lit("")).alias(CORRUPT))


def read_claims_csv(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    """Read a claims CSV by header name (files carry more columns than the
    jobs read, in their own order): every column as text, then typed by name,
    or by what the whole file holds where there is no schema."""
    # A file of a folder whose header differs fails, and rows with too many
    # or too few fields are marked.
    columns = text_schema(spark, path)
    text = read_csv(spark, path, columns.add(MALFORMED, StringType()), mode="PERMISSIVE",
                    columnNameOfCorruptRecord=MALFORMED, enforceSchema=False)
    if schema is None:
        text = text.drop(MALFORMED)
        return typed(text, infer_types(text))
    return typed_by_name(text, schema)


def ingest_raw(spark: SparkSession, csv_dir: str, out_dir: str,
               extra: dict[str, str] | None = None, partial: bool = False) -> DataFrame:
    """Read ``<csv_dir>/<table>.csv`` for every claims table and every
    counted-only table present, write each as Parquet under ``out_dir``
    (overwrite: re-runs are idempotent) and return the row count per table.

    ``extra`` maps more table names to CSV paths (e.g. the CDC overdose
    file), typed by what they hold.  A missing claims table or
    extra file raises, unless ``partial`` says that some may be absent."""

    tables = [(n, posixpath.join(csv_dir, f"{n}.csv"), schemas.CLAIMS[n]) for n in RAW_NAMES]
    tables += [(n, posixpath.join(csv_dir, f"{n}.csv"), None) for n in schemas.COUNTED_ONLY]
    tables += [(n, p, None) for n, p in (extra or {}).items()]
    present = [t for t in tables if _exists(spark, t[1])]
    needed = {*RAW_NAMES, *(extra or {})}
    missing = sorted(needed - {t[0] for t in present})
    if missing and not partial:
        raise FileNotFoundError(f"no CSV file for {', '.join(missing)}")

    def one(t):
        name, path, schema = t
        target = posixpath.join(out_dir, name)
        (read_claims_csv(spark, path, schema).write.mode("overwrite")
         .option("compression", "zstd").parquet(target))
        return spark.read.parquet(target)

    done = run_concurrently(one, present)
    return row_counts({t[0]: df for t, df in done.items()}, "table_name", "row_count")


def read_ingested(spark: SparkSession, parquet_dir: str, name: str) -> DataFrame:
    """An ingested table without the marks of its faulty rows."""
    return spark.read.parquet(posixpath.join(parquet_dir, name)).drop(CORRUPT)


def load_raw(spark: SparkSession, parquet_dir: str, profile=None) -> RawTables:
    """The ingested Parquet tables as ``RawTables`` (the input of the star)."""
    from carestar.config import REFERENCE

    def rd(n):
        return read_ingested(spark, parquet_dir, n)

    counted = {}
    for n in schemas.COUNTED_ONLY + ["cdc_drug_overdose"]:
        if _exists(spark, posixpath.join(parquet_dir, n)):
            counted[n] = rd(n)
    return RawTables(counted=counted, profile=profile or REFERENCE,
                     **{n: rd(n) for n in RAW_NAMES})


def corrupt_rows(df: DataFrame) -> DataFrame:
    """Rows with at least one value that did not parse against the schema."""
    return df.filter(F.col(CORRUPT).isNotNull())


def rejected_counts(spark: SparkSession, parquet_dir: str) -> DataFrame:
    """Rows per ingested claims table that carry a mark, and all rows."""
    from functools import reduce

    parts = [spark.read.parquet(posixpath.join(parquet_dir, n))
             .agg(F.count_if(F.col(CORRUPT).isNotNull()).alias("rejected"), F.count("*").alias("rows"))
             .select(F.lit(n).alias("table_name"), "rejected", "rows") for n in RAW_NAMES]
    return reduce(DataFrame.unionByName, parts)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def export_raw_csv(raw: RawTables, csv_dir: str, compression: str = "none") -> None:
    """Write raw tables in the claims CSV layout (schema columns, missing
    ones empty; counted tables as they are): the inverse of ``ingest_raw``,
    used for round trips.  A compressed file is not split by its readers, so
    it holds FILE_ROWS rows at most."""
    def one(name):
        df = raw.get(name)
        if name in schemas.CLAIMS:
            df = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                             .cast(f.dataType).alias(f.name) for f in schemas.CLAIMS[name].fields])
        (df.write.mode("overwrite").option("header", True).option("escape", '"')
         .option("compression", compression)
         .option("maxRecordsPerFile", 0 if compression == "none" else FILE_ROWS)
         .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
         .option("dateFormat", "yyyy-MM-dd").csv(posixpath.join(csv_dir, f"{name}.csv")))

    run_concurrently(one, RAW_NAMES + list(raw.counted))
