"""CSV scans: files are split unless a quoted field of theirs spans lines,
and types are inferred from whole files.

A line with an odd number of quotes begins or ends inside a quoted field
(doubled quotes count twice).  One pass counts such lines per file, as plain
text that Spark splits freely; only files that have some are parsed as a
whole (``multiLine``), all others are split among tasks.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def spanning_files(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(files whose quoted fields span lines, all other files) under ``path``."""
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    # most lines have no quote: found by bytes, before anything is counted
    odd = (lines.where(F.col("value").contains('"')).where(quotes % 2 == 1).groupBy(F.input_file_name().alias("file"))
           .agg(F.count("*").alias("n")).select("file").collect())  # names of files only
    odd_names = {_plain(r["file"]) for r in odd}
    names = sorted({_plain(f) for f in lines.inputFiles()})
    return [f for f in names if f in odd_names], [f for f in names if f not in odd_names]


def _plain(uri: str) -> str:
    return unquote(uri)


def read_csv(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """Rows of every file under ``path`` with ``schema``, quotes inside a
    field doubled; split wherever the file allows it."""
    def read(files, whole: bool) -> DataFrame:
        reader = spark.read.schema(schema).option("header", True).option("escape", '"')
        return reader.options(**options).option("multiLine", whole).csv(files)

    spanning, others = spanning_files(spark, path)
    if not spanning:
        return read(path, False)
    if not others:
        return read(path, True)
    return read(others, False).unionByName(read(spanning, True))


# Types from narrow to wide; a column takes the first that all its values fit.
# The patterns keep out what a cast alone would let in (a year as a date).
_TYPES = [
    ("boolean", r"^(?i)(true|false)$"),
    ("bigint", r"^[+-]?\d+$"),
    ("double", r"^(?i)[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?$|^[+-]?(inf|infinity|nan)$"),
    ("date", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("timestamp", r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?"
                  r"( ?Z| ?[+-]\d{2}(:?\d{2})?)?)?$"),
]


def infer_types(text: DataFrame) -> dict[str, str]:
    """Type of every text column, from all its values: the narrowest of
    boolean, bigint, double, date and timestamp that every non-empty value
    parses as, else string (also for a column without values).

    One aggregate over the whole table; each task sends one row.  A value
    names all its types as bits, and stops at the first that leaves no other:
    a whole number is also a double and nothing else.  Patterns
    come before parses, which are dear where they fail."""
    patterns = dict(_TYPES)
    bit = {kind: 1 << i for i, kind in enumerate(patterns)}

    def kinds(c: str) -> Column:
        v = F.col(c)

        def fits(kind: str) -> Column:
            return v.rlike(patterns[kind]) & v.try_cast(kind).isNotNull()

        # a date is also written as a time: the wider pattern matches both
        day = F.when((F.length(v) <= 11) & fits("date"), bit["date"]).otherwise(0)
        time = F.when(v.try_cast("timestamp").isNotNull(), bit["timestamp"]).otherwise(0)
        return (F.when(v.isNull() | (v == ""), F.lit(None).cast("int"))
                .when(fits("bigint"), bit["bigint"] | bit["double"])
                .when((F.substring(v, 5, 1) == "-") & v.rlike(patterns["timestamp"]), day + time)
                .when(fits("double"), bit["double"])
                .when((F.length(v) <= 6) & fits("boolean"), bit["boolean"]).otherwise(0))

    if not text.columns:
        return {}
    trimmed = text.select(*[F.trim(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(text.columns)])
    row = trimmed.agg(*[F.bit_and(kinds(c)).alias(c) for c in trimmed.columns]).first()
    return {c: next((k for k in patterns if (row[f"c{i}"] or 0) & bit[k]), "string")
            for i, c in enumerate(text.columns)}


def typed(text: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns cast to the given types; blank values become NULL where
    the type is not string."""
    return text.select(*[
        F.col(f"`{c}`") if types[c] == "string"
        else F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).try_cast(types[c]).alias(c)
        for c in text.columns])


def text_schema(spark: SparkSession, path: str) -> StructType:
    """All-text schema in the order of the file header (reads the header only)."""
    header = (spark.read.option("header", True).option("escape", '"').option("multiLine", True)
              .csv(path).columns)
    return StructType([StructField(c, StringType(), True) for c in header])
