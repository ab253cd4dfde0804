"""CSV scans: files stay splittable unless a quoted field spans lines; types
come from whole files; digests tell tables apart."""

import os

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from carestar.sources import csvscan
from carestar.sources.digest import content_digest
from carestar.sources.ingest import read_claims_csv

HEADER = "Id,NOTE\n"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def _schema(*names):
    return StructType([StructField(n, StringType()) for n in names])


def test_plain_file_is_read_by_many_tasks(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "big.csv")
    _write(path, HEADER + "".join(f'{i},"a ""quoted"" word, {i}"\n' for i in range(60_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        df = csvscan.read_csv(spark, path, _schema("Id", "NOTE"))
        assert df.rdd.getNumPartitions() >= 10
        assert df.count() == 60_000 and df.select("Id").distinct().count() == 60_000
        assert df.where(F.col("NOTE") == F.concat(F.lit('a "quoted" word, '), "Id")).count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_only_files_with_spanning_fields_are_parsed_whole(spark, tmpdir_fresh):
    folder = os.path.join(tmpdir_fresh, "many files 100%")
    _write(f"{folder}/a b.csv", HEADER + '1,plain\n2,"with ""quotes"""\n')
    _write(f"{folder}/c.csv", HEADER + '3,"two\nlines, ""and"" more"\n4,\n')
    _write(f"{folder}/d.csv", HEADER)
    spanning, others = csvscan.spanning_files(spark, folder)
    assert [os.path.basename(f) for f in spanning] == ["c.csv"]
    assert {os.path.basename(f) for f in others} == {"a b.csv", "d.csv"}
    rows = {r.Id: r.NOTE for r in csvscan.read_csv(spark, folder, _schema("Id", "NOTE")).collect()}
    assert rows == {"1": "plain", "2": 'with "quotes"', "3": 'two\nlines, "and" more', "4": None}


def test_types_come_from_the_whole_file(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "cdc.csv")
    body = "".join(f"{1999 + i},S{i},{i},2020-01-{1 + i % 28:02d},true,\n" for i in range(3000))
    _write(path, "Year,State Name,Data Value,Day,Flag,Nothing\n" + body
           + "2020,S,1.5,2020-02-29T10:00:00Z,FALSE,\n,,,,,\n")  # the last values decide
    df = read_claims_csv(spark, path, None)
    assert dict(df.dtypes) == {"Year": "bigint", "State Name": "string", "Data Value": "double",
                               "Day": "timestamp", "Flag": "boolean", "Nothing": "string"}
    assert df.count() == 3002 and df.where("`Data Value` = 1.5 AND NOT Flag").count() == 1
    assert df.where("Year IS NULL AND `State Name` IS NULL AND Day IS NULL").count() == 1


def test_types_narrow_to_wide(spark):
    df = spark.createDataFrame(
        [("1", "1", "2020", "x", "", "2020-01-01", "nan"), ("-7", "1e3", "2021-01-01", "1", None,
                                                           "2020-12-31", "2")],
        "i string, f string, mixed string, s string, none string, d string, n string")
    assert csvscan.infer_types(df) == {"i": "bigint", "f": "double", "mixed": "string", "s": "string",
                                       "none": "string", "d": "date", "n": "double"}
    assert csvscan.infer_types(df.where("1 = 0")) == dict.fromkeys(df.columns, "string")
    assert csvscan.typed(df, csvscan.infer_types(df)).where("f = 1000").count() == 1


def test_digest_ignores_order_and_sees_values(spark):
    a = spark.createDataFrame([(1, "x", 0.1), (2, None, None)], "k int, s string, v double")
    same = a.orderBy(F.desc("k")).select("v", "s", "k").repartition(3)
    one = content_digest("t", a).first()
    assert one.row_count == 2 and content_digest("t", same).first() == one
    for other in (a.union(a), a.withColumn("s", F.lit("x")), a.withColumn("v", F.col("v") + 1e-6)):
        assert content_digest("t", other).first() != one
    assert tuple(content_digest("t", a.where("1 = 0")).first()) == ("t", 0, "0")
