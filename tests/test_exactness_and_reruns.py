"""Exact ratios, re-runs without stale rows, CSV dialect, report order."""

import glob
import gzip
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from carestar.functions.expr import avg_money, pct

SF = "/root/testdata/sf0.001"


def test_ratios_are_rounded_once_at_any_scale(spark):
    df = spark.sql("""SELECT
        cast(12349999.96 AS decimal(38,2)) a, cast(100000000.00 AS decimal(38,2)) b,
        cast(0.0049 AS decimal(18,4)) c, cast(0.0100 AS decimal(18,4)) d,
        cast(12499.99 AS decimal(38,2)) e, 2500000L n, cast(0 AS decimal(18,2)) z,
        cast(-1.05 AS decimal(18,2)) m, cast(10 AS decimal(18,2)) t""")
    r = df.select(pct("a", "b").alias("x"), pct("c", "d").alias("y"), avg_money("e", "n").alias("q"),
                  pct("a", "z").alias("none"), pct("m", "t").alias("minus"),
                  avg_money("m", "z").alias("none2")).first()
    assert (r.x, r.y, r.q, r.none, r.minus, r.none2) == (12.3, 49.0, 0.0, None, -10.5, None)


def test_rerun_leaves_no_vanished_year(spark, tmpdir_fresh):
    from carestar.sources.sinks import write_parquet
    from carestar.sources.warehouse import _write
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for write in (lambda d, p: write_parquet(d, p, "y"), lambda d, p: _write(d, p, "y")):
            path = os.path.join(tmpdir_fresh, str(id(write)))
            df = spark.range(10).withColumn("y", F.col("id") % 3)
            write(df, path)
            write(df.where("y <> 2"), path)
            assert {r.y for r in spark.read.parquet(path).collect()} == {0, 1}
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_rewritten_input_is_noticed(spark, tmpdir_fresh):
    from carestar.sources.warehouse import star_for
    copy = os.path.join(tmpdir_fresh, "sf")
    shutil.copytree(SF, copy)
    for f in glob.glob(f"{copy}/*"):
        os.chmod(f, 0o644)
    os.chmod(copy, 0o755)
    before = star_for(spark, copy).dim_patient.count()
    ten = spark.read.parquet(f"{SF}/customer.parquet").limit(10).toPandas()
    ten.to_parquet(f"{copy}/customer.parquet")
    assert before > 10 and star_for(spark, copy).dim_patient.count() == 10


def test_csv_dialect_and_marked_rows(spark, tmpdir_fresh):
    from carestar.sources.ingest import CORRUPT, read_claims_csv
    from carestar.sources.schemas import CLAIMS
    path = os.path.join(tmpdir_fresh, "conditions.csv")
    with open(path, "w") as f:
        f.write('START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION\n'
                '2020-01-01,,p1,e1,c1,"Room ""A"", ward 2\nsecond line"\n'
                '2020-01-02,,p2,e2,c2,fine,extra\n2020-01-03,,p3\n')
    rows = {r.PATIENT: r for r in read_claims_csv(spark, path, CLAIMS["conditions"]).collect()}
    assert rows["p1"].DESCRIPTION == 'Room "A", ward 2\nsecond line' and rows["p1"][CORRUPT] is None
    assert "<fields>" in rows["p2"][CORRUPT] and "<fields>" in rows["p3"][CORRUPT]


def test_folder_with_other_header_fails(spark, tmpdir_fresh):
    from carestar.sources.ingest import read_claims_csv
    for name, text in (("a", "x,y\n1,2\n"), ("b", "y,x\n3,4\n")):
        with open(os.path.join(tmpdir_fresh, f"{name}.csv"), "w") as f:
            f.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        read_claims_csv(spark, tmpdir_fresh, None).collect()


def test_missing_table_raises(spark, tmpdir_fresh):
    from carestar.sources.ingest import ingest_raw
    with pytest.raises(FileNotFoundError, match="patients"):
        ingest_raw(spark, tmpdir_fresh, os.path.join(tmpdir_fresh, "out"))


def test_sinks_keep_quotes_and_nulls(spark, tmpdir_fresh):
    from carestar.sources.sinks import write_csv, write_gzip_json
    df = spark.createDataFrame([(1, 'say "hi", x', None)], "id int, t string, n string").coalesce(1)
    write_csv(df, f"{tmpdir_fresh}/c")
    text = "".join(open(f).read() for f in glob.glob(f"{tmpdir_fresh}/c/part*"))
    assert '"say ""hi"", x"' in text
    write_gzip_json(df, f"{tmpdir_fresh}/j")
    line = gzip.open(glob.glob(f"{tmpdir_fresh}/j/part*")[0], "rt").read()
    assert json.loads(line) == {"id": 1, "t": 'say "hi", x', "n": None}


def test_reports_come_in_order(spark):
    from carestar.registry import JOBS, ORDERED
    from carestar.sources.warehouse import star_for
    star = star_for(spark, SF)
    for name, keys in ORDERED.items():
        rows = JOBS[name](star).collect()

        def key(r):
            out = []
            for k in keys:
                v = r[k.lstrip("-")]
                out.append((v is None, 0 if v is None else (-v if k[0] == "-" else v)))
            return out

        assert [key(r) for r in rows] == sorted(key(r) for r in rows), name


def test_orphans_and_null_dimension_key(spark):
    """Seeded orphans: facts against patients without every third one, and
    against a dimension with a NULL key (nothing qualifies then)."""
    from carestar.operators.joins import count_not_in
    from carestar.sources.warehouse import star_for
    star = star_for(spark, SF)
    few = star.dim_patient.where(F.col("patient_key") % 3 != 0)
    # the mapping's own orphans have negative keys
    expected = star.fact_encounter.where("patient_key % 3 = 0 OR patient_key < 0").count()
    got = count_not_in(star.fact_encounter, "patient_key", few, "patient_key").first()["violations"]
    assert got == expected > 0
    with_null = few.select("patient_key").union(spark.sql("SELECT cast(NULL AS bigint)"))
    assert count_not_in(star.fact_encounter, "patient_key", with_null,
                        "patient_key").first()["violations"] == 0
