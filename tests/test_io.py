"""Sources and sinks: CSV ingest with a malformed line, gzip JSON and CSV
round trips, the dashboard document file, incremental streaming ingest."""

import gzip
import glob
import json
import os

from pyspark.sql import functions as F

from carestar.sources import ingest, schemas, sinks

PATIENTS_CSV = """Id,BIRTHDATE,DEATHDATE,SSN,GENDER,RACE,ETHNICITY,STATE,COUNTY,HEALTHCARE_EXPENSES,HEALTHCARE_COVERAGE
a1,1980-01-02,,999-1,F,white,nonhispanic,Massachusetts,Suffolk,100.1234,50.5
a2,1950-12-31,2020-02-29,999-2,M,black,hispanic,Massachusetts,Norfolk,20,0
a3,not-a-date,,999-3,M,asian,nonhispanic,Massachusetts,Suffolk,10,1
"""


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_ingest_explicit_schema_and_counts(spark, tmpdir_fresh):
    """Columns are taken by header name: the file has extra columns (SSN) and
    its own order; a value that does not parse is NULL and reported."""
    csv_dir = os.path.join(tmpdir_fresh, "csv")
    _write(os.path.join(csv_dir, "patients.csv"), PATIENTS_CSV)
    _write(os.path.join(csv_dir, "observations.csv"), "DATE,PATIENT,CODE,VALUE\n2020-01-01,a1,x,1\n")
    counts = {r.table_name: r.row_count
              for r in ingest.ingest_raw(spark, csv_dir, os.path.join(tmpdir_fresh, "pq"), partial=True).collect()}
    assert counts == {"patients": 3, "observations": 1}
    p = spark.read.parquet(os.path.join(tmpdir_fresh, "pq", "patients"))
    assert dict(p.dtypes)["HEALTHCARE_EXPENSES"] == "decimal(18,4)"
    assert dict(p.dtypes)["Id"] == "string" and "SSN" not in p.columns
    rows = {r.Id: r for r in p.collect()}
    assert rows["a1"].GENDER == "F" and rows["a1"].STATE == "Massachusetts"
    assert str(rows["a1"].HEALTHCARE_EXPENSES) == "100.1234"
    assert rows["a2"].DEATHDATE.isoformat() == "2020-02-29"
    bad = ingest.corrupt_rows(p).collect()
    assert [(r.Id, r._corrupt_record) for r in bad] == [("a3", "BIRTHDATE")]
    assert rows["a3"].BIRTHDATE is None and rows["a3"].GENDER == "M"
    obs = spark.read.parquet(os.path.join(tmpdir_fresh, "pq", "observations"))
    assert dict(obs.dtypes) == {"DATE": "date", "PATIENT": "string", "CODE": "string",
                                "VALUE": "bigint"}  # what the whole file holds


def test_gzip_json_and_document_sinks(spark, tmpdir_fresh):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 2.5)], "k int, s string, x double")
    out = os.path.join(tmpdir_fresh, "facts.json.gz")
    sinks.write_gzip_json(df, out)
    rows = []
    for f in glob.glob(os.path.join(out, "*.json.gz")):
        with gzip.open(f, "rt") as fh:
            rows += [json.loads(l) for l in fh]
    assert sorted(rows, key=lambda r: r["k"]) == [{"k": 1, "s": "a", "x": None}, {"k": 2, "s": "b", "x": 2.5}]
    doc = df.agg(F.to_json(F.struct(F.collect_list("s").alias("s"))).alias("document"))
    sinks.write_document(doc, os.path.join(tmpdir_fresh, "doc"))
    (txt,) = glob.glob(os.path.join(tmpdir_fresh, "doc", "part-*"))
    assert sorted(json.loads(open(txt).read())["s"]) == ["a", "b"]


def test_csv_round_trip(spark, tmpdir_fresh):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2020, 2, 29), 1.25, "x,y"), (None, None, None)],
                               "d date, v double, s string")
    p = os.path.join(tmpdir_fresh, "t.csv")
    sinks.write_csv(df, p)
    back = spark.read.schema(df.schema).option("header", True).csv(p)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_streaming_incremental_ingest_picks_only_new_files(spark, tmpdir_fresh):
    from carestar.streaming.incremental import ingest_new_files
    src = os.path.join(tmpdir_fresh, "drops")
    out = os.path.join(tmpdir_fresh, "out")
    # header in the export's own order, with a column the jobs do not read
    hdr = "Id,ORGANIZATION,NAME,GENDER,SPECIALITY,ADDRESS,CITY,STATE,ZIP,LAT,UTILIZATION\n"
    _write(os.path.join(src, "part1.csv"), hdr + "p1,o1,A,F,GP,x,Boston,MA,02101,42.3,3\n")
    n1 = ingest_new_files(spark, src, schemas.PROVIDERS, out, "providers-" + os.path.basename(tmpdir_fresh))
    _write(os.path.join(src, "part2.csv"), hdr + "p2,o1,B,M,GP,y,Salem,MA,01970,42.5,4\n"
           + "p3,o2,C,F,CARDIOLOGY,z,Lynn,MA,01901,42.4,5\n")
    n2 = ingest_new_files(spark, src, schemas.PROVIDERS, out, "providers-" + os.path.basename(tmpdir_fresh))
    assert (n1, n2) == (1, 2)
    got = sorted((r.Id, r.UTILIZATION, r.ZIP) for r in spark.read.parquet(out).collect())
    assert got == [("p1", 3, "02101"), ("p2", 4, "01970"), ("p3", 5, "01901")]


def test_fact_export_gzip_json_round_trip(spark, tmpdir_fresh):
    """L44 written as gzip JSON Lines reads back equal (NULL fields omitted)."""
    from carestar.plans.bi import export_facts, export_medication_facts
    from carestar.sources.warehouse import star_for
    s = star_for(spark, "/root/testdata/sf0.001")
    paths = export_facts(s, tmpdir_fresh)
    df = export_medication_facts(s)
    back = spark.read.schema(df.schema).json(paths["fact_med.json.gz"])
    assert back.count() == df.count()
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    assert glob.glob(os.path.join(paths["conditions.json.gz"], "*.json.gz"))


ENCOUNTERS_CSV = (
    "Id,START,STOP,PATIENT,ORGANIZATION,PROVIDER,PAYER,ENCOUNTERCLASS,CODE,DESCRIPTION,"
    "BASE_ENCOUNTER_COST,TOTAL_CLAIM_COST,PAYER_COVERAGE,REASONCODE,REASONDESCRIPTION\n"
    "e1,2019-02-17T05:07:38Z,2019-02-17T05:22:38Z,p1,o1,pr1,py1,wellness,410620009,"
    "Well child visit (procedure),129.16,129.16,0.0,,\n"
    "e2,2020-02-29T23:30:00Z,,p2,o1,pr1,,emergency,50849002,"
    "\"Emergency room admission, first\",85.55,1234.5678,1000.1,444814009,Viral sinusitis (disorder)\n"
)


def test_ingest_claims_csv_format(spark, tmpdir_fresh):
    """UTC 'Z' timestamps, empty optional fields, quoted commas, 4-place money."""
    from decimal import Decimal
    csv_dir = os.path.join(tmpdir_fresh, "csv")
    _write(os.path.join(csv_dir, "encounters.csv"), ENCOUNTERS_CSV)
    ingest.ingest_raw(spark, csv_dir, os.path.join(tmpdir_fresh, "pq"), partial=True).collect()
    enc = spark.read.parquet(os.path.join(tmpdir_fresh, "pq", "encounters"))
    e = {r.Id: r for r in enc.collect()}
    start = {r.Id: r.s for r in enc.select("Id", F.date_format("START", "yyyy-MM-dd HH:mm:ss")
                                           .alias("s")).collect()}  # session zone UTC
    assert start == {"e1": "2019-02-17 05:07:38", "e2": "2020-02-29 23:30:00"}
    assert e["e2"].STOP is None and e["e2"].PAYER is None
    assert e["e1"].REASONCODE is None  # empty field -> NULL
    assert e["e2"].DESCRIPTION == "Emergency room admission, first"
    assert e["e2"].TOTAL_CLAIM_COST == Decimal("1234.5678")
    assert all(r._corrupt_record is None for r in e.values())


def test_catalog_tables_and_views_are_dropped_and_recreated(spark):
    """Tables and views of the catalog hold what the jobs return; a second
    registration replaces the first."""
    from carestar.plans.bi import bi_encounter, bi_medication
    from carestar.sources import catalog
    from carestar.sources.warehouse import built_root, star_for
    sf = "/root/testdata/sf0.001"
    star, root = star_for(spark, sf), built_root(spark, sf)
    for _ in range(2):
        names = catalog.register(spark, root, "carestar_test")
    assert spark.table("carestar_test.fact_medication").count() == star.fact_medication.count()
    for view, job in (("v_bi_encounter", bi_encounter), ("v_bi_medication", bi_medication)):
        df = job(star)
        got = spark.table(f"carestar_test.{view}").select(df.columns)
        assert got.exceptAll(df).count() == 0 and df.exceptAll(got).count() == 0
    assert {t.name for t in spark.catalog.listTables("carestar_test")} >= {n.split(".")[1] for n in names}
    plan = spark.sql("SELECT * FROM carestar_test.v_bi_medication WHERE year = 1997")
    assert "fill_year" in plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]
