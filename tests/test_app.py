"""The pipeline on claims CSV files end to end (hand-made rows written as CSV)."""

import glob
import json
import os

from carestar.app import build_from_csv, write_reports
from carestar.sources.ingest import export_raw_csv
from tests.claims_fixture import raw_tables


def test_pipeline_from_csv(spark, tmpdir_fresh):
    csv_dir = os.path.join(tmpdir_fresh, "csv")
    export_raw_csv(raw_tables(spark), csv_dir)
    out = os.path.join(tmpdir_fresh, "out")
    star = build_from_csv(spark, csv_dir, out)
    assert star.fact_encounter.count() == 6 and star.fact_medication.count() == 4
    assert star.dim_date.count() == 7670
    paths = write_reports(star, out)
    lb = spark.read.parquet(paths["brand_leaderboard"]).collect()
    assert {r.drug_description for r in lb} == {"Simvastatin 10 MG Oral Tablet",
                                                "lisinopril 10 MG Oral Tablet"}
    orphans = {r.check_name: r.violations
               for r in spark.read.parquet(paths["orphan_checks"]).collect()}
    assert orphans["orphan_encounters_no_patient"] == 1
    filters = {}
    for r in sorted(spark.read.json(os.path.join(out, "documents", "filters", "parts")).collect(),
                    key=lambda r: (r["dimension"], r["part"])):
        filters.setdefault(r["dimension"], []).extend(json.loads(r["items"]))
    manifest = {r["dimension"]: r["parts"] for r in
                spark.read.json(os.path.join(out, "documents", "filters", "manifest")).collect()}
    assert manifest == dict.fromkeys(filters, 1)
    assert filters["payers"] == ["Medicare", "NO_INSURANCE"]
    assert filters["years"] == ["2019", "2020", "2021"]  # 2005 is before the spine
    (dash,) = glob.glob(os.path.join(out, "documents", "dashboard", "part-*"))
    assert json.loads(open(dash).read())["kpis"]["total_encounters"] == 6
    assert os.path.isdir(paths["bi_encounter.csv"]) and os.path.isdir(paths["fact_med.json.gz"])
