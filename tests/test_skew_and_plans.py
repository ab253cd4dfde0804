"""Hot keys (one drug and one patient holding a third of all fills) against
a pandas brute force, and plan properties the jobs rely on at scale."""

import datetime as dt
import re
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from carestar.config import REFERENCE
from carestar.plans import brand, conditions, quality
from carestar.plans.star import build_star
from carestar.sources import schemas
from carestar.sources.tables import RawTables
from tests.claims_fixture import ORGANIZATIONS, PAYERS, PROVIDERS, _rows


def _skewed_raw(spark, n=3000):
    rng = random.Random(7)
    pats = [dict(Id=f"P{i}", BIRTHDATE=dt.date(1950 + i % 50, 1 + i % 12, 1), GENDER="FM"[i % 2],
                 RACE="r", ETHNICITY="e", STATE=f"S{i % 9}", COUNTY="c",
                 HEALTHCARE_EXPENSES=Decimal(100), HEALTHCARE_COVERAGE=Decimal(10))
            for i in range(200)]
    meds, encs, conds = [], [], []
    for i in range(n):
        hot = i % 3 == 0
        drug = "Hotdrug 5 MG" if hot else f"Drug{rng.randint(0, 40)} 1 MG"
        pat = "P0" if i % 3 == 1 else f"P{rng.randint(1, 199)}"
        cost = Decimal(rng.randint(0, 50000)) / 100
        meds.append(dict(START=dt.datetime(2020, 1 + i % 12, 1, tzinfo=dt.timezone.utc),
                         STOP=None if i % 4 == 0 else dt.datetime(2021, 1, 1, tzinfo=dt.timezone.utc),
                         PATIENT=pat, PAYER="PY1" if i % 2 else "PY2", ENCOUNTER=f"E{i}",
                         CODE="1", DESCRIPTION=drug, BASE_COST=Decimal(1),
                         PAYER_COVERAGE=cost / 2, DISPENSES=1, TOTALCOST=cost))
        encs.append(dict(Id=f"E{i}", START=dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc),
                         PATIENT=pat, PROVIDER="PR1", PAYER="PY1", ENCOUNTERCLASS="a",
                         TOTAL_CLAIM_COST=cost, PAYER_COVERAGE=cost, BASE_ENCOUNTER_COST=cost))
    for i in range(600):
        pat = "P0" if i % 3 == 0 else f"P{rng.randint(1, 199)}"
        conds.append(dict(PATIENT=pat, ENCOUNTER=f"E{i}", CODE=str(i % 5),
                          DESCRIPTION="Hot condition" if i % 3 else f"Cond{i % 7}"))
    mk = lambda name, rows: spark.createDataFrame(_rows(schemas.CLAIMS[name], rows),
                                                  schemas.CLAIMS[name])
    raw = RawTables(patients=mk("patients", pats), encounters=mk("encounters", encs),
                    medications=mk("medications", meds), conditions=mk("conditions", conds),
                    providers=mk("providers", PROVIDERS), organizations=mk("organizations", ORGANIZATIONS),
                    payers=mk("payers", PAYERS), profile=REFERENCE)
    return raw, pd.DataFrame(meds), pd.DataFrame(encs), pd.DataFrame(conds)


@pytest.fixture(scope="module")
def skewed(spark):
    raw, meds, encs, conds = _skewed_raw(spark)
    return build_star(raw), meds, encs, conds


def test_leaderboard_with_hot_drug_and_patient(skewed):
    star, meds, _, _ = skewed
    m = meds[meds.TOTALCOST > 0]
    g = m.groupby("DESCRIPTION").agg(fill_count=("PATIENT", "size"),
                                     unique_patients=("PATIENT", "nunique"),
                                     rev=("TOTALCOST", "sum")).reset_index()
    g = g.sort_values(["rev", "DESCRIPTION"], ascending=[False, True]).head(25)
    got = brand.brand_leaderboard(star).collect()
    assert [r.drug_description for r in got] == list(g.DESCRIPTION)
    assert [r.fill_count for r in got] == list(g.fill_count)
    assert [r.unique_patients for r in got] == list(g.unique_patients)
    assert [Decimal(str(r.total_revenue)) for r in got] == list(g.rev)


def test_brand_by_state_with_hot_patient(skewed):
    star, meds, _, _ = skewed
    pos = meds[meds.TOTALCOST > 0].groupby("DESCRIPTION").TOTALCOST.sum().reset_index()
    top = set(pos.sort_values(["TOTALCOST", "DESCRIPTION"], ascending=[False, True])
              .head(20).DESCRIPTION)
    states = {f"P{i}": f"S{i % 9}" for i in range(200)}
    m = meds[meds.DESCRIPTION.isin(top)].assign(state=lambda d: d.PATIENT.map(states))
    want = {(r.DESCRIPTION, r.state): (r.n, r.rev) for r in
            m.groupby(["DESCRIPTION", "state"]).agg(n=("PATIENT", "size"), rev=("TOTALCOST", "sum"))
            .reset_index().itertuples()}
    got = brand.brand_by_state(star, k=1000).collect()
    assert {(r.drug_description, r.patient_state): r.fill_count for r in got} == \
        {k: v[0] for k, v in want.items()}
    from decimal import ROUND_HALF_UP
    for r in got:  # whole dollars, half-up
        exact = want[(r.drug_description, r.patient_state)][1]
        assert r.revenue == float(exact.quantize(Decimal(1), rounding=ROUND_HALF_UP))


def test_condition_fan_out_with_hot_patient(skewed):
    star, _, encs, conds = skewed
    e = encs[encs.TOTAL_CLAIM_COST > 0]
    bridge = conds[["DESCRIPTION", "PATIENT"]].drop_duplicates()
    j = bridge.merge(e, on="PATIENT")
    want = {r.DESCRIPTION: (r.p, r.n) for r in
            j.groupby("DESCRIPTION").agg(p=("PATIENT", "nunique"), n=("Id", "size"))
            .reset_index().itertuples()}
    got = {r.therapeutic_area: (r.patient_count, r.encounter_count)
           for r in conditions.condition_encounter_cost(star, k=100).collect()}
    assert got == want


def test_orphans_on_skewed_keys(skewed):
    star, _, _, _ = skewed
    got = {r.check_name: r.violations for r in quality.orphan_checks(star).collect()}
    assert got["orphan_meds_no_patient"] == 0 and got["orphan_encounters_no_payer"] == 0


def _plan(df):
    # whole paths (left on: plans are also asked for by several threads)
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_slicer_prunes_raw_partitions(spark):
    from carestar.operators.slicers import apply_slicers
    from carestar.plans.bi import bi_encounter, bi_medication
    from carestar.sources.warehouse import star_for
    s = star_for(spark, "/root/testdata/sf0.001")
    for df in (bi_encounter(s), bi_medication(s)):
        plan = _plan(apply_slicers(df, {"year": [1996, 1997]}))
        assert re.search(r"PartitionFilters: \[(fill_)?year#\d+ IN \(1996,1997\)\]", plan)


def test_no_cross_join_anywhere(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for name, q in qs.items():
        if name in ("export_bi_parquet", "export_bi_csv", "ingest_roundtrip"):
            continue
        plan = _plan(q(spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_only_sides_of_a_bounded_size_are_broadcast_hinted(spark):
    """By bytes, not rows: a narrow side is hinted, a wide one with fewer
    rows is not, nor one of unknown size."""
    from carestar.operators.joins import maybe_broadcast

    def hinted(df):
        return "broadcast" in maybe_broadcast(df)._jdf.queryExecution().logical().toString().lower()

    assert hinted(spark.range(1_000_000))
    wide = spark.range(900_000).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(20)])
    assert not hinted(wide) and not hinted(spark.range(1 << 40))
    assert not hinted(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int"))


def test_aqe_splits_hot_key_partition_in_bi_join(spark, skewed, monkeypatch):
    """A patient holding a third of the fills (and NULL keys) in the BI left
    join: with broadcast off, AQE marks the sort-merge join as a skew join
    and splits the hot partition; the result keeps every fill."""
    from carestar.operators import joins
    from carestar.plans.bi import bi_medication
    star, meds, _, _ = skewed
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 0)
        df = bi_medication(star)
        rows = df.collect()  # runs this DataFrame's own adaptive plan to its final form
        assert len(rows) == len(meds)
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final
        assert re.search(r"SortMergeJoin\(skew=true\) \[patient_key#\d+\]", final), final[:3000]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


SF = "/root/testdata/sf0.001"


def test_cost_filter_reaches_the_scan_of_the_fills(spark):
    """Written facts hold their final money columns, so Parquet statistics
    serve the filter."""
    from carestar.plans import conditions as cond
    from carestar.sources.warehouse import star_for
    star = star_for(spark, SF)
    for job in (brand.brand_leaderboard, brand.payer_coverage_rate, brand.drug_class_revenue,
                brand.payer_coverage_by_brand, brand.top_drugs_by_revenue,
                cond.condition_encounter_cost):
        plan = _plan(job(star))
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(total_(claim_)?cost,0.00\)", plan), job.__name__


def test_facts_are_partitioned_and_sorted(spark):
    import glob

    import pyarrow.parquet as pq
    from carestar.sources.warehouse import built_root
    root = built_root(spark, SF).removeprefix("file:")
    files = glob.glob(f"{root}/star/fact_medication/fill_year=*/*.parquet")
    assert len({f.split("fill_year=")[1].split("/")[0] for f in files}) == 7
    for f in files:
        t = pq.read_table(f, columns=["drug_description", "total_cost"], partitioning=None).to_pylist()
        keys = [(r["drug_description"], r["total_cost"]) for r in t]
        assert keys == sorted(keys)


def test_cohort_shuffles_no_fill(spark, monkeypatch):
    """Only a row per patient and task leaves the scan of the fills, also
    where the cohort is too large to broadcast."""
    from carestar.plans.filters import condition_cohort_fills
    from carestar.sources.warehouse import star_for
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = _plan(condition_cohort_fills(star_for(spark, SF))).split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    (scan,) = [i for i, x in enumerate(lines) if "/fact_medication" in x]
    above = [x for x in lines[:scan][::-1] if "Project" not in x and "Filter" not in x]
    assert "partial_count(1)" in above[0], lines


def test_dashboard_reads_every_table_at_most_twice(spark, monkeypatch):
    """Large tables are read by the groupings only, once each."""
    from carestar.operators import ranking
    from carestar.plans import dashboard
    from carestar.sources.warehouse import star_for
    made = []

    def kept(df):
        made.append(_plan(df))
        return ranking.written_once(df)

    monkeypatch.setattr(dashboard, "written_once", kept)
    star = star_for(spark, SF)
    plans = [_plan(dashboard.dashboard_document(star)), *made]
    assert len(made) == 4

    def scans(table):
        return sum(p.count(f"/{table}]") + p.count(f"/{table},") for p in plans)

    for table in ("fact_medication", "fact_encounter", "conditions", "dim_patient"):
        assert scans(table) == 1, (table, scans(table))
    assert scans("dim_provider") <= 2 and scans("dim_payer") <= 2


def test_positions_number_the_whole_order_over_many_tasks(spark):
    from carestar.operators.ranking import positions
    rng = random.Random(3)
    rows = [(f"v{rng.randint(0, 10 ** 6)}-{i}", rng.randint(0, 5)) for i in range(4000)]
    df = spark.createDataFrame(rows, "value string, n int").repartition(6)
    got = positions(df, [F.col("n").desc(), F.col("value")])
    assert "SinglePartition" not in _plan(got.drop("position"))
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [(r.value, r.n) for r in sorted(got.collect(), key=lambda r: r.position)] == want
    assert sorted(r.position for r in got.collect()) == list(range(1, 4001))
    assert positions(df.where("1 = 0"), [F.col("value")]).collect() == []


def test_long_lists_are_written_in_parts(spark):
    import json

    from carestar.plans import dashboard
    rows = [("a", i + 1, f"v{i:05d}") for i in range(2500)] + [("b", 1, 'x"y')]
    df = spark.createDataFrame(rows, "dimension string, position long, value string").repartition(4)
    parts = {(r.dimension, r.part): json.loads(r["items"]) for r in dashboard.document_parts(df).collect()}
    assert {k: len(v) for k, v in parts.items()} == {("a", 0): 1000, ("a", 1): 1000, ("a", 2): 500, ("b", 0): 1}
    assert parts["a", 0] + parts["a", 1] + parts["a", 2] == [f"v{i:05d}" for i in range(2500)]
    assert parts["b", 0] == ['x"y']


def test_sliced_facts_equal_the_filtered_wide_tables(spark):
    from carestar.operators.slicers import apply_slicers
    from carestar.plans.bi import bi_encounter, bi_medication
    from carestar.plans.filters import sliced
    from carestar.sources.warehouse import star_for
    star = star_for(spark, SF)
    for selection in ({}, {"age_band": []}, {"payer_name": ["PAYER_1", "PAYER_7"], "year": [1997, 1999]},
                      {"age_band": ["35-49", None], "patient_gender": ["F"], "month_num": [1, 2, 3]},
                      {"day_type": ["Weekend"], "provider_state": ["ASIA"], "quarter": [2]},
                      {"patient_state": ["nowhere"]}):
        for fact, wide, cost in (("fact_encounter", bi_encounter, "total_claim_cost"),
                                 ("fact_medication", bi_medication, "total_cost")):
            df = wide(star)
            known = {k: v for k, v in selection.items() if k in df.columns}
            want = apply_slicers(df, known).agg(F.count("*"), F.sum(F.col(cost).cast("decimal(18,2)")))
            got = sliced(star, fact, selection).agg(F.count("*"), F.sum(cost))
            assert [str(x) for x in got.first()] == [str(x) for x in want.first()], (fact, selection)
