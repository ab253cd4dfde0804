"""Star, KPI and quality jobs on hand-made claims rows."""

import datetime as dt

import pytest

from carestar.plans import brand, conditions, dashboard, profile, quality
from carestar.plans.star import build_star, date_spine
from tests.claims_fixture import raw_tables


@pytest.fixture(scope="module")
def star(spark):
    return build_star(raw_tables(spark))


def test_date_spine_reference_bounds(spark):
    dd = date_spine(spark, dt.date(2010, 1, 1), dt.date(2030, 12, 31))
    assert dd.count() == 7670  # Q12: the docs say 7,672
    rows = {r.full_date: r for r in dd.filter("full_date in ('2010-01-03', '2020-02-29', "
                                              "'2020-03-02')").collect()}
    sun = rows[dt.date(2010, 1, 3)]
    assert (sun.week_num, sun.day_name, sun.day_type, sun.date_key) == (53, "Sunday", "Weekend", 20100103)
    leap = rows[dt.date(2020, 2, 29)]
    assert (leap.day_name, leap.day_type, leap.month_name, leap.quarter) == ("Saturday", "Weekend", "February", 1)
    assert rows[dt.date(2020, 3, 2)].day_type == "Weekday"


def test_dim_patient_age_band_and_null_guards(star):
    p = {r.patient_key: r for r in star.dim_patient.collect()}
    assert (p["P1"].age_years, p["P1"].age_band) == (35, "35-49")  # as_of 2025-12-31
    assert p["P2"].age_years is None and p["P2"].age_band is None  # NULL birth date (Q6)
    assert p["P2"].coverage_rate_pct is None  # zero expenses -> NULL, no error
    assert p["P2"].is_deceased == 1 and p["P2"].death_date == dt.date(2020, 2, 29)
    assert (p["P3"].age_years, p["P3"].age_band) == (15, "0-17")
    assert (p["P4"].age_band, p["P4"].coverage_rate_pct) == ("80+", 33.3)


def test_fact_encounter_rounding_flags_duration(star):
    e = {(r.encounter_key, r.patient_key): r for r in star.fact_encounter.collect()}
    e1 = e[("E1", "P1")]
    assert e1.encounter_duration_days == 1  # crosses midnight
    assert e1.is_fully_covered == 1 and e1.date_key == 20191231 and e1.year == 2019
    e2 = e[("E2", "P1")]
    assert str(e2.total_claim_cost) == "200.01" and str(e2.base_cost) == "120.01"  # half-up
    assert str(e2.patient_responsibility) == "150.01"
    assert e[("E3", "P2")].encounter_duration_days is None  # NULL stop


def test_fact_medication_completed_flag(star):
    m = star.fact_medication.collect()
    assert sorted(r.is_completed for r in m) == [0, 1, 1, 1]
    assert {r.date_key for r in m} == {20200115, 20200215, 20200301, 20200401}


def test_orphan_checks_null_semantics(star):
    got = {r.check_name: r.violations for r in quality.orphan_checks(star).collect()}
    assert got == {"orphan_encounters_no_patient": 1, "orphan_meds_no_patient": 0,
                   "orphan_encounters_no_provider": 1,  # NULL provider never counts
                   "orphan_encounters_no_payer": 1}     # NULL payer skipped


def test_null_rates_blank_is_null(star):
    got = {(r.tbl, r.col): r.null_pct for r in quality.null_rates(star).collect()}
    # REASONCODE: NULL, '' and '  ' of 6 encounters
    assert got[("encounters", "REASONCODE")] == 50.0
    assert got[("encounters", "PAYER")] == 16.7
    assert got[("medications", "REASONCODE")] == 50.0
    assert got[("medications", "STOP")] == 25.0
    assert got[("patients", "DEATHDATE")] == 75.0


def test_duplicates_overpayment_nonpositive(star):
    assert quality.duplicate_encounters(star).first().violations == 1
    over = quality.overpayment_violations(star).collect()
    # coverage 0 on a -5 claim also exceeds the cost
    assert [(r.encounter_key, r.overpayment_amt) for r in over] == [("E4", 50.0), ("E6", 5.0)]
    nonpos = {r.encounter_class: r.zero_or_neg_cost_count
              for r in quality.nonpositive_cost_by_class(star).collect()}
    assert nonpos == {"emergency": 1, "wellness": 1}


def test_leaderboard_half_cent_average_and_ties(star):
    rows = brand.brand_leaderboard(star).collect()
    # both drugs total 100.01: the tie breaks on the name (binary order)
    assert [r.drug_description for r in rows] == ["Simvastatin 10 MG Oral Tablet",
                                                  "lisinopril 10 MG Oral Tablet"]
    simva = rows[0]
    assert (simva.fill_count, simva.unique_patients, simva.total_revenue) == (2, 2, 100.01)
    assert simva.avg_cost_per_fill == 50.01  # 50.005 rounds half-up


def test_payer_rate_and_sum_property(star):
    rows = {r.payer_name: r for r in brand.payer_coverage_rate(star).collect()}
    assert set(rows) == {"Medicare"}  # PY2 fill has zero cost
    assert rows["Medicare"].coverage_rate_pct == 40.0  # 80.01 / 200.02
    total = star.fact_medication.filter("total_cost > 0").count()
    assert sum(r.fill_count for r in rows.values()) == total


def test_drug_class_one_word_name(star):
    classes = {r.drug_class for r in brand.drug_class_revenue(star).collect()}
    assert classes == {"Simvastatin", "lisinopril"}
    allc = {r.drug_class for r in dashboard.frequent_drug_classes(star, min_fills=0).collect()}
    assert allc == classes


def test_condition_encounter_cost_fan_out(star):
    rows = {r.therapeutic_area: r for r in conditions.condition_encounter_cost(star).collect()}
    # Hypertension: patient P1 with encounters E1 (100) and E2 (200.01), once each
    h = rows["Hypertension"]
    assert (h.patient_count, h.encounter_count, h.total_encounter_cost) == (1, 2, 300.01)
    v = rows["Viral sinusitis (disorder)"]  # P2 has only a zero-cost encounter; P3 has E1 (40)
    assert (v.patient_count, v.encounter_count, v.total_encounter_cost) == (1, 1, 40.0)


def test_code_prefix_and_profile(star):
    cp = {r.code_prefix: r.patient_count for r in conditions.code_prefix_distribution(star).collect()}
    assert cp == {"3": 1, "4": 2}
    cd = profile.cost_distribution(star).first()
    # positive base costs: 80, 120.005, 300, 10 -> median (80 + 120.005) / 2 = 100.0025;
    # the exact median rounds to 100.00 (rounding to cents first would give 100.01)
    assert (cd.min_cost, cd.max_cost, cd.median_cost, cd.total_cost) == (10.0, 300.0, 100.0, 510.01)
    assert cd.avg_cost == 127.5  # 510.005 / 4 = 127.50125
    rng = profile.activity_date_range(star).first()
    assert (rng.earliest_encounter, rng.day_span) == (dt.date(2005, 5, 5),
                                                     (dt.date(2021, 7, 3) - dt.date(2005, 5, 5)).days)


def test_dim_date_drops_old_years_in_bi(star):
    from carestar.plans.bi import bi_encounter
    e4 = bi_encounter(star).filter("encounter_key = 'E4'").first()
    assert e4.month_name is None  # 2005 is before the 2010 spine (Q13)
    assert e4.age_band is None and e4.payer_name is None  # orphan keys keep the row


def test_dashboard_document_is_json(star):
    import json
    doc = json.loads(dashboard.dashboard_document(star).first().document)
    assert doc["kpis"]["total_patients"] == 4 and doc["kpis"]["total_prescriptions"] == 4
    assert [t["drug"] for t in doc["top_drugs"]][0] == "Simvastatin 10 MG Oral Tablet"
    assert {"payer_mix", "specialties", "states", "age_bands", "trend", "ta_patients",
            "ta_enc_cost", "icd10", "drug_class", "adherence"} <= set(doc)


def test_register_views_for_sql(spark, star):
    from carestar.plans.bi import register_views
    names = register_views(star)
    assert "v_bi_encounter" in names
    n = spark.sql("SELECT count(*) AS n FROM v_bi_encounter WHERE age_band IS NOT NULL").first().n
    assert n == 4  # E4: orphan patient; E3: patient without birth date


def test_calendar_frame_differs_from_rows_frame(star):
    rows = {(r.drug_description, r.yr, r.mo): r.moving_avg_3mo_revenue
            for r in brand.monthly_brand_trend(star).collect()}
    cal = {(r.drug_description, r.yr, r.mo): r.moving_avg_3mo_revenue
           for r in brand.monthly_brand_trend(star, calendar=True).collect()}
    key = ("Simvastatin 10 MG Oral Tablet", 2020, 4)
    assert rows[key] == 50.01  # previous row (Jan) is inside a 3-row frame
    assert cal[key] == 0.01    # Jan is outside Feb..Apr
