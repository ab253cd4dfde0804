"""The dashboard document (JSON, no SQL oracle) equals, section by section,
the standalone jobs that the oracle checks."""

import json

from carestar.plans import brand, conditions, dashboard
from carestar.sources.warehouse import star_for

SF = "/root/testdata/sf0.001"


def _rows(df):
    return [r.asDict() for r in df.collect()]


def _num(row):
    return {k: (float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v)
            for k, v in row.items()}


def test_document_sections_equal_jobs(spark):
    s = star_for(spark, SF)
    doc = json.loads(dashboard.dashboard_document(s).first().document)
    assert _num(doc["kpis"]) == _num(_rows(dashboard.kpi_cards(s))[0])
    same_order = {
        "top_drugs": brand.top_drugs_by_revenue(s),
        "specialties": dashboard.specialty_volume(s),
        "states": dashboard.state_distribution(s),
        "ta_patients": conditions.condition_patients(s),
        "ta_enc_cost": conditions.condition_encounter_cost_summary(s),
        "drug_class": brand.drug_class_fills(s),
        "adherence": brand.adherence_top(s),
    }
    for key, df in same_order.items():
        assert [_num(x) for x in doc[key]] == [_num(r) for r in _rows(df)], key
    for key, df in {"payer_mix": brand.payer_mix(s), "trend": dashboard.monthly_trend(s),
                    "age_bands": dashboard.age_band_distribution(s)}.items():
        got = sorted(json.dumps(_num(x), sort_keys=True) for x in doc[key])
        want = sorted(json.dumps(_num(r), sort_keys=True) for r in _rows(df))
        assert got == want, key
    icd = [{"chapter": r["code_prefix"], "patients": r["patient_count"],
            "conditions": r["distinct_conditions"]}
           for r in _rows(conditions.code_prefix_distribution(s))]
    assert doc["icd10"] == icd
