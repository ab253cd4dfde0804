"""Oracle SQL for the BI tables and exports."""

from carestar.oracle.base import with_star

SQL = {}

# Attributes looked up per key: output name -> column, one pre-projected
# sub-select per dimension, joined USING its key.
_LOOKUP = {
    "date_key": ("dim_date", {"month_name": "month_name", "quarter": "quarter", "day_type": "day_type"}),
    "patient_key": ("dim_patient", {
        "age_band": "age_band", "patient_gender": "GENDER", "patient_race": "RACE",
        "patient_state": "patient_state", "is_deceased": "is_deceased",
        "lifetime_healthcare_expenses": "cast(lifetime_healthcare_expenses AS double)",
        "patient_lifetime_coverage_pct": "coverage_rate_pct"}),
    "provider_key": ("dim_provider", {
        "provider_specialty": "SPECIALITY", "organization_name": "organization_name",
        "provider_city": "CITY", "provider_state": "STATE"}),
    "payer_key": ("dim_payer", {"payer_name": "payer_name", "payer_coverage_pct": "coverage_rate_pct"}),
}
_ENCOUNTER = ("encounter_key encounter_date year month_num date_key encounter_class "
              "encounter_description is_fully_covered encounter_duration_days").split()
_ENCOUNTER_MONEY = "base_cost total_claim_cost payer_coverage patient_responsibility".split()
_FILL = "fill_date drug_description drug_code dispense_count is_completed".split()
_FILL_MONEY = "base_cost payer_coverage total_cost".split()


def _wide(fact: str, plain: list[str], amounts: list[str], wanted: dict[str, list[str]],
          more: str = "") -> str:
    """``fact`` with the wanted attributes of each key."""
    looked = [n for names in wanted.values() for n in names]
    cols = ", ".join([*plain, *[f"cast({m} AS double) AS {m}" for m in amounts], *looked])
    joins = "".join(
        "\nLEFT JOIN (SELECT {0}, {1} FROM {2}) USING ({0})".format(
            key, ", ".join(f"{_LOOKUP[key][1][n]} AS {n}" for n in names), _LOOKUP[key][0])
        for key, names in wanted.items())
    return f"SELECT {cols}{more} FROM {fact}{joins}"


def _all(key: str, *names: str) -> list[str]:
    return list(names) or list(_LOOKUP[key][1])


BI_ENCOUNTER = _wide("fact_encounter", _ENCOUNTER, _ENCOUNTER_MONEY, {k: _all(k) for k in _LOOKUP})
BI_MEDICATION = _wide(
    "fact_medication", _FILL, _FILL_MONEY,
    {"patient_key": ["age_band", "patient_gender", "patient_state"], "payer_key": _all("payer_key")},
    ", cast(date_part('year', fill_date) AS integer) AS year"
    ", cast(date_part('month', fill_date) AS integer) AS month_num")

SQL["bi_encounter"] = with_star(BI_ENCOUNTER)
SQL["bi_medication"] = with_star(BI_MEDICATION)


def _short(inner: str, names: dict[str, str], zero: dict[str, str]) -> str:
    cols = [f"{c} AS {n}" for n, c in names.items()]
    cols += [f"ifnull({c}, 0) AS {n}" for n, c in zero.items()]
    return f"SELECT {', '.join(cols)} FROM ({inner})"


SQL["export_medication_facts"] = with_star(_short(
    _wide("fact_medication", [*_FILL, "patient_key", "payer_key"], _FILL_MONEY,
          {"patient_key": ["age_band", "patient_gender", "patient_state"], "payer_key": _all("payer_key")}),
    {"d": "strftime(fill_date, '%Y-%m-%d')", "y": "cast(date_part('year', fill_date) AS integer)",
     "m": "cast(date_part('month', fill_date) AS integer)", "pk": "patient_key", "yk": "payer_key",
     "dc": "drug_code", "dd": "drug_description", "ab": "age_band", "g": "patient_gender",
     "ps": "patient_state", "yn": "payer_name"},
    {"bc": "base_cost", "pc": "payer_coverage", "tc": "total_cost", "di": "dispense_count",
     "ic": "is_completed", "yp": "payer_coverage_pct"}))

SQL["export_encounter_facts"] = with_star(_short(
    _wide("fact_encounter", [*_ENCOUNTER, "patient_key", "provider_key", "payer_key"], _ENCOUNTER_MONEY,
          {"patient_key": ["age_band", "patient_gender", "patient_state"],
           "provider_key": ["provider_specialty", "organization_name", "provider_city"],
           "payer_key": ["payer_name"]}),
    {"d": "strftime(encounter_date, '%Y-%m-%d')", "y": "year", "m": "month_num", "pk": "patient_key",
     "prk": "provider_key", "yk": "payer_key", "ec": "encounter_class", "ed": "encounter_description",
     "ab": "age_band", "g": "patient_gender", "ps": "patient_state", "yn": "payer_name",
     "sp": "provider_specialty", "ci": "provider_city", "org": "organization_name"},
    {"bc": "base_cost", "tc": "total_claim_cost", "pc": "payer_coverage",
     "pr": "patient_responsibility", "fc": "is_fully_covered", "du": "encounter_duration_days"}))

SQL["export_condition_bridge"] = with_star("""
SELECT PATIENT AS pk, DESCRIPTION AS d, CODE AS c FROM conditions""")
