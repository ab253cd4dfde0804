"""The star as persistent tables and views of the session catalog.

Tables name the written Parquet by location, so other sessions of the
catalog (and SQL users) read the same files; views are stored as SQL text
and planned anew by every query.  A repeated run drops and creates all.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from carestar.config import TESTDATA
from carestar.sources.tables import STAR_NAMES
from carestar.sources.warehouse import FACTS

# Wide views: (fact, {key: (dimension, {name: column})}).
_PERSON = {"age_band": "age_band", "patient_gender": "GENDER", "patient_state": "patient_state"}
_PAYER = {"payer_name": "payer_name", "payer_coverage_pct": "coverage_rate_pct"}
_VIEWS = {
    "v_bi_encounter": ("fact_encounter", {
        "date_key": ("dim_date", {"month_name": "month_name", "quarter": "quarter",
                                  "day_type": "day_type"}),
        "patient_key": ("dim_patient", {
            **_PERSON, "patient_race": "RACE", "is_deceased": "is_deceased",
            "lifetime_healthcare_expenses": "CAST(lifetime_healthcare_expenses AS DOUBLE)",
            "patient_lifetime_coverage_pct": "coverage_rate_pct"}),
        "provider_key": ("dim_provider", {
            "provider_specialty": "SPECIALITY", "organization_name": "organization_name",
            "provider_city": "CITY", "provider_state": "STATE"}),
        "payer_key": ("dim_payer", _PAYER)},
        ["encounter_key", "encounter_date", "year", "month_num", "date_key", "encounter_class",
         "encounter_description", "is_fully_covered", "encounter_duration_days"],
        ["base_cost", "total_claim_cost", "payer_coverage", "patient_responsibility"], {}),
    "v_bi_medication": ("fact_medication", {
        "patient_key": ("dim_patient", _PERSON), "payer_key": ("dim_payer", _PAYER)},
        ["fill_date", "drug_description", "drug_code", "dispense_count", "is_completed"],
        ["base_cost", "payer_coverage", "total_cost"],
        {"year": "fill_year", "month_num": "MONTH(fill_date)"}),
}


def view_sql(name: str, database: str, calendar_start: dt.date | None = None) -> str:
    """The SELECT of a wide view: a fact with the attributes of its keys
    (dates from ``calendar_start`` on)."""
    fact, looked, plain, money, computed = _VIEWS[name]
    columns = [f"f.{c}" for c in plain] + [f"CAST(f.{c} AS DOUBLE) AS {c}" for c in money]
    columns += [f"{expression} AS {c}" for c, expression in computed.items()]
    joins = []
    for i, (key, (dim, names)) in enumerate(looked.items()):
        own = ", ".join(f"{column} AS {c}" for c, column in names.items())
        held = f"{database}.{dim}"
        if dim == "dim_date" and calendar_start is not None:
            held += f" WHERE full_date >= DATE '{calendar_start}'"
        joins.append(f"LEFT JOIN (SELECT {key}, {own} FROM {held}) d{i} ON f.{key} = d{i}.{key}")
        columns += [f"d{i}.{c}" for c in names]
    return f"SELECT {', '.join(columns)} FROM {database}.{fact} f {' '.join(joins)}"


def register(spark: SparkSession, root: str, database: str,
             calendar_start: dt.date | None = TESTDATA.calendar_start) -> list[str]:
    """Create the star tables written under ``root`` and the wide views in
    ``database`` (in place of earlier ones); returns their names.  The star is
    the test tables' unless told otherwise, as in ``warehouse.attach``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/catalog'")
    for view in _VIEWS:
        spark.sql(f"DROP VIEW IF EXISTS {database}.{view}")
    for name in STAR_NAMES:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.catalog.createTable(f"{database}.{name}", path=f"{root}/star/{name}", source="parquet")
        if name in FACTS:  # the folders of the years
            spark.catalog.recoverPartitions(f"{database}.{name}")
    for view in _VIEWS:
        spark.sql(f"CREATE VIEW {database}.{view} AS {view_sql(view, database, calendar_start)}")
    return [f"{database}.{n}" for n in [*STAR_NAMES, *_VIEWS]]
