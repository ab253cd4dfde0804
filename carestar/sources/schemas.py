"""Explicit schemas of the raw claims CSV files (no type inference).

Ids, codes and ZIPs are strings; raw money keeps four places
(``decimal(18,4)``) so that jobs that sum raw cost and round afterwards
stay exact; times are UTC timestamps.
"""

from __future__ import annotations

from pyspark.sql.types import (DateType, DecimalType, DoubleType, IntegerType,
                               StringType, StructField, StructType, TimestampType)

RAW_MONEY = DecimalType(18, 4)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, D, TS, I, DB = StringType(), DateType(), TimestampType(), IntegerType(), DoubleType()

PATIENTS = _s(("Id", S), ("BIRTHDATE", D), ("DEATHDATE", D), ("GENDER", S), ("RACE", S),
              ("ETHNICITY", S), ("STATE", S), ("COUNTY", S),
              ("HEALTHCARE_EXPENSES", RAW_MONEY), ("HEALTHCARE_COVERAGE", RAW_MONEY))
ENCOUNTERS = _s(("Id", S), ("START", TS), ("STOP", TS), ("PATIENT", S), ("ORGANIZATION", S),
                ("PROVIDER", S), ("PAYER", S), ("ENCOUNTERCLASS", S), ("CODE", S),
                ("DESCRIPTION", S), ("BASE_ENCOUNTER_COST", RAW_MONEY),
                ("TOTAL_CLAIM_COST", RAW_MONEY), ("PAYER_COVERAGE", RAW_MONEY),
                ("REASONCODE", S), ("REASONDESCRIPTION", S))
MEDICATIONS = _s(("START", TS), ("STOP", TS), ("PATIENT", S), ("PAYER", S), ("ENCOUNTER", S),
                 ("CODE", S), ("DESCRIPTION", S), ("BASE_COST", RAW_MONEY),
                 ("PAYER_COVERAGE", RAW_MONEY), ("DISPENSES", I), ("TOTALCOST", RAW_MONEY),
                 ("REASONCODE", S), ("REASONDESCRIPTION", S))
CONDITIONS = _s(("START", D), ("STOP", D), ("PATIENT", S), ("ENCOUNTER", S), ("CODE", S),
                ("DESCRIPTION", S))
PROVIDERS = _s(("Id", S), ("ORGANIZATION", S), ("NAME", S), ("GENDER", S), ("SPECIALITY", S),
               ("ADDRESS", S), ("CITY", S), ("STATE", S), ("ZIP", S), ("UTILIZATION", I))
ORGANIZATIONS = _s(("Id", S), ("NAME", S), ("ADDRESS", S), ("CITY", S), ("STATE", S),
                   ("ZIP", S), ("REVENUE", RAW_MONEY), ("UTILIZATION", I))
PAYERS = _s(("Id", S), ("NAME", S), ("STATE_HEADQUARTERED", S), ("AMOUNT_COVERED", RAW_MONEY),
            ("AMOUNT_UNCOVERED", RAW_MONEY), ("REVENUE", RAW_MONEY),
            ("COVERED_ENCOUNTERS", I), ("UNCOVERED_ENCOUNTERS", I), ("COVERED_MEDICATIONS", I),
            ("UNCOVERED_MEDICATIONS", I), ("COVERED_PROCEDURES", I), ("UNCOVERED_PROCEDURES", I),
            ("UNIQUE_CUSTOMERS", I), ("QOLS_AVG", DB), ("MEMBER_MONTHS", I))

# Tables the reference loads and only counts; read with every column as text.
COUNTED_ONLY = ["procedures", "immunizations", "allergies", "careplans",
                "imaging_studies", "observations"]

CLAIMS = {
    "patients": PATIENTS, "encounters": ENCOUNTERS, "medications": MEDICATIONS,
    "conditions": CONDITIONS, "providers": PROVIDERS, "organizations": ORGANIZATIONS,
    "payers": PAYERS,
}
