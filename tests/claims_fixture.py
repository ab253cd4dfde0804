"""Hand-made claims rows covering the edge cases of FIXTURES.md:
NULL and blank reason codes, NULL stop / death / birth dates, encounters
without patient / provider / payer in the dimensions, a NULL payer key,
coverage above cost, zero cost, a duplicate encounter id, ranking ties,
a half-cent average, a visit crossing midnight, a date before 2010,
Feb 29, Saturday and Sunday, a one-word drug name, zero denominators."""

import datetime as dt
from decimal import Decimal as Dm

from carestar.config import REFERENCE
from carestar.sources import schemas
from carestar.sources.tables import RawTables


def ts(s):
    return dt.datetime.fromisoformat(s).replace(tzinfo=dt.timezone.utc)


def d(s):
    return dt.date.fromisoformat(s)


def _rows(schema, dicts):
    names = [f.name for f in schema.fields]
    return [tuple(r.get(n) for n in names) for r in dicts]


PATIENTS = [
    dict(Id="P1", BIRTHDATE=d("1990-06-15"), GENDER="F", RACE="white", ETHNICITY="nonhispanic",
         STATE="Massachusetts", COUNTY="Suffolk", HEALTHCARE_EXPENSES=Dm("1000"),
         HEALTHCARE_COVERAGE=Dm("250")),
    dict(Id="P2", BIRTHDATE=None, DEATHDATE=d("2020-02-29"), GENDER="M", RACE="black",
         ETHNICITY="hispanic", STATE="Massachusetts", COUNTY="Middlesex",
         HEALTHCARE_EXPENSES=Dm("0"), HEALTHCARE_COVERAGE=Dm("0")),
    dict(Id="P3", BIRTHDATE=d("2010-12-31"), GENDER="F", RACE="asian", ETHNICITY="nonhispanic",
         STATE="New York", COUNTY="Kings", HEALTHCARE_EXPENSES=Dm("500"),
         HEALTHCARE_COVERAGE=Dm("500")),
    dict(Id="P4", BIRTHDATE=d("1940-01-01"), GENDER="M", RACE="white", ETHNICITY="nonhispanic",
         STATE="New York", COUNTY="Queens", HEALTHCARE_EXPENSES=Dm("3"),
         HEALTHCARE_COVERAGE=Dm("1")),
]

ENCOUNTERS = [
    dict(Id="E1", START=ts("2019-12-31T23:00:00"), STOP=ts("2020-01-01T01:00:00"), PATIENT="P1",
         ORGANIZATION="O1", PROVIDER="PR1", PAYER="PY1", ENCOUNTERCLASS="ambulatory",
         CODE="185345009", DESCRIPTION="Encounter for symptom", BASE_ENCOUNTER_COST=Dm("80"),
         TOTAL_CLAIM_COST=Dm("100"), PAYER_COVERAGE=Dm("100"), REASONCODE=None),
    dict(Id="E2", START=ts("2020-02-29T10:00:00"), STOP=ts("2020-02-29T11:00:00"), PATIENT="P1",
         ORGANIZATION="O1", PROVIDER="PR1", PAYER="PY1", ENCOUNTERCLASS="wellness",
         CODE="162673000", DESCRIPTION="General examination", BASE_ENCOUNTER_COST=Dm("120.0050"),
         TOTAL_CLAIM_COST=Dm("200.0050"), PAYER_COVERAGE=Dm("50"), REASONCODE=""),
    dict(Id="E3", START=ts("2020-03-01T08:00:00"), STOP=None, PATIENT="P2", ORGANIZATION="O2",
         PROVIDER="PR2", PAYER=None, ENCOUNTERCLASS="emergency", CODE="50849002",
         DESCRIPTION="Emergency room admission", BASE_ENCOUNTER_COST=Dm("0"),
         TOTAL_CLAIM_COST=Dm("0"), PAYER_COVERAGE=Dm("0"), REASONCODE="444814009"),
    dict(Id="E4", START=ts("2005-05-05T12:00:00"), STOP=ts("2005-05-07T12:00:00"), PATIENT="P9",
         ORGANIZATION="O9", PROVIDER="PR9", PAYER="PY9", ENCOUNTERCLASS="inpatient",
         CODE="32485007", DESCRIPTION="Hospital admission", BASE_ENCOUNTER_COST=Dm("300"),
         TOTAL_CLAIM_COST=Dm("300"), PAYER_COVERAGE=Dm("350"), REASONCODE="1"),
    dict(Id="E1", START=ts("2021-06-01T09:00:00"), STOP=ts("2021-06-01T09:30:00"), PATIENT="P3",
         ORGANIZATION="O1", PROVIDER="PR1", PAYER="PY2", ENCOUNTERCLASS="ambulatory",
         CODE="185345009", DESCRIPTION="Encounter for symptom", BASE_ENCOUNTER_COST=Dm("10"),
         TOTAL_CLAIM_COST=Dm("40"), PAYER_COVERAGE=Dm("0"), REASONCODE="2"),
    dict(Id="E6", START=ts("2021-07-03T09:00:00"), STOP=ts("2021-07-03T09:30:00"), PATIENT="P4",
         ORGANIZATION="O1", PROVIDER=None, PAYER="PY1", ENCOUNTERCLASS="wellness",
         CODE="162673000", DESCRIPTION="General examination", BASE_ENCOUNTER_COST=Dm("-5"),
         TOTAL_CLAIM_COST=Dm("-5"), PAYER_COVERAGE=Dm("0"), REASONCODE="  "),
]

MEDICATIONS = [
    dict(START=ts("2020-01-15T00:00:00"), STOP=ts("2020-02-15T00:00:00"), PATIENT="P1",
         PAYER="PY1", ENCOUNTER="E1", CODE="314231", DESCRIPTION="Simvastatin 10 MG Oral Tablet",
         BASE_COST=Dm("10"), PAYER_COVERAGE=Dm("80"), DISPENSES=1, TOTALCOST=Dm("100.00"),
         REASONCODE="38341003", REASONDESCRIPTION="Hypertension"),
    dict(START=ts("2020-02-15T00:00:00"), STOP=None, PATIENT="P1", PAYER="PY1", ENCOUNTER="E2",
         CODE="314076", DESCRIPTION="lisinopril 10 MG Oral Tablet", BASE_COST=Dm("5"),
         PAYER_COVERAGE=Dm("0"), DISPENSES=2, TOTALCOST=Dm("100.01"), REASONCODE=None,
         REASONDESCRIPTION=None),
    dict(START=ts("2020-03-01T00:00:00"), STOP=ts("2020-03-02T00:00:00"), PATIENT="P2",
         PAYER="PY2", ENCOUNTER="E3", CODE="243670", DESCRIPTION="Aspirin", BASE_COST=Dm("0"),
         PAYER_COVERAGE=Dm("0"), DISPENSES=1, TOTALCOST=Dm("0"), REASONCODE="",
         REASONDESCRIPTION="Viral sinusitis (disorder)"),
    dict(START=ts("2020-04-01T00:00:00"), STOP=ts("2020-05-01T00:00:00"), PATIENT="P3",
         PAYER="PY1", ENCOUNTER="E1", CODE="314231", DESCRIPTION="Simvastatin 10 MG Oral Tablet",
         BASE_COST=Dm("1"), PAYER_COVERAGE=Dm("0.01"), DISPENSES=1, TOTALCOST=Dm("0.01"),
         REASONCODE="38341003", REASONDESCRIPTION="Hypertension"),
]

CONDITIONS = [
    dict(START=d("2019-12-31"), PATIENT="P1", ENCOUNTER="E1", CODE="38341003",
         DESCRIPTION="Hypertension"),
    dict(START=d("2020-02-29"), PATIENT="P1", ENCOUNTER="E2", CODE="38341003",
         DESCRIPTION="Hypertension"),
    dict(START=d("2020-03-01"), PATIENT="P2", ENCOUNTER="E3", CODE="444814009",
         DESCRIPTION="Viral sinusitis (disorder)"),
    dict(START=d("2021-06-01"), PATIENT="P3", ENCOUNTER="E1", CODE="444814009",
         DESCRIPTION="Viral sinusitis (disorder)"),
]

PROVIDERS = [
    dict(Id="PR1", ORGANIZATION="O1", NAME="Dr A", GENDER="F", SPECIALITY="GENERAL PRACTICE",
         ADDRESS="1 Main St", CITY="Boston", STATE="MA", ZIP="02101", UTILIZATION=10),
    dict(Id="PR2", ORGANIZATION="O2", NAME="Dr B", GENDER="M", SPECIALITY="CARDIOLOGY",
         ADDRESS="2 Elm St", CITY="", STATE="MA", ZIP="02139", UTILIZATION=5),
]

ORGANIZATIONS = [
    dict(Id="O1", NAME="General Hospital", REVENUE=Dm("1000000"), UTILIZATION=100),
    dict(Id="O2", NAME="Heart Clinic", REVENUE=Dm("50000"), UTILIZATION=20),
]

PAYERS = [
    dict(Id="PY1", NAME="Medicare", STATE_HEADQUARTERED="MD", AMOUNT_COVERED=Dm("900"),
         AMOUNT_UNCOVERED=Dm("100"), UNIQUE_CUSTOMERS=3, COVERED_ENCOUNTERS=2,
         UNCOVERED_ENCOUNTERS=1, COVERED_MEDICATIONS=2, COVERED_PROCEDURES=0, QOLS_AVG=0.8),
    dict(Id="PY2", NAME="NO_INSURANCE", AMOUNT_COVERED=Dm("0"), AMOUNT_UNCOVERED=Dm("0"),
         UNIQUE_CUSTOMERS=1, COVERED_ENCOUNTERS=0, UNCOVERED_ENCOUNTERS=1, COVERED_MEDICATIONS=0,
         COVERED_PROCEDURES=0, QOLS_AVG=0.5),
]


def raw_tables(spark, profile=REFERENCE) -> RawTables:
    mk = lambda name, rows: spark.createDataFrame(_rows(schemas.CLAIMS[name], rows),
                                                  schemas.CLAIMS[name])
    return RawTables(patients=mk("patients", PATIENTS), encounters=mk("encounters", ENCOUNTERS),
                     medications=mk("medications", MEDICATIONS),
                     conditions=mk("conditions", CONDITIONS),
                     providers=mk("providers", PROVIDERS),
                     organizations=mk("organizations", ORGANIZATIONS),
                     payers=mk("payers", PAYERS), profile=profile)
