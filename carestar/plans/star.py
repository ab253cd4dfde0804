"""Star schema: dimensions and facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.functions.expr import (age_band, date_key, flag, money, pct, to_date_lit,
                                     year_diff)
from carestar.operators.counts import row_counts
from carestar.sources.tables import RawTables, Star


def dim_patient(raw: RawTables, as_of: dt.date | None = None) -> DataFrame:
    """One row per patient with age, band, deceased flag, coverage rate."""
    as_of = as_of or raw.profile.as_of
    p = raw.patients
    age = year_diff(F.col("BIRTHDATE").cast("date"), to_date_lit(as_of))
    return p.select(
        F.col("Id").alias("patient_key"), "GENDER", "RACE", "ETHNICITY",
        F.col("STATE").alias("patient_state"), F.col("COUNTY").alias("patient_county"),
        age.alias("age_years"),
        age_band(age).alias("age_band"),
        flag(F.col("DEATHDATE").isNotNull()).alias("is_deceased"),
        F.col("DEATHDATE").cast("date").alias("death_date"),
        F.col("HEALTHCARE_EXPENSES").alias("lifetime_healthcare_expenses"),
        F.col("HEALTHCARE_COVERAGE").alias("lifetime_payer_coverage"),
        pct("HEALTHCARE_COVERAGE", "HEALTHCARE_EXPENSES").alias("coverage_rate_pct"),
    )


def dim_provider(raw: RawTables) -> DataFrame:
    """Providers left-joined to their organization."""
    org = raw.organizations.select(F.col("Id").alias("_org_id"),
                                   F.col("NAME").alias("organization_name"),
                                   F.col("REVENUE").alias("organization_revenue"),
                                   F.col("UTILIZATION").alias("organization_utilization"))
    pr = raw.providers
    return (pr.join(org, pr["ORGANIZATION"] == org["_org_id"], "left")
            .select(F.col("Id").alias("provider_key"), F.col("NAME").alias("provider_name"),
                    F.col("GENDER").alias("provider_gender"), "SPECIALITY", "ADDRESS", "CITY",
                    "STATE", "ZIP", F.col("UTILIZATION").alias("provider_utilization"),
                    "organization_name", "organization_revenue", "organization_utilization"))


def dim_payer(raw: RawTables) -> DataFrame:
    """Payers with their coverage rate."""
    py = raw.payers
    return py.select(
        F.col("Id").alias("payer_key"), F.col("NAME").alias("payer_name"), "STATE_HEADQUARTERED",
        "AMOUNT_COVERED", "AMOUNT_UNCOVERED",
        pct("AMOUNT_COVERED", F.col("AMOUNT_COVERED") + F.col("AMOUNT_UNCOVERED"))
        .alias("coverage_rate_pct"),
        "UNIQUE_CUSTOMERS", "COVERED_ENCOUNTERS", "UNCOVERED_ENCOUNTERS", "COVERED_MEDICATIONS",
        "COVERED_PROCEDURES", "QOLS_AVG")


def _date_attributes(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"), d.alias("full_date"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"), F.weekofyear(d).alias("week_num"),
        F.dayofmonth(d).alias("day_of_month"), F.date_format(d, "EEEE").alias("day_name"),
        F.when(F.dayofweek(d).isin(1, 7), "Weekend").otherwise("Weekday").alias("day_type"))


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """L9 with fixed bounds: one row per calendar day, inclusive."""
    days = spark.range(1).select(F.explode(F.sequence(to_date_lit(start), to_date_lit(end),
                                                      F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return _date_attributes(days)


def fact_date_bounds(raw: RawTables, facts: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row: Jan 1 of the first and Dec 31 of the last year any encounter
    or fill falls in (partial min/max aggregates, one tiny shuffle).  Written
    ``facts`` are partitioned by year; its min/max need no timestamp data,
    only the partition values."""
    if facts is None:
        years = [df.select(F.year("START").alias("y")) for df in (raw.encounters, raw.medications)]
    else:
        years = [facts[0].select(F.col("year").alias("y")), facts[1].select(F.col("fill_year").alias("y"))]
    b = years[0].unionByName(years[1]).agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    return b.select(F.make_date("lo", F.lit(1), F.lit(1)).alias("start"),
                    F.make_date("hi", F.lit(12), F.lit(31)).alias("end"))


def dim_date(raw: RawTables, spark: SparkSession | None = None,
             facts: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """The date dimension over the profile's bounds; an end that the
    profile leaves open is that of the years the facts cover."""
    prof = raw.profile
    if prof.spine_start is not None and prof.spine_end is not None:
        return date_spine(spark or raw.patients.sparkSession, prof.spine_start, prof.spine_end)
    bounds = fact_date_bounds(raw, facts)
    for name, fixed in (("start", prof.spine_start), ("end", prof.spine_end)):
        if fixed is not None:
            bounds = bounds.withColumn(name, to_date_lit(fixed))
    days = bounds.where(F.col("start") <= F.col("end")).select(
        F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return _date_attributes(days)


def dim_diagnosis(raw: RawTables) -> DataFrame:
    """Occurrences per (code, description)."""
    return (raw.conditions.groupBy(F.col("CODE").alias("diagnosis_key"),
                                   F.col("DESCRIPTION").alias("diagnosis_description"))
            .agg(F.count(F.lit(1)).alias("occurrence_count")))


def fact_encounter(raw: RawTables) -> DataFrame:
    """One row per encounter."""
    e = raw.encounters
    start = F.col("START").cast("timestamp_ntz")
    total, cov = F.col("TOTAL_CLAIM_COST"), F.col("PAYER_COVERAGE")
    return e.select(
        F.col("Id").alias("encounter_key"), F.col("PATIENT").alias("patient_key"),
        F.col("PROVIDER").alias("provider_key"), F.col("PAYER").alias("payer_key"),
        F.col("ORGANIZATION").alias("organization_key"),
        F.col("ENCOUNTERCLASS").alias("encounter_class"), F.col("CODE").alias("encounter_code"),
        F.col("DESCRIPTION").alias("encounter_description"),
        start.cast("date").alias("encounter_date"), date_key(start).alias("date_key"),
        F.year(start).alias("year"), F.month(start).alias("month_num"),
        money("BASE_ENCOUNTER_COST").alias("base_cost"),
        money(total).alias("total_claim_cost"), money(cov).alias("payer_coverage"),
        money(total - cov).alias("patient_responsibility"),
        flag(cov >= total).alias("is_fully_covered"),
        F.datediff(F.col("STOP").cast("date"), start.cast("date")).alias("encounter_duration_days"),
    )


def fact_medication(raw: RawTables) -> DataFrame:
    """One row per medication fill; ``fill_year`` is the partition
    column of the written table, so year slicers on fills prune files."""
    m = raw.medications
    return m.select(
        F.col("START").alias("fill_date"), date_key("START").alias("date_key"),
        F.col("PATIENT").alias("patient_key"), F.col("PAYER").alias("payer_key"),
        F.col("ENCOUNTER").alias("encounter_key"), F.col("CODE").alias("drug_code"),
        F.col("DESCRIPTION").alias("drug_description"),
        F.col("REASONCODE").alias("reason_diagnosis_code"),
        F.col("REASONDESCRIPTION").alias("reason_description"),
        money("BASE_COST").alias("base_cost"), money("PAYER_COVERAGE").alias("payer_coverage"),
        money("TOTALCOST").alias("total_cost"), F.col("DISPENSES").alias("dispense_count"),
        flag(F.col("STOP").isNotNull()).alias("is_completed"),
        F.year("START").alias("fill_year"),
    )


def build_star(raw: RawTables) -> Star:
    """All star tables as lazy DataFrames over the raw tables."""
    return Star(dim_patient=dim_patient(raw), dim_provider=dim_provider(raw),
                dim_payer=dim_payer(raw), dim_date=dim_date(raw),
                dim_diagnosis=dim_diagnosis(raw), fact_encounter=fact_encounter(raw),
                fact_medication=fact_medication(raw), raw=raw)


def star_row_counts(star: Star) -> DataFrame:
    """Rows per star table."""
    return row_counts({n: star.get(n) for n in
                       ["dim_patient", "dim_provider", "dim_payer", "dim_date", "dim_diagnosis",
                        "fact_encounter", "fact_medication"]}, name_col="tbl", count_col="rows")
