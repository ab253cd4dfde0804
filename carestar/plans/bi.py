"""Denormalized BI tables and fact exports: L24-L26, L44-L46."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.functions.expr import out_money
from carestar.operators.joins import maybe_broadcast
from carestar.sources import sinks
from carestar.sources.csvscan import read_csv
from carestar.sources.tables import Star


def _dim(star: Star, name: str, cols: list) -> DataFrame:
    return maybe_broadcast(star.get(name).select(*cols))


def bi_encounter(star: Star) -> DataFrame:
    """One row per encounter with date, patient, provider and payer
    attributes (left joins: unmatched keys keep the fact row).

    Date and payer are broadcast (bounded by calendar and payer count);
    patient and provider are joined by key, where AQE broadcasts them when
    their measured size allows and splits skewed key partitions otherwise."""
    fe = star.fact_encounter
    dd = maybe_broadcast(star.calendar().select("date_key", "month_name", "quarter", "day_type"))
    dp = _dim(star, "dim_patient", [
        "patient_key", "age_band", F.col("GENDER").alias("patient_gender"),
        F.col("RACE").alias("patient_race"), "patient_state", "is_deceased",
        "lifetime_healthcare_expenses",
        F.col("coverage_rate_pct").alias("patient_lifetime_coverage_pct")])
    dpr = _dim(star, "dim_provider", [
        "provider_key", F.col("SPECIALITY").alias("provider_specialty"), "organization_name",
        F.col("CITY").alias("provider_city"), F.col("STATE").alias("provider_state")])
    dpy = _dim(star, "dim_payer", ["payer_key", "payer_name",
                                   F.col("coverage_rate_pct").alias("payer_coverage_pct")])
    j = (fe.join(dd, "date_key", "left").join(dp, "patient_key", "left")
         .join(dpr, "provider_key", "left").join(dpy, "payer_key", "left"))
    return j.select(
        "encounter_key", "encounter_date", "year", "month_num", "date_key", "month_name", "quarter",
        "day_type", "encounter_class", "encounter_description",
        out_money("base_cost").alias("base_cost"),
        out_money("total_claim_cost").alias("total_claim_cost"),
        out_money("payer_coverage").alias("payer_coverage"),
        out_money("patient_responsibility").alias("patient_responsibility"),
        "is_fully_covered", "encounter_duration_days", "age_band", "patient_gender",
        "patient_race", "patient_state", "is_deceased",
        out_money("lifetime_healthcare_expenses").alias("lifetime_healthcare_expenses"),
        "patient_lifetime_coverage_pct", "provider_specialty", "organization_name",
        "provider_city", "provider_state", "payer_name", "payer_coverage_pct")


def bi_medication(star: Star) -> DataFrame:
    """One row per fill with patient and payer attributes."""
    fm = star.fact_medication
    dp = _dim(star, "dim_patient", ["patient_key", "age_band",
                                    F.col("GENDER").alias("patient_gender"), "patient_state"])
    dpy = _dim(star, "dim_payer", ["payer_key", "payer_name",
                                   F.col("coverage_rate_pct").alias("payer_coverage_pct")])
    j = fm.join(dp, "patient_key", "left").join(dpy, "payer_key", "left")
    return j.select(
        "fill_date", F.col("fill_year").alias("year"), F.month("fill_date").alias("month_num"),
        "drug_description", "drug_code", out_money("base_cost").alias("base_cost"),
        out_money("payer_coverage").alias("payer_coverage"),
        out_money("total_cost").alias("total_cost"), "dispense_count", "is_completed",
        "age_band", "patient_gender", "patient_state", "payer_name", "payer_coverage_pct")


def register_views(star: Star) -> list[str]:
    """The star tables and both BI tables as temporary views, so SQL
    users query the same plans (``spark.sql("SELECT ... FROM v_bi_encounter")``)."""
    views = {n: star.get(n) for n in ["dim_patient", "dim_provider", "dim_payer", "dim_date",
                                      "dim_diagnosis", "fact_encounter", "fact_medication"]}
    views["v_bi_encounter"] = bi_encounter(star)
    views["v_bi_medication"] = bi_medication(star)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def export_bi(star: Star, root: str, formats=("parquet", "csv")) -> dict[str, str]:
    """Materialize both BI tables as Parquet and/or CSV under ``root``.

    The encounter table is partitioned by year so dashboard refreshes that
    slice by year read only their partitions."""
    paths = {}
    for name, df, part in (("bi_encounter", bi_encounter(star), "year"),
                           ("bi_medication", bi_medication(star), "year")):
        if "parquet" in formats:
            p = posixpath.join(root, f"{name}.parquet")
            sinks.write_parquet(df, p, part)
            paths[f"{name}.parquet"] = p
        if "csv" in formats:
            p = posixpath.join(root, f"{name}.csv")
            sinks.write_csv(df, p)
            paths[f"{name}.csv"] = p
    return paths


def read_bi_parquet(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.parquet(path).select(*like.columns)


def read_bi_csv(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return read_csv(spark, path, like.schema, timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss")


def _z(c, typ: str = "double"):
    """NULL -> 0 for exported numbers (Q20: export only)."""
    return F.coalesce(F.col(c).cast(typ), F.lit(0).cast(typ))


def export_medication_facts(star: Star) -> DataFrame:
    """Fills with patient and payer attributes under short keys."""
    fm = star.fact_medication
    dp = _dim(star, "dim_patient", ["patient_key", "age_band", "GENDER", "patient_state"])
    dpy = _dim(star, "dim_payer", ["payer_key", "payer_name", "coverage_rate_pct"])
    j = fm.join(dp, "patient_key", "left").join(dpy, "payer_key", "left")
    return j.select(
        F.date_format("fill_date", "yyyy-MM-dd").alias("d"), F.year("fill_date").alias("y"),
        F.month("fill_date").alias("m"), F.col("patient_key").alias("pk"),
        F.col("payer_key").alias("yk"), F.col("drug_code").alias("dc"),
        F.col("drug_description").alias("dd"), _z("base_cost").alias("bc"),
        _z("payer_coverage").alias("pc"), _z("total_cost").alias("tc"),
        _z("dispense_count", "int").alias("di"), _z("is_completed", "int").alias("ic"),
        F.col("age_band").alias("ab"), F.col("GENDER").alias("g"),
        F.col("patient_state").alias("ps"), F.col("payer_name").alias("yn"),
        _z("coverage_rate_pct").alias("yp"))


def export_encounter_facts(star: Star) -> DataFrame:
    """Encounters with patient, provider and payer attributes, short keys."""
    fe = star.fact_encounter
    dp = _dim(star, "dim_patient", ["patient_key", "age_band", "GENDER", "patient_state"])
    dpr = _dim(star, "dim_provider", ["provider_key", "SPECIALITY", "CITY", "organization_name"])
    dpy = _dim(star, "dim_payer", ["payer_key", "payer_name"])
    j = (fe.join(dp, "patient_key", "left").join(dpr, "provider_key", "left")
         .join(dpy, "payer_key", "left"))
    return j.select(
        F.date_format("encounter_date", "yyyy-MM-dd").alias("d"), F.col("year").alias("y"),
        F.col("month_num").alias("m"), F.col("patient_key").alias("pk"),
        F.col("provider_key").alias("prk"), F.col("payer_key").alias("yk"),
        F.col("encounter_class").alias("ec"), F.col("encounter_description").alias("ed"),
        _z("base_cost").alias("bc"), _z("total_claim_cost").alias("tc"),
        _z("payer_coverage").alias("pc"), _z("patient_responsibility").alias("pr"),
        _z("is_fully_covered", "int").alias("fc"), _z("encounter_duration_days", "int").alias("du"),
        F.col("age_band").alias("ab"), F.col("GENDER").alias("g"),
        F.col("patient_state").alias("ps"), F.col("payer_name").alias("yn"),
        F.col("SPECIALITY").alias("sp"), F.col("CITY").alias("ci"),
        F.col("organization_name").alias("org"))


def export_condition_bridge(star: Star) -> DataFrame:
    """(patient, description, code) rows of the conditions table."""
    return star.raw.conditions.select(F.col("PATIENT").alias("pk"),
                                      F.col("DESCRIPTION").alias("d"), F.col("CODE").alias("c"))


def export_facts(star: Star, root: str) -> dict[str, str]:
    """L44-L46 as gzip JSON Lines under ``root`` (one file per task)."""
    out = {}
    for name, df in (("fact_med.json.gz", export_medication_facts(star)),
                     ("fact_enc.json.gz", export_encounter_facts(star)),
                     ("conditions.json.gz", export_condition_bridge(star))):
        p = posixpath.join(root, name)
        sinks.write_gzip_json(df, p)
        out[name] = p
    return out


def read_facts(spark: SparkSession, paths: dict[str, str], star: Star) -> dict[str, DataFrame]:
    """The exports of ``export_facts`` read back with their own types."""
    like = {"fact_med.json.gz": export_medication_facts(star),
            "fact_enc.json.gz": export_encounter_facts(star),
            "conditions.json.gz": export_condition_bridge(star)}
    return {name: spark.read.schema(like[name].schema).json(path) for name, path in paths.items()}
