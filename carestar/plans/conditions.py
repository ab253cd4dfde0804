"""Therapeutic-area (condition) analytics: L15, L27-L29, L39."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.functions.expr import avg_money, code_prefix, round_money
from carestar.operators.distinct import agg_with_distinct
from carestar.operators.topk import top_k
from carestar.sources.tables import Star


def condition_cost_rollup(star: Star, k: int = 20) -> DataFrame:
    """Patients and encounters per condition with the medication cost
    whose reason is that condition (both sides aggregated before the join)."""
    c = star.raw.conditions.withColumnRenamed("DESCRIPTION", "condition_description")
    cc = agg_with_distinct(c, ["condition_description"], [],
                           {"patient_count": "PATIENT", "encounter_count": "ENCOUNTER"})
    mc = (star.raw.medications.filter(F.col("REASONDESCRIPTION").isNotNull())
          .groupBy(F.col("REASONDESCRIPTION").alias("condition_description"))
          .agg(F.sum("TOTALCOST").alias("_med")))
    out = (cc.join(mc, "condition_description", "left")
           .select("condition_description", "patient_count", "encounter_count",
                   F.coalesce(F.round("_med", 2), F.lit(0)).cast("double").alias("medication_cost")))
    return top_k(out, k, "-patient_count", "condition_description")


def _condition_counts(star: Star) -> DataFrame:
    c = star.raw.conditions.withColumnRenamed("DESCRIPTION", "therapeutic_area")
    return agg_with_distinct(c, ["therapeutic_area"],
                             [F.count(F.lit(1)).alias("condition_record_count")],
                             {"patient_count": "PATIENT", "encounter_count": "ENCOUNTER"})


def condition_leaderboard(star: Star, k: int = 15) -> DataFrame:
    """Conditions by distinct patients."""
    return top_k(_condition_counts(star), k, "-patient_count", "therapeutic_area")


def condition_patients(star: Star, k: int = 15) -> DataFrame:
    """L27 dashboard variant (condition, patients)."""
    agg = (star.raw.conditions.groupBy(F.col("DESCRIPTION").alias("condition"))
           .agg(F.count_distinct("PATIENT").alias("patients")))
    return top_k(agg, k, "-patients", "condition")


def _condition_encounter_agg(star: Star) -> DataFrame:
    """Encounter cost per condition through the patient bridge (Q8 fan-out).

    Each encounter counts once per condition of its patient.  Instead of
    joining every encounter to every condition of its patient, encounters
    are first reduced to one row per patient (count, cost, coverage), and
    only that is joined to the distinct (condition, patient) bridge.  All
    measures are sums and counts, so the result equals the naive join."""
    per_patient = (star.fact_encounter.filter(F.col("total_claim_cost") > 0)
                   .groupBy("patient_key")
                   .agg(F.count(F.lit(1)).alias("_n"), F.sum("total_claim_cost").alias("_tot"),
                        F.sum("payer_coverage").alias("_cov")))
    bridge = (star.raw.conditions.select(F.col("DESCRIPTION").alias("therapeutic_area"),
                                         F.col("PATIENT").alias("patient_key"))
              .filter(F.col("patient_key").isNotNull()).distinct())
    return (bridge.join(per_patient, "patient_key")
            .groupBy("therapeutic_area")
            .agg(F.count(F.lit(1)).alias("patient_count"), F.sum("_n").alias("encounter_count"),
                 F.sum("_tot").alias("_tot"), F.sum("_cov").alias("_cov")))


def condition_encounter_cost(star: Star, k: int = 15) -> DataFrame:
    """Conditions by the encounter cost of their patients."""
    agg = _condition_encounter_agg(star)
    out = agg.select("therapeutic_area", "patient_count", "encounter_count",
                     round_money("_tot").alias("total_encounter_cost"),
                     round_money("_cov").alias("total_payer_coverage"),
                     avg_money("_tot", "encounter_count").alias("avg_cost_per_encounter"), "_tot")
    return top_k(out, k, "-_tot", "therapeutic_area").drop("_tot")


def condition_encounter_cost_summary(star: Star, k: int = 15) -> DataFrame:
    """L28 dashboard variant: whole-dollar total and average."""
    agg = _condition_encounter_agg(star)
    out = agg.select(F.col("therapeutic_area").alias("condition"),
                     F.col("patient_count").alias("patients"),
                     round_money("_tot", 0).alias("total_cost"),
                     avg_money("_tot", "encounter_count", 0).alias("avg_cost"), "_tot")
    return top_k(out, k, "-_tot", "condition").drop("_tot")


def condition_drug_cost(star: Star, k: int = 15) -> DataFrame:
    """Pharmacy spend per reason condition."""
    m = star.raw.medications.filter(F.col("REASONDESCRIPTION").isNotNull()
                                    & (F.col("TOTALCOST") > 0))
    agg = agg_with_distinct(m.withColumnRenamed("REASONDESCRIPTION", "therapeutic_area"),
                            ["therapeutic_area"],
                            [F.count(F.lit(1)).alias("fill_count"),
                             F.sum("TOTALCOST").alias("_tot")],
                            {"patient_count": "PATIENT"})
    out = agg.select("therapeutic_area", "patient_count", "fill_count",
                     round_money("_tot").alias("total_drug_cost"),
                     avg_money("_tot", "fill_count").alias("avg_cost_per_fill"), "_tot")
    return top_k(out, k, "-_tot", "therapeutic_area").drop("_tot")


def code_prefix_distribution(star: Star, k: int = 10) -> DataFrame:
    """Patients and distinct codes per first character of the code (Q4, Q5)."""
    c = star.raw.conditions.withColumn("code_prefix", code_prefix("CODE"))
    agg = agg_with_distinct(c, ["code_prefix"], [],
                            {"patient_count": "PATIENT", "distinct_conditions": "CODE"})
    return top_k(agg, k, "-patient_count", "code_prefix")
