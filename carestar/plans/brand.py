"""Brand (drug) performance KPIs: L14-L18, L30-L33."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carestar.functions.expr import avg_money, first_word, pct, ratio_pct, round_money
from carestar.operators.distinct import agg_with_distinct
from carestar.operators.joins import maybe_broadcast
from carestar.operators.topk import top_k, top_keys
from carestar.sources.tables import Star


def _positive_fills(star: Star) -> DataFrame:
    return star.fact_medication.filter(F.col("total_cost") > 0)


def brand_leaderboard(star: Star, k: int = 25) -> DataFrame:
    """L14 (flagship): top drugs by revenue among fills with a positive cost.

    The sums are one map-side combined aggregate per drug (a drug holding a
    third of all fills leaves one small row per partition); the distinct
    patients come from the (drug, patient) pairs alone, so only narrow pairs
    are shuffled, not the partial sums (``agg_with_distinct``)."""
    agg = agg_with_distinct(
        _positive_fills(star), ["drug_description"],
        [F.count(F.lit(1)).alias("fill_count"), F.sum("base_cost").alias("_base"),
         F.sum("payer_coverage").alias("_cov"), F.sum("total_cost").alias("_rev")],
        {"unique_patients": "patient_key"})
    out = agg.select("drug_description", "fill_count", "unique_patients",
                     round_money("_base").alias("total_base_cost"),
                     round_money("_cov").alias("total_payer_coverage"),
                     round_money("_rev").alias("total_revenue"),
                     avg_money("_rev", "fill_count").alias("avg_cost_per_fill"),
                     F.col("_rev"))
    return top_k(out, k, "-_rev", "drug_description").drop("_rev")


def top_drugs_by_revenue(star: Star, k: int = 10) -> DataFrame:
    """L14 k=10 variant of the dashboard: fills and revenue in whole dollars."""
    agg = (_positive_fills(star).groupBy("drug_description")
           .agg(F.count(F.lit(1)).alias("fills"), F.sum("total_cost").alias("_rev")))
    out = agg.select(F.col("drug_description").alias("drug"), "fills",
                     round_money("_rev", 0).alias("revenue"), "_rev")
    return top_k(out, k, "-_rev", "drug").drop("_rev")


def monthly_brand_trend(star: Star, k: int = 5, frame: int = 3,
                        calendar: bool = False) -> DataFrame:
    """Monthly fills and revenue of the top-k drugs with a moving
    average of revenue over the current and ``frame - 1`` preceding rows
    (the reference's frame: months without fills are skipped, Q7), or with
    ``calendar=True`` over the current and ``frame - 1`` preceding calendar
    months (months without fills simply add nothing).

    Monthly sums come first (one row per drug and month), the top-k key set
    is broadcast as a semi join, and the window then runs over a few dozen
    rows per drug."""
    fm = star.fact_medication
    monthly = (fm.groupBy("drug_description", F.year("fill_date").alias("yr"),
                          F.month("fill_date").alias("mo"))
               .agg(F.count(F.lit(1)).alias("fill_count"),
                    F.sum("total_cost").alias("_rev")))
    per_drug = monthly.groupBy("drug_description").agg(F.sum("_rev").alias("_tot"))
    keys = top_keys(per_drug, "drug_description", k, "-_tot", "drug_description")
    top = monthly.join(keys, "drug_description", "left_semi")
    if calendar:
        w = (Window.partitionBy("drug_description").orderBy(F.col("yr") * 12 + F.col("mo"))
             .rangeBetween(-(frame - 1), Window.currentRow))
    else:
        w = (Window.partitionBy("drug_description").orderBy("yr", "mo")
             .rowsBetween(-(frame - 1), Window.currentRow))
    mov = F.round(F.sum("_rev").over(w) / F.count(F.lit(1)).over(w).cast("decimal(20,0)"), 2)
    return top.select("drug_description", "yr", "mo", "fill_count",
                      round_money("_rev").alias("monthly_revenue"),
                      mov.cast("double").alias("moving_avg_3mo_revenue"))


def monthly_brand_trend_calendar(star: Star, k: int = 5, frame: int = 3) -> DataFrame:
    """L16 with a calendar-month frame (Q7 option)."""
    return monthly_brand_trend(star, k, frame, calendar=True)


def _with_payer(fills: DataFrame, star: Star) -> DataFrame:
    dp = maybe_broadcast(star.dim_payer.select("payer_key", "payer_name"))
    return fills.join(dp, "payer_key")


def payer_coverage_rate(star: Star) -> DataFrame:
    """Per payer, patients, fills, cost, covered amount and rate."""
    agg = agg_with_distinct(
        _with_payer(_positive_fills(star), star), ["payer_name"],
        [F.count(F.lit(1)).alias("fill_count"), F.sum("total_cost").alias("_cost"),
         F.sum("payer_coverage").alias("_cov")],
        {"patient_count": "patient_key"})
    return agg.select("payer_name", "patient_count", "fill_count",
                      round_money("_cost").alias("total_drug_cost"),
                      round_money("_cov").alias("total_covered"),
                      pct("_cov", "_cost").alias("coverage_rate_pct"))


def payer_mix(star: Star) -> DataFrame:
    """L17 dashboard variant: cost in whole dollars."""
    agg = agg_with_distinct(
        _with_payer(_positive_fills(star), star), ["payer_name"],
        [F.count(F.lit(1)).alias("fills"), F.sum("total_cost").alias("_cost"),
         F.sum("payer_coverage").alias("_cov")],
        {"patients": "patient_key"})
    return agg.select(F.col("payer_name").alias("payer"), "patients", "fills",
                      round_money("_cost", 0).alias("cost"),
                      pct("_cov", "_cost").alias("cov_pct"))


def _adherence_base(star: Star, min_fills: int) -> DataFrame:
    fm = star.fact_medication
    return (fm.groupBy("drug_description")
            .agg(F.count(F.lit(1)).alias("total_fills"),
                 F.sum("is_completed").alias("completed_fills"),
                 F.sum(F.when(F.col("is_completed") == 1, F.col("total_cost"))
                       .otherwise(F.lit(0))).alias("_done_rev"))
            .filter(F.col("total_fills") >= min_fills)
            .withColumn("adherence_rate_pct", ratio_pct("completed_fills", "total_fills")))


def adherence(star: Star, min_fills: int = 50, k: int = 15) -> DataFrame:
    """Share of fills with a stop date, drugs with at least ``min_fills``."""
    base = _adherence_base(star, min_fills)
    return top_k(base.select("drug_description", "total_fills", "completed_fills",
                             "adherence_rate_pct"),
                 k, "-adherence_rate_pct", "drug_description")


def adherence_with_revenue(star: Star, min_fills: int = 100, k: int = 15) -> DataFrame:
    """As L18 plus the revenue of completed fills (whole dollars)."""
    base = _adherence_base(star, min_fills)
    return top_k(base.select("drug_description", "total_fills", "completed_fills",
                             "adherence_rate_pct",
                             round_money("_done_rev", 0).alias("completed_revenue")),
                 k, "-adherence_rate_pct", "drug_description")


def adherence_top(star: Star, min_fills: int = 100, k: int = 10) -> DataFrame:
    """L32 dashboard variant (fills, adherence_pct)."""
    base = _adherence_base(star, min_fills)
    return top_k(base.select(F.col("drug_description").alias("drug"),
                             F.col("total_fills").alias("fills"),
                             F.col("adherence_rate_pct").alias("adherence_pct")),
                 k, "-adherence_pct", "drug")


def brand_by_state(star: Star, top: int = 20, k: int = 50) -> DataFrame:
    """The top drugs by revenue, split by patient state.

    The fills of the top drugs are first reduced to one row per (drug,
    patient); only that (not every fill) is shuffled against the patient
    dimension, then folded per (drug, state)."""
    fm = star.fact_medication
    per_drug = (_positive_fills(star).groupBy("drug_description")
                .agg(F.sum("total_cost").alias("_tot")))
    keys = top_keys(per_drug, "drug_description", top, "-_tot", "drug_description")
    per_patient = (fm.join(keys, "drug_description", "left_semi")
                   .groupBy("drug_description", "patient_key")
                   .agg(F.count(F.lit(1)).alias("_n"), F.sum("total_cost").alias("_rev")))
    dp = star.dim_patient.select("patient_key", "patient_state")
    agg = (per_patient.join(dp, "patient_key")
           .groupBy("drug_description", "patient_state")
           .agg(F.sum("_n").alias("fill_count"), F.sum("_rev").alias("_rev")))
    out = agg.select("drug_description", "patient_state", "fill_count",
                     round_money("_rev", 0).alias("revenue"), "_rev")
    return top_k(out, k, "-_rev", "drug_description", "patient_state").drop("_rev")


def drug_class_revenue(star: Star, k: int = 15) -> DataFrame:
    """Revenue by drug class (first word of the drug name)."""
    fills = _positive_fills(star).withColumn("drug_class", first_word("drug_description"))
    agg = agg_with_distinct(
        fills, ["drug_class"],
        [F.count(F.lit(1)).alias("fill_count"), F.sum("total_cost").alias("_rev")],
        {"unique_drugs": "drug_description", "unique_patients": "patient_key"})
    out = agg.select("drug_class", "fill_count", "unique_drugs", "unique_patients",
                     round_money("_rev", 0).alias("total_revenue"),
                     avg_money("_rev", "fill_count").alias("avg_cost_per_fill"), "_rev")
    return top_k(out, k, "-_rev", "drug_class").drop("_rev")


def drug_class_fills(star: Star, k: int = 15) -> DataFrame:
    """L31 dashboard variant: class, fills, revenue."""
    agg = (_positive_fills(star).groupBy(first_word("drug_description").alias("class"))
           .agg(F.count(F.lit(1)).alias("fills"), F.sum("total_cost").alias("_rev")))
    out = agg.select("class", "fills", round_money("_rev", 0).alias("revenue"), "_rev")
    return top_k(out, k, "-_rev", "class").drop("_rev")


def payer_coverage_by_brand(star: Star, top: int = 10, k: int = 30) -> DataFrame:
    """Coverage of the most-filled drugs, per payer."""
    pos = _positive_fills(star)
    per_drug = pos.groupBy("drug_description").agg(F.count(F.lit(1)).alias("_n"))
    keys = top_keys(per_drug, "drug_description", top, "-_n", "drug_description")
    agg = (_with_payer(pos.join(keys, "drug_description", "left_semi"), star)
           .groupBy("drug_description", "payer_name")
           .agg(F.count(F.lit(1)).alias("fill_count"), F.sum("total_cost").alias("_cost"),
                F.sum("payer_coverage").alias("_cov")))
    out = agg.select("drug_description", "payer_name", "fill_count",
                     round_money("_cost", 0).alias("drug_cost"),
                     round_money("_cov", 0).alias("payer_covered"),
                     pct("_cov", "_cost").alias("coverage_rate_pct"), "_cost")
    return top_k(out, k, "-_cost", "drug_description", "payer_name").drop("_cost")
