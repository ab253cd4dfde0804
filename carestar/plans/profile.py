"""Profiling of the raw tables: L1-L5."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.functions.expr import avg_money, out_money, pct, round_money
from carestar.operators.counts import row_counts
from carestar.operators.joins import combine_one_row
from carestar.operators.quantile import exact_median_scaled, round_scaled
from carestar.operators.topk import top_k
from carestar.sources.tables import RawTables, Star


def _raw(x) -> RawTables:
    return x.raw if isinstance(x, Star) else x


def table_row_counts(src) -> DataFrame:
    """L1: rows per loaded table (claims tables and counted-only tables)."""
    return row_counts(_raw(src).named(), "table_name", "row_count")


def cost_distribution(src) -> DataFrame:
    """L2: min / avg / median / max / total of positive base encounter costs."""
    e = _raw(src).encounters.select(F.col("BASE_ENCOUNTER_COST").alias("c")).filter(F.col("c") > 0)
    stats = e.agg(F.min("c").alias("_min"), F.max("c").alias("_max"), F.sum("c").alias("_sum"),
                  F.count(F.lit(1)).alias("_n"))
    # Raw money keeps four places: the median is taken on 1/10000 units.
    med = exact_median_scaled(e, "c", 10000).select(F.col("median").alias("_med"))
    return combine_one_row(stats, med).select(
        out_money("_min").alias("min_cost"),
        avg_money("_sum", "_n").alias("avg_cost"),
        round_scaled(F.col("_med"), 10000, 2).alias("median_cost"),
        out_money("_max").alias("max_cost"),
        round_money("_sum").alias("total_cost"))


def activity_date_range(src) -> DataFrame:
    """L3: first and last encounter day and the days between them."""
    d = _raw(src).encounters.select(F.col("START").cast("date").alias("d"))
    return (d.agg(F.min("d").alias("earliest_encounter"), F.max("d").alias("latest_encounter"))
            .withColumn("day_span", F.datediff("latest_encounter", "earliest_encounter")))


def demographics(src, k: int = 20) -> DataFrame:
    """L4: patients per (gender, race), largest first."""
    agg = _raw(src).patients.groupBy("GENDER", "RACE").agg(F.count(F.lit(1)).alias("patient_count"))
    return top_k(agg, k, "-patient_count", "GENDER", "RACE")


def payer_coverage_profile(src) -> DataFrame:
    """Payers with covered / uncovered amounts and coverage percent."""
    p = _raw(src).payers
    cov, unc = F.col("AMOUNT_COVERED"), F.col("AMOUNT_UNCOVERED")
    return p.select(F.col("NAME").alias("payer_name"), out_money(cov).alias("AMOUNT_COVERED"),
                    out_money(unc).alias("AMOUNT_UNCOVERED"),
                    pct(cov, cov + unc).alias("coverage_pct"),
                    "UNIQUE_CUSTOMERS", "COVERED_ENCOUNTERS", "COVERED_MEDICATIONS")
