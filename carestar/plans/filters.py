"""Interactive filters of the dashboard as Spark jobs: L47-L49, L53."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.functions.expr import avg_money, round_money
from carestar.operators.joins import combine_one_row, maybe_broadcast
from carestar.operators.slicers import apply_slicers, contains_ci
from carestar.operators.topk import top_k
from carestar.sources.tables import Star

# A sample selection for the registered jobs (payer names and bands of the
# test tables' role mapping); any dict of column -> values works.
SAMPLE_SELECTION = {"payer_name": ["PAYER_1", "PAYER_7", "PAYER_19"],
                    "age_band": ["35-49", "50-64", "65-79"]}


# Attributes a slicer may name, by fact: (dimension, key, column) where a
# dimension holds them; the fact's own columns go by their BI names.
_PERSON = {"age_band": ("dim_patient", "patient_key", "age_band"),
           "patient_gender": ("dim_patient", "patient_key", "GENDER"),
           "patient_state": ("dim_patient", "patient_key", "patient_state")}
_PAYER = {"payer_name": ("dim_payer", "payer_key", "payer_name"),
          "payer_coverage_pct": ("dim_payer", "payer_key", "coverage_rate_pct")}
_LOOKED_UP = {
    "fact_medication": {**_PERSON, **_PAYER},
    "fact_encounter": {
        **_PERSON, **_PAYER,
        "patient_race": ("dim_patient", "patient_key", "RACE"),
        "is_deceased": ("dim_patient", "patient_key", "is_deceased"),
        "provider_specialty": ("dim_provider", "provider_key", "SPECIALITY"),
        "organization_name": ("dim_provider", "provider_key", "organization_name"),
        "provider_city": ("dim_provider", "provider_key", "CITY"),
        "provider_state": ("dim_provider", "provider_key", "STATE"),
        "month_name": ("dim_date", "date_key", "month_name"),
        "quarter": ("dim_date", "date_key", "quarter"),
        "day_type": ("dim_date", "date_key", "day_type")},
}


def sliced(star: Star, fact: str, selection: dict[str, list] | None) -> DataFrame:
    """The fact's rows that a slicer selection keeps, with the fact's own
    columns; attributes that the fact's BI table lacks are ignored.

    A selected value is never NULL, so filtering the wide table equals a
    semi join with the filtered dimension: only dimensions that the
    selection names are read, by their key, already filtered."""
    df, looked_up = star.get(fact), _LOOKED_UP[fact]
    own = {"year": F.col("fill_year"), "month_num": F.month("fill_date")} \
        if fact == "fact_medication" else {}
    per_dim: dict[tuple[str, str], dict[str, list]] = {}
    for name, values in (selection or {}).items():
        if not values:
            continue
        if name in looked_up:
            dim, key, column = looked_up[name]
            per_dim.setdefault((dim, key), {})[column] = values
        elif name in own or name in df.columns:
            df = df.filter(own.get(name, F.col(name)).isin(list(values)))
    for (dim, key), wanted in per_dim.items():
        held = star.calendar() if dim == "dim_date" else star.get(dim)
        keys = apply_slicers(held, wanted).select(key)
        df = df.join(maybe_broadcast(keys), key, "left_semi")
    return df


def sliced_totals(star: Star, selection: dict[str, list] | None = None) -> DataFrame:
    """Totals of both BI tables under one slicer selection.
    Dimensions the table lacks are ignored for that table."""
    selection = SAMPLE_SELECTION if selection is None else selection
    parts = []
    for name, fact, cost in (("medications", "fact_medication", "total_cost"),
                             ("encounters", "fact_encounter", "total_claim_cost")):
        parts.append(sliced(star, fact, selection)
                     .agg(F.count(F.lit(1)).alias("records"), F.sum(cost).alias("_cost"))
                     .select(F.lit(name).alias("fact"), "records",
                             F.coalesce(round_money("_cost"), F.lit(0.0)).alias("total_cost")))
    return reduce(DataFrame.unionByName, parts)


def drug_search(star: Star, term: str = "ring") -> DataFrame:
    """Fills and revenue of drugs whose name contains ``term`` (any case)."""
    fm = star.fact_medication.filter(contains_ci("drug_description", term))
    return (fm.agg(F.count(F.lit(1)).alias("fills"), F.sum("total_cost").alias("_rev"))
            .select(F.lit(term).alias("term"), "fills",
                    F.coalesce(round_money("_rev"), F.lit(0.0)).alias("revenue")))


def condition_cohort_fills(star: Star, condition: str = "Brand#7") -> DataFrame:
    """Condition records, their distinct patients, and the fills of
    that patient cohort (a semi join against the cohort)."""
    cond = star.raw.conditions.filter(F.col("DESCRIPTION") == condition)
    rec = cond.agg(F.count(F.lit(1)).alias("condition_records"),
                   F.count_distinct("PATIENT").alias("cohort_patients"))
    # Fills are counted per patient before they meet the cohort (combined
    # before the shuffle): no fill is shuffled, only a row per patient and task.
    per_patient = star.fact_medication.groupBy("patient_key").agg(F.count(F.lit(1)).alias("_n"))
    cohort = cond.select(F.col("PATIENT").alias("patient_key")).distinct()
    fills = (per_patient.join(cohort, "patient_key")
             .agg(F.coalesce(F.sum("_n"), F.lit(0).cast("long")).alias("cohort_fills")))
    return combine_one_row(rec, fills).select(F.lit(condition).alias("condition"),
                                              "condition_records", "cohort_patients",
                                              "cohort_fills")


def leaderboard_sliced(star: Star, selection: dict[str, list] | None = None,
                       k: int = 25) -> DataFrame:
    """The brand leaderboard under payer / state / band slicers."""
    selection = SAMPLE_SELECTION if selection is None else selection
    fm = sliced(star, "fact_medication", selection).filter(F.col("total_cost") > 0)
    agg = (fm.groupBy("drug_description")
           .agg(F.count(F.lit(1)).alias("fill_count"), F.sum("total_cost").alias("_rev")))
    out = agg.select("drug_description", "fill_count", round_money("_rev").alias("total_revenue"),
                     avg_money("_rev", "fill_count").alias("avg_cost_per_fill"), "_rev")
    return top_k(out, k, "-_rev", "drug_description").drop("_rev")
