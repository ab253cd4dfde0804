"""Data quality and governance checks: L19-L23."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.functions.expr import is_blank, out_money, ratio_pct, round_money
from carestar.operators.joins import NotIn, not_in_counts
from carestar.operators.topk import top_k
from carestar.sources.tables import Star

# The columns the reference checks for NULL or blank values.
DEFAULT_NULL_CHECKS = {
    "encounters": ["REASONCODE", "PAYER"],
    "medications": ["REASONCODE", "STOP"],
    "patients": ["DEATHDATE"],
}


ORPHAN_RULES = [
    NotIn("orphan_encounters_no_patient", "fact_encounter", "patient_key", "dim_patient", "patient_key"),
    NotIn("orphan_meds_no_patient", "fact_medication", "patient_key", "dim_patient", "patient_key"),
    NotIn("orphan_encounters_no_provider", "fact_encounter", "provider_key", "dim_provider",
          "provider_key"),
    NotIn("orphan_encounters_no_payer", "fact_encounter", "payer_key", "dim_payer", "payer_key",
          known=True),
]

# Keys that no fact names.  Encounters without a provider put a NULL into the
# set of the first provider rule, which therefore counts nothing.
UNREFERENCED_RULES = [
    NotIn("patients_without_encounters", "dim_patient", "patient_key", "fact_encounter", "patient_key"),
    NotIn("patients_without_fills", "dim_patient", "patient_key", "fact_medication", "patient_key"),
    NotIn("providers_without_encounters", "dim_provider", "provider_key", "fact_encounter",
          "provider_key"),
    NotIn("providers_without_known_encounters", "dim_provider", "provider_key", "fact_encounter",
          "provider_key", known_set=True),
    NotIn("encounters_without_fills", "fact_encounter", "encounter_key", "fact_medication",
          "encounter_key"),
    NotIn("encounters_of_fillless_patients", "fact_encounter", "patient_key", "fact_medication",
          "patient_key"),
    NotIn("providers_of_encounters_not_payers", "fact_encounter", "provider_key",
          "dim_payer", "payer_key"),
]


def _counts(star: Star, rules: list[NotIn]) -> DataFrame:
    names = {t for r in rules for t in (r.table, r.set_table)}
    return not_in_counts({n: star.get(n) for n in sorted(names)}, rules)


def orphan_checks(star: Star) -> DataFrame:
    """Fact rows whose key is NOT IN the dimension (SQL NULL semantics),
    all rules in one pass over each table."""
    return _counts(star, ORPHAN_RULES)


def unreferenced_keys(star: Star) -> DataFrame:
    """NOT IN the other way round: keys that no row of a fact names."""
    return _counts(star, UNREFERENCED_RULES)


def dim_null_keys(star: Star) -> DataFrame:
    """NULL keys inside the dimensions: such a key silently turns every
    ``NOT IN`` check above into 0 violations, so it is reported apart."""
    parts = [star.get(d).agg(F.count_if(F.col(k).isNull()).alias("null_keys"))
             .select(F.lit(d).alias("dimension"), "null_keys")
             for d, k in [("dim_patient", "patient_key"), ("dim_provider", "provider_key"),
                          ("dim_payer", "payer_key")]]
    return reduce(DataFrame.unionByName, parts)


def overpayment_violations(star: Star, k: int = 20) -> DataFrame:
    """Encounters whose payer coverage exceeds the claim cost (Q11: ordered)."""
    fe = star.fact_encounter.filter(F.col("payer_coverage") > F.col("total_claim_cost"))
    out = fe.select("encounter_key", "patient_key", out_money("total_claim_cost").alias("total_claim_cost"),
                    out_money("payer_coverage").alias("payer_coverage"),
                    round_money(F.col("payer_coverage") - F.col("total_claim_cost"))
                    .alias("overpayment_amt"))
    return top_k(out, k, "-overpayment_amt", "encounter_key")


def null_rates(star: Star, checks: dict[str, list[str]] | None = None) -> DataFrame:
    """Percent of NULL-or-blank values per (table, column).

    One aggregate per table covers all its checked columns (instead of one
    scan per column), then ``unpivot`` turns the row into long form."""
    checks = checks or DEFAULT_NULL_CHECKS
    parts = []
    for tbl, cols in checks.items():
        df = star.raw.get(tbl)
        wide = df.agg(F.count(F.lit(1)).alias("_n"),
                      *[F.count_if(is_blank(c)).alias(c) for c in cols])
        long = wide.unpivot(["_n"], cols, "col", "_blank")
        parts.append(long.select(F.lit(tbl).alias("tbl"), "col",
                                 ratio_pct("_blank", "_n").alias("null_pct")))
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, key: str, check_name: str) -> DataFrame:
    """Rows beyond one per key value; NULL keys count as surplus."""
    return (df.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("violations"))
            .select(F.lit(check_name).alias("check_name"), "violations"))


def duplicate_encounters(star: Star) -> DataFrame:
    return duplicate_keys(star.fact_encounter, "encounter_key", "duplicate_encounters")


def duplicate_fill_encounters(star: Star) -> DataFrame:
    """L22 on the fills' encounter column (many fills per encounter)."""
    return duplicate_keys(star.fact_medication, "encounter_key", "duplicate_fill_encounters")


def nonpositive_cost_by_class(star: Star) -> DataFrame:
    """Encounters with zero or negative claim cost, per class."""
    return (star.fact_encounter.filter(F.col("total_claim_cost") <= 0)
            .groupBy("encounter_class").agg(F.count(F.lit(1)).alias("zero_or_neg_cost_count")))
