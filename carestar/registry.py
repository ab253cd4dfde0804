"""Registered jobs: name -> job over the star (one per SURVEY 2L entry or variant)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from carestar.plans import (bi, brand, conditions, dashboard, filters, profile, quality,
                            star as star_plans)
from carestar.sources import schemas
from carestar.sources.digest import content_digest
from carestar.sources.tables import Star


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Money leaves the engine as DOUBLE (exact decimal until here)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def _star_table(name: str) -> Callable[[Star], DataFrame]:
    def job(s: Star) -> DataFrame:
        df = s.get(name)
        if "fill_year" in df.columns:  # partition helper, not a fact column
            df = df.drop("fill_year")
        return decimals_to_double(df)
    job.__name__ = name
    return job


JOBS: dict[str, Callable[[Star], DataFrame]] = {
    # star (L6-L13)
    "dim_patient": _star_table("dim_patient"),
    "dim_provider": _star_table("dim_provider"),
    "dim_payer": _star_table("dim_payer"),
    "dim_date": _star_table("dim_date"),
    "dim_diagnosis": _star_table("dim_diagnosis"),
    "fact_encounter": _star_table("fact_encounter"),
    "fact_medication": _star_table("fact_medication"),
    "star_row_counts": star_plans.star_row_counts,
    # brand (L14, L16-L18, L30-L33)
    "brand_leaderboard": brand.brand_leaderboard,
    "top_drugs_by_revenue": brand.top_drugs_by_revenue,
    "monthly_brand_trend": brand.monthly_brand_trend,
    "monthly_brand_trend_calendar": brand.monthly_brand_trend_calendar,
    "payer_coverage_rate": brand.payer_coverage_rate,
    "payer_mix": brand.payer_mix,
    "adherence": brand.adherence,
    "adherence_with_revenue": brand.adherence_with_revenue,
    "adherence_top": brand.adherence_top,
    "brand_by_state": brand.brand_by_state,
    "drug_class_revenue": brand.drug_class_revenue,
    "drug_class_fills": brand.drug_class_fills,
    "payer_coverage_by_brand": brand.payer_coverage_by_brand,
    # profile (L1-L5)
    "table_row_counts": profile.table_row_counts,
    "cost_distribution": profile.cost_distribution,
    "activity_date_range": profile.activity_date_range,
    "demographics": profile.demographics,
    "payer_coverage_profile": profile.payer_coverage_profile,
    # quality (L19-L23)
    "orphan_checks": quality.orphan_checks,
    "unreferenced_keys": quality.unreferenced_keys,
    "dim_null_keys": quality.dim_null_keys,
    "overpayment_violations": quality.overpayment_violations,
    "null_rates": quality.null_rates,
    "duplicate_encounters": quality.duplicate_encounters,
    "duplicate_fill_encounters": quality.duplicate_fill_encounters,
    "nonpositive_cost_by_class": quality.nonpositive_cost_by_class,
    # conditions
    "condition_cost_rollup": conditions.condition_cost_rollup,
    "condition_leaderboard": conditions.condition_leaderboard,
    "condition_patients": conditions.condition_patients,
    "condition_encounter_cost": conditions.condition_encounter_cost,
    "condition_encounter_cost_summary": conditions.condition_encounter_cost_summary,
    "condition_drug_cost": conditions.condition_drug_cost,
    "code_prefix_distribution": conditions.code_prefix_distribution,
    # BI tables and exports
    "bi_encounter": bi.bi_encounter,
    "bi_medication": bi.bi_medication,
    "export_medication_facts": bi.export_medication_facts,
    "export_encounter_facts": bi.export_encounter_facts,
    "export_condition_bridge": bi.export_condition_bridge,
    # dashboard
    "kpi_cards": dashboard.kpi_cards,
    "specialty_volume": dashboard.specialty_volume,
    "state_distribution": dashboard.state_distribution,
    "age_band_distribution": dashboard.age_band_distribution,
    "monthly_trend": dashboard.monthly_trend,
    "dashboard_document": dashboard.dashboard_document,
    "slicer_domains": dashboard.slicer_domains,
    "frequent_drug_classes": dashboard.frequent_drug_classes,
    "search_domains": dashboard.search_domains,
    "filters_document": dashboard.filters_document,
    "search_document": dashboard.search_document,
    "payer_covered_vs_uncovered": dashboard.payer_covered_vs_uncovered,
    "patient_distribution": dashboard.patient_distribution,
    "provider_geography": dashboard.provider_geography,
    # slicers and cohorts
    "sliced_totals": filters.sliced_totals,
    "drug_search": filters.drug_search,
    "condition_cohort_fills": filters.condition_cohort_fills,
    "leaderboard_sliced": filters.leaderboard_sliced,
}

# Reports without a limit come back in the report's order, ties broken by
# what makes their rows unique ("-": descending).
ORDERED = {
    "table_row_counts": ("-row_count", "table_name"),
    "payer_coverage_profile": ("-AMOUNT_COVERED", "payer_name"),
    "dim_diagnosis": ("-occurrence_count", "diagnosis_key", "diagnosis_description"),
    "star_row_counts": ("tbl",),
    "monthly_brand_trend": ("drug_description", "yr", "mo"),
    "monthly_brand_trend_calendar": ("drug_description", "yr", "mo"),
    "payer_coverage_rate": ("-total_drug_cost", "payer_name"),
    "nonpositive_cost_by_class": ("-zero_or_neg_cost_count", "encounter_class"),
    "age_band_distribution": ("age_band",),
    "monthly_trend": ("year", "month"),
}


# A few rows by what they are (tables, payers, classes, bands, months): one
# task sorts them, without the extra job that samples ranges.
FEW_ROWS = {"table_row_counts", "payer_coverage_profile", "star_row_counts", "payer_coverage_rate",
            "nonpositive_cost_by_class", "age_band_distribution", "monthly_trend"}


def _ordered(job: Callable[[Star], DataFrame], keys: tuple[str, ...], few: bool):
    def run(s: Star) -> DataFrame:
        df = job(s)
        order = [F.col(k[1:]).desc_nulls_last() if k[0] == "-" else F.col(k).asc_nulls_last()
                 for k in keys]
        return df.coalesce(1).sortWithinPartitions(*order) if few else df.orderBy(*order)
    run.__name__ = getattr(job, "__name__", "job")
    return run


JOBS.update({name: _ordered(JOBS[name], keys, name in FEW_ROWS) for name, keys in ORDERED.items()})


def _fresh(spark, sf_dir: str, name: str) -> str:
    """A new folder per call: an earlier lazy result keeps its files."""
    from carestar.sources.warehouse import work_dir
    return work_dir(spark, sf_dir, f"{name}-{uuid.uuid4().hex}")


# Jobs that write files and return what they read back: (spark, sf_dir, star).
SINK_JOBS: dict[str, Callable] = {}


def _digests(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table read back: name, rows, digest of the content."""
    return reduce(DataFrame.unionByName, [content_digest(n, df) for n, df in tables.items()])


def _export_bi_parquet(spark, sf_dir, s: Star) -> DataFrame:
    """Both BI tables exported as Parquet, digests of what is read back."""
    paths = bi.export_bi(s, _fresh(spark, sf_dir, "exports"), formats=("parquet",))
    return _digests({
        "bi_encounter": bi.read_bi_parquet(spark, paths["bi_encounter.parquet"], bi.bi_encounter(s)),
        "bi_medication": bi.read_bi_parquet(spark, paths["bi_medication.parquet"],
                                            bi.bi_medication(s))})


def _export_bi_csv(spark, sf_dir, s: Star) -> DataFrame:
    """Both BI tables exported as CSV, digests of what is read back."""
    paths = bi.export_bi(s, _fresh(spark, sf_dir, "exports_csv"), formats=("csv",))
    return _digests({
        "bi_encounter": bi.read_bi_csv(spark, paths["bi_encounter.csv"], bi.bi_encounter(s)),
        "bi_medication": bi.read_bi_csv(spark, paths["bi_medication.csv"], bi.bi_medication(s))})


def _export_facts_json(spark, sf_dir, s: Star) -> DataFrame:
    """The fact exports as gzip JSON Lines, digests of what is read back."""
    paths = bi.export_facts(s, _fresh(spark, sf_dir, "exports_json"))
    back = bi.read_facts(spark, paths, s)
    return _digests({name.split(".")[0]: df for name, df in back.items()})


SINK_JOBS["export_bi_parquet"] = _export_bi_parquet
SINK_JOBS["export_bi_csv"] = _export_bi_csv
SINK_JOBS["export_facts_json"] = _export_facts_json


def oracle() -> dict[str, str]:
    from carestar.oracle import (bi as obi, brand as obrand, dashboard as odash,
                                 quality as oquality, sinks as osinks, star as ostar)
    out: dict[str, str] = {}
    for mod in (ostar, obrand, oquality, obi, odash, osinks):
        out.update(mod.SQL)
    return {k: v for k, v in out.items() if k in JOBS or k in SINK_JOBS}


def _ingest_roundtrip(spark, sf_dir, s: Star) -> DataFrame:
    """L0 round trip: every raw table (claims, counted-only and the extra
    one) written in its CSV layout (gzip: text is several times its input's
    size), ingested back, and digested by content."""
    from carestar.sources.ingest import export_raw_csv, ingest_raw, read_ingested
    csv_dir, out_dir = _fresh(spark, sf_dir, "csv"), _fresh(spark, sf_dir, "ingested")
    export_raw_csv(s.raw, csv_dir, compression="gzip")
    extra = {n: f"{csv_dir}/{n}.csv" for n in s.raw.counted if n not in schemas.COUNTED_ONLY}
    ingest_raw(spark, csv_dir, out_dir, extra=extra)
    return _digests({n: read_ingested(spark, out_dir, n) for n in s.raw.named()})


SINK_JOBS["ingest_roundtrip"] = _ingest_roundtrip


def _catalog_views(spark, sf_dir, s: Star) -> DataFrame:
    """The star as tables of the catalog, both wide views queried in SQL."""
    from carestar.sources import catalog
    from carestar.sources.warehouse import built_root
    root = built_root(spark, sf_dir)
    database = f"carestar_{root.rstrip('/').rpartition('/')[2]}"
    catalog.register(spark, root, database, s.raw.profile.calendar_start)
    return spark.sql(f"""
        SELECT 'encounters' AS fact, payer_name, age_band, day_type, COUNT(*) AS records,
               CAST(SUM(CAST(total_claim_cost AS DECIMAL(18,2))) AS DOUBLE) AS cost
        FROM {database}.v_bi_encounter GROUP BY payer_name, age_band, day_type
        UNION ALL
        SELECT 'fills', payer_name, age_band, NULL, COUNT(*),
               CAST(SUM(CAST(total_cost AS DECIMAL(18,2))) AS DOUBLE)
        FROM {database}.v_bi_medication WHERE year >= 1998 GROUP BY payer_name, age_band""")


SINK_JOBS["catalog_views"] = _catalog_views
