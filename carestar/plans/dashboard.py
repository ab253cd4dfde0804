"""Dashboard metrics, documents and slicer domains: L34-L38, L40-L43, L50-L52."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestar.functions.expr import (avg_money, code_prefix, first_word, pct, ratio_pct,
                                     round_money)
from carestar.operators.joins import combine_one_row, maybe_broadcast
from carestar.operators.ranking import positions, written_once
from carestar.operators.topk import top_k
from carestar.sources.concurrent import run_concurrently
from carestar.sources.tables import Star


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def kpi_cards(star: Star) -> DataFrame:
    """The eight headline numbers, one row (partial aggregates, no
    cross join of scalar subqueries)."""
    fm = star.fact_medication
    return combine_one_row(
        _count(star.raw.patients, "total_patients"),
        _count(star.raw.encounters, "total_encounters"),
        fm.agg(F.count(F.lit(1)).alias("total_prescriptions"),
               round_money(F.sum("total_cost"), 0).alias("total_revenue"),
               F.count_distinct("drug_description").alias("unique_drugs")),
        _count(star.dim_provider, "total_providers"),
        _count(star.raw.organizations, "total_orgs"),
        _count(star.dim_payer, "total_payers"),
    ).select("total_patients", "total_encounters", "total_prescriptions", "total_revenue",
             "unique_drugs", "total_providers", "total_orgs", "total_payers")


def specialty_volume(star: Star, k: int = 10) -> DataFrame:
    """Encounters and cost per provider specialty.

    Encounters are reduced to one row per provider first; only that meets
    the provider dimension."""
    per_provider = (star.fact_encounter.filter(F.col("total_claim_cost") > 0)
                    .groupBy("provider_key")
                    .agg(F.count(F.lit(1)).alias("_n"), F.sum("total_claim_cost").alias("_cost")))
    dpr = maybe_broadcast(star.dim_provider.select("provider_key", "SPECIALITY"))
    agg = (per_provider.join(dpr, "provider_key").groupBy(F.col("SPECIALITY").alias("specialty"))
           .agg(F.sum("_n").alias("encounters"), F.sum("_cost").alias("_cost")))
    out = agg.select("specialty", "encounters", round_money("_cost", 0).alias("cost"))
    return top_k(out, k, "-encounters", "specialty")


def state_distribution(star: Star, k: int = 10) -> DataFrame:
    """Patients per state, top k."""
    agg = (star.dim_patient.groupBy(F.col("patient_state").alias("state"))
           .agg(F.count(F.lit(1)).alias("patients")))
    return top_k(agg, k, "-patients", "state")


def age_band_distribution(star: Star) -> DataFrame:
    """Patients per age band (NULL band = unknown birth date, Q6)."""
    return star.dim_patient.groupBy("age_band").agg(F.count(F.lit(1)).alias("patients"))


def monthly_trend(star: Star) -> DataFrame:
    """Fills and revenue per calendar month."""
    fm = star.fact_medication
    agg = (fm.groupBy(F.year("fill_date").alias("year"), F.month("fill_date").alias("month"))
           .agg(F.count(F.lit(1)).alias("fills"), F.sum("total_cost").alias("_rev")))
    return agg.select("year", "month", "fills", round_money("_rev", 0).alias("revenue"))


def _section(df: DataFrame, name: str, order: list[tuple[str, bool]],
             fields: list) -> DataFrame:
    """A bounded frame (top-k or a small domain) as one array<struct> column
    in a deterministic order: each struct carries its sort keys first
    (descending keys negated), ``array_sort`` orders them, and the keys are
    dropped again.  One global aggregate, no window.

    ``fields`` are names or (name, places): rounded money and percents are
    written as decimals with that many places, so the JSON shows them as
    plain numbers (``1234567``, ``33.3``)."""
    keys = [(-F.col(c) if desc else F.col(c)).alias(f"_k{i}") for i, (c, desc) in enumerate(order)]
    cols = [F.col(f) if isinstance(f, str) else F.col(f[0]).cast(f"decimal(38,{f[1]})").alias(f[0])
            for f in fields]
    arr = F.array_sort(F.collect_list(F.struct(*keys, *cols)))
    drop = [f"_k{i}" for i in range(len(order))]
    return df.agg(F.transform(arr, lambda s: s.dropFields(*drop)).alias(name))


def _written(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return run_concurrently(lambda name: written_once(frames[name]), list(frames))


def _groupings(star: Star) -> dict[str, DataFrame]:
    """What the document's sections are made of, one pass per table: several
    groupings (GROUPING SETS, combined before the shuffle) of the fills, the
    encounters, the conditions and the patients, written once."""
    tc, cost = F.col("total_cost"), F.col("total_claim_cost")
    paid = tc > 0
    fills = star.fact_medication.select(
        "drug_description", "payer_key", "patient_key", F.year("fill_date").alias("year"),
        F.month("fill_date").alias("month"), "is_completed", "total_cost", "payer_coverage")
    by = ["drug_description", "payer_key", "patient_key", "year", "month"]
    drugs, payers, months = [["drug_description"], ["payer_key", "patient_key"], ["year", "month"]]
    keys = {"drug": drugs, "payer": payers, "month": months}

    def tag(all_by: list[str]) -> Column:
        """Which grouping a row belongs to, by the columns grouped away."""
        return F.grouping_id(*all_by).alias("_set")

    conditions_by = ["DESCRIPTION", "code_prefix", "PATIENT", "CODE"]
    conds = star.raw.conditions.select("DESCRIPTION", code_prefix("CODE").alias("code_prefix"),
                                       "PATIENT", "CODE")
    return _written({
        "fills": fills.groupingSets(list(keys.values()), *by).agg(
            tag(by), F.count(F.lit(1)).alias("n"), F.sum("is_completed").alias("completed"),
            F.count_if(paid).alias("n_pos"), F.sum(F.when(paid, tc)).alias("rev_pos"),
            F.sum(F.when(paid, F.col("payer_coverage"))).alias("cov_pos"), F.sum(tc).alias("rev")),
        "encounters": star.fact_encounter.select(
            "provider_key", "patient_key", "total_claim_cost", "payer_coverage")
        .groupingSets([["provider_key"], ["patient_key"]], "provider_key", "patient_key").agg(
            tag(["provider_key", "patient_key"]), F.count(F.lit(1)).alias("n"),
            F.count_if(cost > 0).alias("n_pos"), F.sum(F.when(cost > 0, cost)).alias("cost_pos"),
            F.sum(F.when(cost > 0, F.col("payer_coverage"))).alias("cov_pos")),
        "conditions": conds.groupingSets(
            [["DESCRIPTION", "PATIENT"], ["code_prefix", "PATIENT"], ["code_prefix", "CODE"]],
            *conditions_by).agg(tag(conditions_by), F.count(F.lit(1)).alias("n")),
        "patients": star.dim_patient.select("patient_state", "age_band").groupingSets(
            [["patient_state"], ["age_band"]], "patient_state", "age_band").agg(
            tag(["patient_state", "age_band"]), F.count(F.lit(1)).alias("n")),
    })


def _set_id(all_by: list[str], kept: list[str]) -> int:
    """Number of a grouping: a bit for every column that is grouped away."""
    return sum(1 << (len(all_by) - 1 - i) for i, c in enumerate(all_by) if c not in kept)


def dashboard_document(star: Star) -> DataFrame:
    """The dashboard's data document (v1 and v2 sections in one object),
    one row with one JSON column.  Every large table is read once, into
    groupings that all sections share; every section is built from an already
    limited frame, so each ``collect_list`` holds at most k rows.  Each equals
    its standalone job (tested)."""
    asc, desc = (lambda c: (c, False)), (lambda c: (c, True))
    made = _groupings(star)

    def grouping(table: str, all_by: list[str], *kept: str) -> DataFrame:
        return made[table].filter(F.col("_set") == _set_id(all_by, list(kept)))

    by_fill = ["drug_description", "payer_key", "patient_key", "year", "month"]
    ds = grouping("fills", by_fill, "drug_description")
    pos = ds.filter(F.col("n_pos") > 0)
    top_drugs = top_k(pos.select(F.col("drug_description").alias("drug"), F.col("n_pos").alias("fills"),
                                 round_money("rev_pos", 0).alias("revenue"), "rev_pos"),
                      10, "-rev_pos", "drug").drop("rev_pos")
    classes = (pos.groupBy(first_word("drug_description").alias("class"))
               .agg(F.sum("n_pos").alias("fills"), F.sum("rev_pos").alias("_rev")))
    drug_class = top_k(classes.select("class", "fills", round_money("_rev", 0).alias("revenue"),
                                      "_rev"), 15, "-_rev", "class").drop("_rev")
    adherence = top_k(ds.filter(F.col("n") >= 100)
                      .select(F.col("drug_description").alias("drug"), F.col("n").alias("fills"),
                              ratio_pct("completed", "n").alias("adherence_pct")),
                      10, "-adherence_pct", "drug")
    payer_names = maybe_broadcast(star.dim_payer.select("payer_key", "payer_name"))
    # A payer's fills per patient; names that several keys share are folded
    # by (name, patient) first, so that a patient counts once.
    payer_mix = (grouping("fills", by_fill, "payer_key", "patient_key").filter(F.col("n_pos") > 0)
                 .join(payer_names, "payer_key").groupBy("payer_name", "patient_key")
                 .agg(F.sum("n_pos").alias("n"), F.sum("rev_pos").alias("cost"),
                      F.sum("cov_pos").alias("cov"))
                 .groupBy(F.col("payer_name").alias("payer"))
                 .agg(F.count("patient_key").alias("patients"), F.sum("n").alias("fills"),
                      F.sum("cost").alias("_cost"), F.sum("cov").alias("_cov"))
                 .select("payer", "patients", "fills", round_money("_cost", 0).alias("cost"),
                         pct("_cov", "_cost").alias("cov_pct")))
    trend = grouping("fills", by_fill, "year", "month").select(
        "year", "month", F.col("n").alias("fills"), round_money("rev", 0).alias("revenue"))
    by_visit = ["provider_key", "patient_key"]
    per_provider = grouping("encounters", by_visit, "provider_key")
    specialties = top_k(
        per_provider.filter(F.col("n_pos") > 0)
        .join(maybe_broadcast(star.dim_provider.select("provider_key", "SPECIALITY")), "provider_key")
        .groupBy(F.col("SPECIALITY").alias("specialty"))
        .agg(F.sum("n_pos").alias("encounters"), F.sum("cost_pos").alias("_cost"))
        .select("specialty", "encounters", round_money("_cost", 0).alias("cost")),
        10, "-encounters", "specialty")
    by_condition = ["DESCRIPTION", "code_prefix", "PATIENT", "CODE"]
    bridge = (grouping("conditions", by_condition, "DESCRIPTION", "PATIENT")
              .select(F.col("DESCRIPTION").alias("condition"), F.col("PATIENT").alias("patient_key")))
    ta_patients = top_k(bridge.groupBy("condition").agg(F.count("patient_key").alias("patients")),
                        15, "-patients", "condition")
    per_patient = (grouping("encounters", by_visit, "patient_key").filter(F.col("n_pos") > 0)
                   .select("patient_key", "n_pos", "cost_pos"))
    ta_cost = (bridge.filter(F.col("patient_key").isNotNull()).join(per_patient, "patient_key")
               .groupBy("condition").agg(F.count(F.lit(1)).alias("patients"), F.sum("n_pos").alias("_n"),
                                         F.sum("cost_pos").alias("_tot")))
    ta_enc_cost = top_k(ta_cost.select("condition", "patients", round_money("_tot", 0).alias("total_cost"),
                                       avg_money("_tot", "_n", 0).alias("avg_cost"), "_tot"),
                        15, "-_tot", "condition").drop("_tot")
    prefixes = (grouping("conditions", by_condition, "code_prefix", "PATIENT")
                .unionByName(grouping("conditions", by_condition, "code_prefix", "CODE"))
                .groupBy(F.col("code_prefix").alias("chapter"))
                .agg(F.count("PATIENT").alias("patients"), F.count("CODE").alias("conditions")))
    by_person = ["patient_state", "age_band"]
    per_state = grouping("patients", by_person, "patient_state")
    states = top_k(per_state.select(F.col("patient_state").alias("state"), F.col("n").alias("patients")),
                   10, "-patients", "state")
    bands = grouping("patients", by_person, "age_band").select("age_band", F.col("n").alias("patients"))
    none = F.lit(0).cast("long")
    kpis = combine_one_row(
        per_state.agg(F.coalesce(F.sum("n"), none).alias("total_patients")),
        per_provider.agg(F.coalesce(F.sum("n"), none).alias("total_encounters")),
        ds.agg(F.coalesce(F.sum("n"), none).alias("total_prescriptions"),
               F.round(F.sum("rev"), 0).cast("decimal(38,0)").alias("total_revenue"),
               F.count("drug_description").alias("unique_drugs")),
        _count(star.dim_provider, "total_providers"),
        _count(star.raw.organizations, "total_orgs"),
        _count(star.dim_payer, "total_payers"),
    ).select(F.struct("total_patients", "total_encounters", "total_prescriptions",
                      "total_revenue", "unique_drugs", "total_providers", "total_orgs",
                      "total_payers").alias("kpis"))
    sections = [
        kpis,
        _section(top_drugs, "top_drugs", [desc("revenue"), asc("drug")],
                 ["drug", "fills", ("revenue", 0)]),
        _section(payer_mix, "payer_mix", [desc("cost"), asc("payer")],
                 ["payer", "patients", "fills", ("cost", 0), ("cov_pct", 1)]),
        _section(specialties, "specialties", [desc("encounters"), asc("specialty")],
                 ["specialty", "encounters", ("cost", 0)]),
        _section(states, "states", [desc("patients"), asc("state")], ["state", "patients"]),
        _section(bands, "age_bands", [asc("age_band")], ["age_band", "patients"]),
        _section(trend, "trend", [asc("year"), asc("month")],
                 ["year", "month", "fills", ("revenue", 0)]),
        _section(ta_patients, "ta_patients", [desc("patients"), asc("condition")],
                 ["condition", "patients"]),
        _section(ta_enc_cost, "ta_enc_cost", [desc("total_cost"), asc("condition")],
                 ["condition", "patients", ("total_cost", 0), ("avg_cost", 0)]),
        _section(top_k(prefixes, 10, "-patients", "chapter"), "icd10",
                 [desc("patients"), asc("chapter")], ["chapter", "patients", "conditions"]),
        _section(drug_class, "drug_class", [desc("revenue"), asc("class")],
                 ["class", "fills", ("revenue", 0)]),
        _section(adherence, "adherence", [desc("adherence_pct"), asc("drug")],
                 ["drug", "fills", ("adherence_pct", 1)]),
    ]
    doc = combine_one_row(*sections)
    names = [c for s in sections for c in s.columns]
    return doc.select(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("document"))


# ---- slicer and search domains (long form: dimension, position, value) ----

@dataclass(frozen=True)
class Domain:
    """A list of the values of ``column``: in order, or the ``top`` most
    frequent ones, most frequent first."""
    name: str
    table: str
    column: str
    top: int | None = None
    blank: bool = True  # '' is a value


SLICERS = [
    Domain("payers", "dim_payer", "payer_name"),
    Domain("states", "dim_patient", "patient_state"),
    Domain("age_bands", "dim_patient", "age_band"),
    Domain("genders", "dim_patient", "GENDER"),
    Domain("races", "dim_patient", "RACE"),
    Domain("ethnicity", "dim_patient", "ETHNICITY"),
    Domain("encounter_classes", "fact_encounter", "encounter_class"),
    Domain("encounter_descs", "fact_encounter", "encounter_description", top=50),
    Domain("years", "fact_encounter", "year"),
    Domain("cities", "dim_provider", "CITY", top=30, blank=False),
    Domain("specialties", "dim_provider", "SPECIALITY", top=30),
]
SEARCHES = [
    Domain("cities", "dim_provider", "CITY", top=30, blank=False),
    Domain("provider_states", "dim_provider", "STATE", blank=False),
    Domain("specialties", "dim_provider", "SPECIALITY"),
    Domain("years", "fact_encounter", "year"),
    Domain("encounter_descs", "fact_encounter", "encounter_description", top=50),
    Domain("all_conditions", "conditions", "DESCRIPTION", top=100),
    Domain("races", "dim_patient", "RACE"),
    Domain("genders", "dim_patient", "GENDER"),
    Domain("ethnicity", "dim_patient", "ETHNICITY"),
]


def _value_counts(star: Star, domains: list[Domain], start: dt.date | None) -> DataFrame:
    """(dimension, value, n) of all domains: one scan per table, whose rows
    name their value of every domain; counted before the shuffle.  Years
    before ``start`` are not listed."""
    parts = []
    for table in dict.fromkeys(d.table for d in domains):
        df = star.raw.conditions if table == "conditions" else star.get(table)
        pairs = []
        for d in (d for d in domains if d.table == table):
            v = F.col(d.column)
            if d.name == "years" and start is not None:  # a lower bound only
                v = F.when(v >= start.year, v)
            v = v.cast("string")
            pairs.append(F.struct(F.lit(d.name).alias("dimension"),
                                  (v if d.blank else F.nullif(v, F.lit(""))).alias("value")))
        parts.append(df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
                     .where(F.col("value").isNotNull())
                     .groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n")))
    return reduce(DataFrame.unionByName, parts)


def _lists(star: Star, domains: list[Domain], more: DataFrame, start: dt.date | None) -> DataFrame:
    """Positions in every list.  Lists without a limit are small domains;
    limited ones keep their best rows per task before they meet."""
    counts = written_once(_value_counts(star, domains, start))
    limits = {d.name: d.top for d in domains if d.top}
    ordered = Window.partitionBy("dimension").orderBy("value")
    frequent = Window.partitionBy("dimension").orderBy(F.col("n").desc(), "value")
    top = F.element_at(F.create_map(*[F.lit(x) for kv in limits.items() for x in kv]), F.col("dimension"))
    plain = counts.where(~F.col("dimension").isin(list(limits))).select(
        "dimension", F.row_number().over(ordered).cast("long").alias("position"), "value")
    limited = (counts.where(F.col("dimension").isin(list(limits)))
               .withColumn("position", F.row_number().over(frequent).cast("long"))
               .where(F.col("position") <= max(limits.values())).where(F.col("position") <= top)
               .select("dimension", "position", "value"))
    return plain.unionByName(limited).unionByName(more.select("dimension", "position", "value"))


def frequent_drug_classes(star: Star, min_fills: int = 100, k: int = 30) -> DataFrame:
    """Drug classes with more than ``min_fills`` positive-cost fills."""
    agg = (star.fact_medication.filter(F.col("total_cost") > 0)
           .groupBy(first_word("drug_description").alias("drug_class"))
           .agg(F.count(F.lit(1)).alias("fill_count"))
           .filter(F.col("fill_count") > min_fills))
    return top_k(agg, k, "-fill_count", "drug_class")


def slicer_domains(star: Star) -> DataFrame:
    """The values each dashboard slicer offers (v1 + v2 lists), full
    strings (Q2 fixed), one row per (dimension, position); all years of the
    spine."""
    return _slicers(star, star.raw.profile.spine_start)


def _slicers(star: Star, start: dt.date | None) -> DataFrame:
    w = Window.orderBy(F.col("fill_count").desc(), "drug_class")  # 30 rows at most
    classes = frequent_drug_classes(star).select(
        F.lit("drug_classes").alias("dimension"), F.row_number().over(w).cast("long").alias("position"),
        F.col("drug_class").alias("value"))
    return _lists(star, SLICERS, classes, start)


def search_domains(star: Star) -> DataFrame:
    """The search page's lists (cities, provider states, years,
    specialties, encounter texts, all drugs, conditions, demographics).  The
    list of all drugs has no bound: its positions come from a range sort."""
    drugs = (star.fact_medication.where(F.col("drug_description").isNotNull())
             .groupBy(F.col("drug_description").alias("value")).agg(F.count(F.lit(1)).alias("n")))
    every = positions(drugs, [F.col("n").desc(), F.col("value")]).withColumn(
        "dimension", F.lit("all_drugs"))
    return _lists(star, SEARCHES, every, star.raw.profile.first_day)


PART = 1000  # values in a part of a document


def document_parts(domains: DataFrame) -> DataFrame:
    """A document of lists as ordered parts: (dimension, part, items) with at
    most PART values in a part, a JSON array in position order; a list of any
    length is the concatenation of its parts."""
    part = F.floor((F.col("position") - 1) / PART).cast("int")
    return (domains.groupBy("dimension", part.alias("part"))
            .agg(F.array_sort(F.collect_list(F.struct("position", "value"))).alias("_v"))
            .select("dimension", "part", F.to_json(F.transform("_v", lambda x: x["value"])).alias("items")))


def filters_document(star: Star) -> DataFrame:
    """A10: the slicers' document in parts."""
    return document_parts(_slicers(star, star.raw.profile.first_day))


def search_document(star: Star) -> DataFrame:
    """A10: the search page's document in parts."""
    return document_parts(search_domains(star))


# ---- pages described by the report (L50-L52) ----

def payer_covered_vs_uncovered(star: Star) -> DataFrame:
    """Per payer, covered vs uncovered drug cost and its share of all cost."""
    per_key = (star.fact_medication.groupBy("payer_key")
               .agg(F.sum("payer_coverage").alias("_cov"), F.sum("total_cost").alias("_cost")))
    dpy = maybe_broadcast(star.dim_payer.select("payer_key", "payer_name"))
    per_payer = (per_key.join(dpy, "payer_key").groupBy("payer_name")
                 .agg(F.sum("_cov").alias("_cov"), F.sum("_cost").alias("_cost")))
    # The window spans one row per payer (a bounded domain).
    grand = F.sum("_cost").over(Window.partitionBy())
    return per_payer.select(
        "payer_name", round_money("_cov").alias("covered_cost"),
        round_money(F.col("_cost") - F.col("_cov")).alias("uncovered_cost"),
        round_money("_cost").alias("total_cost"),
        pct("_cov", "_cost").alias("covered_pct"),
        pct("_cost", grand).alias("mix_share_pct"))


def patient_distribution(star: Star) -> DataFrame:
    """Patients by gender, race, state and age band (long form), one scan."""
    pairs = F.array(*[F.struct(F.lit(name).alias("dimension"), F.col(c).cast("string").alias("value"))
                      for name, c in (("gender", "GENDER"), ("race", "RACE"),
                                      ("state", "patient_state"), ("age_band", "age_band"))])
    return (star.dim_patient.select(F.explode(pairs).alias("p"))
            .groupBy("p.dimension", "p.value").agg(F.count(F.lit(1)).alias("patients")))


def provider_geography(star: Star) -> DataFrame:
    """Providers, encounters and claim cost per provider state and city."""
    per_provider = (star.fact_encounter.groupBy("provider_key")
                    .agg(F.count(F.lit(1)).alias("_n"), F.sum("total_claim_cost").alias("_cost")))
    j = star.dim_provider.select("provider_key", "STATE", "CITY").join(per_provider,
                                                                        "provider_key", "left")
    agg = (j.groupBy(F.col("STATE").alias("provider_state"), F.col("CITY").alias("provider_city"))
           .agg(F.count(F.lit(1)).alias("providers"),
                F.coalesce(F.sum("_n"), F.lit(0).cast("long")).alias("encounters"),
                F.sum("_cost").alias("_cost")))
    return agg.select("provider_state", "provider_city", "providers", "encounters",
                      F.coalesce(round_money("_cost"), F.lit(0.0)).alias("claim_cost"))
