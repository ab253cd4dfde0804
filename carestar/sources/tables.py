"""Containers of lazy DataFrames: the raw claims tables and the star."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.config import Profile, REFERENCE

RAW_NAMES = ["patients", "encounters", "medications", "conditions", "providers",
             "organizations", "payers"]
STAR_NAMES = ["dim_patient", "dim_provider", "dim_payer", "dim_date", "dim_diagnosis",
              "fact_encounter", "fact_medication"]


@dataclass
class RawTables:
    patients: DataFrame
    encounters: DataFrame
    medications: DataFrame
    conditions: DataFrame
    providers: DataFrame
    organizations: DataFrame
    payers: DataFrame
    # Loaded and counted only (procedures, observations, cdc_drug_overdose, ...).
    counted: dict[str, DataFrame] = field(default_factory=dict)
    profile: Profile = REFERENCE

    def get(self, name: str) -> DataFrame:
        return getattr(self, name) if name in RAW_NAMES else self.counted[name]

    def named(self) -> dict[str, DataFrame]:
        out = {n: getattr(self, n) for n in RAW_NAMES}
        out.update(self.counted)
        return out


@dataclass
class Star:
    """Conformed star schema plus the raw tables some jobs read directly."""
    dim_patient: DataFrame
    dim_provider: DataFrame
    dim_payer: DataFrame
    dim_date: DataFrame
    dim_diagnosis: DataFrame
    fact_encounter: DataFrame
    fact_medication: DataFrame
    raw: RawTables

    def get(self, name: str) -> DataFrame:
        return getattr(self, name)

    def calendar(self) -> DataFrame:
        """The date dimension from the first day that reports look up."""
        start = self.raw.profile.calendar_start
        if start is None:
            return self.dim_date
        return self.dim_date.where(F.col("full_date") >= F.lit(start))
