"""carestar: claims analytics as PySpark jobs.

Raw claims tables -> profile -> star schema (patient, provider, payer,
date, diagnosis dimensions; encounter and medication facts) -> brand,
payer, adherence and condition KPIs, data-quality checks, BI tables,
exports, dashboard documents, slicer domains and slicer/cohort filters.

Every job is a function ``job(star_or_raw, **params) -> DataFrame`` built
from the DataFrame API and built-in functions only.
"""

__version__ = "0.1.0"
