"""Oracle SQL for the star tables."""

from carestar.oracle.base import WHOLE_DATE, with_star

SQL = {}

SQL["dim_patient"] = with_star("""
SELECT * REPLACE (cast(lifetime_healthcare_expenses AS double) AS lifetime_healthcare_expenses,
                  cast(lifetime_payer_coverage AS double) AS lifetime_payer_coverage)
FROM dim_patient""")

SQL["dim_provider"] = with_star("""
SELECT * REPLACE (cast(organization_revenue AS double) AS organization_revenue) FROM dim_provider""")

SQL["dim_payer"] = with_star("""
SELECT * REPLACE (cast(AMOUNT_COVERED AS double) AS AMOUNT_COVERED,
                  cast(AMOUNT_UNCOVERED AS double) AS AMOUNT_UNCOVERED) FROM dim_payer""")

SQL["dim_date"] = with_star("SELECT * FROM whole_date", ctes=WHOLE_DATE)

SQL["dim_diagnosis"] = with_star("SELECT * FROM dim_diagnosis")

SQL["fact_encounter"] = with_star("""
SELECT * REPLACE (cast(base_cost AS double) AS base_cost,
                  cast(total_claim_cost AS double) AS total_claim_cost,
                  cast(payer_coverage AS double) AS payer_coverage,
                  cast(patient_responsibility AS double) AS patient_responsibility)
FROM fact_encounter""")

SQL["fact_medication"] = with_star("""
SELECT * REPLACE (cast(base_cost AS double) AS base_cost,
                  cast(payer_coverage AS double) AS payer_coverage,
                  cast(total_cost AS double) AS total_cost)
FROM fact_medication""")

SQL["star_row_counts"] = with_star("""
SELECT 'dim_patient' AS tbl, count(*) AS "rows" FROM dim_patient
UNION ALL SELECT 'dim_provider', count(*) FROM dim_provider
UNION ALL SELECT 'dim_payer', count(*) FROM dim_payer
UNION ALL SELECT 'dim_date', count(*) FROM whole_date
UNION ALL SELECT 'dim_diagnosis', count(*) FROM dim_diagnosis
UNION ALL SELECT 'fact_encounter', count(*) FROM fact_encounter
UNION ALL SELECT 'fact_medication', count(*) FROM fact_medication""", ctes=WHOLE_DATE)
