"""Oracle SQL of the content digests (L0, L26, L44-L46): what every written
table has to hold, whatever its format (see ``carestar.sources.digest``)."""

from carestar.oracle.base import parts, with_star
from carestar.oracle.bi import BI_ENCOUNTER, BI_MEDICATION, SQL as BI_SQL
from carestar.sources import schemas

SQL = {}

_SHOWN = {"n": "cast(cast({c} AS decimal(38,6)) AS varchar)",
          "t": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
          "d": "strftime({c}, '%Y-%m-%d')",
          "s": "cast({c} AS varchar)",
          "e": "nullif(cast({c} AS varchar), '')"}  # an empty CSV field, quoted or not, is NULL


def _digest(name: str, source: str, kinds: dict[str, str | None]) -> str:
    """Digest row of ``source`` (a table or select); a kind is n(umber),
    t(ime), d(ate), s(tring or other), e(mpty is NULL) or None for a column that is NULL."""
    texts = [("'~'" if kinds[c] is None else "ifnull(" + _SHOWN[kinds[c]].format(c=f'"{c}"') + ", '~')")
             for c in sorted(kinds, key=str.lower)]
    return (f"SELECT '{name}' AS table_name, count(*) AS row_count, "
            f"cast(ifnull(sum(number), 0) AS varchar) AS content FROM (\n"
            f"  SELECT cast('0x' || left(md5(concat_ws('|', {', '.join(texts)})), 15) AS bigint) AS number\n"
            f"  FROM {source})")


def _kinds(numbers: str, times: str = "", dates: str = "", others: str = "") -> dict[str, str]:
    out = {c: "n" for c in numbers.split()}
    out.update({c: "t" for c in times.split()})
    out.update({c: "d" for c in dates.split()})
    out.update({c: "s" for c in others.split()})
    return out


_BI = {
    "bi_encounter": (BI_ENCOUNTER, _kinds(
        "base_cost total_claim_cost payer_coverage patient_responsibility lifetime_healthcare_expenses "
        "patient_lifetime_coverage_pct payer_coverage_pct", "", "encounter_date",
        "encounter_key year month_num date_key month_name quarter day_type encounter_class "
        "encounter_description is_fully_covered encounter_duration_days age_band patient_gender "
        "patient_race patient_state is_deceased provider_specialty organization_name provider_city "
        "provider_state payer_name")),
    "bi_medication": (BI_MEDICATION, _kinds(
        "base_cost payer_coverage total_cost payer_coverage_pct", "fill_date", "",
        "year month_num drug_description drug_code dispense_count is_completed age_band "
        "patient_gender patient_state payer_name")),
}
SQL["export_bi_parquet"] = with_star("\nUNION ALL\n".join(
    _digest(n, f"({sql})", kinds) for n, (sql, kinds) in _BI.items()))
SQL["catalog_views"] = with_star("""
SELECT 'encounters' AS fact, payer_name, age_band, day_type, count(*) AS records,
  cast(sum(total_claim_cost) AS double) AS cost
FROM fact_encounter LEFT JOIN dim_payer USING (payer_key) LEFT JOIN dim_patient USING (patient_key)
  LEFT JOIN dim_date USING (date_key)
GROUP BY ALL
UNION ALL
SELECT 'fills', payer_name, age_band, NULL, count(*), cast(sum(total_cost) AS double)
FROM fact_medication LEFT JOIN dim_payer USING (payer_key) LEFT JOIN dim_patient USING (patient_key)
WHERE date_key >= 19980101 GROUP BY ALL""")
SQL["export_bi_csv"] = SQL["export_bi_parquet"]

_FACTS = {
    "fact_med": ("export_medication_facts", _kinds("bc pc tc yp", "", "",
                                                   "d y m pk yk dc dd di ic ab g ps yn")),
    "fact_enc": ("export_encounter_facts", _kinds(
        "bc tc pc pr", "", "", "d y m pk prk yk ec ed fc du ab g ps yn sp ci org")),
    "conditions": ("export_condition_bridge", _kinds("", "", "", "pk d c")),
}
SQL["export_facts_json"] = with_star("\nUNION ALL\n".join(
    _digest(n, f"({parts(BI_SQL[job])[0]})", kinds) for n, (job, kinds) in _FACTS.items()))

# Schema columns that the role mapping does not have come back as NULL.
_MISSING = {"encounters": ["REASONDESCRIPTION"], "organizations": ["ADDRESS", "CITY", "STATE", "ZIP"],
            "payers": ["REVENUE", "UNCOVERED_MEDICATIONS", "UNCOVERED_PROCEDURES", "MEMBER_MONTHS"]}
_KIND = {"decimal": "n", "double": "n", "timestamp": "t", "date": "d"}


def _claims(table: str) -> str:
    kinds = {f.name: None if f.name in _MISSING.get(table, ()) else
             _KIND.get(f.dataType.typeName(), "e") for f in schemas.CLAIMS[table].fields}
    return _digest(table, table, kinds)


# The counted-only tables and the extra one: (select, kinds of what is ingested).
_money = "cast({} AS decimal(18,2))".format
COUNTED = {
    "procedures": (
        f"""(SELECT l_shipdate AS "DATE", l_orderkey AS "ENCOUNTER", l_partkey AS "CODE",
    l_returnflag AS "DESCRIPTION", {_money('l_extendedprice')} AS "BASE_COST"
    FROM lineitem WHERE l_linestatus = 'O')""",
        _kinds("BASE_COST", "DATE", "", "ENCOUNTER CODE DESCRIPTION")),
    "immunizations": (
        f"""(SELECT o_orderdate AS "DATE", o_custkey AS "PATIENT", o_orderkey AS "ENCOUNTER",
    o_orderpriority AS "DESCRIPTION", {_money('o_totalprice')} AS "BASE_COST"
    FROM orders WHERE o_orderstatus <> 'F')""",
        _kinds("BASE_COST", "DATE", "", "PATIENT ENCOUNTER DESCRIPTION")),
    "allergies": (
        f"""(SELECT c_custkey AS "PATIENT", c_mktsegment AS "CODE",
    if(c_acctbal >= 0, c_name, NULL) AS "DESCRIPTION", {_money('c_acctbal')} AS "SCORE" FROM customer)""",
        _kinds("SCORE", "", "", "PATIENT CODE DESCRIPTION")),
    "careplans": (
        """(SELECT p_partkey AS "Id", p_size AS "CODE", p_brand AS "REASON",
    p_name || chr(10) || '"' || p_type || '"' AS "DESCRIPTION" FROM part)""",
        _kinds("", "", "", "Id CODE REASON DESCRIPTION")),
    "imaging_studies": (
        f"""(SELECT s_suppkey AS "Id", s_name AS "BODYSITE", s_nationkey % 2 = 0 AS "CONTRAST",
    {_money('s_acctbal')} AS "DOSE" FROM supplier)""",
        _kinds("DOSE", "", "", "Id BODYSITE CONTRAST")),
    "observations": (
        """(SELECT ts AS "DATE", user_id AS "PATIENT", event_type AS "CODE", value AS "VALUE",
    props AS "UNITS" FROM events)""",
        _kinds("VALUE", "DATE", "", "PATIENT CODE UNITS")),
    "cdc_drug_overdose": (
        """(SELECT n_name AS "State Name", r_name AS "Indicator", n_nationkey + 1999 AS "Year",
    n_nationkey / 8.0 AS "Data Value" FROM nation JOIN region ON r_regionkey = n_regionkey)""",
        {"State Name": "s", "Indicator": "s", "Year": "s", "Data Value": "n"}),
}

SQL["ingest_roundtrip"] = with_star("\nUNION ALL\n".join(
    [_claims(t) for t in schemas.CLAIMS] + [_digest(n, src, kinds) for n, (src, kinds) in COUNTED.items()]))

SQL["table_row_counts"] = with_star("\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {src}"
    for n, src in [*[(t, t) for t in schemas.CLAIMS], *[(n, src) for n, (src, _) in COUNTED.items()]]))
