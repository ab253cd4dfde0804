"""Role mapping: the provided TPC-style test tables -> raw claims tables.

customer -> patients, orders -> encounters, lineitem -> medications,
returned-and-finished lineitems -> conditions, supplier -> providers,
region -> organizations, nation -> payers.  Every raw table is a lazy
DataFrame over the whole input tables; nothing is sampled or capped.
Derived attributes (gender, ethnicity, birth dates, seeded NULLs, blanks and
orphans) are deterministic functions of the keys.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.config import TESTDATA, Profile
from carestar.sources.tables import RawTables

MONEY = "decimal(18,2)"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def read_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet")) for t in TABLES}


def _dec(c: str):
    return F.col(c).cast(MONEY)


def _lost(row_key: str, every: int, at: int, key: str):
    """Seeded orphans: some rows name a key that no dimension holds."""
    return F.when(F.col(row_key) % every == at, -1 - F.col(key)).otherwise(F.col(key))


def patients(t: dict[str, DataFrame]) -> DataFrame:
    k = F.col("c_custkey")
    nat = t["nation"].select("n_nationkey", "n_name")
    return (t["customer"].join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                k.alias("Id"),
                F.when(k % 2 == 0, "F").otherwise("M").alias("GENDER"),
                F.col("c_mktsegment").alias("RACE"),
                F.when(k % 5 == 0, "hispanic").otherwise("nonhispanic").alias("ETHNICITY"),
                F.col("n_name").alias("STATE"),
                F.concat(F.col("n_name"), F.lit(" County "), (k % 7).cast("string")).alias("COUNTY"),
                F.when(k % 97 == 0, F.lit(None).cast("date"))
                 .otherwise(F.make_date((1930 + k % 90).cast("int"), (1 + k % 12).cast("int"),
                                        (1 + k % 28).cast("int"))).alias("BIRTHDATE"),
                F.when(k % 10 == 0, F.lit("2015-01-01").cast("date")).alias("DEATHDATE"),
                (F.abs(_dec("c_acctbal")) * 10).cast(MONEY).alias("HEALTHCARE_EXPENSES"),
                F.when(k % 3 == 0, F.lit(0).cast(MONEY))
                 .otherwise(F.abs(_dec("c_acctbal"))).cast(MONEY).alias("HEALTHCARE_COVERAGE"),
                F.col("c_nationkey").alias("PAYER"),
            ))


def encounters(t: dict[str, DataFrame]) -> DataFrame:
    lines = (t["lineitem"].groupBy("l_orderkey")
             .agg(F.min("l_suppkey").alias("provider"), F.max("l_shipdate").alias("stop_ts"),
                  F.sum(_dec("l_extendedprice")).alias("base_amt")))
    cust = t["customer"].select("c_custkey", "c_nationkey")
    nat = t["nation"].select("n_nationkey", "n_regionkey")
    o = (t["orders"].join(cust, F.col("o_custkey") == F.col("c_custkey"))
         .join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left"))
    total = _dec("o_totalprice")
    no_lines = F.col("l_orderkey").isNull()
    return o.select(
        F.col("o_orderkey").alias("Id"),
        _lost("o_orderkey", 350, 3, "o_custkey").alias("PATIENT"),
        _lost("o_orderkey", 400, 7, "provider").alias("PROVIDER"),
        F.when(F.col("o_orderkey") % 450 == 9, F.col("c_nationkey") + 1000)
         .otherwise(F.col("c_nationkey")).alias("PAYER"),
        F.col("n_regionkey").alias("ORGANIZATION"),
        F.col("o_orderpriority").alias("ENCOUNTERCLASS"),
        F.col("o_orderstatus").alias("CODE"),
        F.concat(F.col("o_orderpriority"), F.lit(" visit ("), F.col("o_orderstatus"), F.lit(")"))
         .alias("DESCRIPTION"),
        F.col("o_orderdate").alias("START"),
        F.col("stop_ts").alias("STOP"),
        F.coalesce(F.col("base_amt"), F.lit(0)).cast(MONEY).alias("BASE_ENCOUNTER_COST"),
        F.when(no_lines, F.lit(0).cast(MONEY)).otherwise(total).alias("TOTAL_CLAIM_COST"),
        F.when(no_lines, F.lit(0))
         .when(F.col("o_orderkey") % 500 == 0, total + 10)
         .when(F.col("o_orderstatus") == "F", total)
         .when(F.col("o_orderstatus") == "P", total * F.lit(0.5).cast("decimal(2,1)"))
         .otherwise(F.lit(0)).cast(MONEY).alias("PAYER_COVERAGE"),
        F.when(F.col("o_orderstatus") == "F", F.col("c_nationkey").cast("string"))
         .when(F.col("o_orderstatus") == "P", F.lit("")).alias("REASONCODE"),
    )


def medications(t: dict[str, DataFrame]) -> DataFrame:
    # Orders meet customers first (the smaller pair), so the line items are
    # shuffled only by order key and by part key, never a third time.
    cust = t["customer"].select("c_custkey", "c_nationkey")
    orders = (t["orders"].select("o_orderkey", "o_custkey")
              .join(cust, F.col("o_custkey") == F.col("c_custkey")))
    part = t["part"].select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    m = (t["lineitem"].join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(part, F.col("l_partkey") == F.col("p_partkey")))
    returned_n = F.col("l_returnflag") == "N"
    return m.select(
        F.col("l_shipdate").alias("START"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("STOP"),
        _lost("l_orderkey", 550, 5, "o_custkey").alias("PATIENT"),
        F.col("c_nationkey").alias("PAYER"),
        F.col("l_orderkey").alias("ENCOUNTER"),
        F.col("l_partkey").alias("CODE"),
        F.col("p_name").alias("DESCRIPTION"),
        _dec("p_retailprice").alias("BASE_COST"),
        (_dec("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")).cast(MONEY)
         .alias("PAYER_COVERAGE"),
        F.col("l_quantity").cast("int").alias("DISPENSES"),
        _dec("l_extendedprice").alias("TOTALCOST"),
        F.when(returned_n, F.lit(None).cast("string")).otherwise(F.col("p_size").cast("string"))
         .alias("REASONCODE"),
        F.when(returned_n, F.lit(None).cast("string")).otherwise(F.col("p_brand"))
         .alias("REASONDESCRIPTION"),
    )


def conditions(t: dict[str, DataFrame]) -> DataFrame:
    orders = t["orders"].select("o_orderkey", "o_custkey")
    part = t["part"].select("p_partkey", "p_brand", "p_size")
    li = t["lineitem"].filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
    return (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_shipdate").cast("date").alias("START"),
                    F.lit(None).cast("date").alias("STOP"),
                    F.col("o_custkey").alias("PATIENT"),
                    F.col("l_orderkey").alias("ENCOUNTER"),
                    F.col("p_size").cast("string").alias("CODE"),
                    F.col("p_brand").alias("DESCRIPTION")))


def providers(t: dict[str, DataFrame]) -> DataFrame:
    k = F.col("s_suppkey")
    return (t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
            .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
            .select(k.alias("Id"),
                    F.col("n_regionkey").alias("ORGANIZATION"),
                    F.col("s_name").alias("NAME"),
                    F.when(k % 2 == 0, "F").otherwise("M").alias("GENDER"),
                    F.col("n_name").alias("SPECIALITY"),
                    F.concat(F.col("s_name"), F.lit(" Street")).alias("ADDRESS"),
                    F.concat(F.col("n_name"), F.lit("-"), (k % 3).cast("string")).alias("CITY"),
                    F.col("r_name").alias("STATE"),
                    (10000 + k % 90000).cast("string").alias("ZIP"),
                    (k % 1000).cast("int").alias("UTILIZATION")))


def organizations(t: dict[str, DataFrame]) -> DataFrame:
    per_region = (t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
                  .groupBy("n_regionkey")
                  .agg(F.sum(_dec("s_acctbal")).alias("rev"), F.count(F.lit(1)).alias("n")))
    return (t["region"].join(per_region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(F.col("r_regionkey").alias("Id"), F.col("r_name").alias("NAME"),
                    F.coalesce(F.col("rev"), F.lit(0)).cast(MONEY).alias("REVENUE"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("int").alias("UTILIZATION")))


def payers(t: dict[str, DataFrame], pats: DataFrame) -> DataFrame:
    cov, exp = F.col("HEALTHCARE_COVERAGE"), F.col("HEALTHCARE_EXPENSES")
    per_payer = (pats.groupBy("PAYER")
                 .agg(F.sum(cov).alias("cov"), F.sum(exp - cov).alias("unc"),
                      F.count(F.lit(1)).alias("n"),
                      F.count_if(cov > 0).alias("n_cov"), F.count_if(cov == 0).alias("n_unc"),
                      F.count_if(F.col("GENDER") == "F").alias("n_f"),
                      F.count_if(F.col("GENDER") == "M").alias("n_m")))
    return (t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
            .join(per_payer, F.col("PAYER") == F.col("n_nationkey"), "left")
            .select(F.col("n_nationkey").alias("Id"),
                    F.concat(F.lit("PAYER_"), F.col("n_nationkey").cast("string")).alias("NAME"),
                    F.col("r_name").alias("STATE_HEADQUARTERED"),
                    F.col("cov").cast(MONEY).alias("AMOUNT_COVERED"),
                    F.col("unc").cast(MONEY).alias("AMOUNT_UNCOVERED"),
                    F.col("n").cast("int").alias("UNIQUE_CUSTOMERS"),
                    F.col("n_cov").cast("int").alias("COVERED_ENCOUNTERS"),
                    F.col("n_unc").cast("int").alias("UNCOVERED_ENCOUNTERS"),
                    F.col("n_f").cast("int").alias("COVERED_MEDICATIONS"),
                    F.col("n_m").cast("int").alias("COVERED_PROCEDURES"),
                    (F.col("n_regionkey").cast("double") / 4).alias("QOLS_AVG")))


def counted(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables that are loaded and counted only, and the extra CSV."""
    li, o, s = t["lineitem"], t["orders"], t["supplier"]
    return {
        "procedures": li.filter(F.col("l_linestatus") == "O").select(
            F.col("l_shipdate").alias("DATE"), F.col("l_orderkey").alias("ENCOUNTER"),
            F.col("l_partkey").alias("CODE"), F.col("l_returnflag").alias("DESCRIPTION"),
            _dec("l_extendedprice").alias("BASE_COST")),
        "immunizations": o.filter(F.col("o_orderstatus") != "F").select(
            F.col("o_orderdate").alias("DATE"), F.col("o_custkey").alias("PATIENT"),
            F.col("o_orderkey").alias("ENCOUNTER"), F.col("o_orderpriority").alias("DESCRIPTION"),
            _dec("o_totalprice").alias("BASE_COST")),
        "allergies": t["customer"].select(
            F.col("c_custkey").alias("PATIENT"), F.col("c_mktsegment").alias("CODE"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("DESCRIPTION"),
            _dec("c_acctbal").alias("SCORE")),
        # a description over two lines with a quoted word in it
        "careplans": t["part"].select(
            F.col("p_partkey").alias("Id"), F.col("p_size").alias("CODE"),
            F.concat(F.col("p_name"), F.lit('\n"'), F.col("p_type"), F.lit('"')).alias("DESCRIPTION"),
            F.col("p_brand").alias("REASON")),
        "imaging_studies": s.select(
            F.col("s_suppkey").alias("Id"), F.col("s_name").alias("BODYSITE"),
            (F.col("s_nationkey") % 2 == 0).alias("CONTRAST"), _dec("s_acctbal").alias("DOSE")),
        "observations": t["events"].select(
            F.col("ts").alias("DATE"), F.col("user_id").alias("PATIENT"),
            F.col("event_type").alias("CODE"), F.col("value").alias("VALUE"),
            F.col("props").alias("UNITS")),
        "cdc_drug_overdose": t["nation"].join(
            t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_name").alias("State Name"), F.col("r_name").alias("Indicator"),
            (F.col("n_nationkey") + 1999).alias("Year"),
            (F.col("n_nationkey") / 8).alias("Data Value")),
    }


def load(spark: SparkSession, sf_dir: str, profile: Profile = TESTDATA) -> RawTables:
    t = read_tables(spark, sf_dir)
    pats = patients(t)
    return RawTables(patients=pats, encounters=encounters(t), medications=medications(t),
                     conditions=conditions(t), providers=providers(t),
                     organizations=organizations(t), payers=payers(t, pats), counted=counted(t),
                     profile=profile)
