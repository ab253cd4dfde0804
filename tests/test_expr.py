"""Column expressions: exact half-up rounding, NULL / zero guards, blanks,
date keys, year-boundary ages, first word, code prefix."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from carestar.functions import expr as X


def _one(spark, schema, row, *cols):
    return spark.createDataFrame([row], schema).select(*cols).first()


def test_avg_and_pct_round_half_up_exactly(spark):
    r = _one(spark, "s decimal(28,2), n long, a long, b long, neg decimal(28,2)",
             (Decimal("100.01"), 2, 1, 8, Decimal("-100.01")),
             X.avg_money("s", "n").alias("avg"), X.ratio_pct("a", "b").alias("p"),
             X.avg_money("neg", "n").alias("avg_neg"), X.pct("s", F.lit(0)).alias("zero"),
             X.avg_money("s", F.lit(0)).alias("zero_n"), X.round_money("s", 0).alias("r0"))
    assert r.avg == 50.01          # 50.005 -> up
    assert r.p == 12.5             # 12.5 exactly
    assert r.avg_neg == -50.01     # away from zero, like the oracle
    assert r.zero is None and r.zero_n is None  # no division error under ANSI
    assert r.r0 == 100.0


def test_pct_of_money_and_third(spark):
    r = _one(spark, "a decimal(18,2), b decimal(18,2)", (Decimal("1"), Decimal("3")),
             X.pct("a", "b").alias("p"), X.pct("a", "b", 2).alias("p2"))
    assert (r.p, r.p2) == (33.3, 33.33)


def test_is_blank_any_type(spark):
    rows = spark.createDataFrame([(None, None, None), ("", 1, dt.date(2020, 1, 1)),
                                  ("  ", None, None), ("x", 0, None)],
                                 "s string, i int, d date")
    got = [tuple(r) for r in rows.select(X.is_blank("s"), X.is_blank("i"), X.is_blank("d")).collect()]
    assert got == [(True, True, True), (True, False, False), (True, True, True),
                   (False, False, True)]


def test_dates_ages_words_codes(spark):
    r = _one(spark, "b date, t timestamp_ntz, name string, one string, code long",
             (dt.date(1990, 12, 31), dt.datetime(2020, 2, 29, 23, 59), "Simvastatin 10 MG",
              "Aspirin", 38341003),
             X.year_diff("b", F.lit("1991-01-01").cast("date")).alias("age"),
             X.date_key("t").alias("k"), X.first_word("name").alias("w"),
             X.first_word("one").alias("w1"), X.code_prefix("code").alias("cp"),
             X.age_band(F.lit(17)).alias("b17"), X.age_band(F.lit(80)).alias("b80"),
             X.age_band(F.lit(None).cast("int")).alias("bnull"),
             X.flag(F.lit(None).cast("boolean")).alias("fnull"))
    assert r.age == 1  # one year boundary, not a full year
    assert r.k == 20200229
    assert (r.w, r.w1, r.cp) == ("Simvastatin", "Aspirin", "3")
    assert (r.b17, r.b80, r.bnull, r.fnull) == ("0-17", "80+", None, 0)
    assert X.AGE_BANDS == ["0-17", "18-34", "35-49", "50-64", "65-79", "80+"]
