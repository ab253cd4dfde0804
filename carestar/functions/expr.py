"""Column expressions shared by the jobs (built-in functions only).

Money stays DECIMAL(18,2) from the fact projection on; sums, averages and
ratios are computed in decimal, rounded half-up once, and turned into
DOUBLE only at the output (``out_money`` / ``avg_money`` / ``pct``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "MONEY", "money", "out_money", "round_money", "avg_money", "pct", "ratio_pct",
    "is_blank", "date_key", "year_diff", "age_band", "first_word", "flag",
    "to_date_lit", "code_prefix", "AGE_BANDS",
]

MONEY = "decimal(18,2)"

# The age bands and their order as the reference defines them.
AGE_BANDS = ["0-17", "18-34", "35-49", "50-64", "65-79", "80+"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x) -> Column:
    """Round a raw amount to cents, keep it exact."""
    return F.round(_c(x), 2).cast(MONEY)


def round_money(x, places: int = 2) -> Column:
    """Round an exact decimal sum half-up to ``places``; double at the output."""
    return F.round(_c(x), places).cast("double")


def out_money(x) -> Column:
    return _c(x).cast("double")


def _half_up_ratio(num, den, factor: int, places: int) -> Column:
    """factor * num / den rounded half-up once, in whole numbers: inputs of
    up to four decimal places, NULL when den = 0."""
    def whole(x):
        return (_c(x).cast("decimal(38,4)") * F.lit(10_000)).cast("decimal(38,0)")

    n, d = whole(num), whole(den)
    unit = 10 ** places
    doubled = F.abs(n) * F.lit(2 * factor * unit) + F.abs(d)
    units = F.call_function("div", doubled, F.nullif(F.abs(d) * F.lit(2), F.lit(0)))
    return units * F.signum(n.cast("double")) * F.signum(d.cast("double")) / F.lit(float(unit))


def avg_money(total, n, places: int = 2) -> Column:
    """Exact average of a decimal sum over a count, rounded half-up once."""
    return _half_up_ratio(total, n, 1, places)


def pct(num, den, places: int = 1) -> Column:
    """100 * num / den, NULL when den = 0, rounded half-up once."""
    return _half_up_ratio(num, den, 100, places)


def ratio_pct(part, whole, places: int = 1) -> Column:
    """Share of a count in percent (integer inputs)."""
    return F.round(_c(part).cast("decimal(20,0)") * F.lit(100)
                   / F.nullif(_c(whole).cast("decimal(20,0)"), F.lit(0)), places).cast("double")


def is_blank(x) -> Column:
    """NULL or empty after trim, for a column of any type (Q3)."""
    return _c(x).isNull() | (F.trim(_c(x).cast("string")) == F.lit(""))


def date_key(x) -> Column:
    """yyyyMMdd as INT."""
    return F.date_format(_c(x), "yyyyMMdd").cast("int")


def year_diff(start, end) -> Column:
    """Year boundaries crossed between two dates (not full years)."""
    return F.year(_c(end)) - F.year(_c(start))


def age_band(age) -> Column:
    a = _c(age)
    return (F.when(a.isNull(), F.lit(None).cast("string"))
            .when(a < 18, "0-17")
            .when(a.between(18, 34), "18-34")
            .when(a.between(35, 49), "35-49")
            .when(a.between(50, 64), "50-64")
            .when(a.between(65, 79), "65-79")
            .otherwise("80+"))


def first_word(x) -> Column:
    return F.split_part(_c(x), F.lit(" "), F.lit(1))


def code_prefix(x) -> Column:
    return F.substring(_c(x).cast("string"), 1, 1)


def flag(cond: Column) -> Column:
    """1/0 integer flag; a NULL condition is 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def to_date_lit(d: dt.date | str) -> Column:
    return F.lit(d if isinstance(d, str) else d.isoformat()).cast("date")
