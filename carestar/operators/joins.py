"""Join helpers: size-checked broadcast and the null-aware anti join."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side shipped to every executor, by the optimizer's size of its
# plan (file sizes scaled to the columns read, in memory several times that).
MAX_BROADCAST_BYTES = 32 << 20


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's upper estimate of the frame's size in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def maybe_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side only when the size of its plan is bounded by
    MAX_BROADCAST_BYTES; otherwise leave the choice to the optimizer and
    AQE, which convert to a broadcast at runtime from measured sizes."""
    return F.broadcast(df) if plan_bytes(df) <= MAX_BROADCAST_BYTES else df


def dim_join(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str) -> DataFrame:
    return fact.join(maybe_broadcast(dim), on, how)


def combine_one_row(*frames: DataFrame) -> DataFrame:
    """Put several one-row aggregates side by side as one row.

    Each frame holds distinct column names; they are stacked with
    ``unionByName`` (missing columns NULL) and folded with ``max``, which
    keeps the one non-NULL value per column.  No cross join is planned.
    """
    cols = [c for f in frames for c in f.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in cols])


def count_not_in(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str,
                 weight: str | None = None) -> DataFrame:
    """Rows of ``fact`` whose key is ``NOT IN (SELECT dim_key FROM dim)``,
    with SQL's three-valued semantics, as a one-row count.

    ``NOT IN`` plans as a null-aware anti join that always broadcasts the
    subquery side.  Here both sides are reduced to their distinct keys (map-
    side combined), joined once by key (a shuffle join at scale), and folded:
      * a NULL fact key never qualifies (comparison is unknown);
      * if the dim holds a NULL key, no row qualifies;
      * if the dim is empty, every row qualifies (incl. NULL keys).
    ``weight`` names a row-count column when ``fact`` is pre-aggregated.
    Each side is scanned and shuffled once; the dim's guard counts reuse the
    dim's shuffle.
    """
    w = F.col(weight) if weight else F.lit(1).cast("long")
    f = fact.select(F.col(fact_key).alias("_k"), w.alias("_w"))
    dk = dim.groupBy(F.col(dim_key).alias("_k")).agg(F.count(F.lit(1)).alias("_dn"))
    hits = dk.filter(F.col("_k").isNotNull()).select("_k", F.lit(True).alias("_hit"))
    per = (f.join(hits, "_k", "left")
           .agg(F.coalesce(F.sum("_w"), F.lit(0).cast("long")).alias("_n_all"),
                F.coalesce(F.sum(F.when(F.col("_k").isNotNull() & F.col("_hit").isNull(),
                                        F.col("_w"))), F.lit(0).cast("long")).alias("_n_anti")))
    guards = dk.agg(F.coalesce(F.sum("_dn"), F.lit(0).cast("long")).alias("_dim_n"),
                    F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_dn"))),
                               F.lit(0).cast("long")).alias("_dim_nulls"))
    return (combine_one_row(per, guards)
            .select(F.when(F.col("_dim_n") == 0, F.col("_n_all"))
                    .when(F.col("_dim_nulls") > 0, F.lit(0).cast("long"))
                    .otherwise(F.col("_n_anti")).alias("violations")))


@dataclass(frozen=True)
class NotIn:
    """Rows of ``table`` whose ``key`` is NOT IN (``set_key`` of
    ``set_table``), counted under ``name``; ``known`` leaves out rows with a
    NULL key, ``known_set`` NULLs of the set."""
    name: str
    table: str
    key: str
    set_table: str
    set_key: str
    known: bool = False
    known_set: bool = False


def not_in_counts(tables: dict[str, DataFrame], rules: list[NotIn]) -> DataFrame:
    """(check_name, violations) of all rules in one pass.

    Every table is scanned once: its rows name all keys they hold for a rule
    or for a set, tagged with that set.  The tagged keys are united and
    aggregated once per (set, key), combined before the shuffle, so a key
    with a third of all rows is one row per task; a second, tiny aggregate
    per set folds the rules with the semantics of ``count_not_in``.  Keys
    are compared as text."""
    sets = list(dict.fromkeys((r.set_table, r.set_key, r.known_set) for r in rules))
    parts = []
    for name in dict.fromkeys(t for r in rules for t in (r.table, r.set_table)):
        tags = [(sets.index((r.set_table, r.set_key, r.known_set)), r.key, i, r.known)
                for i, r in enumerate(rules) if r.table == name]
        tags += [(k, key, -1, known) for k, (table, key, known) in enumerate(sets) if table == name]
        rows = F.array(*[F.struct(F.lit(s).alias("s"), F.col(key).cast("string").alias("k"),
                                  F.lit(i).alias("rule"), F.lit(known).alias("known"))
                         for s, key, i, known in tags])
        parts.append(tables[name].select(F.explode(rows).alias("t")).select("t.*")
                     .where(~F.col("known") | F.col("k").isNotNull())
                     .select("s", "k", "rule", F.lit(1).cast("long").alias("n")))
    spark = next(iter(tables.values())).sparkSession
    parts.append(spark.range(len(sets)).select(  # a set stays when nothing is in it
        F.col("id").cast("int").alias("s"), F.lit(None).cast("string").alias("k"),
        F.lit(-1).alias("rule"), F.lit(0).cast("long").alias("n")))

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0).cast("long"))

    per_key = reduce(DataFrame.unionByName, parts).groupBy("s", "k").agg(
        total(F.col("rule") < 0).alias("held"),
        *[total(F.col("rule") == i).alias(f"r{i}") for i in range(len(rules))])
    unmatched = F.col("k").isNotNull() & (F.col("held") == 0)
    per_set = per_key.groupBy("s").agg(
        F.sum("held").alias("set_n"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("held"))), F.lit(0)).alias("set_nulls"),
        *[F.sum(f"r{i}").alias(f"all{i}") for i in range(len(rules))],
        *[F.coalesce(F.sum(F.when(unmatched, F.col(f"r{i}"))), F.lit(0)).alias(f"anti{i}")
          for i in range(len(rules))])
    out = F.array(*[F.struct(
        F.lit(sets.index((r.set_table, r.set_key, r.known_set))).alias("of"),
        F.lit(r.name).alias("check_name"),
        F.when(F.col("set_n") == 0, F.col(f"all{i}")).when(F.col("set_nulls") > 0, 0)
        .otherwise(F.col(f"anti{i}")).cast("long").alias("violations")) for i, r in enumerate(rules)])
    return (per_set.select("s", F.explode(out).alias("o")).where(F.col("o.of") == F.col("s"))
            .select("o.check_name", "o.violations"))
