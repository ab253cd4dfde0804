"""Operator 1: mixing sources to target weights.

Every document gets a hash-random key; a range sort by (source, key) and
distributed running totals of the document sizes give each document its
place in its source's epoch.  A source whose budget is ``p`` epochs and
``r`` words contributes every document ``p`` times and, once more, the
documents of its first ``r`` words; the document across the cut counts as
far as the cut.  A hot source spreads over many range partitions because
the order continues with the hash key.

Size: words ``[^\\x20\\x09-\\x0D]+`` of the text (null: 0).  Null source: a
source of its own, sorted last.  Null or repeated ids: rows count one by
one; rows equal in id and text are interchangeable.  Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.llm.common import (SEPARATORS, WORD, pick, read_table, running, stash, text_hash,
                                 unstash)

WEIGHTS = (3, 1, 2)   # by source order, repeating
MAX_EPOCHS = 2        # a source gives at most this many times its size
SEED = "mix-1"


def _source_key(source):
    """Sorts like the source by code point, with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (skey, source_size): adds ``start`` (words of the sources
    before it) and ``target``.

    The shared budget is 3/2 of all words.  Water filling: in the order of
    cap / weight a source is full if its cap is within its share of what
    the full ones before it leave; the others share the rest by weight.
    """
    cycle = F.array(*[F.lit(w).cast("bigint") for w in weights])
    ranked = running(sizes, ["skey"], ["source_size"]).select(
        "skey", "source_size", F.col("before_source_size").alias("start"),
        cycle[(F.col("rank") % len(weights)).cast("int")].alias("weight"))
    ranked = ranked.withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    filled = running(ranked.withColumn("level", F.col("cap") / F.col("weight")),
                     ["level", "skey"], ["cap", "weight"])
    total = filled.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    all_words, all_weight = total["t"] or 0, total["w"] or 0
    left = F.lit(3 * all_words) - 2 * F.col("before_cap")      # twice the budget left
    rest = F.lit(all_weight) - F.col("before_weight")
    big = lambda c: c.cast("decimal(19,0)")                    # noqa: E731
    full = big(2 * F.col("cap")) * big(rest) <= big(F.col("weight")) * big(left)
    first = filled.where(~full).agg(F.min(F.struct("rank", left.alias("num"),
                                                   rest.alias("den"))).alias("f")).first()["f"]
    cap = F.col("cap").cast("double")
    if first is None:
        target = cap
    else:
        target = F.when(F.col("rank") < first["rank"], cap).otherwise(
            (F.col("weight") * F.lit(first["num"])).cast("double") / F.lit(float(2 * first["den"])))
    return filled.select("skey", "source_size", "start", target.alias("target"))


def plan_mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS,
             seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, skey, text_id, size, source_size,
    target, taken (words of it in the mix, repeats counted)."""
    d = pick(docs, doc_id="bigint", text="string", source="string")
    text = F.coalesce("text", F.lit(""))
    slim = d.select("doc_id", _source_key(F.col("source")).alias("skey"),
                    text_hash(F.col("text")).alias("text_id"),
                    F.md5(F.concat(F.lit(seed), F.lit(":"),
                                   F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                   F.lit(":"), F.md5(text))).alias("key"),
                    F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"))
    placed = running(slim, ["skey", "key", "doc_id"], ["size"])
    # The running totals are checkpointed: the texts are read once.
    sizes = placed.groupBy("skey").agg(F.sum("size").alias("source_size"))
    t = source_targets(sizes, weights, max_epochs)
    budget = F.floor("target").cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    j = placed.join(t, "skey").withColumn("epochs", whole.cast("bigint"))
    cut = budget - F.col("epochs") * F.col("source_size")
    place = F.col("before_size") - F.col("start")
    part = F.greatest(F.lit(0), F.least(F.col("size"), cut - place))
    return j.select("doc_id", "skey", "text_id", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size") + part).cast("bigint").alias("taken"))


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixed documents themselves, with the input's columns: a row per
    whole copy, and the document across a cut shortened to its words
    before the cut.  Documents without words or outside the budget go."""
    plan = (plan_mix(docs, **kw).groupBy("doc_id", "skey", "text_id")
            .agg(F.sum("taken").alias("taken"), F.max("size").alias("size")).where("taken > 0"))
    rows = stash(docs, doc_id="bigint", text="string", source="string").select(
        "_row", "doc_id", "text", _source_key(F.col("source")).alias("skey"),
        text_hash(F.col("text")).alias("text_id"))
    # Rows equal in id, source and text count together in the plan.
    keys = ["doc_id", "skey", "text_id"]
    one = rows.groupBy(*keys).agg(F.first(F.struct("_row", "text")).alias("d")).select(
        *keys, "d._row", "d.text")
    p = plan.select(F.col("doc_id").alias("p_id"), F.col("skey").alias("p_skey"),
                    F.col("text_id").alias("p_text"), "taken", "size")
    j = one.join(p, F.col("doc_id").eqNullSafe(F.col("p_id")) & (F.col("skey") == F.col("p_skey"))
                 & (F.col("text_id") == F.col("p_text")))
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") % F.col("size")).cast("int")
    lengths = F.concat(F.array_repeat(F.lit(0), whole),
                       F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    copies = j.withColumn("cut", F.explode(lengths))
    words = F.filter(F.split("text", SEPARATORS), lambda w: w != "")
    text = F.when(F.col("cut") == 0, F.col("text")).otherwise(
        F.array_join(F.slice(words, 1, F.greatest(F.col("cut"), F.lit(1))), " "))
    copies = copies.withColumn("mixed", text)
    return unstash(copies, docs, text=F.col("mixed"), n_chars=F.length("mixed"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents),
s AS (
  SELECT skey, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY skey) - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY skey),
f AS (
  SELECT *, 2 * source_size AS cap, row_number() OVER o AS pos,
         coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS cap0,
         coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS w0,
         sum(source_size) OVER ()::HUGEINT AS t, sum(weight) OVER ()::HUGEINT AS w
  FROM s WINDOW o AS (ORDER BY 2 * source_size / weight::DOUBLE, skey)),
u AS (
  SELECT pos, 3 * t - 2 * cap0 AS num, w - w0 AS den FROM f
  WHERE 2 * cap::HUGEINT * (w - w0) > weight * (3 * t - 2 * cap0) ORDER BY pos LIMIT 1),
g AS (
  SELECT skey, source_size,
         CASE WHEN (SELECT pos FROM u) IS NULL OR pos < (SELECT pos FROM u) THEN cap::DOUBLE
              ELSE (weight * (SELECT num FROM u))::DOUBLE / (2 * (SELECT den FROM u))::DOUBLE END AS target
  FROM f),
p AS (
  SELECT d.*, sum(size) OVER (PARTITION BY skey ORDER BY k, doc_id
                              ROWS UNBOUNDED PRECEDING) - size AS place FROM d)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE
         (floor(target)::BIGINT // source_size) * size
         + greatest(0, least(size, floor(target)::BIGINT % source_size - place)) END::BIGINT AS taken
FROM p JOIN g USING (skey)
"""
