"""Operator 2: document fingerprints (SimHash), DataFrame functions only.

Terms: the distinct lower-cased words of a text, split at space and
tab .. carriage return; a term of more than SHORT bytes weighs LONG_WEIGHT.
Each term's 128 hash bits vote with its weight, and a fingerprint bit is set
where the votes for it exceed half of the text's weight.  Votes are counted
two bits to a 64-bit sum, so a text takes 64 sums and one aggregate whose
map side already reduces it to a row.

Search: fingerprints are cut into BLOCKS blocks; within radius
BLOCKS - 2 at least two blocks are equal, so one table per pair of blocks
(its two blocks permuted to the front as the key) finds every fingerprint
within the radius; distances are checked exactly.  Equal fingerprints meet
once, whatever number of documents has them.

The next document is found by a window inside blocks of the id order whose
borders are ids of the table; the first document of a block also goes to
the end of the block before.  Null text: as the empty text, whose
fingerprint is zero.  Null ids: after all others, ordered by text.  Repeated
rows: one row each.  Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carestar.llm.common import SEPARATORS, checkpoint, pick, read_table

BITS = 128
SHORT, LONG_WEIGHT = 3, 2
BLOCK_ROWS = 2000        # documents of an order block, on average
MAX_BORDERS = 10_000     # borders held as a literal; blocks grow beyond
BLOCKS = 8               # of the search tables
RADIUS = 6
QUERY_STEP = 100         # documents whose id it divides search all others
NO_ID = (1 << 63) - 1

_LANES = (1 << 32) + 1   # bits i and 32 + i of a hash, in one sum


def terms(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(text), SEPARATORS))


def votes(word: Column) -> list[Column]:
    """The 64 packed sums of the 128 vote counts, and the whole weight."""
    weight = F.when(word == "", 0).when(F.octet_length(word) > SHORT, LONG_WEIGHT).otherwise(1)
    weight = weight.cast("bigint")
    sums = []
    for k in range(2):
        h = F.xxhash64(word, F.lit(k))
        sums += [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_LANES)) * weight)
                 .alias(f"s{k}_{i}") for i in range(32)]
    return [*sums, F.sum(weight).alias("weight")]


def fingerprint(k: int) -> Column:
    """64 fingerprint bits from the sums of hash ``k``."""
    low = (1 << 32) - 1
    bits = F.lit(0).cast("bigint")
    for i in range(32):
        s = F.col(f"s{k}_{i}")
        for half, at in ((s.bitwiseAND(F.lit(low)), i), (F.shiftrightunsigned(s, 32), 32 + i)):
            bits = bits.bitwiseOR(F.when(2 * half > F.col("weight"),
                                         F.lit(_signed(1 << at))).otherwise(F.lit(0)))
    return bits


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _likeness(a1, a2, b1, b2) -> Column:
    differ = F.bit_count(a1.bitwiseXOR(b1)) + F.bit_count(a2.bitwiseXOR(b2))
    return 1 - differ / BITS


def _ordered(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text in blocks of the id order: columns blk, pos
    (place in the block), extra (the next block's first document)."""
    d = pick(docs, doc_id="bigint", text="string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("doc_id", F.lit(NO_ID)).alias("o"))
    stats = d.agg(F.count("*").alias("n"), F.min("o").alias("lo")).first()
    n = min(MAX_BORDERS, (stats["n"] or 0) // BLOCK_ROWS)
    borders = []
    if n:
        q = F.percentile_approx("o", [i / n for i in range(1, n)] or [0.5], 10 * n)
        borders = sorted({b for b in d.agg(q.alias("q")).first()["q"]} - {stats["lo"]})
    if borders:  # binary search of the literal: the number of borders at or below o
        known = F.array(*[F.lit(b) for b in borders])
        steps = [1 << i for i in range(len(borders).bit_length() - 1, -1, -1)]
        blk = F.aggregate(
            F.array(*[F.lit(s) for s in steps]), F.lit(0),
            lambda at, s: F.when((at + s <= len(borders)) & (F.get(known, at + s - 1) <= F.col("o")),
                                 at + s).otherwise(at))
        d = d.withColumn("blk", blk)
        opens = (F.col("blk") > 0) & (F.get(known, F.col("blk") - 1) == F.col("o"))
    else:
        d = d.withColumn("blk", F.lit(0))
        opens = F.lit(False)
    def home(blk, wrap, extra):
        return F.struct(blk.cast("int").alias("blk"), F.lit(wrap).alias("wrap"),
                        F.lit(extra).alias("extra"))

    own = home(F.col("blk"), 0, False)
    ahead, round_ = home(F.col("blk") - 1, 0, True), home(F.lit(len(borders)), 1, True)
    first = F.col("o") == F.lit(stats["lo"] if stats["lo"] is not None else 0)
    homes = F.when(first, F.array(own, round_)).when(opens, F.array(own, ahead)).otherwise(
        F.array(own))
    placed = d.select("doc_id", "text", "o", F.explode(homes).alias("h")).select(
        "doc_id", "text", "o", "h.blk", "h.wrap", "h.extra")
    w = Window.partitionBy("blk").orderBy("wrap", "o", "text", "extra")
    return placed.select("doc_id", "text", "blk", "extra", F.row_number().over(w).alias("pos"),
                         F.lead("text").over(w).alias("next_text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, f1, f2 (the fingerprint's halves),
    e1, e2 (the edited text's), near_edited, near_next; checkpointed."""
    d = _ordered(docs).withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                      F.substring("next_text", F.lit(1), half))
    d = d.withColumn("edited", F.when(~F.col("extra"), edited))
    d = d.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))

    def version(which, text):
        return F.struct(F.lit(which).alias("which"), F.col(text).alias("t"))

    texts = F.when(F.col("extra"), F.array(version(0, "text"))).otherwise(
        F.array(version(0, "text"), version(1, "edited")))
    keys = ["blk", "pos", "extra", "doc_id", "n_chars", "edited_sha256"]
    words = (d.select(*keys, F.explode(texts).alias("v"))
             .select(*keys, "v.which", F.explode(terms(F.col("v.t"))).alias("word")))
    voted = words.groupBy(*keys, "which").agg(*votes(F.col("word")))
    marked = voted.select(*keys, "which", fingerprint(0).alias("f1"), fingerprint(1).alias("f2"))
    # A document, its edited text and the next document follow each other.
    w = Window.partitionBy("blk").orderBy("pos", "which")
    near = marked.select(*keys, "which", "f1", "f2",
                         *[F.lead(c, k).over(w).alias(f"{c}_{k}") for k in (1, 2)
                           for c in ("f1", "f2")]).where("which = 0 and not extra")
    return checkpoint(near.select(
        "doc_id", "n_chars", "edited_sha256", "f1", "f2",
        F.col("f1_1").alias("e1"), F.col("f2_1").alias("e2"),
        _likeness(F.col("f1"), F.col("f2"), F.col("f1_1"), F.col("f2_1")).alias("near_edited"),
        _likeness(F.col("f1"), F.col("f2"), F.col("f1_2"), F.col("f2_2")).alias("near_next")))


def _tables(prints: DataFrame) -> DataFrame:
    """One row per fingerprint and pair of blocks: the permuted tables."""
    per = 64 // (BLOCKS // 2)
    mask = F.lit((1 << per) - 1)
    blocks = [F.shiftrightunsigned(F.col(c), per * i).bitwiseAND(mask)
              for c in ("f1", "f2") for i in range(BLOCKS // 2)]
    pairs = [(i, j) for i in range(BLOCKS) for j in range(i + 1, BLOCKS)]
    keys = F.array(*[F.struct(F.lit(t).alias("tab"),
                              (F.shiftleft(blocks[i], per).bitwiseOR(blocks[j])).alias("key"))
                     for t, (i, j) in enumerate(pairs)])
    return prints.select("f1", "f2", F.explode(keys).alias("k")).select("f1", "f2", "k.tab", "k.key")


def near_fingerprints(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs of a query's fingerprint (q1, q2) and another distinct
    fingerprint (f1, f2) at Hamming distance <= radius (at most BLOCKS - 2)."""
    if radius > BLOCKS - 2:
        raise ValueError(f"the block tables are complete up to radius {BLOCKS - 2}")
    all_ = _tables(prints.select("f1", "f2").distinct())
    ask = _tables(queries.select("f1", "f2").distinct()).withColumnsRenamed({"f1": "q1", "f2": "q2"})
    differ = F.bit_count(F.col("f1").bitwiseXOR(F.col("q1"))) + F.bit_count(
        F.col("f2").bitwiseXOR(F.col("q2")))
    # Never broadcast: Spark sizes a side as before its explode, a 28th of its rows.
    return (ask.hint("merge").join(all_, ["tab", "key"]).withColumn("distance", differ)
            .where((F.col("distance") > 0) & (F.col("distance") <= radius))
            .select("q1", "q2", "f1", "f2", "distance").distinct())


def shown(a: str, b: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprints(read_table(spark, sf_dir, "documents"))
    queries = prints.where(F.col("doc_id") % QUERY_STEP == 0)
    counts = near_fingerprints(prints, queries).groupBy(
        F.col("q1").alias("f1"), F.col("q2").alias("f2")).agg(F.count("*").alias("n"))
    asked = queries.select("f1", "f2").distinct().join(counts, ["f1", "f2"], "left").select(
        "f1", "f2", F.coalesce("n", F.lit(0)).alias("n"))
    return (prints.join(asked, ["f1", "f2"], "left")
            .select("doc_id", "n_chars", "edited_sha256", shown("f1", "f2").alias("fingerprint"),
                    shown("e1", "e2").alias("edited_fingerprint"), "near_edited", "near_next",
                    F.when(F.col("doc_id") % QUERY_STEP == 0, F.col("n")).alias("n_near")))
