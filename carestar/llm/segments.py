"""Operator 13: hard negatives by segment summary filtering.

Vectors are whole numbers (floor(SCALE * x)).  For an anchor, its positives
are the best rows of its label; for each positive with score p the hard
negatives are the best rows of other labels whose score lies between LOW and
HIGH percent of p.

Every row stores, for each of SEGMENTS stretches of its components, their
mean and deviation.  Over a stretch of n components the product of two
vectors is n * mean * mean give or take n * deviation * deviation (Cauchy and
Schwarz), so sums over the stretches bound a score from both sides; wider
stretches follow from the stored ones, finer ones are cut from the vector.

1. Thresholds: the best scores among at most SAMPLE rows (by the hash of the
   id, within HELD_BYTES) are a floor for what an anchor keeps; they only
   spare work.
2. Positives: groups of anchors of a label meet chunks of the label's rows.
   Numbers of groups and chunks come from the label's counts, in a table.
3. Negatives: anchors are dealt to cells by the signs of their stretch means.
   A cell's summary (range of every mean, greatest deviations, scores still
   asked for) bounds its scores with a row; rows out of these bounds for
   all cells of a group never travel to it.  Tasks hold a group of anchors
   and read a chunk of rows: bounds of 1, 2, .. SEGMENTS stretches, then of
   halves of them, against the best scores so far; exact scores of the rest.
   Where most pairs pass, the whole block is scored at once.
4. The best of the chunks are ranked at the end.

No pair is dropped but by a bound; vectors without structure have bounds
that let most pairs pass, and the work is then that of scoring them all.

Rows with a null id, label or vector, an empty vector or a null or non-finite
component (2**500 or more after scaling included) take no part.  Vectors meet
vectors of their own length only.  An id that repeats counts once, with its
smallest vector.  A score beyond a long is the nearest long, and is ranked
and bounded as that.  Anchors without other rows of their label return
nothing.  Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.llm import vectors as vec
from carestar.llm.common import checkpoint, pick, read_table

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90   # percent of the positive's score
SEGMENTS = 8         # stretches stored
SAMPLE = 2048
BLOCK = 256          # anchors bounded together
DENSE = 0.2          # share of pairs above which the whole block is scored
ROUNDING = 1e-9      # of bounds, in units of the product of the norms

ROW = "vec_id bigint, label bigint, dim int, v array<double>, means array<double>, deviations array<double>"
FOUND = "anchor_id bigint, slot int, vec_id bigint, score bigint"


def edges(dim: int, parts: int) -> np.ndarray:
    """Where ``parts`` stretches of ``dim`` components begin and end; those
    of twice as many parts halve them."""
    return np.arange(parts + 1) * dim // parts


def summary(x: np.ndarray, parts: int):
    """Means and deviations of every stretch, weighted so that their plain
    products bound the score (times the root of the stretch's length)."""
    e = edges(x.shape[1], parts)
    means, deviations = np.zeros((2, len(x), parts))
    for s in range(parts):
        n = e[s + 1] - e[s]
        if n:
            own = x[:, e[s]:e[s + 1]]
            mean = own.mean(1)
            means[:, s] = mean * np.sqrt(n)
            deviations[:, s] = np.sqrt(((own - mean[:, None]) ** 2).sum(1))
    return means, deviations


def wider(means: np.ndarray, deviations: np.ndarray, dim: int):
    """The summary of half as many stretches."""
    parts = means.shape[1]
    size = np.diff(edges(dim, parts)).astype(np.float64)
    pair = size[0::2] + size[1::2]
    root = np.sqrt(size)
    total = means * root  # sums of the components
    mean = np.divide(total[:, 0::2] + total[:, 1::2], pair, out=np.zeros((len(means), parts // 2)),
                     where=pair > 0)
    square = (means ** 2 + deviations ** 2)
    inside = square[:, 0::2] + square[:, 1::2] - pair * mean ** 2
    return mean * np.sqrt(pair), np.sqrt(np.maximum(0.0, inside))


def levels(means: np.ndarray, deviations: np.ndarray, dim: int):
    """Summaries from one stretch to those given."""
    out = [(means, deviations)]
    while out[0][0].shape[1] > 1:
        out.insert(0, wider(*out[0], dim))
    return out


def percent(p: np.ndarray, share: int, up: bool) -> np.ndarray:
    """share * p / 100 rounded down or up, within a long for share <= 100."""
    whole, rest = p // 100, p % 100
    return whole * share + (-((-rest * share) // 100) if up else rest * share // 100)


class Scores:
    """Anchors of a group; their rows so far per slot.

    A slot keeps the ``k`` best rows with a score between ``low`` and
    ``high``; rows of the anchor's label where ``same``, else of others."""

    def __init__(self, ids, labels, v, means, deviations, low, high, k: int, same: bool):
        self.ids, self.labels, self.v, self.same = ids, labels, v, same
        self.dim = v.shape[1]
        self.levels = levels(means, deviations, self.dim)
        self.fine = summary(v, 2 * means.shape[1])
        self.norm = np.sqrt((v * v).sum(1))
        self.high = high
        self.slots = [vec.Best(len(ids), k, low[:, s].copy()) for s in range(low.shape[1])]

    def see(self, ids, labels, v, means, deviations) -> None:
        norm = np.sqrt((v * v).sum(1))
        stored = levels(means, deviations, self.dim)
        fine = None
        for lo in range(0, len(self.ids), BLOCK):
            at = np.arange(lo, min(lo + BLOCK, len(self.ids)))
            alike = self.labels[at][:, None] == labels[None, :]
            ok = (alike == self.same) & (self.ids[at][:, None] != ids[None, :])
            # A score matters above the least of the slots, below the highest.
            least = np.stack([np.where(b.floor[at] > self.high[at, s], np.iinfo(np.int64).max,
                                       b.least()[at]) for s, b in enumerate(self.slots)], 1).min(1)
            most = self.high[at].max(1)
            spare = ROUNDING * (1.0 + self.norm[at][:, None] * norm[None, :])
            # The ends of a long stand for all scores beyond them.
            floor = np.where(least == vec.NONE, -np.inf, least)[:, None] - spare
            roof = np.where(most == np.iinfo(np.int64).max, np.inf, most)[:, None] + spare
            for (ma, da), (mb, db) in zip(self.levels, stored):
                self._bound(ok, ma[at], da[at], mb, db, floor, roof)
                if not ok.any():
                    break
            share = ok.mean()
            if share == 0.0:
                continue
            if share <= DENSE:
                fine = fine or summary(v, 2 * means.shape[1])
                r, c = np.nonzero(ok)
                base = np.einsum("ij,ij->i", self.fine[0][at[r]], fine[0][c])
                room = np.einsum("ij,ij->i", self.fine[1][at[r]], fine[1][c])
                keep = (base + room >= floor[r, c]) & (base - room <= roof[r, c])
                ok[r[~keep], c[~keep]] = False
                cols = np.flatnonzero(ok.any(0))
            else:
                cols = np.arange(len(ids))
            if not len(cols):
                continue
            s = vec.scores(self.v[at], v[cols])
            for k, best in enumerate(self.slots):
                best.add(at, s, ids[cols], ok[:, cols] & (s <= self.high[at, k][:, None]))

    @staticmethod
    def _bound(ok, ma, da, mb, db, floor, roof) -> None:
        base, room = ma @ mb.T, da @ db.T
        ok &= base + room >= floor
        ok &= base - room <= roof

    def found(self):
        """(index of the anchor, slot, row, score)."""
        parts = [(r, np.full(len(r), k), i, s) for k, b in enumerate(self.slots)
                 for r, i, s in [b.found()]]
        return tuple(np.concatenate(c) for c in zip(*parts))


def _columns(b):
    return (b.column("vec_id").to_numpy(zero_copy_only=False) if isinstance(b, pa.RecordBatch)
            else b.column("vec_id").to_numpy(),
            b.column("label").to_numpy(zero_copy_only=False) if isinstance(b, pa.RecordBatch)
            else b.column("label").to_numpy(),
            vec.matrix(b.column("v")), vec.matrix(b.column("means")), vec.matrix(b.column("deviations")))


class Group:
    """``Scores`` fed with Arrow batches (see ``vectors.meet``)."""

    def __init__(self, anchors, k: int, same: bool):
        low, high = vec.matrix(anchors.column("low")), vec.matrix(anchors.column("high"))
        self.scores = Scores(*_columns(anchors), low, high, k, same)

    def see(self, rows) -> None:
        self.scores.see(*_columns(rows))

    def result(self) -> pa.RecordBatch:
        at, slot, ids, score = self.scores.found()
        return pa.RecordBatch.from_arrays(
            [pa.array(self.scores.ids[at]), pa.array(slot.astype(np.int32)), pa.array(ids),
             pa.array(score)], names=["anchor_id", "slot", "vec_id", "score"])


def summarised(rows: DataFrame) -> DataFrame:
    """Rows with the mean and deviation of each of SEGMENTS stretches."""
    def add(batches):
        for b in batches:
            means, deviations = summary(vec.matrix(b.column("v")), SEGMENTS)
            at = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * SEGMENTS)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("vec_id", "label", "dim", "v")],
                 pa.ListArray.from_arrays(at, pa.array(means.ravel())),
                 pa.ListArray.from_arrays(at, pa.array(deviations.ravel()))],
                names=["vec_id", "label", "dim", "v", "means", "deviations"])

    return rows.mapInArrow(add, ROW)


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   scale: int = vec.SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score for the rows of ``vectors`` (vec_id, label, embedding)
    where ``anchors`` (a condition on vec_id) holds."""
    spark = vectors.sparkSession
    named = pick(vectors, vec_id="bigint", label="bigint", embedding="array<double>")
    rows = vec.one_per_id(vec.whole_vectors(named.where(F.col("label").isNotNull()), scale))
    mined = None
    for dim in vec.dimensions(rows):
        own = summarised(rows.where(F.col("dim") == dim).drop("norm"))
        asked = _with_positives(own, own.where(anchors), dim, positives)
        found = _negatives(own, asked, dim, negatives, low, high)
        mined = found if mined is None else mined.unionByName(found)
    if mined is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, "
                                         "negative_id bigint, positive_score bigint, "
                                         "negative_score bigint")
    ranked = vec.best_rows(mined, ["anchor_id", "slot"], negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                         "positive_score", F.col("score").alias("negative_score"))


def _sample(rows: DataFrame, dim: int):
    """A broadcast of at most SAMPLE rows, drawn by the hash of the id."""
    n = rows.count()
    most = max(1, min(SAMPLE, vec.HELD_BYTES // (8 * dim)))
    share = min(1 << 30, -(-(2 * most << 30) // max(1, n)))
    h = F.xxhash64("vec_id", F.lit(5))
    drawn = (rows.where(F.pmod(h, F.lit(1 << 30)) < share).orderBy(h, "vec_id").limit(most)
             .toArrow())
    return n, rows.sparkSession.sparkContext.broadcast(_columns(drawn))


def _with_floor(anchors: DataFrame, sample, k: int, same: bool, bounds) -> DataFrame:
    """Anchors with ``low`` raised to their k-th best score in the sample and
    ``high``, per slot; ``bounds(batch)`` gives both for a batch."""
    extra = [c for c in anchors.columns if c not in ("vec_id", "label", "dim", "v", "means",
                                                     "deviations")]
    kinds = dict(anchors.dtypes)
    schema = ROW + "".join(f", {c} {kinds[c]}" for c in extra) + \
        ", low array<bigint>, high array<bigint>"

    def run(batches):
        for b in batches:
            low, high = bounds(b)
            s = Scores(*_columns(b), low, high, k, same)
            if len(sample.value[0]):
                s.see(*sample.value)
            raised = np.stack([np.maximum(low[:, i], slot.least())
                               for i, slot in enumerate(s.slots)], 1)
            at = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * low.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.ListArray.from_arrays(at, pa.array(raised.ravel())),
                 pa.ListArray.from_arrays(at, pa.array(high.ravel()))],
                names=[*b.schema.names, "low", "high"])

    return anchors.mapInArrow(run, schema)


def _no_bounds() -> list[Column]:
    return [F.lit(None).cast("array<bigint>").alias(c) for c in ("low", "high")]


_SHIPPED = ["vec_id", "label", "v", "means", "deviations", "low", "high"]


def _with_positives(rows: DataFrame, anchors: DataFrame, dim: int, k: int) -> DataFrame:
    """Anchors with the ids and scores of their best rows of the same label,
    best first (anchors without any are left out)."""
    _, sample = _sample(rows, dim)

    def all_scores(b):
        return (np.full((b.num_rows, 1), vec.NONE),
                np.full((b.num_rows, 1), np.iinfo(np.int64).max))

    asked = _with_floor(anchors, sample, k, True, all_scores)
    room = vec.group_size(dim)
    counts = rows.groupBy("label").agg(F.count("*").alias("n")).join(
        anchors.groupBy("label").agg(F.count("*").alias("asking")), "label").select(
        "label", F.ceil(F.col("asking") / room).cast("int").alias("parts"),
        F.least(F.lit(vec.MAX_CHUNKS), F.ceil(F.col("n") / vec.CHUNK)).cast("int").alias("chunks"))
    counts = checkpoint(counts)
    units = counts.agg(F.sum(F.col("parts").cast("bigint") * F.col("chunks"))).first()[0] or 1
    # A label with a third of all rows: AQE broadcasts the counts or splits the label.
    dealt = (rows.join(counts, "label")
             .select(F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                     vec.cut_by_id(F.col("chunks")).alias("chunk"), *_SHIPPED[:5], *_no_bounds()))
    grouped = (asked.join(counts, "label")
               .select(vec.cut_by_id(F.col("parts")).alias("part"),
                       F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                       *_SHIPPED))
    keyed = [df.withColumn("key", F.col("label")) for df in (grouped, dealt)]
    found = vec.meet(*keyed, ["key", "part", "chunk"], units, lambda a: Group(a, k, True), FOUND)
    best = (vec.best_rows(found, ["anchor_id"], k).groupBy("anchor_id")
            .agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best"))
            .select(F.col("anchor_id").alias("vec_id"), F.col("best.vec_id").alias("positive_ids"),
                    F.col("best.score").alias("positive_scores")))
    return checkpoint(anchors.join(best, "vec_id"))


def _negatives(rows: DataFrame, asked: DataFrame, dim: int, k: int, low: int, high: int) -> DataFrame:
    """anchor_id, slot, vec_id, score, positive_id, positive_score."""
    spark = rows.sparkSession
    n, sample = _sample(rows, dim)
    slots = asked.agg(F.max(F.size("positive_ids"))).first()[0] or 1

    def windows(b):
        lists = b.column("positive_scores")
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        p = np.zeros((b.num_rows, slots), np.int64)
        on = np.arange(slots)[None, :] < size[:, None]
        p[on] = lists.flatten().to_numpy(zero_copy_only=False)
        # An empty window (no positive, or a score below zero) asks for nothing.
        lo, hi = percent(p, low, True), percent(p, high, False)
        none = ~on | (lo > hi)
        return np.where(none, np.iinfo(np.int64).max, lo), np.where(none, vec.NONE, hi)

    bounded = checkpoint(_with_floor(asked, sample, k, False, windows)
                         .where(F.exists(F.arrays_zip("low", "high"), lambda w: w["low"] <= w["high"])))
    # Cells: signs of the stretch means.
    sign = sum((F.when(F.col("means")[i] > 0, 1 << i).otherwise(0) for i in range(SEGMENTS)), F.lit(0))
    celled = bounded.withColumn("cell", sign.cast("int"))
    real = F.filter(F.arrays_zip("low", "high"), lambda w: w["low"] <= w["high"])
    per_cell = celled.groupBy("cell").agg(
        F.count("*").alias("n"), F.min(F.array_min(real["low"])).alias("low"),
        F.max(F.array_max(real["high"])).alias("high"),
        *[f(F.col(c)[i]).alias(f"{name}{i}") for i in range(SEGMENTS)
          for f, c, name in ((F.min, "means", "a"), (F.max, "means", "b"), (F.max, "deviations", "d"))]
    ).collect()  # 2 ** SEGMENTS rows at most
    wanted = asked.select(F.col("vec_id").alias("anchor_id"), F.posexplode(
        F.arrays_zip("positive_ids", "positive_scores")).alias("slot", "p")).select(
        "anchor_id", "slot", F.col("p.positive_ids").alias("positive_id"),
        F.col("p.positive_scores").alias("positive_score"))
    if not per_cell:
        return spark.createDataFrame([], FOUND).join(wanted, ["anchor_id", "slot"])
    first, cuts, groups = vec.groups_of({r["cell"]: r["n"] for r in per_cell}, vec.group_size(dim))
    by_cell = {r["cell"]: r for r in per_cell}
    order = sorted(first, key=lambda c: (first[c], c))

    def table(name):
        return np.array([[by_cell[c][f"{name}{i}"] for i in range(SEGMENTS)] for c in order])

    plan = spark.sparkContext.broadcast(
        (table("a"), table("b"), table("d"), np.array([by_cell[c]["low"] for c in order], np.float64),
         np.array([by_cell[c]["high"] for c in order], np.float64),
         np.array([first[c] for c in order]), np.array([cuts[c] for c in order])))

    def needed(batches):
        a, b, d, least, most, begin, cut = plan.value
        size = np.maximum(np.abs(a), np.abs(b))
        for batch in batches:
            mean, dev = vec.matrix(batch.column("means")), vec.matrix(batch.column("deviations"))
            up, down = np.maximum(mean, 0.0), np.minimum(mean, 0.0)
            room = dev @ d.T
            spare = ROUNDING * (1.0 + np.abs(mean) @ size.T + room)
            need = (up @ b.T + down @ a.T + room + spare >= least) & \
                (up @ a.T + down @ b.T - room - spare <= most)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in _SHIPPED[:5]], vec.groups_needed(need, begin, cut)],
                names=[*_SHIPPED[:5], "groups"])

    chunks = vec.chunks_for(n)
    dealt = (rows.mapInArrow(needed, "vec_id bigint, label bigint, v array<double>, "
                                     "means array<double>, deviations array<double>, "
                                     "groups array<int>")
             .select(F.explode("groups").alias("part"), vec.cut_by_id(chunks).alias("chunk"),
                     *_SHIPPED[:5], *_no_bounds()))
    where = spark.createDataFrame([(int(c), int(first[c]), int(cuts[c])) for c in order],
                                  "cell int, first int, cuts int")
    grouped = (celled.join(F.broadcast(where), "cell")  # 2 ** SEGMENTS rows at most
               .select((F.col("first") + vec.cut_by_id(F.col("cuts"))).cast("int").alias("part"),
                       F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), *_SHIPPED))
    found = vec.meet(grouped, dealt, ["part", "chunk"], groups * chunks,
                     lambda q: Group(q, k, False), FOUND)
    return found.join(wanted, ["anchor_id", "slot"])


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    moved = table.select("vec_id", label.alias("label"), "embedding")
    return hard_negatives(moved, F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), rows AS (
  SELECT vec_id, min({'v': v, 'label': label}) AS r FROM whole GROUP BY vec_id
), pairs AS (
  SELECT a.vec_id AS anchor_id, o.vec_id, a.r.label = o.r.label AS same,
         CAST(list_inner_product(a.r.v, o.r.v) AS BIGINT) AS score
  FROM rows a JOIN rows o ON len(a.r.v) = len(o.r.v) AND a.vec_id <> o.vec_id
  WHERE a.vec_id % 100 = 0
), alike AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM pairs WHERE same
), mined AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score,
         n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id
                            ORDER BY n.score DESC, n.vec_id) AS rank
  FROM alike p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score
  WHERE p.place <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM mined WHERE rank <= 10
"""
