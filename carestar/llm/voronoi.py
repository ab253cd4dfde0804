"""Operator 12: exact top-k search by a Voronoi kNN join.

For every query the k rows with the greatest inner product of whole-number
components (floor(SCALE * x)), ties to the smaller id, without the query's
own row.  The greatest inner product is the smallest distance once a row
gets one more component, sqrt(M^2 - |x|^2) with M the greatest norm, and a
query a zero; cells and bounds live in that space, scores are exact integers.

1. Pivots (at most PIVOTS, within PIVOT_BYTES; drawn by the hash of the id)
   split rows and queries into Voronoi cells.
2. The summary of a cell holds its k + 1 rows nearest to the pivot.  All
   summaries together (of that proven size) are broadcast; a query's k-th
   best score among them bounds the distance of its k nearest rows.
3. A cell's queries have a radius U (distance to the pivot) and a greatest
   bound T.  A row at distance d from the cell's pivot is needed there only
   if d <= U + T; it is replicated to the groups of queries whose cells need
   it and to no other.
4. Groups of queries meet chunks of their rows, each task keeping k rows a
   query and dropping scores below the query's bound; the best of the
   chunks are ranked at the end.

On vectors without structure the bounds let every row pass to every group:
the work is then that of comparing all rows with all queries, which no exact
method avoids, spread over groups x chunks tasks.

Null ids, null or empty vectors and vectors with null or non-finite
components take no part (a component of 2**500 or more after scaling counts
as non-finite).  Vectors meet vectors of their own length only.  An id that
repeats counts once, with its smallest vector.  A score beyond a long is the
nearest long and ranked as that.  Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.llm import vectors as vec
from carestar.llm.common import checkpoint, read_table

K = 5
PIVOTS = 512
PIVOT_BYTES = 32 << 20  # of pivots and summaries
ROWS_PER_PIVOT = 32
SLACK = 1e-6            # rounding of distances in units of the greatest norm
BLOCK = 512             # queries scored together

FOUND = "query_id bigint, vec_id bigint, score bigint"


class Space:
    """Pivots in the space where the best score is the smallest distance."""

    def __init__(self, pivots: np.ndarray, norms: np.ndarray, top: float):
        self.top = top  # greatest norm of the rows
        self.pivots = self._place(pivots, norms)

    def _place(self, x: np.ndarray, norm: np.ndarray) -> np.ndarray:
        share = np.minimum(1.0, norm / self.top) if self.top else np.zeros(len(x))
        up = np.sqrt((1.0 - share) * (1.0 + share))
        return np.concatenate([x / (self.top or 1.0), up[:, None]], 1)

    def rows(self, x: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Distances of rows to the pivots (columns)."""
        return self._distances(self._place(x, norm))

    def queries(self, x: np.ndarray) -> np.ndarray:
        return self._distances(np.concatenate([x / (self.top or 1.0), np.zeros((len(x), 1))], 1))

    def _distances(self, p: np.ndarray) -> np.ndarray:
        square = (p * p).sum(1)[:, None] + (self.pivots ** 2).sum(1)[None, :] - 2.0 * p @ self.pivots.T
        return np.sqrt(np.maximum(0.0, square))

    def reach(self, norm: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Distance within which rows of at least ``score`` lie."""
        q = norm / (self.top or 1.0)
        s = score.astype(np.float64) / (self.top or 1.0) / (self.top or 1.0)
        far = q * q + 1.0 - 2.0 * s
        return np.where(score == vec.NONE, np.inf,
                        np.sqrt(np.maximum(0.0, far + SLACK * SLACK)) + SLACK * (1.0 + q))


class Nearest:
    """A group's queries and their best rows so far."""

    def __init__(self, queries: pa.Table, k: int):
        self.ids = queries.column("vec_id").to_numpy()
        self.v = vec.matrix(queries.column("v"))
        self.best = vec.Best(len(self.ids), k, queries.column("floor").to_numpy())

    def see(self, rows: pa.RecordBatch) -> None:
        ids, v = rows.column("vec_id").to_numpy(), vec.matrix(rows.column("v"))
        for lo in range(0, len(self.ids), BLOCK):
            at = np.arange(lo, min(lo + BLOCK, len(self.ids)))
            self.best.add(at, vec.scores(self.v[at], v), ids, self.ids[at][:, None] != ids[None, :])

    def result(self) -> pa.RecordBatch:
        row, ids, score = self.best.found()
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[row]), pa.array(ids), pa.array(score)],
            names=["query_id", "vec_id", "score"])


def _pivots(rows: DataFrame, n: int, dim: int, k: int) -> pa.Table:
    """Distinct vectors drawn by the hash of the id, about as many as asked."""
    most = max(1, min(PIVOTS, PIVOT_BYTES // (8 * dim * (k + 2)), n // ROWS_PER_PIVOT))
    share = min(1 << 30, -(-(2 * most << 30) // n))
    drawn = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < share)
    return drawn.select("v", "norm").distinct().orderBy(F.xxhash64("v"), "v").limit(most).toArrow()


def voronoi_join(queries: DataFrame, data: DataFrame, k: int = K,
                 scale: int = vec.SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of ``data``
    for every row of ``queries`` (both vec_id, embedding); a row with the
    query's id is its own and left out."""
    spark = data.sparkSession
    rows = vec.one_per_id(vec.whole_vectors(data, scale))
    asks = vec.one_per_id(vec.whole_vectors(queries, scale))
    out = spark.createDataFrame([], FOUND)
    for dim in vec.dimensions(asks):
        found = _join(asks.where(F.col("dim") == dim), rows.where(F.col("dim") == dim), dim, k)
        out = out if found is None else out.union(found)
    return vec.best_rows(out, ["query_id"], k).select("query_id", "rank", "vec_id", "score")


def _join(asks: DataFrame, rows: DataFrame, dim: int, k: int) -> DataFrame | None:
    spark = rows.sparkSession
    size = rows.agg(F.count("*").alias("n"), F.max("norm").alias("top")).first()
    if not size["n"]:
        return None
    drawn = _pivots(rows, size["n"], dim, k)
    if drawn.num_rows:
        space = Space(vec.matrix(drawn.column("v")), drawn.column("norm").to_numpy(), size["top"])
    else:
        space = Space(np.zeros((1, dim)), np.zeros(1), size["top"])
    shared = spark.sparkContext.broadcast(space)

    def cells(batches):
        for b in batches:
            d = shared.value.rows(vec.matrix(b.column("v")), b.column("norm").to_numpy())
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("v"), pa.array(near.astype(np.int32)),
                 pa.array(d[np.arange(len(near)), near])], names=["vec_id", "v", "cell", "d"])

    placed = rows.mapInArrow(cells, "vec_id bigint, v array<double>, cell int, d double")
    nearest = placed.withColumn("score", -F.col("d"))
    summary = vec.best_rows(nearest, ["cell"], k + 1).select("vec_id", "v").toArrow()
    known = spark.sparkContext.broadcast(
        (summary.column("vec_id").to_numpy(), vec.matrix(summary.column("v"))))

    def bounds(batches):
        ids, v = known.value
        for b in batches:
            own, q = b.column("vec_id").to_numpy(), vec.matrix(b.column("v"))
            best = vec.Best(len(own), k)
            for lo in range(0, len(own), BLOCK):
                at = np.arange(lo, min(lo + BLOCK, len(own)))
                best.add(at, vec.scores(q[at], v), ids, own[at][:, None] != ids[None, :])
            d = shared.value.queries(q)
            near = d.argmin(1)
            floor = best.least()
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("v"), pa.array(floor), pa.array(near.astype(np.int32)),
                 pa.array(d[np.arange(len(near)), near]),
                 pa.array(shared.value.reach(b.column("norm").to_numpy(), floor))],
                names=["vec_id", "v", "floor", "cell", "d", "reach"])

    asked = checkpoint(asks.mapInArrow(bounds, "vec_id bigint, v array<double>, floor bigint, "
                                               "cell int, d double, reach double"))
    per_cell = asked.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("d").alias("u"), F.max("reach").alias("t")).collect()
    if not per_cell:
        return None
    first, cuts, groups = vec.groups_of({r["cell"]: r["n"] for r in per_cell}, vec.group_size(dim))
    order = sorted(first, key=lambda c: (first[c], c))
    at = np.array(order)
    limit = {r["cell"]: r["u"] + r["t"] + SLACK for r in per_cell}
    plan = spark.sparkContext.broadcast(
        (at, np.array([limit[c] for c in order]), np.array([first[c] for c in order]),
         np.array([cuts[c] for c in order])))

    def needed(batches):
        cell, most, begin, cut = plan.value
        for b in batches:
            d = shared.value.rows(vec.matrix(b.column("v")), b.column("norm").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("v"),
                 vec.groups_needed(d[:, cell] <= most[None, :], begin, cut)],
                names=["vec_id", "v", "groups"])

    chunks = vec.chunks_for(size["n"])
    dealt = (rows.mapInArrow(needed, "vec_id bigint, v array<double>, groups array<int>")
             .select(F.explode("groups").alias("part"), vec.cut_by_id(chunks).alias("chunk"),
                     "vec_id", "v", F.lit(vec.NONE).alias("floor")))
    where = spark.createDataFrame([(int(c), int(first[c]), int(cuts[c])) for c in order],
                                  "cell int, first int, cuts int")
    grouped = (asked.join(F.broadcast(where), "cell")  # a row per cell, PIVOTS at most
               .select((F.col("first") + vec.cut_by_id(F.col("cuts"))).cast("int").alias("part"),
                       F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
                       "vec_id", "v", "floor"))
    return vec.meet(grouped, dealt, ["part", "chunk"], groups * chunks,
                    lambda q: Nearest(q, k), FOUND)


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    return voronoi_join(table.where(F.col("vec_id") % 50 == 0), table)


ORACLE_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), rows AS (
  SELECT vec_id, min(v) AS v FROM whole GROUP BY vec_id
), pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         CAST(list_inner_product(q.v, r.v) AS BIGINT) AS score
  FROM rows q JOIN rows r ON len(q.v) = len(r.v) AND q.vec_id <> r.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
