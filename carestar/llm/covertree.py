"""Operator 7: embedding near-dedup by dual traversal of cover trees.

Vectors are compared by cosine in double precision; on the unit sphere
cosine >= THRESHOLD is a distance of at most sqrt(2 - 2 * THRESHOLD).
Vectors that are null, empty, zero or hold null or non-finite components
link with nothing, and vectors of different lengths do not link.

Equal vectors meet once, with their number.  A top tree over at most PIVOTS
vectors (lowest hash of the vector) has nested levels with halving radii;
every vector descends to its nearest pivot, the pivot's subtree order deals
the vectors into blocks of about BLOCK rows (a pivot with more rows is cut
by hash), and a block keeps its pivots with their covering radii.  Pairs of
blocks survive if some pair of their pivots is within the radius bounds.

In a surviving pair of blocks both sides grow local cover trees and are
traversed together: a pair of nodes goes when the distance of its centres
exceeds both covering radii plus the link distance, else its children are
paired.  Where nothing can be pruned (most node pairs of a level survive)
the rows below are compared at once; every comparison that decides is the
cosine itself.  A pair of blocks returns per vector its number of links and
one edge to the smallest vector it is connected to there, never the pairs.

Null ids: component null, kept false, no links.  Rows that repeat an id with
another vector are one vertex whose links add up.  Empty table: no rows.

Components of any finite size count: a vector is scaled by its largest
component before it is squared.

The work is quadratic in blocks that the bounds cannot separate, which is
inherent in exact thresholds on vectors without structure.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.llm.common import checkpoint, components, pick, read_table

THRESHOLD = 0.9
PIVOTS = 512
BLOCK = 3000
LEAF = 64        # rows a local tree does not split further
DENSE = 0.25     # share of surviving node pairs above which rows are compared at once
SLACK = 1e-7     # rounding of distances (sqrt(2 - 2x) near 0 included), on the safe side


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)  # squares neither overflow nor vanish
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def net_levels(points: np.ndarray, levels: int = 5):
    """Nested nets: every point's centre per level, radii 2, 1, 1/2, ...;
    a centre of a level is a centre of all finer ones."""
    centres, owner = [], []
    current = np.zeros(0, np.int64)
    for level in range(levels):
        radius = 2.0 / 2 ** level
        chosen = current.tolist()
        near = distances(points, points[current]).min(1) if len(current) else \
            np.full(len(points), np.inf)
        for i in range(len(points)):
            if near[i] > radius:
                chosen.append(i)
                near = np.minimum(near, distances(points, points[i:i + 1])[:, 0])
        current = np.array(chosen, np.int64)
        centres.append(current)
        owner.append(current[distances(points, points[current]).argmin(1)])
    return centres, owner


class Node:
    """A ball over rows: centre, covering radius, children with about half
    the radius (none in a leaf)."""

    __slots__ = ("centre", "radius", "rows", "children")

    def __init__(self, points, rows, depth=0):
        self.rows = rows
        own = points[rows]
        mean = own.mean(0)
        self.centre = mean
        d = np.sqrt(np.maximum(0.0, ((own - mean) ** 2).sum(1)))
        self.radius = float(d.max()) if len(rows) else 0.0
        self.children = []
        if len(rows) > LEAF and self.radius > 1e-6 and depth < 24:
            target = self.radius / 2
            left, far = np.arange(len(rows)), d.copy()
            parts = []
            # Farthest-first centres until all rows are within half the radius.
            seeds = [int(far.argmax())]
            dist = np.sqrt(np.maximum(0.0, ((own - own[seeds[0]]) ** 2).sum(1)))
            label = np.zeros(len(rows), np.int64)
            while dist.max() > target and len(seeds) < 16:
                s = int(dist.argmax())
                new = np.sqrt(np.maximum(0.0, ((own - own[s]) ** 2).sum(1)))
                closer = new < dist
                label[closer], dist = len(seeds), np.minimum(dist, new)
                seeds.append(s)
            parts = [left[label == k] for k in range(len(seeds))]
            parts = [p for p in parts if len(p)]
            if len(parts) > 1:
                self.children = [Node(points, rows[p], depth + 1) for p in parts]


def dual_traversal(a: np.ndarray, b: np.ndarray, threshold: float, same: bool, visit):
    """Call ``visit(rows of a, rows of b)`` with sets of rows that hold
    every pair of cosine >= threshold; pairs of nodes too far apart go."""
    reach = np.sqrt(2.0 - 2.0 * threshold) + SLACK
    if not len(a) or not len(b):
        return
    root_a = Node(a, np.arange(len(a)))
    root_b = root_a if same else Node(b, np.arange(len(b)))
    level = [(root_a, root_b)]
    while level:
        pairs = []
        for x, y in level:
            xs, ys = x.children or [x], y.children or [y]
            if not x.children and not y.children:
                visit(x.rows, y.rows)
                continue
            pairs += [(p, q) for i, p in enumerate(xs) for j, q in enumerate(ys)
                      if not (x is y and j < i)]
        if not pairs:
            return
        gap = np.sqrt(np.maximum(0.0, ((np.stack([p.centre for p, _ in pairs])
                                        - np.stack([q.centre for _, q in pairs])) ** 2).sum(1)))
        bound = np.array([p.radius + q.radius for p, q in pairs]) + reach
        alive = [pq for pq, near in zip(pairs, gap <= bound) if near]
        work = sum(len(p.rows) * len(q.rows) for p, q in alive)
        every = sum(len(p.rows) * len(q.rows) for p, q in pairs)
        if len(pairs) > 64 and work > DENSE * every:  # the bounds do not bite here
            for p, q in alive:
                visit(p.rows, q.rows)
            return
        level = alive


def link_counts(a, b, ids_a, ids_b, times_a, times_b, threshold, same):
    """(links of each a row, of each b row, edges as (id, id) arrays)."""
    found_a, found_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    ids = np.concatenate([ids_a, ids_b])
    parent = np.arange(len(ids))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def visit(ra, rb):
        for k in range(0, len(ra), 1024):
            part = ra[k:k + 1024]
            i, j = np.nonzero(a[part] @ b[rb].T >= threshold)
            i, j = part[i], rb[j]
            if same:
                if ra is rb or np.array_equal(ra, rb):
                    keep = i < j
                    i, j = i[keep], j[keep]
                np.add.at(found_a, i, times_a[j])
                np.add.at(found_a, j, times_a[i])
            else:
                np.add.at(found_a, i, times_b[j])
                np.add.at(found_b, j, times_a[i])
            shift = 0 if same else len(a)
            # One edge a row and the row it joins: enough for components.
            for x, y in zip(i.tolist(), (j + shift).tolist()):
                rx, ry = find(x), find(y)
                if rx != ry:
                    if ids[rx] > ids[ry]:
                        rx, ry = ry, rx
                    parent[ry] = rx

    dual_traversal(a, b, threshold, same, visit)
    roots = np.array([find(x) for x in range(len(ids))], np.int64)
    on = np.flatnonzero(ids[roots] != ids)
    return found_a, found_b, ids[roots[on]], ids[on]


def _valid(embedding) -> F.Column:
    """Finite, non-empty and not zero."""
    whole = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x)
                     & (F.abs(x) < F.lit(float("inf"))))
    return (embedding.isNotNull() & (F.size(embedding) > 0) & F.coalesce(whole, F.lit(False))
            & F.coalesce(F.exists(embedding, lambda x: x != 0), F.lit(False)))


def near_links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``
    (vec_id, embedding).  Rows without an id: no links counted from or to
    them; component null and kept false."""
    spark = vectors.sparkSession
    v = pick(vectors, vec_id="bigint", embedding="array<double>")
    good = v.where(_valid(F.col("embedding")) & F.col("vec_id").isNotNull())
    reps = checkpoint(good.groupBy("embedding").agg(F.min("vec_id").alias("rep"),
                                                    F.count("*").alias("times"))
                      .select("rep", "times", "embedding", F.size("embedding").alias("dim"),
                              F.xxhash64("embedding").alias("h")))
    dims = [r["dim"] for r in reps.select("dim").distinct().collect()]
    counts, edges = None, None
    for dim in dims:
        c, e = _links_of(spark, reps.where(F.col("dim") == dim).drop("dim"), threshold)
        counts = c if counts is None else counts.union(c)
        edges = e if edges is None else edges.union(e)
    if counts is None:
        return v.select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                        F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    found = counts.groupBy("rep").agg(F.sum("n").alias("n"))
    comp = components(edges).withColumnRenamed("v", "rep")
    by_rep = (reps.join(found, "rep", "left").join(comp, "rep", "left")
              .select("embedding", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n"),
                      F.coalesce("component", "rep").alias("component")))
    ok = _valid(F.col("embedding")) & F.col("vec_id").isNotNull()
    keyed = v.withColumn("key", F.when(ok, F.col("embedding")))
    j = keyed.join(by_rep.withColumnRenamed("embedding", "key"), "key", "left")
    component = F.coalesce("component", "vec_id")
    return j.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"),
                    F.when(F.col("vec_id").isNotNull(), component).alias("component_id"),
                    F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _links_of(spark, reps: DataFrame, threshold: float):
    """(rep, n) partial link counts and (a, b) edges of one vector length."""
    sample = reps.orderBy("h", "rep").limit(PIVOTS).select("embedding").toArrow()
    pivots = unit(np.array(sample.column("embedding").to_pylist(), np.float64))
    centres, owner = net_levels(pivots)
    # Subtree order: pivots sorted by their centres from coarse to fine.
    order = np.lexsort([np.arange(len(pivots))] + owner[::-1])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    shared = spark.sparkContext.broadcast((pivots, place))

    def descend(batches):
        points, at = shared.value
        for b in batches:
            x = unit(b.column("embedding").flatten().to_numpy().reshape(b.num_rows, -1))
            d = distances(x, points)
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [b.column("rep"), b.column("times"), b.column("h"), b.column("embedding"),
                 pa.array(at[near].astype(np.int32)), pa.array(d[np.arange(len(near)), near])],
                names=["rep", "times", "h", "embedding", "cell", "d"])

    placed = checkpoint(reps.mapInArrow(
        descend, "rep bigint, times bigint, h bigint, embedding array<double>, cell int, d double"))
    cells = {r["cell"]: (r["n"], r["r"]) for r in placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("d").alias("r")).collect()}  # PIVOTS rows at most
    # Blocks: consecutive cells up to BLOCK rows; a larger cell is cut by hash.
    first, cuts, members, block, room = {}, {}, {}, -1, 0
    for cell in sorted(cells):
        n = cells[cell][0]
        if n > BLOCK:
            cuts[cell] = -(-n // BLOCK)
            first[cell] = block + 1
            for k in range(cuts[cell]):
                members[block + 1 + k] = [cell]
            block, room = block + cuts[cell], 0
        else:
            if n > room:
                block, room = block + 1, BLOCK
                members[block] = []
            first[cell], cuts[cell] = block, 1
            members[block].append(cell)
            room -= n
    at_place = pivots[order]
    reach = float(np.sqrt(2.0 - 2.0 * threshold)) + SLACK
    gap = distances(at_place, at_place)
    partners: dict[int, list[int]] = {b: [] for b in members}
    for x in members:
        rx = np.array([cells[c][1] for c in members[x]])
        for y in members:
            ry = np.array([cells[c][1] for c in members[y]])
            if (gap[np.ix_(members[x], members[y])] <= rx[:, None] + ry[None, :] + reach).any():
                partners[x].append(y)
    where = spark.createDataFrame(
        [(c, first[c], cuts[c]) for c in cells], "cell int, first int, cuts int")
    other = spark.createDataFrame([(x, y) for x, ys in partners.items() for y in ys],
                                  "block int, other int")
    dealt = (placed.join(F.broadcast(where), "cell")  # PIVOTS rows at most
             .withColumn("block", (F.col("first") + F.pmod("h", F.col("cuts"))).cast("int"))
             .join(other, "block")
             .select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "rep", "times", "embedding"))

    def compare(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block = table.column("block").to_numpy()
        flat = table.column("embedding").combine_chunks().flatten().to_numpy()
        x = unit(flat.reshape(table.num_rows, -1))
        ids, times = table.column("rep").to_numpy(), table.column("times").to_numpy()
        if i == j:
            na, _, lo, hi = link_counts(x, x, ids, ids, times, times, threshold, True)
            rows = np.flatnonzero(na)
            rep, n = ids[rows], na[rows]
        else:
            p, q = block == i, block == j
            na, nb, lo, hi = link_counts(x[p], x[q], ids[p], ids[q], times[p], times[q],
                                         threshold, False)
            rep, n = np.concatenate([ids[p], ids[q]]), np.concatenate([na, nb])
            rep, n = rep[n > 0], n[n > 0]
        k, m = len(rep), len(lo)
        return pa.table({"rep": pa.array(np.concatenate([rep, lo])),
                         "n": pa.array(np.concatenate([n, np.zeros(m, np.int64)])),
                         "b": pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(hi, pa.int64())])})

    out = checkpoint(dealt.groupBy("i", "j").applyInArrow(compare, "rep bigint, n bigint, b bigint"))
    return (out.where("b is null").select("rep", "n"),
            out.where("b is not null").select(F.col("rep").alias("a"), "b"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_links(read_table(spark, sf_dir, "embeddings"))
