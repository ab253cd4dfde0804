"""Helpers of the vector searches (operators 12 and 13): whole-number
components, exact scores, best rows of many queries, and the plan both
share: groups of queries meet chunks of rows.

A task holds one group of queries (GROUP at most) with its best rows so far
and reads a chunk of rows batch by batch, so its memory does not depend on
the number of rows.  Chunks are cut by the hash of the id and a group of
queries that is too large is cut by it as well, so equal vectors, one label
or one cell with a third of all rows spread like any others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestar.llm.common import checkpoint, pick

SCALE = 256
LARGEST = 2.0 ** 500   # components from here on count as not finite
GROUP = 4096           # queries held by one task
CHUNK = 16_384         # rows of a chunk, until there are MAX_CHUNKS
MAX_CHUNKS = 4096
MAX_PARTITIONS = 20_000
HELD_BYTES = 64 << 20  # of vectors held by one task, or broadcast
NONE = np.iinfo(np.int64).min

VECTOR = "vec_id bigint, label bigint, dim int, v array<double>, norm double"


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of rows of one length as a two-dimensional array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, dim, v (floor(scale * x) of every component x, as
    doubles) and the norm of v.  Rows without an id or a vector, with an
    empty vector or with a component that is null, not finite or not below
    LARGEST after scaling are left out."""
    def floors(batches):
        for b in batches:
            e = b.column("embedding")
            flat = e.flatten()
            sizes = pc.fill_null(pc.list_value_length(e), 0).to_numpy(zero_copy_only=False)
            x = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(scale * x) + 0.0
            ends = np.cumsum(sizes)
            bad = np.concatenate([[0], np.cumsum(~(np.abs(x) < LARGEST))])
            ok = (sizes > 0) & (bad[ends] == bad[ends - sizes]) & \
                b.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            x = x[np.repeat(ok, sizes)]
            sizes = sizes[ok].astype(np.int32)
            at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            sums = np.add.reduceat(x * x, at[:-1]) if len(sizes) else np.zeros(0)
            mask = pa.array(ok)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").filter(mask), b.column("label").filter(mask), pa.array(sizes),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(x)), pa.array(np.sqrt(sums))],
                names=["vec_id", "label", "dim", "v", "norm"])

    named = pick(vectors, vec_id="bigint", label="bigint", embedding="array<double>")
    return named.mapInArrow(floors, VECTOR)


def one_per_id(rows: DataFrame) -> DataFrame:
    """Rows as they are where no id repeats, else the smallest row of each
    id (by vector, then label)."""
    seen = rows.agg(F.count("*").alias("n"), F.count_distinct("vec_id").alias("ids")).first()
    if seen["n"] == seen["ids"]:
        return rows
    least = rows.groupBy("vec_id").agg(F.min(F.struct("v", "label", "dim", "norm")).alias("r"))
    return checkpoint(least.select("vec_id", "r.label", "r.dim", "r.v", "r.norm"))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, as int64; a score
    that does not fit is the nearest one that does."""
    limit = np.sqrt(2.0 ** 53 / a.shape[1])  # sums below 2**53 are exact in doubles
    wide_a, wide_b = np.abs(a).max(1) > limit, np.abs(b).max(1) > limit
    if not wide_a.any() and not wide_b.any():
        return (a @ b.T).astype(np.int64)
    out = (np.where(wide_a[:, None], 0.0, a) @ np.where(wide_b[:, None], 0.0, b).T).astype(np.int64)
    for on_a, on_b in ((wide_a, np.ones(len(b), bool)), (~wide_a, wide_b)):
        if on_a.any() and on_b.any():
            exact = _integers(a[on_a]) @ _integers(b[on_b]).T
            fit = np.minimum(np.maximum(exact, NONE), np.iinfo(np.int64).max)
            out[np.ix_(on_a, on_b)] = fit.astype(np.int64)
    return out


def _integers(x: np.ndarray) -> np.ndarray:
    out = np.empty(x.shape, object)
    out[:] = [[int(c) for c in row] for row in x]
    return out


class Best:
    """The k best (score, id) of each of n queries: higher scores first,
    then smaller ids."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.score = np.full((n, k), NONE)
        self.id = np.zeros((n, k), np.int64)
        self.have = np.zeros(n, np.int64)
        # Scores below these are known not to be among the k best.
        self.floor = np.full(n, NONE) if floor is None else floor

    def least(self) -> np.ndarray:
        """The score a row has to reach to matter."""
        return np.where(self.have == self.k, np.maximum(self.score[:, -1], self.floor), self.floor)

    def add(self, at: np.ndarray, s: np.ndarray, ids: np.ndarray, ok: np.ndarray) -> None:
        """Scores ``s`` of queries ``at`` and rows ``ids`` where ``ok``."""
        ok = ok & (s >= self.least()[at][:, None])
        many = np.flatnonzero(ok.sum(1) > 8 * self.k)
        if len(many):
            own = np.where(ok[many], s[many], NONE)
            kth = np.partition(own, own.shape[1] - self.k, axis=1)[:, own.shape[1] - self.k]
            ok[many] &= s[many] >= kth[:, None]
        row, col = np.nonzero(ok)
        if not len(row):
            return
        touched = np.unique(row)
        old = np.arange(self.k)[None, :] < self.have[at[touched]][:, None]
        o_row, o_col = np.nonzero(old)
        rows = np.concatenate([row, touched[o_row]])
        score = np.concatenate([s[row, col], self.score[at[touched]][o_row, o_col]])
        vec = np.concatenate([ids[col], self.id[at[touched]][o_row, o_col]])
        order = np.lexsort((vec, ~score, rows))  # ~x falls as x rises, without overflow
        rows, score, vec = rows[order], score[order], vec[order]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        place = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
        on = place < self.k
        self.score[at[rows[on]], place[on]] = score[on]
        self.id[at[rows[on]], place[on]] = vec[on]
        self.have[at[touched]] = np.bincount(rows[on], minlength=len(s))[touched]

    def found(self):
        """(query index, id, score) of all rows held that reach the floor."""
        on = (np.arange(self.k)[None, :] < self.have[:, None]) & (self.score >= self.floor[:, None])
        row, col = np.nonzero(on)
        return row, self.id[row, col], self.score[row, col]


def chunks_for(n: int) -> int:
    return int(min(MAX_CHUNKS, max(1, -(-n // CHUNK))))


def group_size(width: int) -> int:
    return max(1, min(GROUP, HELD_BYTES // (8 * max(1, width))))


def groups_of(counts: dict[int, int], room: int):
    """First group and number of groups of each cell: successive small cells
    share a group of ``room`` queries, a larger cell is cut."""
    first, cuts, at, left = {}, {}, -1, 0
    for cell in sorted(counts):
        n = counts[cell]
        if n > room:
            first[cell], cuts[cell] = at + 1, -(-n // room)
            at, left = at + cuts[cell], 0
            continue
        if n > left:
            at, left = at + 1, room
        first[cell], cuts[cell] = at, 1
        left -= n
    return first, cuts, at + 1


def groups_needed(need: np.ndarray, first: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Groups of every row as lists: ``need`` says which cells (columns, in
    the order of their groups) a row must meet."""
    edge = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
    need = np.logical_or.reduceat(need, edge, axis=1)
    row, col = np.nonzero(need)
    times = cuts[edge][col]
    group = np.repeat(first[edge][col], times) + np.arange(times.sum()) - np.repeat(
        np.cumsum(times) - times, times)
    per_row = np.bincount(row, weights=times, minlength=len(need)).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(group.astype(np.int32)))


def cut_by_id(n: Column | int) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(F.xxhash64("vec_id", F.lit(17)), n).cast("int")


def meet(queries: DataFrame, rows: DataFrame, keys: list[str], units: int, start, schema: str):
    """Queries and rows of equal ``keys`` (integers) meet in one task each.

    Both have the same columns.  ``start(batch)`` takes the queries of a key
    and returns an object whose ``see(batch)`` is called for the rows that
    follow and whose ``result()`` gives the output."""
    tagged = queries.withColumn("kind", F.lit(0)).unionByName(rows.withColumn("kind", F.lit(1)))
    order = [*keys, "kind"]
    width = int(max(1, min(4 * units, MAX_PARTITIONS)))

    def walk(batches):
        key, state, waiting = None, None, []
        for b in batches:
            if not b.num_rows:
                continue
            tags = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in order], 1)
            turn = np.flatnonzero((tags[1:] != tags[:-1]).any(1)) + 1
            for lo, hi in zip([0, *turn], [*turn, len(tags)]):
                own = tuple(tags[lo, :-1].tolist())
                if own != key:
                    if state is not None:
                        yield state.result()
                    key, state, waiting = own, None, []
                part = b.slice(int(lo), int(hi - lo))
                if tags[lo, -1] == 0:
                    waiting.append(part)
                    continue
                if waiting:  # all queries of the key are here
                    state = start(pa.Table.from_batches(waiting).combine_chunks())
                    waiting = []
                if state is not None:
                    state.see(part)
        if state is not None:
            yield state.result()

    return (tagged.repartition(width, *keys).sortWithinPartitions(*order)
            .mapInArrow(walk, schema))


def best_rows(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k best rows of each query with their rank from 1."""
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def dimensions(rows: DataFrame) -> list[int]:
    """The lengths of the vectors (few: they come from few models)."""
    return sorted(r["dim"] for r in rows.select("dim").distinct().collect())
