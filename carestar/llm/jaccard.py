"""Operator 8: n-gram Jaccard join by parity sketches.

Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a
document's set is its distinct 5-word shingles (fewer words: the whole
sequence as one; none: empty).  Two sets link at Jaccard >= 0.8.

Sets linked that way differ in at most d = (a + b) / 9 elements (sizes a,
b).  Every element is XOR-ed into one block of the set's sketch, so
sketches of linked sets differ in at most d blocks.  Sizes fall into bands
(powers of two) with a number of blocks of their own; a set joins its band
and, if a partner may be there, the next one.  Pigeonhole join: a set sends
its first d + 1 blocks that hold anything (d for its largest partner); of
two linked sets at least one such block is equal.  Sets with fewer such
blocks meet under one more key of their band: what a pair of them can miss
both have, because the blocks they agree in are then empty in both.

Sets, not documents, take part: equal texts meet once, under their set's
hash.  Verification in two rounds keeps large groups linear: first every
set against the smallest of each group of equal blocks; then sets of a group
that are in different components so far, unless the Hamming distance of
their bit sketches, a lower bound of the difference, rules them out.  Tasks
send only edges that connect such candidates; what they connect meets once
more with its shingles, is compared exactly, and sends edges that connect
what is linked.  Pairs are never written.  Groups are cut into chunk pairs,
so none meets in one task whole.

Links: a linked pair lies in one component, so every pair of sets of a
component is compared exactly, in chunk pairs of bounded size; the tasks
send each set's number of links, no pairs.  ``n_links`` of a document is the
number of other rows with an id whose set is linked or equal.
``linked_pairs`` gives the pairs themselves.

Null text: no words.  Rows without an id link with nothing; their component
is that of an equal set with an id, else null.  Rows that repeat an id with
another text take part with each text.  Without words: no links.  Empty
table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.llm.common import (WordHashes, bloom, checkpoint, components, gram_hashes, in_bloom,
                                 mix64, pick, read_table, slices, small_batches, stash, text_hash, unstash)

SHINGLE = 5
NUM, DEN = 4, 5                  # similarity 0.8 as a fraction
SKETCH_LOAD = 2                  # bits of a set's bit sketch per element, at least
CHUNK = 2048                     # members of a group compared at a time
CHUNK_SHINGLES = 1 << 19         # their shingles, about, when links are counted
MAX_HELD = 1_000_000             # rows of one block held to name its group
TOGETHER = 2 << 20               # bytes of text whose shingles are made together
BLOOM_WORDS = 1 << 17            # 64-bit words of the filter for round trips


def shingle_sets(texts: pa.Array):
    """Per text: sorted distinct 64-bit shingle hashes, as (values, starts)."""
    t = WordHashes(texts, lower=True)
    h = t.hash
    n_docs = len(texts)
    grams = gram_hashes(h, SHINGLE)
    counts = np.maximum(t.counts - SHINGLE + 1, 0)
    doc = np.repeat(np.arange(n_docs), counts)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    at = t.starts[:-1][doc] + np.arange(len(doc)) - first[doc]
    values = grams[at] if len(doc) else np.zeros(0, np.uint64)
    short = np.flatnonzero((t.counts > 0) & (t.counts < SHINGLE))
    if len(short):
        own = np.array([gram_hashes(h[t.starts[i]:t.starts[i + 1]], int(t.counts[i]))[0]
                        ^ np.uint64(t.counts[i]) for i in short], np.uint64)
        values, doc = np.concatenate([values, own]), np.concatenate([doc, short])
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    values, doc = values[new], doc[new]
    sizes = np.bincount(doc, minlength=n_docs)
    return values, np.concatenate([[0], np.cumsum(sizes)]), sizes


def set_ids(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hash of each set (order-free)."""
    if not len(values):
        return np.zeros(len(sizes), np.int64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(values), dtype=np.uint64)])
    own = total[starts[1:]] - total[starts[:-1]]
    return mix64(own ^ mix64(sizes.astype(np.uint64))).view(np.int64)


def largest_difference(size: int) -> int:
    """Most elements a set of this size and a linked one can differ in."""
    # J >= NUM/DEN  <=>  difference * (DEN + NUM) <= (a + b) * (DEN - NUM)
    return (size + size * DEN // NUM) * (DEN - NUM) // (DEN + NUM)


def block_count(band: int) -> int:
    """Blocks of the sketches of sizes 2**band .. 2**(band + 1) - 1."""
    return max(8, (3 * (2 << band) + 9) // 10)


def _block_keys(values, doc, n, band_of, seed_bits=np.uint64(0x5851F42D4C957F2D)):
    """Keys of the first d + 1 filled blocks of every set, for the band
    given per set.  Returns (key, doc)."""
    blocks = np.array([block_count(b) for b in range(64)], np.uint64)
    scattered = mix64(values ^ seed_bits)
    block = (scattered >> np.uint64(11)) % blocks[band_of[doc]]
    order = np.lexsort((block, doc))
    doc_s, block_s, val_s = doc[order], block[order], mix64(values[order])
    new = np.ones(len(doc_s), bool)
    new[1:] = (doc_s[1:] != doc_s[:-1]) | (block_s[1:] != block_s[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    parity = np.bitwise_xor.reduceat(val_s, at)
    d, b = doc_s[at], block_s[at]
    filled = np.bincount(d, minlength=len(n))
    first = np.concatenate([[0], np.cumsum(filled)])[:-1]
    need = np.array([largest_difference(int(s)) + 1 for s in n], np.int64)
    keep = (np.arange(len(d)) - first[d]) < need[d]
    key = mix64(parity ^ mix64(b + np.uint64(1000003) * (band_of[d].astype(np.uint64) + np.uint64(1))))
    short = np.flatnonzero((filled < need) & (n > 0))
    extra = mix64(np.uint64(0xD1B54A32D192ED03) + band_of[short].astype(np.uint64))
    return np.concatenate([key[keep], extra]), np.concatenate([d[keep], short])


def signatures(values, starts, sizes):
    """(key, index of the set) pairs under which linked sets must meet."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    band = np.zeros(len(sizes), np.int64)
    some = sizes > 0
    band[some] = np.floor(np.log2(sizes[some])).astype(np.int64)
    k1, d1 = _block_keys(values, doc, sizes, band)
    up = some & (sizes * DEN // NUM >= (np.int64(2) << band))
    on = up[doc]
    own = np.where(up, sizes, 0)
    k2, d2 = _block_keys(values[on], doc[on], own, band + 1)
    return np.concatenate([k1, k2]), np.concatenate([d1, d2])


def _i64(a: np.ndarray) -> pa.Array:
    return pa.array(a.astype(np.uint64).view(np.int64) if a.dtype != np.int64 else a)


def document_sets(docs: DataFrame) -> DataFrame:
    """doc_id, text_id, node (hash of the set), n_shingles; checkpointed."""
    d = pick(docs, doc_id="bigint", text="string").withColumn("text_id", text_hash(F.col("text")))

    def run(batches):
        for batch in batches:
            for b in slices(batch, size=TOGETHER):
                values, starts, sizes = shingle_sets(b.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("text_id"),
                     pa.array(set_ids(values, starts, sizes)), pa.array(sizes.astype(np.int64))],
                    names=["doc_id", "text_id", "node", "n_shingles"])

    return checkpoint(d.mapInArrow(run, "doc_id bigint, text_id bigint, node bigint, "
                                   "n_shingles bigint"))


def block_members(docs: DataFrame) -> DataFrame:
    """(key, node): the pigeonhole rows of every set (a task sends a set
    that repeats in it once)."""
    d = pick(docs, text="string").where(F.col("text").isNotNull())

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for b in slices(batch, size=TOGETHER):
                values, starts, sizes = shingle_sets(b.column("text"))
                nodes = set_ids(values, starts, sizes)
                fresh = np.zeros(len(nodes), bool)
                if len(seen) > 200_000:  # saves rows only; forgetting is harmless
                    seen.clear()
                for i, node in enumerate(nodes.tolist()):
                    if sizes[i] and node not in seen:
                        seen.add(node)
                        fresh[i] = True
                rows = np.repeat(fresh, sizes)
                own = sizes[fresh]
                key, doc = signatures(values[rows], None, own)
                yield pa.RecordBatch.from_arrays([_i64(key), pa.array(nodes[fresh][doc])],
                                                 names=["key", "node"])

    return d.mapInArrow(run, "key bigint, node bigint")


def shared_blocks(members: DataFrame) -> DataFrame:
    """(grp, node) for every block that two or more sets share; blocks
    with the same members count as one group.  A block with more than
    MAX_HELD sets streams through as a group of its own."""
    ready = members.repartition("key").sortWithinPartitions("key", "node")

    def batch(group, node):
        order = np.lexsort((node, group))
        group, node = group[order], node[order]
        new = np.ones(len(group), bool)
        new[1:] = (group[1:] != group[:-1]) | (node[1:] != node[:-1])
        return pa.RecordBatch.from_arrays([_i64(group[new]), pa.array(node[new])],
                                          names=["grp", "node"])

    def run(batches):
        held_k = held_n = np.zeros(0, np.int64)
        spilled = None  # the key that outgrew the memory bound

        def emit(k, n):
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (n[1:] != n[:-1])
            k, n = k[new], n[new]
            start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            size = np.diff(np.concatenate([start, [len(k)]]))
            total = np.add.reduceat(mix64(n.view(np.uint64)), start)
            group = mix64(total ^ mix64(size.astype(np.uint64)))
            many = size > 1
            if spilled is not None and k[0] == spilled:
                group[0], many[0] = mix64(k[:1].view(np.uint64))[0], True
            on = np.repeat(many, size)
            return batch(np.repeat(group, size)[on], n[on]) if on.any() else None

        for b in batches:
            k = np.concatenate([held_k, b.column("key").to_numpy()])
            n = np.concatenate([held_n, b.column("node").to_numpy()])
            if not len(k):
                continue
            cut = np.searchsorted(k, k[-1])  # the last key may go on
            held_k, held_n = k[cut:], n[cut:]
            if cut and (out := emit(k[:cut], n[:cut])) is not None:
                yield out
            if len(held_k) > MAX_HELD:
                spilled = held_k[0]
                yield batch(np.repeat(mix64(held_k[:1].view(np.uint64)), len(held_k)), held_n)
                held_k, held_n = held_k[:0], held_n[:0]
        if len(held_k) and (out := emit(held_k, held_n)) is not None:
            yield out

    return ready.mapInArrow(run, "grp bigint, node bigint").distinct()


def _scan_sets(docs: DataFrame, wanted: DataFrame, make, schema: str) -> DataFrame:
    """``make(node, values, starts, sizes)`` batches for the texts of the
    ``wanted`` (node, rep) sets and a few more; ``rep``: the smallest
    document that has the set."""
    words = docs.sparkSession.sparkContext.broadcast(
        bloom(wanted.select(F.xxhash64("rep").alias("h")), "h", BLOOM_WORDS))
    d = pick(docs, doc_id="bigint", text="string").where(F.col("text").isNotNull())
    d = d.select("text", F.xxhash64("doc_id").alias("h"))

    def run(batches):
        for batch in batches:
            near = batch.filter(pa.array(in_bloom(words.value, batch.column("h").to_numpy())))
            for b in slices(near, size=TOGETHER) if near.num_rows else ():
                values, starts, sizes = shingle_sets(b.column("text"))
                yield make(set_ids(values, starts, sizes), values, starts, sizes)

    return d.mapInArrow(run, schema)


def sketch_words(sizes: np.ndarray) -> np.ndarray:
    """64-bit words of the bit sketches: powers of two, so that a longer
    sketch folds to a shorter one (its halves XOR-ed)."""
    need = np.maximum(1, -(-sizes * SKETCH_LOAD // 64))
    return (1 << np.ceil(np.log2(need)).astype(np.int64))


def fold(sketch: np.ndarray, words: int) -> np.ndarray:
    """Rows of parity sketches folded to ``words`` words."""
    while sketch.shape[1] > words:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def node_sketches(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, sketch): size and parity bit sketch of the wanted sets."""
    def make(node, values, starts, sizes):
        bits = 64 * sketch_words(sizes)
        row = np.repeat(np.arange(len(node)), sizes)
        first = np.concatenate([[0], np.cumsum(bits)])
        at = first[row] + (mix64(values) % bits[row].astype(np.uint64)).astype(np.int64)
        odd = np.bincount(at, minlength=int(first[-1])).astype(np.uint8) & 1
        packed = np.packbits(odd, bitorder="little")
        offsets = pa.py_buffer((first // 8).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(node), pa.array(sizes.astype(np.int64)),
             pa.Array.from_buffers(pa.binary(), len(node), [None, offsets, pa.py_buffer(packed)])],
            names=["node", "n", "sketch"])

    found = _scan_sets(docs, wanted, make, "node bigint, n bigint, sketch binary")
    return checkpoint(found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]))


def possible(na, nb, far):
    """Sizes and a lower bound of the difference allow a link."""
    return (np.minimum(na, nb) * DEN >= np.maximum(na, nb) * NUM) & (
        far * (DEN + NUM) <= (na + nb) * (DEN - NUM))


def near_by_sketch(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and the sketches' Hamming distance, a
    lower bound of the difference, leave possible."""
    def side(x):
        return sketches.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"),
                               F.col("sketch").alias(f"s{x}"))

    def run(batches):
        for b in batches:
            na, nb = b.column("na").to_numpy(), b.column("nb").to_numpy()
            wa, wb = sketch_words(na), sketch_words(nb)
            sa, sb = b.column("sa").to_pylist(), b.column("sb").to_pylist()
            far = np.zeros(len(na), np.int64)
            for x, y in {*zip(wa.tolist(), wb.tolist())}:  # few lengths
                rows = np.flatnonzero((wa == x) & (wb == y))
                u = np.frombuffer(b"".join(sa[i] for i in rows), np.uint64).reshape(-1, x)
                v = np.frombuffer(b"".join(sb[i] for i in rows), np.uint64).reshape(-1, y)
                k = min(x, y)
                far[rows] = np.bitwise_count(fold(u, k) ^ fold(v, k)).sum(1, dtype=np.int64)
            ok = pa.array(possible(na, nb, far))
            yield pa.RecordBatch.from_arrays([b.column("a").filter(ok), b.column("b").filter(ok)],
                                             names=["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def verified(docs: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have Jaccard >= 0.8, exactly; ``nodes``:
    (node, rep).  Checkpointed."""
    def make(node, values, starts, sizes):
        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), _i64(values))
        return pa.RecordBatch.from_arrays([pa.array(node), lists], names=["node", "shingles"])

    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _scan_sets(docs, checkpoint(ends.join(nodes, "node")), make,
                      "node bigint, shingles array<bigint>")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))

    def run(batches):
        for batch in batches:
            a, b = batch.column("sa"), batch.column("sb")
            la, lb = (pc.list_value_length(c).to_numpy() for c in (a, b))
            row = np.concatenate([np.repeat(np.arange(len(a)), la), np.repeat(np.arange(len(b)), lb)])
            val = np.concatenate([a.flatten().to_numpy(), b.flatten().to_numpy()])
            order = np.lexsort((val, row))
            row, val = row[order], val[order]
            twice = (row[1:] == row[:-1]) & (val[1:] == val[:-1])
            both = np.bincount(row[1:][twice], minlength=len(a))
            ok = pa.array(DEN * both >= NUM * (la + lb - both))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok),
                                              batch.column("b").filter(ok)], names=["a", "b"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return checkpoint(joined.mapInArrow(run, "a bigint, b bigint").distinct())


def _candidates(members: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all sets of different components in a
    group which may be linked as far as sizes and sketches tell, fewer than
    a task has sets; members (grp, chunks, node, component, n, sketch)."""
    side = members.withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    # A member meets its own chunk and all others: chunk pair (i <= j).
    spread = side.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    spread = spread.select("grp", F.least("own", "other").alias("i"),
                           F.greatest("own", "other").alias("j"), "own", "node", "component", "n",
                           "sketch")

    def compare(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        comp = table.column("component").to_numpy()
        n = table.column("n").to_numpy()
        own = table.column("own").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        width = sketch_words(n)
        raw = table.column("sketch").to_pylist()
        # Per length: all sketches at least that long, folded to it.
        levels = {}
        for w in np.unique(width).tolist():
            level = np.zeros((len(n), w), np.uint64)
            for v in np.unique(width[width >= w]).tolist():
                rows = np.flatnonzero(width == v)
                level[rows] = fold(np.frombuffer(b"".join(raw[k] for k in rows), np.uint64)
                                   .reshape(-1, v), w)
            levels[w] = level
        left = np.flatnonzero(own == i)
        right = np.flatnonzero(own == j)
        joined = Joined()
        for x in left.tolist():
            r = right[node[right] > node[x]] if i == j else right
            r = r[comp[r] != comp[x]]
            r = r[possible(n[r], n[x], 0)]
            for w in np.unique(np.minimum(width[r], width[x])).tolist():
                q = r[np.minimum(width[r], width[x]) == w]
                far = np.bitwise_count(levels[w][q] ^ levels[w][x]).sum(1, dtype=np.int64)
                q = q[possible(n[q], n[x], far)]
                joined.add(node[x], node[q])
        return joined.edges()

    return spread.groupBy("grp", "i", "j").applyInArrow(compare, "a bigint, b bigint").distinct()


class Joined:
    """Edges that connect what was linked: one where two parts meet."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.a: list[int] = []
        self.b: list[int] = []

    def _root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    def add(self, x, others) -> None:
        x = int(x)
        for y in others.tolist():
            p, q = self._root(x), self._root(y)
            if p != q:
                self.parent[max(p, q)] = min(p, q)
                self.a.append(x)
                self.b.append(y)

    def edges(self) -> pa.Table:
        return pa.table({"a": pa.array(self.a, pa.int64()), "b": pa.array(self.b, pa.int64())})


def _cross_edges(docs: DataFrame, candidates: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect whatever sets are linked along the
    ``candidates``; nodes (node, rep, times, n).  Checkpointed.

    A set meets, with its shingles, the sets that candidate edges connect
    it to: once, in chunk pairs of bounded size where they are many."""
    near = components(candidates).withColumnRenamed("v", "node")

    def make(table, links):
        node, joined = table.column("node").to_numpy(), Joined()
        for x, r in links:
            joined.add(node[x], node[r])
        return joined.edges()

    return checkpoint(_compared(docs, checkpoint(nodes.join(near, "node")), make,
                                "a bigint, b bigint").distinct())


def _links(values: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool):
    """(x, linked rows of ``right``) for every x of ``left``, exactly;
    ``same``: right is left, each pair once."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    _, code, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times > 1                            # others are in no intersection
    keep = shared[code]
    code, row = (np.cumsum(shared) - 1)[code[keep]], row[keep]
    starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(sizes)))])
    width = -(-int(shared.sum()) // 64)
    bits = None
    if len(sizes) * width <= len(values):         # bit sets no larger than the lists
        bits = np.zeros((len(sizes), 64 * width), bool)
        bits[row, code] = True
        bits = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    mark = np.zeros(int(shared.sum()), bool)
    for k, x in enumerate(left.tolist()):
        r = right[k + 1:] if same else right
        r = r[possible(sizes[r], sizes[x], 0)]
        if not len(r):
            continue
        if bits is not None:
            both = np.bitwise_count(bits[r] & bits[x]).sum(1, dtype=np.int64)
        else:
            own = code[starts[x]:starts[x + 1]]
            mark[own] = True
            hits = np.concatenate([[0], np.cumsum(mark[code])])
            both = hits[starts[r + 1]] - hits[starts[r]]
            mark[own] = False
        linked = r[DEN * both >= NUM * (sizes[x] + sizes[r] - both)]
        if len(linked):
            yield x, linked


def _compared(docs: DataFrame, placed: DataFrame, make, schema: str) -> DataFrame:
    """``make(table, links)`` tables over all linked pairs of sets, each in
    one call; ``placed``: (node, rep, times, n, component) of the sets with
    a link.  Components too large for a task are cut into chunk pairs, small
    ones share a task."""
    total = placed.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // CHUNK_SHINGLES))
    chunks = F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n") / CHUNK_SHINGLES)).cast("int")
    large = placed.groupBy("component").agg(chunks.alias("chunks")).where("chunks > 1")
    placed = placed.join(large, "component", "left")

    def shingles(node, values, starts, sizes):
        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), _i64(values))
        return pa.RecordBatch.from_arrays([pa.array(node), lists], names=["node", "shingles"])

    sets = _scan_sets(docs, placed, shingles, "node bigint, shingles array<bigint>")
    side = placed.join(sets.dropDuplicates(["node"]), "node").withColumn(
        "own", F.coalesce(F.pmod(F.xxhash64("node"), F.col("chunks")), F.lit(-1)).cast("int"))
    others = F.when(F.col("chunks").isNull(), F.array(F.lit(-1))).otherwise(
        F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1))
    spread = side.select("*", F.explode(others).alias("other")).select(
        F.when(F.col("chunks").isNull(), F.pmod(F.xxhash64("component"), F.lit(buckets)))
        .otherwise(F.col("component")).alias("grp"),
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "own", "component", "node", "rep", "times", "shingles")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("component", "ascending"), ("node", "ascending")]).combine_chunks()
        lists = table.column("shingles").chunk(0)
        values = lists.flatten().to_numpy()
        sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)])
        component, own = (table.column(c).to_numpy() for c in ("component", "own"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        cut = np.flatnonzero(np.concatenate([[True], component[1:] != component[:-1]]))

        def links():
            for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(component)]):
                at = own[lo:hi]
                for x, r in _links(values[first[lo]:first[hi]], sizes[lo:hi], np.flatnonzero(at == i),
                                   np.flatnonzero(at == j), i == j):
                    yield lo + x, lo + r

        return make(table, links())

    return spread.groupBy("grp", "i", "j").applyInArrow(compare, schema)


def link_counts(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """(node, linked): rows with an id in the sets linked with each set."""
    def make(table, links):
        times = table.column("times").to_numpy()
        n = np.zeros(len(times), np.int64)
        for x, r in links:
            n[x] += times[r].sum()
            n[r] += times[x]
        on = np.flatnonzero(n)
        return pa.table({"node": table.column("node").to_numpy()[on], "n": n[on]})

    return (_compared(docs, placed, make, "node bigint, n bigint").groupBy("node")
            .agg(F.sum("n").alias("n")))


def linked_pairs(docs: DataFrame) -> DataFrame:
    """(a, b), a < b: the smallest ids of every two linked sets (documents
    with equal sets count as their smallest id)."""
    def make(table, links):
        rep = table.column("rep").to_numpy()
        parts = [(np.minimum(rep[r], rep[x]), np.maximum(rep[r], rep[x])) for x, r in links]
        a, b = (np.concatenate([np.zeros(0, np.int64), *(q[k] for q in parts)]) for k in (0, 1))
        return pa.table({"a": a, "b": b})

    return _compared(docs, _placed(docs)[2], make, "a bigint, b bigint").where("a < b").distinct()


def _placed(docs: DataFrame):
    """The documents' sets; the sets with an id (node, rep, times, n); those
    of them that have a link, with their component.  All checkpointed."""
    small_batches(docs)
    sets = document_sets(docs)
    nodes = checkpoint(sets.where("n_shingles > 0 and doc_id is not null").groupBy("node")
                       .agg(F.min("doc_id").alias("rep"), F.count("*").alias("times"),
                            F.first("n_shingles").alias("n")))
    groups = checkpoint(shared_blocks(block_members(docs)).join(nodes.select("node", "rep"), "node")
                        .select("grp", "node", "rep"))
    members = checkpoint(groups.select("node", "rep").distinct())
    sketches = node_sketches(docs, members)
    # First round: every set against the smallest one it shares a block with.
    hub = groups.groupBy("grp").agg(F.min("node").alias("a"))
    tried = checkpoint(groups.join(hub, "grp").select("a", F.col("node").alias("b"))
                       .where("a < b").distinct())
    stars = checkpoint(near_by_sketch(tried, sketches).groupBy("b").agg(F.min("a").alias("a"))
                       .select("a", "b"))
    first = verified(docs, stars, members)
    label = components(first).withColumnRenamed("v", "node")
    # Second round: groups whose members are not all connected yet.
    named = (groups.join(label, "node", "left")
             .select("grp", "node", F.coalesce("component", "node").alias("component")))
    open_ = (named.groupBy("grp").agg(F.min("component").alias("lo"),
                                      F.max("component").alias("hi"), F.count("*").alias("size"))
             .where("lo <> hi")
             .select("grp", F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks")))
    rows = named.join(open_, "grp").join(sketches, "node").select(
        "grp", "chunks", "node", "component", "n", "sketch")
    second = _cross_edges(docs, _candidates(rows), nodes)
    final = components(first.union(second)).withColumnRenamed("v", "node")
    return sets, nodes, checkpoint(nodes.join(final, "node"))


def _named(sets: DataFrame, nodes: DataFrame, joined: DataFrame) -> DataFrame:
    """The sets' rows with their component's name and smallest id."""
    placed = nodes.join(joined.select("node", "component"), "node", "left").select(
        "node", "rep", "times", F.coalesce("component", "node").alias("linked"))
    smallest = placed.groupBy("linked").agg(F.min("rep").alias("component_id"))
    by_node = placed.join(smallest, "linked").select("node", "times", "linked", "component_id")
    worded = F.col("n_shingles") > 0
    return (sets.join(by_node, "node", "left")
            .select("doc_id", "text_id", "n_shingles", "node", "times",
                    F.when(worded, F.col("linked")).alias("linked"),
                    F.when(worded, F.col("component_id")).otherwise(F.col("doc_id"))
                    .alias("component_id")))


def join_documents(docs: DataFrame) -> DataFrame:
    """doc_id, text_id, n_shingles, n_links, component_id and ``linked``
    (one value per component; null without words) for every row."""
    sets, nodes, joined = _placed(docs)
    own = F.when(F.col("doc_id").isNotNull() & F.col("linked").isNotNull(),
                 F.coalesce("n", F.lit(0)) + F.col("times") - 1)
    return (_named(sets, nodes, joined).join(link_counts(docs, joined), "node", "left")
            .select("doc_id", "text_id", "n_shingles", F.coalesce(own, F.lit(0)).alias("n_links"),
                    "component_id", "linked"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document per component (the smallest id), with the input's
    columns.  Documents without words stay, and rows without an id whose
    set no document has; rows equal in id and text count as one."""
    found = _named(*_placed(docs))
    keepers = (found.where("doc_id is not null and linked is not null").groupBy("linked")
               .agg(F.min(F.struct("doc_id", "text_id")).alias("k")).select("k.doc_id", "k.text_id"))
    alone = found.where("linked is null").select("doc_id", "text_id")
    keep = keepers.union(alone).distinct().select(F.col("doc_id").alias("k_id"),
                                                  F.col("text_id").alias("k_text"))
    rows = stash(docs, doc_id="bigint", text="string").select(
        "_row", "doc_id", text_hash(F.col("text")).alias("text_id"))
    one = rows.groupBy("doc_id", "text_id").agg(F.first("_row").alias("_row"))
    kept = one.join(keep, F.col("doc_id").eqNullSafe(F.col("k_id"))
                    & (F.col("text_id") == F.col("k_text")), "left_semi")
    return unstash(kept, docs)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "n_links", "component_id")
