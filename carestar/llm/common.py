"""Helpers the text operators share: column picking, token hashes, running
totals over a range sort, connected components, checkpoints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carestar.session import ensure_checkpoint_dir

# Word separators of every contract: space and tab .. carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = r"[\x20\x09-\x0D]+"

# Texts are handled in slices of about this many bytes inside a task.
SLICE_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of text that travel to a Python worker together: batches are held on
# both sides, so they bound an executor's memory outside its heap.
TEXT_ROWS = 1000


def small_batches(df: DataFrame) -> None:
    """From now on the session sends at most TEXT_ROWS rows a batch."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= TEXT_ROWS:
        conf.set(key, str(TEXT_ROWS))


def pick(df: DataFrame, **types: str) -> DataFrame:
    """Exactly the named columns, cast to the given types.

    Found by exact name and position, so extra columns (also ones that
    differ in case only) cannot clash; a missing column is all null.
    """
    at = {}
    for i, name in enumerate(df.columns):
        at.setdefault(name, i)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[(F.col(f"c{at[n]}") if n in at else F.lit(None)).cast(t).alias(n)
                          for n, t in types.items()])


def stash(df: DataFrame, **types: str) -> DataFrame:
    """The named columns plus ``_row``: a struct of all input columns."""
    at = {}
    for i, name in enumerate(df.columns):
        at.setdefault(name, i)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(F.struct(*plain.columns).alias("_row"),
                        *[(F.col(f"c{at[n]}") if n in at else F.lit(None)).cast(t).alias(n)
                          for n, t in types.items()])


def unstash(df: DataFrame, like: DataFrame, **replaced: Column) -> DataFrame:
    """The input's columns back from ``_row``; some replaced."""
    cols, seen = [], set()
    for i, (name, kind) in enumerate(like.dtypes):
        if name in replaced and name not in seen:
            cols.append(replaced[name].cast(kind))
        else:
            cols.append(F.col("_row")[f"c{i}"])
        seen.add(name)
    return df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).toDF(*like.columns)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the cluster's shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: of '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def text_hash(text: Column) -> Column:
    """64-bit hash that tells rows with one id but other texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES):
    """Row slices of a batch that hold about ``size`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = 0
    total = np.cumsum(sizes)
    while start < batch.num_rows:
        base = total[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(total, base + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


class Tokens:
    """Words of a slice of texts: vocabulary, word index per token, and
    where each text's tokens begin."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten()
        parents = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
        keep = pc.greater(pc.binary_length(flat), 0)
        keep_np = keep.to_numpy(zero_copy_only=False)
        if not keep_np.all():
            flat, parents = flat.filter(keep), parents[keep_np]
        coded = flat.dictionary_encode()
        self.vocabulary = coded.dictionary.cast(pa.large_binary())
        self.index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.doc = parents.astype(np.int64)
        self.counts = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def words(self) -> list[bytes]:
        return self.vocabulary.to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` tokens from every position (len - size + 1 of them)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
        out = out ^ (out >> np.uint64(29))
    return mix64(out)


def running(df: DataFrame, order: list[str], sums: list[str]) -> DataFrame:
    """Exclusive running totals ``before_<c>`` and position ``rank`` over
    the whole table in ``order``, without gathering it anywhere.

    Range sort, totals inside each partition while it streams by, then one
    row per partition (that many and no more) gives the offsets.
    """
    names = list(df.columns)
    fields = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    extra = "".join(f", `in_{c}` bigint" for c in sums)

    def scan(batches):
        part, at, done = TaskContext.get().partitionId(), 0, [0] * len(sums)
        for b in batches:
            cols = [b.column(n) for n in names]
            own = []
            for k, c in enumerate(sums):
                v = pc.fill_null(b.column(c), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                cum = np.cumsum(v)
                own.append(pa.array(cum - v + done[k]))
                done[k] += int(cum[-1]) if len(cum) else 0
            rows = np.arange(at, at + b.num_rows)
            at += b.num_rows
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(rows), *own],
                names=[*names, "part", "pos", *[f"in_{c}" for c in sums]])

    scanned = checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .mapInArrow(scan, f"{fields}, part int, pos bigint{extra}"))
    each = scanned.groupBy("part").agg(F.count("*").alias("n"),
                                       *[F.sum(c).alias(f"all_{c}") for c in sums])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = each.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"),
                          *[F.coalesce(F.sum(f"all_{c}").over(before), F.lit(0)).alias(f"off_{c}")
                            for c in sums])
    return (scanned.join(F.broadcast(offsets), "part")  # one row per partition
            .select(*names, (F.col("pos") + F.col("off")).alias("rank"),
                    *[(F.col(f"in_{c}") + F.col(f"off_{c}")).alias(f"before_{c}") for c in sums]))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (v, component) with
    the smallest id reachable, for every vertex that has an edge.

    Alternating large-star / small-star passes (each an aggregate and an
    equi-join), checkpointed, until the edge set stays as it is.
    """
    def digest(e):
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                  .alias("h")).first()
        return r["n"], r["h"]

    cur = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                  F.least("a", "b").alias("b")).distinct())
    state = digest(cur)
    while state[0]:
        both = cur.union(cur.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"),
                                                           F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low2, "a")
                 .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"),
                                                    F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        cur = checkpoint(small)
        new = digest(cur)
        if new == state:
            break
        state = new
    return cur.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("component")).union(
        cur.select("b", "b").distinct())


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0x9E6C63D0876A9A47  # odd, so it has an inverse modulo 2**64
_STRETCH = 1 << 21          # bytes hashed at a time
_TABLES: dict[str, np.ndarray] = {}


def _table(name: str) -> np.ndarray:
    if not _TABLES:
        value = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
        lower = np.arange(256)
        lower[65:91] += 32
        blank = np.zeros(256, bool)
        blank[[9, 10, 11, 12, 13, 32]] = True
        _TABLES.update(value=value, lower=value[lower], blank=blank)
    return _TABLES[name]


class WordHashes:
    """64-bit hash of every word of a slice of texts (a polynomial over
    scrambled byte values, taken from prefix sums), the words' places.

    hash, doc (text index), begin / end (byte offsets into ``data``),
    counts (per text), starts (first word per text).  ``lower``: A-Z count
    as a-z.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
        raw = texts.buffers()[2]
        whole = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        data = whole[offsets[0]:offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.data = data
        solid = ~_table("blank")[data]
        first = np.zeros(len(data) + 1, bool)
        first[self.offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = solid[:-1]
        self.begin = np.flatnonzero(solid & (first[:-1] | ~before))
        after = np.zeros(len(data), bool)
        after[:-1] = solid[1:]
        self.end = np.flatnonzero(solid & (first[1:] | ~after)) + 1
        self.doc = np.searchsorted(self.offsets, self.begin, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=n).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)]).astype(np.int64)
        self.hash = self._hash(_table("lower" if lower else "value"))

    def _hash(self, table: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.begin), np.uint64)
        at = 0
        while at < len(self.begin):  # stretches that end between words
            to = max(at + 1, int(np.searchsorted(self.end, self.begin[at] + _STRETCH)))
            lo, hi = self.begin[at], self.end[to - 1]
            n = int(hi - lo)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(table[self.data[lo:hi]] * _cached_powers(_BASE, n)[:n], out=sums[1:])
            s, e = self.begin[at:to] - lo, self.end[at:to] - lo
            back = _cached_powers(pow(_BASE, -1, 1 << 64), n)
            out[at:to] = mix64((sums[e] - sums[s]) * back[s]
                               + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            at = to
        return out


_POWERS: dict[int, np.ndarray] = {}


def _cached_powers(base: int, n: int) -> np.ndarray:
    if n > _STRETCH + (1 << 16):  # a single giant word: not kept
        return _powers(base, n)
    if base not in _POWERS:
        _POWERS[base] = _powers(base, _STRETCH + (1 << 16))
    return _POWERS[base]


def bloom(ids: DataFrame, column: str, words: int) -> np.ndarray:
    """Bit filter of ``words`` (a power of two) 64-bit words over a bigint
    column, two bits a value; it only ever spares work."""
    h = F.col(column)
    bits = ids.select(F.explode(F.array(*[
        F.struct(F.pmod(F.shiftright(h, s), F.lit(words)).cast("int").alias("i"),
                 F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                 F.pmod(F.shiftright(h, s + 24), F.lit(64)).cast("int")).alias("bit"))
        for s in (0, 32)])).alias("e"))
    rows = bits.groupBy("e.i").agg(F.bit_or("e.bit").alias("bits")).toArrow()
    out = np.zeros(words, np.int64)
    out[rows.column("i").to_numpy()] = rows.column("bits").to_numpy()
    return out


def in_bloom(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which int64 values may be in the filter."""
    on = np.ones(len(h), bool)
    for s in (0, 32):
        at = (h >> s) % len(table)
        on &= ((table[at] >> ((h >> (s + 24)) % 64)) & 1).astype(bool)
    return on
