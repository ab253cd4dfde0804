"""Operator 3: LM scoring with a hierarchical Pitman-Yor model.

Tokens: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end
token.  Restaurants: one per token before (or a text's start), as many as
there are; it backs off to the restaurant of that token's class, called a
context: its last two bytes (CHILDREN classes under each of PARENTS classes
of the last byte, one class for a text's start).  The contexts of one last
byte share a parent restaurant, the parents share the root, and the root's
base is uniform over the V learned tokens and one unknown.  No trigrams.

Bigrams are rows (w, prev, c, n) that Spark counts, with the totals of
the restaurants (prev) in a table; both are joined.  Their tables are drawn
PASSES times, given the averaged predictive of the levels above and the
restaurants' tables of the pass before (a bigram seen once has one table), and
seat the levels above anew each time.  Their tables are averaged over the last
SAMPLES passes, as sweeps of the levels above are; those levels' averages are
from the sweeps of the last pass.

Seating of contexts and above: a dish's number of tables in a restaurant is drawn by blocked
Gibbs steps from its exact conditional (generalised Stirling numbers up to
MAX_EXACT customers, further customers arriving in growing groups by the
Chinese-restaurant rule).  A table of a child is a customer of its parent.
Dishes meet only through the restaurants' totals, so words are independent
within a sweep: a sweep is a scan of the counts that returns the totals.
Draws come from hashes of word, context and sweep, so a sweep gives the same
seating wherever and however often it runs, and no seating has to be stored.
Predictive probabilities are averaged over the last SAMPLES sweeps.

The bigrams of the held-out texts are counted beside the learned ones: of the
bigrams learned once, only those a held-out text asks for are kept.

Scoring: the HOT_WORDS most frequent words' predictive terms, as many
restaurants' totals and HOT_PAIRS bigrams at most are broadcast; what a text
needs besides is joined by bigram, word before and word, one after another,
and only what asks travels.  So neither a hot
word nor the vocabulary meets in one task.  Bit filters of the bigrams and
words seen twice spare the rows of a trained text whose bigram or word is not
among them: it was seen once, as was one that passes a filter and is joined
with nothing.  Steps write files, and files and shuffles that
nothing reads any more are deleted.

Null text: as the empty text (the end token alone).  Null id: remainder of
the empty id.  Rows are scored one by one, repeated or not.  Nothing to
learn from (also an empty table): every probability is 1.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.llm.common import (WordHashes, bloom, id_remainder, in_bloom, mix64, pick, read_table,
                                 slices, small_batches)
from carestar.session import ensure_checkpoint_dir, tidy

PARENTS, CHILDREN = 32, 4
CONTEXTS = PARENTS * CHILDREN
DISCOUNT = (0.9, 0.85, 0.85)     # root, parents, contexts
STRENGTH = (10.0, 50.0, 100.0)
WORD_DISCOUNT, WORD_STRENGTH = 0.8, 5.0  # restaurants of the token before
BURN_IN, SAMPLES = 1, 2          # sweeps after the first seating
PASSES = BURN_IN + SAMPLES       # of the bigrams, which first have a table each
MAX_EXACT = 96
HOT_WORDS = 131_072              # rows of the broadcast part, at most
HOT_PAIRS = 1 << 20
BLOOM_WORDS = 1 << 22            # 64-bit words of the filter of repeated bigrams, at most
BLOCK = 4096                     # bigrams of a row that travels, at most
TOKENS = 1 << 21                 # tokens counted together before they travel
TOTALS = 1 << 20                 # a task sends on its sums by token before beyond so many
START = 0x51A27B0E6D3C9F84       # the token before a text's first
END = np.uint64(0x7E57E4D0F1E2D3C5)


def token_stream(texts: pa.Array):
    """(word hash, context, text index) of every token, the end included."""
    t = WordHashes(texts, lower=True)
    n = len(texts)
    total = len(t.hash) + n
    at = np.arange(len(t.hash)) + t.doc            # an end token after each text before
    ends = t.starts[1:] + np.arange(n)
    word = np.full(total, END, np.uint64)
    word[at] = t.hash
    doc = np.zeros(total, np.int64)
    doc[at], doc[ends] = t.doc, np.arange(n)
    last = t.data[t.end - 1] if len(t.end) else np.zeros(0, np.uint8)
    second = np.where(t.end - t.begin > 1, t.data[np.maximum(t.end - 2, 0)], 0) if len(t.end) \
        else np.zeros(0, np.uint8)
    lower = lambda b: np.where((b >= 65) & (b <= 90), b + 32, b).astype(np.int64)
    context = np.zeros(total, np.int64)            # 0: the start of a text
    context[at + 1] = (1 + lower(last) % (PARENTS - 1)) * CHILDREN + lower(second) % CHILDREN
    return word.view(np.int64), context, doc


def pair_hash(word: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mix64(word.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                 + mix64(before.view(np.uint64))).view(np.int64)


def bigrams_of(word: np.ndarray, doc: np.ndarray):
    """(hash of the pair, token before) of every token."""
    before = np.concatenate([[START], word[:-1]]).astype(np.int64)
    before[np.concatenate([[True], doc[1:] != doc[:-1]])[:len(word)]] = START
    before = before[:len(word)]
    return pair_hash(word, before), before


def _stirling(d: float) -> np.ndarray:
    """log of the generalised Stirling numbers S_d(customers, tables)."""
    out = np.full((MAX_EXACT + 1, MAX_EXACT + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(MAX_EXACT):
        t = np.arange(1, c + 2)
        stay = np.where(t <= c, out[c, t] + np.log(np.maximum(c - d * t, 1e-300)), -np.inf)
        out[c + 1, 1:c + 2] = np.logaddexp(out[c, t - 1], stay)
    return out


_STIRLING: dict[float, np.ndarray] = {}


def _uniform(key: np.ndarray) -> np.ndarray:
    return ((mix64(key) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def draw_tables(count: np.ndarray, weight: np.ndarray, d: float, key: np.ndarray) -> np.ndarray:
    """Tables of dishes with ``count`` customers; ``weight``: mass of a new
    table (restaurant's new-table mass times the parent's probability)."""
    if d not in _STIRLING:
        _STIRLING[d] = _stirling(d)
    table = _STIRLING[d]
    out = np.minimum(count, 1)
    exact = np.minimum(count, MAX_EXACT)
    order = np.argsort(exact, kind="stable")
    edges = np.searchsorted(exact[order], np.arange(MAX_EXACT + 2))
    logw = np.log(np.maximum(weight, 1e-300))
    for c in range(2, MAX_EXACT + 1):
        for k in range(edges[c], edges[c + 1], 65_536 // c + 1):
            rows = order[k:min(edges[c + 1], k + 65_536 // c + 1)]
            t = np.arange(1, c + 1)
            logit = table[c, 1:c + 1][None, :] + t[None, :] * logw[rows][:, None]
            u = _uniform(key[rows][:, None] + t.astype(np.uint64)[None, :]
                         * np.uint64(0x9E3779B97F4A7C15))
            out[rows] = 1 + np.argmax(logit - np.log(-np.log(u)), axis=1)
    rows = np.flatnonzero(count > MAX_EXACT)
    seated, tables = np.full(len(rows), float(MAX_EXACT)), out[rows].astype(np.float64)
    step = 0
    while len(rows):
        block = np.minimum(np.ceil(seated / 16), count[rows] - seated)
        mean = block * weight[rows] / (seated - d * tables + weight[rows])
        tables = tables + np.floor(mean + _uniform(key[rows] + np.uint64(1 << 20) + np.uint64(step)))
        seated = seated + block
        done = seated >= count[rows]
        out[rows[done]] = tables[done].astype(out.dtype)
        rows, seated, tables = rows[~done], seated[~done], tables[~done]
        step += 1
    return out


class Seating:
    """Tables of the words of a batch, sweep by sweep.

    One row per word; ``row``, ``ctx``, ``n``: its pairs with contexts, in order
    of both.  ``totals``: per sweep done (C2, T2, C1, T1, C0, T0) over all words.
    A dish with one customer has one table: only the others are drawn.
    """

    def __init__(self, word, row, ctx, n, vocabulary: int):
        self.word, self.row, self.ctx, self.n = word.view(np.uint64), row, ctx, n
        self.base = 1.0 / (vocabulary + 1)
        pair = row * PARENTS + ctx // CHILDREN                     # (word, parent) pairs
        new = np.ones(len(pair), bool)
        new[1:] = pair[1:] != pair[:-1]
        self.up, self.mid = np.cumsum(new) - 1, pair[new]
        self.mid_row, self.parent = self.mid // PARENTS, self.mid % PARENTS
        self.many = np.flatnonzero(n > 1)
        self.t2 = np.minimum(n, 1)
        self.c1 = np.bincount(self.up, self.t2, len(self.mid)).astype(np.int64)
        self.t1 = np.minimum(self.c1, 1)
        self.c0 = np.bincount(self.mid_row, self.t1, len(word)).astype(np.int64)
        self.t0 = np.minimum(self.c0, 1)

    def root(self, totals, c0, t0):
        (d, s), (cc, tt) = (DISCOUNT[0], STRENGTH[0]), totals[4:6]
        return (c0 - d * t0 + (s + d * tt) * self.base) / (s + cc)

    def sweep(self, totals, number: int) -> None:
        c2, t2, c1, t1, cc0, tt0 = totals
        (d0, d1, d2), (s0, s1, s2) = DISCOUNT, STRENGTH
        turn = np.uint64(number * 0xC2B2AE3D27D4EB4F % (1 << 64))
        # Contexts: the parent's probability without the dish's own tables.
        i = self.many
        up, row, ctx = self.up[i], self.row[i], self.ctx[i]
        rest = self.c1[up] - self.t2[i]
        less = np.minimum(self.t1[up], rest)
        own = self.parent[up]
        root = self.root(totals, self.c0[row], self.t0[row])
        parent = (rest - d1 * less + (s1 + d1 * t1[own]) * root) / (
            s1 + np.maximum(c1[own] - self.t2[i], 0))
        key = mix64(self.word[row] + np.uint64(1_000_003) * ctx.astype(np.uint64) + turn)
        self.t2[i] = draw_tables(self.n[i], (s2 + d2 * t2[ctx]) * parent, d2, key)
        self.c1 = np.bincount(self.up, self.t2, len(self.mid)).astype(np.int64)
        i = np.flatnonzero(self.c1 > 1)
        row, own = self.mid_row[i], self.parent[i]
        rest = self.c0[row] - self.t1[i]
        root = self.root(totals, rest, np.minimum(self.t0[row], rest))
        key = mix64(self.word[row] + np.uint64(7_000_003) * (own + 1).astype(np.uint64) + turn)
        self.t1 = np.minimum(self.c1, 1)
        self.t1[i] = draw_tables(self.c1[i], (s1 + d1 * t1[own]) * root, d1, key)
        self.c0 = np.bincount(self.mid_row, self.t1, len(self.word)).astype(np.int64)
        self.t0, i = np.minimum(self.c0, 1), np.flatnonzero(self.c0 > 1)
        key = mix64(self.word[i] + turn)
        self.t0[i] = draw_tables(self.c0[i], np.full(len(i), (s0 + d0 * tt0) * self.base), d0, key)

    def totals(self):
        add = lambda at, v, n: np.bincount(at, v, n)
        return np.concatenate([add(self.ctx, self.n, CONTEXTS), add(self.ctx, self.t2, CONTEXTS),
                               add(self.parent, self.c1, PARENTS), add(self.parent, self.t1, PARENTS),
                               [self.c0.sum(), self.t0.sum()]]).astype(np.int64)


def _parts(flat: np.ndarray):
    at = np.cumsum([CONTEXTS, CONTEXTS, PARENTS, PARENTS])
    c2, t2, c1, t1, rest = np.split(flat.astype(np.float64), at)
    return c2, t2, c1, t1, rest[0], rest[1]


def _together(batches, rows: int = 1 << 16):
    """Batches of ``rows`` rows or more, of smaller ones."""
    parts, size = [], 0
    for b in batches:
        parts.append(b)
        size += b.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(parts).combine_chunks().to_batches()
            parts, size = [], 0
    if size:
        yield from pa.Table.from_batches(parts).combine_chunks().to_batches()


def _seated(batch: pa.RecordBatch, vocabulary: int, done: list):
    """Seating of a batch of the count table after the sweeps done."""
    ctx, n = batch.column("ctx"), batch.column("n")
    sizes = np.diff(np.frombuffer(ctx.buffers()[1], np.int32)[ctx.offset:ctx.offset + len(ctx) + 1])
    row = np.repeat(np.arange(len(ctx)), sizes)
    s = Seating(batch.column("w").to_numpy(), row, ctx.flatten().to_numpy().astype(np.int64),
                n.flatten().to_numpy().astype(np.int64), vocabulary)
    for number, totals in enumerate(done, 1):
        s.sweep(_parts(totals), number)
    return s


class Model:
    """The learned model: ``table`` (w, count, ctx, a2, par, a1, a0), computed
    from ``counts`` when read, the back-off masses of the restaurants, ``once``:
    a2, a1, a0 of a word seen once by context and parent; ``pairs`` (h, n, mass)
    of the bigrams, ``before`` (prev, total, back) of the
    restaurants of the token before: customers, back-off mass."""

    def __init__(self, counts, predicted, tokens, vocabulary, g2, g1, g0, once):
        self.counts, self.predicted, self.tokens, self.vocabulary = counts, predicted, tokens, vocabulary
        self.g2, self.g1, self.g0, self.once = g2, g1, g0, once
        self.pairs = self.before = None

    @property
    def table(self) -> DataFrame:
        return self.predicted(self.counts)

    @property
    def unseen(self) -> float:
        return self.g0 / (self.vocabulary + 1)


def _kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` as files in the shared folder."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _forget(spark: SparkSession, *paths: str) -> None:
    """Delete files of ``_kept`` that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _bigrams(docs: DataFrame, keep_all: bool) -> DataFrame:
    """Bigrams of the texts (text, held_out), a row per word and class c of the
    token before: (w, c, t, n, prev, times) with t the distinct bigrams learned,
    n their customers; prev, times: those seen twice or more and those seen
    once that a held-out text holds too (``keep_all``: all).  Rows with c = -1
    have t and n of a token before (as w), partly summed.

    Bigrams travel in blocks of one bucket, words by their first place: so
    8 bytes for the token before are most of a bigram, and tasks count them
    in arrays.  A bucket holds whole (w, c), of which the largest is a small part.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def tokens(batches):
        """Tokens of many texts: word, class, token before, whether held out."""
        parts, size = [], 0
        for batch in batches:
            for b in slices(batch):
                w, c, doc = token_stream(b.column("text"))
                held = b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)[doc]
                parts.append((w, c, *bigrams_of(w, doc), held))
                size += len(w)
                if size >= TOKENS:
                    yield [np.concatenate(x) for x in zip(*parts)]
                    parts, size = [], 0
        if parts:
            yield [np.concatenate(x) for x in zip(*parts)]

    def blocks(batches):
        for w, c, h, prev, held in tokens(batches):
            _, at, of = np.unique(h, return_index=True, return_inverse=True)
            n = np.bincount(of, ~held, len(at)).astype(np.int64)
            asked = np.bincount(of, held, len(at)) > 0
            w, c, prev = w[at], c[at], prev[at]
            key = mix64(w.view(np.uint64) + np.uint64(1_000_003) * (c + 1).astype(np.uint64))
            bucket = ((key >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((w, bucket))
            w, c, prev, bucket = w[order], c[order], prev[order], bucket[order]
            value = (2 * n + asked)[order]
            # Blocks end with a bucket or after BLOCK rows; runs of a word inside them.
            block = (np.arange(len(w)) - np.searchsorted(bucket, bucket)) % BLOCK == 0
            run = block.copy()
            run[1:] |= w[1:] != w[:-1]
            cuts = np.append(np.flatnonzero(block), len(w)).astype(np.int32)
            starts = np.flatnonzero(run)
            sizes = np.diff(np.append(starts, len(w))).astype(np.int32)
            inner = np.searchsorted(starts, cuts).astype(np.int32)
            lists = lambda cut, v: pa.ListArray.from_arrays(pa.array(cut), pa.array(v))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts[:-1]].astype(np.int32)), lists(inner, w[starts]),
                 lists(inner, sizes), lists(cuts, prev), lists(cuts, c.astype(np.int16)),
                 lists(cuts, value)], names=["bucket", "w", "run", "prev", "c", "value"])

    def counted(parts):
        """Rows of one bucket from its blocks, and its tokens before."""
        w, prev, c, value = [np.concatenate(x) for x in zip(*parts)]
        order = np.lexsort((prev, c, w))
        w, prev, c, value = w[order], prev[order], c[order], value[order]
        group = np.ones(len(w), bool)
        group[1:] = (w[1:] != w[:-1]) | (c[1:] != c[:-1])
        new = group.copy()
        new[1:] |= prev[1:] != prev[:-1]
        at = np.flatnonzero(new)
        n = np.add.reduceat(value >> 1, at)
        asked = np.bitwise_or.reduceat(value & 1, at) > 0
        learned = n > 0
        w, prev, c, n, asked = w[at][learned], prev[at][learned], c[at][learned], n[learned], asked[learned]
        return w, prev, c, n, asked

    def rows(w, prev, c, n, asked):
        group = np.ones(len(w), bool)
        group[1:] = (w[1:] != w[:-1]) | (c[1:] != c[:-1])
        at = np.flatnonzero(group)
        keep = np.ones(len(w), bool) if keep_all else (n > 1) | asked
        cut = np.concatenate([[0], np.cumsum(np.add.reduceat(keep.astype(np.int64), at))]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(w[at]), pa.array(c[at].astype(np.int32)),
             pa.array(np.diff(np.append(at, len(w))).astype(np.int64)), pa.array(np.add.reduceat(n, at)),
             pa.ListArray.from_arrays(pa.array(cut), pa.array(prev[keep])),
             pa.ListArray.from_arrays(pa.array(cut), pa.array(n[keep]))],
            names=["w", "c", "t", "n", "prev", "times"])

    def sums(prev, t, n):
        prev, of = np.unique(prev, return_inverse=True)
        return (prev, np.bincount(of, t, len(prev)).astype(np.int64),
                np.bincount(of, n, len(prev)).astype(np.int64))

    def totals(prev, t, n):
        none = pa.ListArray.from_arrays(pa.array(np.zeros(len(prev) + 1, np.int32)),
                                        pa.array(np.zeros(0, np.int64)))
        return pa.RecordBatch.from_arrays(
            [pa.array(prev), pa.array(np.full(len(prev), -1, np.int32)), pa.array(t), pa.array(n),
             none, none], names=["w", "c", "t", "n", "prev", "times"])

    def count(batches):
        parts, now, held = [], None, None
        numpy = lambda x: x.to_numpy(zero_copy_only=False)                          # noqa: E731

        def bucket_done():
            nonlocal held
            w, prev, c, n, asked = counted(parts)
            parts.clear()
            if len(w):
                yield rows(w, prev, c, n, asked)
                own = sums(prev, np.ones(len(prev)), n)
                held = own if held is None else sums(*[np.concatenate(x) for x in zip(held, own)])
                if len(held[0]) > TOTALS:
                    yield totals(*held)
                    held = None

        for b in batches:
            bucket = b.column("bucket").to_numpy()
            for i, k in enumerate(bucket):
                if now is not None and k != now:
                    yield from bucket_done()
                now = k
                own = {x: numpy(b.column(x)[i].values) for x in ("w", "run", "prev", "c", "value")}
                parts.append((np.repeat(own["w"], own["run"]), own["prev"], own["c"].astype(np.int64),
                              own["value"]))
        if parts:
            yield from bucket_done()
        if held is not None:
            yield totals(*held)

    return (docs.select("text", "held_out")
            .mapInArrow(blocks, "bucket int, w array<bigint>, run array<int>, prev array<bigint>, "
                        "c array<smallint>, value array<bigint>")
            .repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(count, "w bigint, c int, t bigint, n bigint, prev array<bigint>, "
                        "times array<bigint>"))


def learn(docs: DataFrame, others: DataFrame | None = None) -> Model:
    """Count the bigrams; seat the levels above them, then the bigrams given
    those, then the levels above anew.  ``docs``: the training rows' texts.
    ``others``: held-out texts; the model's ``pairs`` then hold, of the bigrams
    learned once, only those of ``others`` (all, if None)."""
    spark = docs.sparkSession
    small_batches(docs)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lm-{uuid.uuid4().hex}"
    d, s = WORD_DISCOUNT, WORD_STRENGTH
    texts = docs.select("text", F.lit(False).alias("held_out"))
    if others is not None:
        texts = texts.union(others.select("text", F.lit(True).alias("held_out")))
    with tidy(spark):
        return _learn(spark, _kept(_bigrams(texts, others is None), f"{root}/bigrams"), root, d, s)


def _learn(spark: SparkSession, bigrams: DataFrame, root: str, d: float, s: float) -> Model:
    first = bigrams.where("c >= 0").select("w", "c", "t", "n")
    base = _kept(bigrams.where("c < 0").groupBy(F.col("w").alias("prev")).agg(
        F.sum("n").alias("total"), F.sum("t").alias("tables")), f"{root}/base")
    before, model = base, _seat_words(first, f"{root}/0")
    samples, old = [], []
    for number in range(1, PASSES + 1):
        # A row per (w, c) with what is above it, then a row per bigram.
        above = _kept(
            bigrams.where("c >= 0 and exists(times, x -> x > 1)")
            .join(model.predicted(model.counts.where("count > 1")), "w", "left")
            .select("w", "c", "prev", "times", _above(model).alias("above")), f"{root}/above{number}")
        repeated = _each(above, "above").where("n > 1").join(before, "prev").select(
            "w", "prev", "c", "n", ((F.lit(s) + F.lit(d) * F.col("tables")) * F.col("above")).alias("weight"))

        def draw(batches, number=number):
            for b in _together(batches):
                key = pair_hash(b.column("w").to_numpy(), b.column("prev").to_numpy())
                key = mix64(key.view(np.uint64) + np.uint64(9_000_011 * number))
                t = draw_tables(b.column("n").to_numpy(), b.column("weight").to_numpy(), d, key)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(x) for x in ("w", "prev", "c", "n")], pa.array(t.astype(np.int64))],
                    names=["w", "prev", "c", "n", "t"])

        drawn = _kept(repeated.mapInArrow(draw, "w bigint, prev bigint, c int, n bigint, t bigint"),
                      f"{root}/drawn{number}")
        if number > BURN_IN:
            samples.append(drawn)
        else:
            old.append(f"{root}/drawn{number}")
        _forget(spark, f"{root}/above{number}", f"{root}/{number - 1}", f"{root}/before{number - 1}")
        # A bigram had one table; the others are added.
        more = drawn.where("t > 1")
        model = _seat_words(first.union(more.select("w", "c", F.col("t") - 1, F.lit(0).cast("bigint"))),
                            f"{root}/{number}")
        if number < PASSES:
            before = _kept(_with_tables(base, more), f"{root}/before{number}")
        _forget(spark, *old)
    seats = _kept(reduce(DataFrame.union, samples).groupBy("w", "prev", "c", "n").agg(F.avg("t").alias("t"))
                  .union(_each(bigrams.where("c >= 0 and exists(times, x -> x = 1)")).where("n = 1").select(
                      "w", "prev", "c", "n", F.lit(1.0).alias("t"))), f"{root}/seats{PASSES}")
    before = _kept(_with_tables(base, seats.where("t > 1")), f"{root}/before{PASSES}")
    _forget(spark, f"{root}/bigrams", f"{root}/base",
            *[f"{root}/drawn{number}" for number in range(BURN_IN + 1, PASSES + 1)])
    model.before = before.select("prev", "total", ((F.lit(s) + F.lit(d) * F.col("tables"))
                                                   / (F.lit(s) + F.col("total"))).alias("back"))

    def named(batches):
        for b in batches:
            h = pair_hash(b.column("w").to_numpy(), b.column("prev").to_numpy())
            n, t = b.column("n").to_numpy(), b.column("t").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(h), b.column("n"), pa.array(n - d * t)],
                                             names=["h", "n", "mass"])

    model.pairs = seats.select("w", "prev", "n", "t").mapInArrow(named, "h bigint, n bigint, mass double")
    return model


def _each(rows: DataFrame, *more: str) -> DataFrame:
    """A row (w, c, prev, n) per bigram of ``rows``, with columns ``more``."""
    return rows.select("w", "c", *more, F.explode(F.arrays_zip("prev", "times")).alias("e")).select(
        "w", "c", *more, "e.prev", F.col("e.times").alias("n"))


def _with_tables(base: DataFrame, more: DataFrame) -> DataFrame:
    """The restaurants (prev, total, tables) with the tables that bigrams of
    ``more`` have beyond their first."""
    return base.select("prev", "total", F.col("tables").cast("double").alias("tables")).union(
        more.select("prev", F.lit(0).cast("bigint"), (F.col("t") - 1).cast("double"))).groupBy("prev").agg(
        F.sum("total").alias("total"), F.sum("tables").alias("tables"))


def _seat_words(seats: DataFrame, root: str) -> Model:
    """Contexts, parents and root seated by Gibbs sweeps, their predictive
    terms averaged.  ``seats``: (w, c, t, n), tables and customers of the
    bigrams of word and class, in any number of rows."""
    spark = seats.sparkSession
    counts = _kept(
        seats.repartition("w").groupBy("w", "c").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
        .groupBy("w").agg(F.sum("n").alias("count"),
                          F.sort_array(F.collect_list(F.struct("c", "t"))).alias("l"))
        .select("w", "count", F.col("l.c").alias("ctx"), F.col("l.t").alias("n")), f"{root}/counts")
    sums = counts.agg(F.count("*").alias("v"), F.sum("count").alias("n")).first()
    vocabulary, tokens = sums["v"], sums["n"] or 0
    done: list[np.ndarray] = []

    def sweep(batches):
        flat = np.zeros(2 * CONTEXTS + 2 * PARENTS + 2, np.int64)
        for b in _together(batches):
            flat += _seated(b, vocabulary, done).totals()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)),
                                          pa.array(flat)], names=["i", "v"])

    for _ in range(1 + BURN_IN + SAMPLES):
        rows = (counts.mapInArrow(sweep, "i int, v bigint").groupBy("i")
                .agg(F.sum("v").alias("v")).collect())  # one row per restaurant total
        flat = np.zeros(2 * CONTEXTS + 2 * PARENTS + 2, np.int64)
        for r in rows:
            flat[r["i"]] = r["v"]
        done.append(flat)
    kept = list(range(BURN_IN + 1, BURN_IN + 1 + SAMPLES))

    def mass(d, s, c, t):
        return (s + d * t) / (s + c)

    g2 = np.mean([mass(DISCOUNT[2], STRENGTH[2], *_parts(done[k])[0:2]) for k in kept], 0)
    g1 = np.mean([mass(DISCOUNT[1], STRENGTH[1], *_parts(done[k])[2:4]) for k in kept], 0)
    g0 = float(np.mean([mass(DISCOUNT[0], STRENGTH[0], *_parts(done[k])[4:6]) for k in kept]))

    def predict(batches):
        (d0, d1, d2), (s0, s1, s2) = DISCOUNT, STRENGTH
        for b in _together(batches):
            s = _seated(b, vocabulary, done[:BURN_IN])
            a2, a0 = np.zeros(len(s.n)), np.zeros(b.num_rows)
            a1 = np.zeros(len(s.mid))
            for k in kept:
                s.sweep(_parts(done[k - 1]), k)
                c2, _, c1, _, c0, _ = _parts(done[k])
                a2 += (s.n - d2 * s.t2) / (s2 + c2[s.ctx]) / SAMPLES
                a1 += (s.c1 - d1 * s.t1) / (s1 + c1[s.parent]) / SAMPLES
                a0 += (s.c0 - d0 * s.t0) / (s0 + c0) / SAMPLES
            offsets = np.concatenate([[0], np.cumsum(np.bincount(s.mid_row, minlength=b.num_rows))])
            offsets = pa.array(offsets.astype(np.int32))
            ctx = b.column("ctx")
            own = pa.array(np.concatenate([[0], np.cumsum(np.bincount(s.row, minlength=b.num_rows))])
                           .astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("w"), b.column("count"),
                 pa.ListArray.from_arrays(own, ctx.flatten().cast(pa.int32())),
                 pa.ListArray.from_arrays(own, pa.array(a2)),
                 pa.ListArray.from_arrays(offsets, pa.array(s.parent.astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(a1)), pa.array(a0)],
                names=["w", "count", "ctx", "a2", "par", "a1", "a0"])

    def predicted(rows):
        return rows.mapInArrow(predict, "w bigint, count bigint, ctx array<int>, a2 array<double>, "
                               "par array<int>, a1 array<double>, a0 double")

    def single(k, d, s):
        return np.mean([(1 - d) / (s + _parts(done[at])[k]) for at in kept], 0)

    once = [single(k, DISCOUNT[i], STRENGTH[i]) for k, i in ((0, 2), (2, 1), (4, 0))]
    return Model(counts, predicted, tokens, vocabulary, g2, g1, g0, once)


def _above(model: Model):
    """The contexts' probability of the word at context ``c``, from the
    columns of ``model.table``."""
    up = F.floor(F.col("c") / CHILDREN).cast("int")
    listed = lambda a: F.array(*[F.lit(float(x)) for x in a])                   # noqa: E731
    zero = F.lit(0.0)

    def term(values, index, at):
        return F.coalesce(F.get(F.col(values), F.array_position(F.col(index), at).cast("int") - 1), zero)

    p1 = term("a1", "par", up) + F.get(listed(model.g1), up) * (F.coalesce("a0", zero)
                                                                + F.lit(model.unseen))
    return term("a2", "ctx", F.col("c")) + F.get(listed(model.g2), F.col("c")) * p1


def _hottest(table: DataFrame, column: str, most: int):
    """(step of a row, least step) so that ``most`` rows at most reach it."""
    step = F.floor(F.log2(F.col(column).cast("double")) * 8).cast("int")
    steps = sorted(((r["s"], r["k"]) for r in table.groupBy(step.alias("s"))
                    .agg(F.count("*").alias("k")).collect()), reverse=True)  # some hundred rows
    limit, total = None, 0
    for s, k in steps:
        if total + k > most:
            break
        limit, total = s, total + k
    return step, limit


def _hot_values(table: DataFrame, key: str, column: str, most: int):
    """The broadcast part of a table: its columns as arrays in the order of
    ``key``; and the rest."""
    step, limit = _hottest(table, column, most)
    hot = (table.where("1 = 0") if limit is None else table.where(step >= limit)).toArrow()
    order = np.argsort(hot.column(key).to_numpy(), kind="stable")
    return ({n: hot.column(n).to_numpy()[order] for n in hot.column_names},
            table if limit is None else table.where(step < limit))


def _hot_rows(model: Model):
    """The broadcast part: all words from a count on, HOT_WORDS at most; and
    the counts of the rest."""
    step, limit = _hottest(model.counts, "count", HOT_WORDS)
    if limit is None:
        return None, model.counts
    hot = model.predicted(model.counts.where(step >= limit)).toArrow().combine_chunks()
    order = np.argsort(hot.column("w").to_numpy(), kind="stable")

    def lists(index, value):
        at, v = (hot.column(c).chunk(0) if hot.column(c).num_chunks else
                 pa.array([], hot.schema.field(c).type) for c in (index, value))
        sizes = np.diff(at.offsets.to_numpy())
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        width = CONTEXTS if index == "ctx" else PARENTS
        key = np.repeat(place, sizes) * width + at.flatten().to_numpy()
        o = np.argsort(key)
        return key[o].astype(np.int32), v.flatten().to_numpy()[o].astype(np.float32)

    k2, a2 = lists("ctx", "a2")
    k1, a1 = lists("par", "a1")
    packed = {"w": hot.column("w").to_numpy()[order], "c": hot.column("count").to_numpy()[order],
              "a0": hot.column("a0").to_numpy()[order], "k2": k2, "a2": a2, "k1": k1, "a1": a1}
    return packed, model.counts.where(step < limit)


def _find(keys, values, wanted):
    """Values at the wanted keys, 0 where there are none."""
    wanted = wanted.astype(keys.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return np.where(keys[at] == wanted, values[at], 0.0) if len(keys) else np.zeros(len(wanted))


def _place(keys, wanted):
    """(found, place) of the wanted among sorted keys."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


WORD, BEFORE, PAIR = 4, 2, 1     # what a request asks for


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Columns of ``docs`` (doc_id, text, held_out) without the text, with
    n_tokens, n_known, base_score and score (log10 of the text's probability).
    Rows that are not held out are those the model has learned from."""
    small_batches(docs)
    with tidy(docs.sparkSession):
        hot, cold_counts = _hot_rows(model)
        before, cold_before = _hot_values(model.before, "prev", "total", HOT_WORDS)
        pairs, cold_pairs = _hot_values(model.pairs, "h", "n", min(HOT_PAIRS, 8 * HOT_WORDS))
        del pairs["n"]
        filters = [_filter(cold_counts.where("count > 1").select("w"), "w"),
                   _filter(cold_pairs.where("n > 1").select("h"), "h"), _filter(cold_pairs.select("h"), "h")]
    packed = docs.sparkSession.sparkContext.broadcast((hot, before, pairs, filters))
    g2, g1, unseen = model.g2, model.g1, model.unseen
    once2, once1, once0 = model.once
    every = float(model.tokens + model.vocabulary + 1)
    d3, s3 = WORD_DISCOUNT, WORD_STRENGTH

    def run(batches):
        table, prevs, known_pairs, (words, again, trained) = packed.value
        for batch in batches:
            for b in slices(batch):
                w, c, doc = token_stream(b.column("text"))
                h, prev = bigrams_of(w, doc)
                n = b.num_rows
                held = b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                learned = ~held[doc]
                known, at = _place(np.zeros(0, np.int64) if table is None else table["w"], w)
                above, count = np.full(len(w), np.nan), np.zeros(len(w))
                if known.any():
                    i, k = at[known], c[known]
                    p = _find(table["k1"], table["a1"], i * PARENTS + k // CHILDREN) \
                        + g1[k // CHILDREN] * (table["a0"][i] + unseen)
                    above[known] = _find(table["k2"], table["a2"], i * CONTEXTS + k) + g2[k] * p
                    count[known] = table["c"][i]
                # A learned word or bigram that no filter holds was seen once.
                single = learned & ~known
                single[single] = ~in_bloom(words, w[single])
                k = c[single]
                up = k // CHILDREN
                above[single] = once2[k] + g2[k] * (once1[up] + g1[up] * (once0 + unseen))
                count[single] = 1
                known |= single
                base = np.bincount(doc[known], np.log10((count[known] + 1) / every), n)
                seen = np.bincount(doc[known], minlength=n).astype(np.int64)
                met, at = _place(prevs["prev"], prev)
                total, back = np.zeros(len(w)), np.ones(len(w))
                total[met], back[met] = prevs["total"][at[met]], prevs["back"][at[met]]
                # The token before was seen as often as the word it is.
                single = np.concatenate([[False], single[:-1]])[:len(w)] & ~met & (prev != START)
                total[single], back[single] = 1, (s3 + d3) / (s3 + 1)
                met |= single
                paired, at = _place(known_pairs["h"], h)
                mass = np.zeros(len(w))
                mass[paired] = known_pairs["mass"][at[paired]]
                once = ~paired & learned
                once[once] = ~in_bloom(again, h[once])
                mass[once] = 1 - d3
                never = ~paired & ~learned
                never[never] = ~in_bloom(trained, h[never])
                paired |= once | never
                whole = known & met & paired
                part = np.bincount(doc[whole], np.log10(
                    mass[whole] / (s3 + total[whole]) + back[whole] * above[whole]), n)
                # Asked for since a filter may err: what the join does not find was learned once.
                mass[learned & ~paired] = 1 - d3
                # The other bigrams: one request per text and bigram.
                rest = np.flatnonzero(~whole)
                order = rest[np.lexsort((h[rest], doc[rest]))]
                new = np.ones(len(order), bool)
                new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.concatenate([at, [len(order)]]))
                q, m = order[at], len(at)
                rid = b.column("rid").to_numpy()
                ask = WORD * ~known[q] + BEFORE * ~met[q] + PAIR * ~paired[q]
                counts = np.bincount(doc, minlength=n)
                gap = lambda x, kind: pa.concat_arrays([x, pa.nulls(m, kind)])
                cat = lambda x, y: pa.array(np.concatenate([x, y]))             # noqa: E731
                none = np.zeros(n, np.int64)
                only = lambda which, x: cat(none, np.where(which[q], 0, x[q]))
                # Words' values that a request will be answered stay 0 until then.
                above[~known] = 0
                yield pa.RecordBatch.from_arrays(
                    [cat(rid, rid[doc[q]]), gap(b.column("doc_id"), pa.int64()),
                     gap(b.column("held_out"), pa.bool_()), gap(pa.array(counts), pa.int64()),
                     cat(seen, np.zeros(m, np.int64)), cat(base, np.zeros(m)), cat(part, np.zeros(m)),
                     cat(none, ask).cast(pa.int32()), only(known, w), only(met, prev), only(paired, h),
                     cat(none, c[q]).cast(pa.int32()), cat(none, times),
                     cat(np.ones(n), above[q]), cat(np.zeros(n), total[q]), cat(np.ones(n), back[q]),
                     cat(np.zeros(n), mass[q])],
                    names=["rid", "doc_id", "held_out", "n_tokens", "seen", "base", "part", "ask", "w",
                           "prev", "h", "c", "times", "above", "total", "back", "mass"])

    rows = (docs.withColumn("rid", F.monotonically_increasing_id())
            .mapInArrow(run, "rid bigint, doc_id bigint, held_out boolean, n_tokens bigint, "
                        "seen bigint, base double, part double, ask int, w bigint, prev bigint, "
                        "h bigint, c int, times bigint, above double, total double, back double, "
                        "mass double"))
    # Written in two folders: what asks for a bigram is read once and then deleted.
    root = f"{ensure_checkpoint_dir(docs.sparkSession).rstrip('/')}/lm-{uuid.uuid4().hex}"
    with tidy(docs.sparkSession):
        rows.withColumn("pair", F.col("ask").bitwiseAND(PAIR)).write.partitionBy("pair").option(
            "compression", "zstd").parquet(f"{root}/rows")
        kept = docs.sparkSession.read.schema(rows.withColumn("pair", F.lit(0)).schema).parquet(f"{root}/rows")
        rest, texts = kept.where("pair = 0 and ask > 0"), kept.where("pair = 0 and ask = 0")
        paired = _kept(_left(_answered(
            kept.where(f"pair = {PAIR}"), cold_pairs.select("h", F.col("mass").alias("y")), "h", PAIR,
            {"mass": F.coalesce("y", "mass").alias("mass")}), s3), f"{root}/paired")
        _forget(docs.sparkSession, f"{root}/rows/pair={PAIR}")
        asks = lambda df: df.where(F.col("ask").bitwiseAND(BEFORE) > 0)           # noqa: E731
        others = lambda df: df.where(F.col("ask").bitwiseAND(BEFORE) == 0)        # noqa: E731
        after = _kept(_left(_answered(
            asks(rest.select(*ASKS)).union(asks(paired)),
            cold_before.select("prev", F.col("total").cast("double").alias("x"), F.col("back").alias("y")),
            "prev", BEFORE, {"total": F.coalesce("x", F.lit(0.0)).alias("total"),
                             "back": F.coalesce("y", F.lit(1.0)).alias("back")}), s3), f"{root}/after")
    found = F.coalesce("count", F.lit(0))
    words = _answered(
        others(rest.select(*ASKS)).union(others(paired.where("ask > 0")))
        .union(after.where("ask > 0")), model.predicted(cold_counts), "w", WORD,
        {"above": _above(model).alias("above")},
        F.when(found > 0, F.col("times")).otherwise(0).alias("seen"),
        (F.col("times") * F.log10((found + 1) / F.lit(every))).alias("base"))
    empty = [F.lit(None).cast(t).alias(n) for n, t in
             (("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"))]
    sums = lambda df: df.where("ask = 0").select(                                 # noqa: E731
        "rid", *empty, F.lit(0).cast("bigint").alias("seen"), F.lit(0.0).alias("base"),
        F.col("mass").alias("part"))
    return (texts.select("rid", "doc_id", "held_out", "n_tokens", "seen", "base", "part")
            .union(words.select("rid", *empty, "seen", "base", _log_probability(s3).alias("part")))
            .union(sums(paired)).union(sums(after))
            .groupBy("rid").agg(
                F.first("doc_id", ignorenulls=True).alias("doc_id"),
                F.first("held_out", ignorenulls=True).alias("held_out"),
                F.max("n_tokens").alias("n_tokens"), F.sum("seen").alias("n_known"),
                F.sum("base").alias("base_score"), F.sum("part").alias("score")).drop("rid"))


ASKS = ["rid", "ask", "w", "prev", "h", "c", "times", "above", "total", "back", "mass"]


def _answered(rows: DataFrame, facts: DataFrame, key: str, kind: int, new: dict, *more) -> DataFrame:
    """Requests with one kind of fact in its place; ``facts``: by ``key``."""
    new = {**new, "ask": (F.col("ask") - kind).alias("ask")}
    return rows.select(*ASKS).join(facts, key, "left").select(*[new.get(n, F.col(n)) for n in ASKS], *more)


def _log_probability(s: float):
    p = F.col("mass") / (F.lit(s) + F.col("total")) + F.col("back") * F.col("above")
    return F.col("times") * F.log10(p)


def _left(rows: DataFrame, s: float) -> DataFrame:
    """The requests; those that ask for nothing more have their log10
    probability as ``mass`` and 0 elsewhere."""
    more = F.col("ask") > 0
    blank = {"w": "bigint", "prev": "bigint", "h": "bigint", "c": "int", "times": "bigint",
             "above": "double", "total": "double", "back": "double"}
    return rows.select(*[
        F.when(more, F.col(n)).otherwise(F.lit(0).cast(blank[n])).alias(n) if n in blank else
        F.when(more, F.col(n)).otherwise(_log_probability(s)).alias(n) if n == "mass" else F.col(n)
        for n in ASKS])


def _filter(ids: DataFrame, column: str) -> np.ndarray:
    """Bit filter of a column, 16 bits or more a value up to BLOOM_WORDS."""
    return bloom(ids, column, min(BLOOM_WORDS, 1 << max(10, (ids.count() // 4).bit_length())))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pick(read_table(spark, sf_dir, "documents"), doc_id="bigint", text="string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        (id_remainder(F.col("doc_id"), 7) == 2).alias("held_out"))
    model = learn(d.where(~F.col("held_out")), d.where("held_out"))
    return score(d, model).select("doc_id", "held_out", "n_tokens", "n_known",
                                  F.lit(model.tokens).cast("bigint").alias("train_tokens"),
                                  "base_score", "score")
