"""Operator 11: periodic runs of words by difference-cover LCE.

A run is a stretch of words with smallest period q (words q apart are equal),
at least ``max(min_length, min_exponent * q)`` long, that no neighbouring word
extends.  Texts are handled in slices of whole documents:

1. Harmonic grid: for every period q the multiples of q are looked at.  A
   run holds at least ``min_exponent - 1`` successive grid points whose words
   q apart are equal, so points where that fails are never asked further
   (about n ln n word comparisons for n words).
2. The other points ask how far the text agrees with itself q words on, to
   the right and to the left.  Longest common extensions come from a
   difference cover: of V residues only those in COVER have their suffixes
   sorted (blocks of V words ranked, then doubled along a residue); any two
   places reach two sampled suffixes by the same shift below V, after that
   many words are compared, and from there the smallest LCP between the two
   ranks, read from a sparse table, is the answer.
3. The same stretch found with several periods keeps the smallest: by Fine
   and Wilf a stretch that long whose smallest period p is below q has p
   dividing q, and its p-run is the same stretch.

Every document is handled whole in one task and no row leaves its partition,
so nothing is shuffled; memory follows the longest text (some 100 bytes a
word).  Null or blank text: no words, no runs, collapsed text ''.  Null ids
are kept, equal rows give equal results, an empty table gives no rows, and
extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.llm.common import SEPARATORS, Tokens, pick, read_table, slices

# A perfect difference cover: every difference modulo V is that of two members.
V = 13
COVER = (0, 1, 3, 9)

MIN_LENGTH = 6
MIN_EXPONENT = 4
POINTS = 1 << 18  # grid points looked at together
TOGETHER = 2 << 20  # bytes of text whose documents are looked at together

_IN_COVER = np.isin(np.arange(V), COVER)
# Smallest shift that brings places with these residues into the cover.
SHIFT = np.array([[next(d for d in range(V) if _IN_COVER[(a + d) % V] and _IN_COVER[(b + d) % V])
                   for b in range(V)] for a in range(V)])


def _ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Dense ranks (from 1) of the rows of ``keys``, first key first."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) + 1
    return out


class CoverLCE:
    """Longest common extensions to the right between places of ``words``,
    an integer array that ends with a value found nowhere else."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = np.concatenate([words, np.zeros(2 * V, words.dtype)])
        at = np.concatenate([np.arange(c, n, V) for c in COVER])
        m = len(at)
        self.index = np.full(n + V, -1, np.int64)
        self.index[at] = np.arange(m)
        # Blocks of V words as few integers, in the order of the words.
        bits = max(1, int(words.max()).bit_length())
        fit = max(1, 62 // bits)
        keys = []
        for lo in range(0, V, fit):
            key = np.zeros(m, np.int64)
            for t in range(lo, min(V, lo + fit)):
                key = (key << bits) | self.words[at + t]
            keys.append(key)
        # Doubling along a residue: place + V is the next sample, or none.
        left = (n - 1 - at) // V  # samples that follow along the residue
        levels, step = [_ranks(keys)], 1
        while levels[-1].max() < m:
            r = levels[-1]
            follow = np.where(left >= step, r[np.minimum(np.arange(m) + step, m - 1)], 0)
            levels.append(_ranks([r, follow]))
            step *= 2
        self.rank = levels[-1] - 1
        order = np.empty(m, np.int64)
        order[self.rank] = np.arange(m)
        # LCP of neighbours in sorted order: whole blocks, then single words.
        a, b = order[:-1].copy(), order[1:].copy()
        blocks = np.zeros(len(a), np.int64)
        for t in range(len(levels) - 1, -1, -1):
            ok = levels[t][a] == levels[t][b]
            blocks[ok] += 1 << t
            a[ok], b[ok] = a[ok] + (1 << t), b[ok] + (1 << t)
        lcp = blocks * V
        x, y = at[order[:-1]] + lcp, at[order[1:]] + lcp
        lcp += self._plain(x, y, np.full(len(x), V))
        # Sparse table: smallest LCP of 2**k neighbours from every rank.
        self.table = [lcp]
        while 2 << (len(self.table) - 1) <= len(lcp):
            k = 1 << (len(self.table) - 1)
            self.table.append(np.minimum(self.table[-1][:-k], self.table[-1][k:]))

    def _plain(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words that agree from x and y on, ``most`` of them at most."""
        out = np.zeros(len(x), np.int64)
        live = np.arange(len(x))
        for t in range(V):
            live = live[most[live] > t]
            live = live[self.words[x[live] + t] == self.words[y[live] + t]]
            if not len(live):
                break
            out[live] += 1
        return out

    def extend(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Words that agree from places x and y (x < y) on."""
        shift = SHIFT[x % V, y % V]
        out = self._plain(x, y, shift)
        go = np.flatnonzero(out == shift)
        a, b = self.index[x[go] + shift[go]], self.index[y[go] + shift[go]]
        lo, hi = np.minimum(self.rank[a], self.rank[b]), np.maximum(self.rank[a], self.rank[b])
        k = np.frexp((hi - lo).astype(np.float64))[1] - 1  # floor of log2
        least = np.zeros(len(go), np.int64)
        for level in np.unique(k):
            on = k == level
            row = self.table[level]
            least[on] = np.minimum(row[lo[on]], row[hi[on] - (1 << int(level))])
        out[go] += least
        return out


def _grid(counts: np.ndarray, starts: np.ndarray, index: np.ndarray, min_length: int, exponent: int):
    """(document, place, period) of the grid points worth asking."""
    need = exponent - 1  # successive grid points of a period that a run holds
    longest = np.where(counts >= min_length, counts // exponent, 0)
    docs = np.repeat(np.arange(len(counts)), longest)
    period = np.arange(len(docs)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    points = np.maximum(0, (counts[docs] - 1) // np.maximum(period, 1) - need + 1)
    ends = np.cumsum(points)
    found, lo = [], 0
    while lo < len(docs):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - points[lo] + POINTS)))
        own = points[lo:hi]
        pair = np.repeat(np.arange(lo, hi), own)
        q = period[pair]
        x = (np.arange(len(pair)) - np.repeat(np.cumsum(own) - own, own)) * q + starts[docs[pair]]
        for t in range(need):
            ok = index[x + t * q] == index[x + (t + 1) * q]
            pair, q, x = pair[ok], q[ok], x[ok]
        found.append((docs[pair], x, q))
        lo = hi
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found))


def runs_of(index: np.ndarray, counts: np.ndarray, min_length: int = MIN_LENGTH,
            exponent: int = MIN_EXPONENT):
    """Runs of documents whose words (equal integers are equal words, 0 and
    up) follow each other in ``index``, ``counts`` words each: arrays
    document, start, length, period, by document, start and period."""
    starts = np.cumsum(counts) - counts
    doc, x, q = _grid(counts, starts, index, min_length, exponent)
    if not len(doc):
        return (np.zeros(0, np.int64),) * 4
    # Only documents with something to ask are laid out, each between two
    # values of its own so that no extension leaves it.
    some = np.unique(doc)
    top = int(index.max()) + 2
    lengths = counts[some] + 1
    begin = np.cumsum(lengths) - lengths + 1
    words = np.empty(int(lengths.sum()) + 1, np.int64)
    words[np.concatenate([begin - 1, [len(words) - 1]])] = top + np.arange(len(some) + 1)
    inner = np.arange(int(counts[some].sum())) - np.repeat(np.cumsum(counts[some]) - counts[some],
                                                           counts[some])
    words[np.repeat(begin, counts[some]) + inner] = \
        index[np.repeat(starts[some], counts[some]) + inner] + 1
    right, left = CoverLCE(words), CoverLCE(words[::-1].copy())
    place = np.searchsorted(some, doc)
    x = x - starts[doc] + begin[place]
    out = []
    for lo in range(0, len(x), POINTS):
        d, at, p = place[lo:lo + POINTS], x[lo:lo + POINTS], q[lo:lo + POINTS]
        ahead = right.extend(at, at + p)
        mirror = len(words) - at  # the place before ``at``, seen from the end
        back = left.extend(mirror - p, mirror)
        length = back + ahead + p
        ok = length >= np.maximum(min_length, exponent * p)
        out.append(np.stack([d[ok], at[ok] - back[ok] - begin[d[ok]], length[ok], p[ok]]))
    rows = np.concatenate(out, 1)
    # The same stretch: its smallest period.
    order = np.lexsort((rows[3], rows[2], rows[1], rows[0]))
    rows = rows[:, order]
    first = np.ones(rows.shape[1], bool)
    first[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(0)
    rows = rows[:, first]
    rows = rows[:, np.lexsort((rows[3], rows[1], rows[0]))]
    return some[rows[0]], rows[1], rows[2], rows[3]


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def collapse_runs(docs: DataFrame, min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; words numbered from 0,
    by start and period) and ``collapsed``: the words joined by one space
    without those that a run holds after its first period.

    ``min_exponent`` (2 at least) is the smallest number of periods."""
    if min_exponent < 2:
        raise ValueError("a run holds two periods at least")

    def find(batches):
        for batch in batches:
            for part in slices(batch, size=TOGETHER):
                t = Tokens(part.column("text"))
                n = len(t.counts)
                doc, start, length, period = runs_of(t.index, t.counts, min_length, min_exponent)
                # Dropped words: +1 where a run's first period ends, -1 at its end.
                edge = np.zeros(len(t.index) + 1, np.int64)
                np.add.at(edge, t.starts[doc] + start + period, 1)
                np.add.at(edge, t.starts[doc] + start + length, -1)
                keep = np.cumsum(edge[:-1]) == 0
                kept = np.bincount(t.doc[keep], minlength=n)
                words = t.vocabulary.cast(pa.large_string()).take(pa.array(t.index[keep]))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)), words)
                spans = pa.StructArray.from_arrays(
                    [pa.array(c) for c in (start, length, period)], ["start", "length", "period"])
                at = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(t.counts),
                     pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), spans),
                     pc.binary_join(lists, pa.scalar(" ", pa.large_string()))
                     .cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return pick(docs, doc_id="bigint", text="string").mapInArrow(
        find, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; documents whose id says so repeat their words from
    one place on (null id: unchanged).  h = crc32(id), g = h div 10: where
    h mod 10 = 0, word i >= a becomes word a + (i - a) mod p, a = g mod n,
    p = 1 + (n - a) div (3 + g mod 8)."""
    h = F.crc32(F.col("doc_id").cast("string"))
    repeated = ("array_join(transform(sequence(0L, n - 1), i -> w[int(if(i < a, i, "
                "a + (i - a) % (1 + (n - a) div (3 + g % 8))))]), ' ')")
    named = pick(docs, doc_id="bigint", text="string")
    return (named.withColumn("h", h).withColumn("g", F.expr("h div 10"))
            .withColumn("w", F.when(F.col("h") % 10 == 0, F.filter(
                F.split(F.coalesce("text", F.lit("")), SEPARATORS), lambda x: x != "")))
            .withColumn("n", F.size("w").cast("bigint"))
            .withColumn("a", F.expr("if(n > 0, g % n, 0L)"))
            .select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), F.expr(repeated))
                    .otherwise(F.col("text")).alias("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = collapse_runs(with_repeats(read_table(spark, sf_dir, "documents")))
    # The greatest length / period, compared as whole numbers; the first wins.
    best = F.expr("aggregate(slice(runs, 2, greatest(size(runs), 1)), get(runs, 0), (b, r) -> "
                  "if(r.length * b.period > b.length * r.period, r, b))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', "
                   "r.period, '\\n')), '')")
    return (runs.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("bigint").alias("n_runs"),
                    F.col("best.start").alias("start"), F.col("best.length").alias("length"),
                    F.col("best.period").alias("period"),
                    F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words"))
