"""Operator 9: substring dedup with a compressed FM-index per shard.

Words ``[^\\x20\\x09-\\x0D]+``, unchanged.  A word goes if a window of
WINDOW consecutive words covers it whose words also start somewhere in a
document with a smaller id; windows are judged on the input.

Sharding: every window belongs to the smallest GRAM-word hash inside it
(its minimizer), so equal windows always meet in one shard and a document
splits into short segments of windows with one minimizer.  A first pass
counts the minimizers; only those that two different documents have go on
(through a bit filter that merely spares work).  Minimizers that hold more
than 1 / HOT_SHARE of all places - at most HOT_SHARE of them, a short list -
send each window as a segment of its own, to a shard by the window's words, so
no shard holds a hot minimizer's windows whole.  Windows that are that frequent
themselves (at most SPAN * HOT_SHARE) spread their lookups over SALT shards.

Shard: the distinct segments, pre-aggregated in the sending tasks with the
smallest document that has them, become the text of an FM-index (suffix
order by prefix doubling as deep as a window needs, wavelet matrix over the
Burrows-Wheeler transform, bit vectors with block ranks).  Backward search
streams the segments right to left; its parent step (to the interval one
word shorter, from the borders of equal prefixes) gives the matching
statistics up to the window length, so a window costs one step more.  The
smallest document in an interval decides.  Lookups stream past the index
and are not held.

Null text: no words.  Rows without an id are sources for nobody and count
as larger than any id.  Rows that repeat an id: neither is smaller; texts of
one id are told apart by their hash.  Empty table: no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.llm.common import (WordHashes, bloom, checkpoint, gram_hashes, in_bloom, mix64, pick,
                                 read_table, slices, small_batches, stash, text_hash, unstash)

WINDOW = 13
GRAM = 5
SPAN = WINDOW - GRAM + 1         # grams in a window
SHARD_PLACES = 50_000            # lookups a shard gets on average
TOGETHER = 2 << 20               # bytes of text handled together
HOT_SHARE = 1000
SALT = 32
NO_ID = np.iinfo(np.int64).max
DEPTH = 16                       # of the suffix order, at least WINDOW + 1


def minimizers(words: WordHashes):
    """(grams, windows, place): hashes of all grams; the starts of all
    windows inside one text; the place of each window's minimizer."""
    grams = gram_hashes(words.hash, GRAM)
    n = max(0, len(words.hash) - WINDOW + 1)
    start = np.arange(n)
    best, place = grams[:n].copy(), start.copy()
    for i in range(1, SPAN):
        other = grams[i:i + n]
        less = other < best
        best = np.where(less, other, best)
        place = np.where(less, start + i, place)
    inside = words.doc[:n] == words.doc[WINDOW - 1:WINDOW - 1 + n]
    return grams, start[inside], place[inside]


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("d").to_numpy()


def _documents(docs: DataFrame) -> DataFrame:
    d = pick(docs, doc_id="bigint", text="string")
    return d.select(F.coalesce("doc_id", F.lit(int(NO_ID))).alias("d"),
                    text_hash(F.col("text")).alias("text_id"), "text").where("text is not null")


def shared_grams(docs: DataFrame) -> DataFrame:
    """(gram, places) of the minimizers that two different documents have."""
    def run(batches):
        for batch in batches:
            for b in slices(batch, size=TOGETHER):
                words = WordHashes(b.column("text"))
                grams, _, place = minimizers(words)
                place = np.unique(place)
                g, d = grams[place].view(np.int64), _ids(b)[words.doc[place]]
                order = np.argsort(g, kind="stable")
                g, d = g[order], d[order]
                at = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) \
                    else np.zeros(0, np.int64)
                if not len(at):
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g[at]), pa.array(np.minimum.reduceat(d, at)),
                     pa.array(np.maximum.reduceat(d, at)),
                     pa.array(np.diff(np.concatenate([at, [len(g)]])).astype(np.int32))],
                    names=["gram", "lo", "hi", "n"])

    counted = _documents(docs).select("d", "text").mapInArrow(
        run, "gram bigint, lo bigint, hi bigint, n int")
    return checkpoint(counted.groupBy("gram").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                                  F.sum("n").alias("places"))
                      .where("lo < hi").select("gram", "places"))


class Bits:
    """Bit vector with ranks from block counts and popcounts."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(len(bits) // 64 * 64 + 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words),
                                                     dtype=np.int64)])[:-1].astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class FMIndex:
    """Backward search over integer symbols (0 is the separator)."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.n = len(text)
        order, ranks = self._suffixes(text)
        self.order = order
        transform = text[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.levels, self.zeros = [], []
        self.bits = max(1, int(symbols - 1).bit_length())
        column = transform
        for shift in range(self.bits - 1, -1, -1):
            bit = (column >> shift) & 1
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(column) - bit.sum()))
            column = np.concatenate([column[bit == 0], column[bit == 1]])
        self.base = self._walk(np.arange(symbols), np.zeros(symbols, np.int64))
        # Borders of the suffixes equal in their first WINDOW - 1 symbols.
        half, rest = ranks[8], ranks[4]
        at = np.minimum(order + 8, self.n)
        key = half[order] * np.int64(self.n + 2) + np.concatenate([rest, [-1]])[at]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        starts = np.flatnonzero(new)
        which = np.cumsum(new) - 1
        self.low = starts[which]
        self.high = np.concatenate([starts[1:], [self.n]])[which]

    @staticmethod
    def _suffixes(text: np.ndarray):
        """Suffix order by the first DEPTH symbols; ranks by depth."""
        rank = text.astype(np.int64)
        kept, depth = {}, 1
        while True:
            kept[depth] = rank
            if depth >= DEPTH:
                return np.argsort(rank, kind="stable"), kept
            ahead = np.concatenate([rank[depth:], np.full(min(depth, len(rank)), -1)])[:len(rank)]
            key = rank * np.int64(len(rank) + int(rank.max()) + 2) + ahead + 1
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[False], key[order][1:] != key[order][:-1]])
            rank = np.empty_like(rank)
            rank[order] = np.cumsum(new)
            depth *= 2

    def _walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            bit = (symbol >> (self.bits - 1 - level)) & 1
            ones = bits.rank(i)
            i = np.where(bit == 1, zeros + ones, i - ones)
        return i

    def back(self, symbol, low, high):
        """Intervals of symbol + pattern from those of pattern."""
        at = self.first[symbol] - self.base[symbol]
        return at + self._walk(symbol, low), at + self._walk(symbol, high)

    def shorter(self, low):
        """Intervals of the patterns' first WINDOW - 1 symbols."""
        return self.low[low], self.high[low]


def smallest_sources(segments: list[bytes], sources: np.ndarray):
    """For every window of every (distinct) segment the smallest source of
    the segments that have it: (values, first value of each segment)."""
    words = [s.split() for s in segments]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = pa.array([x for w in words for x in w], pa.large_binary()).dictionary_encode()
    codes = flat.indices.to_numpy().astype(np.int64) + 1
    begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    text = np.zeros(int(sizes.sum()) + len(sizes), np.int64)  # a separator after each
    place = np.arange(len(codes)) + np.repeat(np.arange(len(sizes)), sizes)
    text[place] = codes
    begin = begin + np.arange(len(sizes))
    index = FMIndex(text, int(codes.max()) + 1)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    by_suffix = np.concatenate([sources[owner[index.order]], [NO_ID]])
    windows = sizes - WINDOW + 1
    first = np.concatenate([[0], np.cumsum(windows)])
    out = np.full(int(first[-1]), NO_ID, np.int64)
    low = np.zeros(len(sizes), np.int64)
    high = np.full(len(sizes), index.n, np.int64)
    for back in range(1, WINDOW + 1):  # the last window, word by word
        low, high = index.back(text[begin + sizes - back], low, high)
    on = np.arange(len(sizes))
    for step in range(int(windows.max())):
        where, which = np.unique(low, return_inverse=True)
        ends = np.zeros(len(where), np.int64)
        ends[which] = high
        least = np.minimum.reduceat(by_suffix, np.stack([where, ends], 1).ravel())[::2]
        out[first[on] + windows[on] - 1 - step] = least[which]
        more = windows[on] > step + 1
        on = on[more]
        if not len(on):
            break
        low, high = index.shorter(low[more])
        low, high = index.back(text[begin[on] + windows[on] - 2 - step], low, high)
    return out, first


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _segments(words: WordHashes, wanted: np.ndarray, hot: np.ndarray):
    """(gram, first window, last window) of the runs of windows with one
    wanted minimizer, and a hash of each run's words; every window of a hot
    minimizer is a run of its own."""
    grams, start, place = minimizers(words)
    if not len(start):
        return (np.zeros(0, np.int64),) * 4
    alone = np.isin(grams.view(np.int64), hot)[place]
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
                          | alone[1:]])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(start)]]) - 1
    gram = grams[place[at]].view(np.int64)
    keep = in_bloom(wanted, gram)
    at, last, gram = at[keep], last[keep], gram[keep]
    if not len(at):
        return (np.zeros(0, np.int64),) * 4
    lo, hi = start[at], start[last] + WINDOW
    length = hi - lo
    # Order-aware sum over the run's words.
    nth = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    every = words.hash[np.repeat(lo, length) + nth] + mix64(nth.astype(np.uint64) + np.uint64(77))
    sums = np.add.reduceat(mix64(every), np.concatenate([[0], np.cumsum(length)])[:-1])
    return gram, lo, hi, mix64(sums ^ mix64(length.astype(np.uint64))).view(np.int64)


def _hot_shard(seg: np.ndarray, salt, shards: int) -> np.ndarray:
    return shards + (mix64(seg.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
                           * np.atleast_1d(np.asarray(salt, np.uint64)))
                     % np.uint64(SPAN * shards)).astype(np.int64)


def route(gram, seg, text_id, d, hot, common, shards: int):
    """Shards of the segments' lookups, and (shards, rows) of the index
    entries: each distinct segment once, with its smallest document, and a
    ``common`` window of a hot minimizer once per salt."""
    is_hot = np.isin(gram, hot)
    spread = is_hot & np.isin(seg, common)
    salt = np.where(spread, np.uint64(1) + mix64(text_id.view(np.uint64)) % np.uint64(SALT),
                    np.uint64(0))
    own = np.where(is_hot, _hot_shard(seg, salt, shards),
                   (mix64(gram.view(np.uint64)) % np.uint64(shards)).astype(np.int64))
    order = np.lexsort((d, seg))
    entries = order[np.concatenate([[True], seg[order][1:] != seg[order][:-1]])]
    once, often = entries[~spread[entries]], entries[spread[entries]]
    to = [own[once], *(_hot_shard(seg[often], k, shards) for k in range(1, SALT + 1))]
    return own, np.concatenate(to), np.concatenate([once, *[often] * SALT])


def _common_windows(docs: DataFrame, wanted, hot: np.ndarray, limit: int) -> np.ndarray:
    """Hashes of the hot minimizers' windows with more than ``limit`` places."""
    def run(batches):
        for batch in batches:
            for b in slices(batch, size=TOGETHER):
                gram, _, _, seg = _segments(WordHashes(b.column("text")), wanted.value, hot)
                seg, n = np.unique(seg[np.isin(gram, hot)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seg), pa.array(n.astype(np.int64))],
                                                 names=["seg", "n"])

    found = (_documents(docs).select("text").mapInArrow(run, "seg bigint, n bigint")
             .groupBy("seg").agg(F.sum("n").alias("n")).where(F.col("n") > limit))
    return np.array([r["seg"] for r in found.select("seg").collect()], np.int64)


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(d, text_id, ranges): per text the word ranges [from, to) to cut."""
    spark = docs.sparkSession
    small_batches(docs)
    grams = shared_grams(docs)
    totals = grams.agg(F.count("*").alias("n"), F.sum("places").alias("places")).first()
    places = totals["places"] or 0
    limit = max(SHARD_PLACES // 4, places // HOT_SHARE)
    hot = np.array([r["gram"] for r in grams.where(F.col("places") > limit).collect()], np.int64)
    bits = 1 << max(14, min(22, int((totals["n"] or 1) * 16 // 64).bit_length()))
    wanted = spark.sparkContext.broadcast(bloom(grams, "gram", bits))
    shards = max(1, -(-places // SHARD_PLACES))
    common = _common_windows(docs, wanted, hot, limit) if len(hot) else hot

    def send(batches):
        for batch in batches:
            for b in slices(batch, size=TOGETHER):
                words = WordHashes(b.column("text"))
                gram, lo, hi, seg = _segments(words, wanted.value, hot)
                if not len(gram):
                    continue
                doc = words.doc[lo]
                d, text_id = _ids(b)[doc], b.column("text_id").to_numpy()[doc]
                first = (lo - words.starts[doc]).astype(np.int32)
                own, rows_s, rows_e = route(gram, seg, text_id, d, hot, common, shards)
                out = {"shard": [], "kind": [], "size": [], "blob": []}
                raw = words.data

                def groups(keys):
                    o = np.argsort(keys, kind="stable")
                    cut = np.flatnonzero(np.concatenate([[True], keys[o][1:] != keys[o][:-1]]))
                    return zip(keys[o][cut], np.split(o, cut[1:]))

                for s, rows in groups(rows_s):
                    e = rows_e[rows]
                    text = b"\n".join(
                        b" ".join(raw[x:y].tobytes().split())
                        for x, y in zip(words.begin[lo[e]], words.end[hi[e] - 1]))
                    head = np.stack([seg[e], d[e]]).tobytes()
                    out["shard"].append(int(s))
                    out["kind"].append(0)
                    out["size"].append(len(e))
                    out["blob"].append(_pack(head + text))
                for s, rows in groups(own):
                    out["shard"].append(int(s))
                    out["kind"].append(1)
                    out["size"].append(len(rows))
                    out["blob"].append(_pack(
                        np.stack([seg[rows], d[rows], text_id[rows], first[rows].astype(np.int64)])
                        .tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["shard"], pa.int64()), pa.array(out["kind"], pa.int32()),
                     pa.array(out["size"], pa.int32()), pa.array(out["blob"], pa.binary())],
                    names=list(out))

    def match(batches):
        shard, segs, least, texts = None, None, None, {}

        def lookup(blob, size):
            seg, d, text_id, first = np.frombuffer(_unpack(blob), np.int64).reshape(4, size)
            at = np.searchsorted(segs[0], seg)
            row = segs[1][at]
            values, starts = least
            count = starts[row + 1] - starts[row]
            owner = np.repeat(np.arange(size), count)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            gone = values[starts[row][owner] + nth] < d[owner]
            owner, lo = owner[gone], (first[owner] + nth)[gone]
            if not len(owner):
                return None
            new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (lo[1:] != lo[:-1] + 1)])
            at = np.flatnonzero(new)
            last = np.concatenate([at[1:], [len(lo)]]) - 1
            o = owner[at]
            return pa.RecordBatch.from_arrays(
                [pa.array(d[o]), pa.array(text_id[o]), pa.array(lo[at].astype(np.int32)),
                 pa.array((lo[last] + WINDOW).astype(np.int32))],
                names=["d", "text_id", "from", "to"])

        for b in batches:
            for s, kind, size, blob in zip(*(b.column(c).to_pylist() for c in (
                    "shard", "kind", "size", "blob"))):
                if s != shard:
                    shard, texts, least = s, {}, None
                if kind == 0:
                    data = _unpack(blob)
                    seg, d = np.frombuffer(data[:16 * size], np.int64).reshape(2, size)
                    for x, y, t in zip(seg.tolist(), d.tolist(), data[16 * size:].split(b"\n")):
                        known = texts.get(x)
                        if known is None or y < known[0]:
                            texts[x] = (y, t)
                    continue
                if least is None:
                    keys = np.fromiter(texts, np.int64, len(texts))
                    least = smallest_sources([t for _, t in texts.values()],
                                             np.array([y for y, _ in texts.values()], np.int64))
                    order = np.argsort(keys)
                    segs, texts = (keys[order], order), {}
                if (out := lookup(blob, size)) is not None:
                    yield out

    sent = _documents(docs).mapInArrow(send, "shard bigint, kind int, size int, blob binary")
    found = (sent.repartition("shard").sortWithinPartitions("shard", "kind")
             .mapInArrow(match, "d bigint, text_id bigint, `from` int, `to` int"))
    return (found.distinct().groupBy("d", "text_id")
            .agg(F.collect_list(F.struct("from", "to")).alias("ranges")))


def _cut(docs: DataFrame, shown: bool) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words' digest (``shown``:
    the input row and the kept text instead)."""
    d = stash(docs, doc_id="bigint", text="string").select(
        *(["_row"] if shown else []), "doc_id", "text",
        F.coalesce("doc_id", F.lit(int(NO_ID))).alias("d"), text_hash(F.col("text")).alias("text_id"))
    j = d.join(repeated_ranges(docs), ["d", "text_id"], "left").select(
        *(["_row"] if shown else ["doc_id"]), "text", "ranges")
    kept_fields = [f for f in j.schema.fields if f.name in ("_row", "doc_id")]
    schema = j.select(*[f.name for f in kept_fields]).schema
    for name, kind in (("n_words", "long"), ("n_removed", "long"),
                       ("kept" if shown else "kept_sha256", "string")):
        schema = schema.add(name, kind)

    def run(batches):
        for batch in batches:
            for part in slices(batch, size=TOGETHER):
                yield cut(part)

    def cut(part):
        n_words, n_removed, kept = [], [], []
        for text, ranges in zip(part.column("text"), part.column("ranges")):
            text = text.as_py()
            words = (text or "").encode("utf-8").split()
            n_words.append(len(words))
            if ranges.is_valid and len(ranges):
                gone = np.zeros(len(words) + 1, np.int64)
                for r in ranges.as_py():
                    gone[r["from"]] += 1
                    gone[r["to"]] -= 1
                stay = np.cumsum(gone)[:-1] == 0
                words = [words[i] for i in np.flatnonzero(stay).tolist()]
            n_removed.append(n_words[-1] - len(words))
            if not shown:
                kept.append(hashlib.sha256(b" ".join(words)).hexdigest())
            else:
                kept.append(b" ".join(words).decode("utf-8") if n_removed[-1] else text)
        return pa.RecordBatch.from_arrays(
            [*[part.column(f.name) for f in kept_fields], pa.array(n_words, pa.int64()),
             pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=schema.names)

    return j.mapInArrow(run, schema)


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The documents without repeated passages, with the input's columns.
    A text that loses words becomes its kept words joined by one space;
    documents of which no word is left go."""
    cut = _cut(docs, shown=True).where("n_removed = 0 or n_removed < n_words")
    changed = F.col("n_removed") > 0
    lengths = {"n_chars": F.when(changed, F.length("kept"))
               .otherwise(F.col("_row")[f"c{docs.columns.index('n_chars')}"])} \
        if "n_chars" in docs.columns else {}
    return unstash(cut, docs, text=F.col("kept"), **lengths)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut(read_table(spark, sf_dir, "documents"), shown=False)


ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (
  SELECT doc_id, unnest(range(1, greatest(len(ws) - 11, 1))) AS i, ws FROM w),
h AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM p),
r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS lo FROM h)
  WHERE lo < doc_id),
g AS (
  SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 13)) AS j FROM r)),
a AS (
  SELECT doc_id, list(j) AS js FROM g GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(
         CASE WHEN js IS NULL THEN ws
              ELSE list_filter(ws, lambda x, j: NOT list_contains(js, j)) END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN a USING (doc_id)
"""
