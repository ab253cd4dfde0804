"""Operator 10: language identification by a bidirectional GRU over bytes.

The network reads the bytes of a word in both directions, starting afresh
at every word border (and after SEGMENT bytes of one word), and labels every
position.  A document's probabilities pool the log-probabilities of all its
positions.  Since a word's labels do not depend on its neighbours, a task
runs the network once per distinct word of a slice of whole texts and adds
up by occurrences; every byte of every text counts.

Training: backpropagation through time in numpy, on at most SAMPLE_ROWS
labelled documents (lowest hash of doc_id; WORDS_PER_ROW words spread evenly
over each whole text), held-out rows never among them.

Null text or text without a letter: ``und`` with score 0.  Null lang: not
learned from.  No learned language (also an empty table): every row ``und``.
Null id: remainder of the empty text.  Rows are independent, repeated ones
give equal rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carestar.llm.common import (Tokens, id_remainder, pick, read_table, slices, small_batches,
                                 stash, unstash)

SAMPLE_ROWS = 4000      # bound of the training sample
WORDS_PER_ROW = 24
EMBED, HIDDEN = 12, 12
SEGMENT = 24            # bytes a state runs on inside one word
STEPS, BATCH, RATE = 500, 256, 0.01
TOGETHER = 2 << 20      # bytes of text whose distinct words are labelled together
POOL = 0.25             # neighbouring positions are not independent


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _forward(p, side, codes, lengths, keep=False):
    """Hidden states (rows, steps, HIDDEN) reading ``codes`` left to right;
    a row's state stands still after its length."""
    table = p["embed"] @ p[side + "x"] + p[side + "b"]     # 256 x 3H
    u = p[side + "h"]
    n, steps = codes.shape
    h = np.zeros((n, HIDDEN), p["embed"].dtype)
    states = np.zeros((n, steps, HIDDEN), h.dtype)
    saved = []
    for t in range(steps):
        gx, gh = table[codes[:, t]], h @ u
        z = _sigmoid(gx[:, :HIDDEN] + gh[:, :HIDDEN])
        r = _sigmoid(gx[:, HIDDEN:2 * HIDDEN] + gh[:, HIDDEN:2 * HIDDEN])
        c = np.tanh(gx[:, 2 * HIDDEN:] + r * gh[:, 2 * HIDDEN:])
        on = (lengths > t)[:, None]
        new = np.where(on, (1 - z) * c + z * h, h)
        if keep:
            saved.append((h, z, r, c, gh[:, 2 * HIDDEN:], on))
        h = new
        states[:, t] = h
    return states, saved


def _backward(p, side, codes, saved, grad_states, grads):
    """Backpropagation through time of one direction."""
    u, wx = p[side + "h"], p[side + "x"]
    dh = np.zeros_like(grad_states[:, 0])
    for t in range(codes.shape[1] - 1, -1, -1):
        h, z, r, c, ghc, on = saved[t]
        dh = dh + grad_states[:, t]
        d = np.where(on, dh, 0)
        dz = d * (h - c) * z * (1 - z)
        dc = d * (1 - z) * (1 - c * c)
        dr = dc * ghc * r * (1 - r)
        gx = np.concatenate([dz, dr, dc], 1)
        gh = np.concatenate([dz, dr, dc * r], 1)
        e = p["embed"][codes[:, t]]
        grads[side + "x"] += e.T @ gx
        grads[side + "b"] += gx.sum(0)
        grads[side + "h"] += h.T @ gh
        np.add.at(grads["embed"], codes[:, t], gx @ wx.T)
        dh = np.where(on, d * z, dh) + gh @ u.T


def _reversed(codes, lengths):
    """Each row's own bytes back to front (padding stays behind)."""
    n, steps = codes.shape
    at = np.clip(lengths[:, None] - 1 - np.arange(steps)[None, :], 0, None)
    return np.take_along_axis(codes, at, 1), at


def _label(p, codes, lengths, keep=False):
    """Log-probabilities (rows, steps, classes) of every position."""
    back, at = _reversed(codes, lengths)
    f, sf = _forward(p, "f", codes, lengths, keep)
    b, sb = _forward(p, "b", back, lengths, keep)
    b = np.take_along_axis(b, at[:, :, None], 1)
    logits = f @ p["of"] + b @ p["ob"] + p["o"]
    logits = logits - logits.max(2, keepdims=True)
    logp = logits - np.log(np.exp(logits).sum(2, keepdims=True))
    return (logp, f, b, back, at, sf, sb) if keep else logp


def train(words: list[bytes], labels: np.ndarray, classes: int, seed: int = 7) -> dict:
    """Parameters learned from labelled words (Adam on the cross-entropy of
    every position)."""
    rng = np.random.default_rng(seed)
    shape = {"embed": (256, EMBED), "fx": (EMBED, 3 * HIDDEN), "fh": (HIDDEN, 3 * HIDDEN),
             "fb": (3 * HIDDEN,), "bx": (EMBED, 3 * HIDDEN), "bh": (HIDDEN, 3 * HIDDEN),
             "bb": (3 * HIDDEN,), "of": (HIDDEN, classes), "ob": (HIDDEN, classes), "o": (classes,)}
    p = {k: (rng.normal(0, 0.3, s) if len(s) > 1 else np.zeros(s)) for k, s in shape.items()}
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    codes, lengths, owner = segments(pa.array(words, pa.large_binary()))
    target = labels[owner]
    for step in range(1, STEPS + 1):
        pick_ = rng.integers(0, len(codes), BATCH)
        n = lengths[pick_]
        x = codes[pick_, :max(1, n.max())]
        logp, f, b, back, at, sf, sb = _label(p, x, n, keep=True)
        mask = np.arange(x.shape[1])[None, :] < n[:, None]
        g = np.exp(logp)
        g[np.arange(BATCH)[:, None], np.arange(x.shape[1])[None, :], target[pick_][:, None]] -= 1
        g *= mask[:, :, None] / mask.sum()
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        flat = g.reshape(-1, classes)
        grads["of"] = f.reshape(-1, HIDDEN).T @ flat
        grads["ob"] = b.reshape(-1, HIDDEN).T @ flat
        grads["o"] = flat.sum(0)
        gb = g @ p["ob"].T
        rows = np.arange(BATCH)[:, None]
        turned = np.zeros_like(gb)
        np.add.at(turned, (rows, at), gb)
        _backward(p, "f", x, sf, g @ p["of"].T, grads)
        _backward(p, "b", back, sb, turned, grads)
        for k in p:
            first[k] = 0.9 * first[k] + 0.1 * grads[k]
            second[k] = 0.999 * second[k] + 0.001 * grads[k] ** 2
            p[k] = p[k] - RATE * (first[k] / (1 - 0.9 ** step)) / (
                np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in p.items()}


def segments(words: pa.Array):
    """(codes, lengths, word index) of the words' stretches of at most
    SEGMENT bytes, zero-padded."""
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"\0", np.uint8)
    size = np.diff(offsets)
    parts = np.maximum(1, -(-size // SEGMENT))
    owner = np.repeat(np.arange(len(words)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = offsets[:-1][owner] + nth * SEGMENT
    length = np.minimum(SEGMENT, offsets[1:][owner] - start)
    at = np.minimum(start[:, None] + np.arange(SEGMENT)[None, :], max(0, len(data) - 1))
    codes = np.where(np.arange(SEGMENT)[None, :] < length[:, None], data[at], 0)
    return codes.astype(np.int64), length.astype(np.int64), owner


def word_scores(p: dict, words: pa.Array, classes: int):
    """Per word: summed log-probabilities by class, positions per own label."""
    codes, lengths, owner = segments(words)
    sums = np.zeros((len(words), classes))
    votes = np.zeros((len(words), classes))
    order = np.argsort(lengths, kind="stable")
    for k in range(0, len(order), 8192):
        rows = order[k:k + 8192]
        n = lengths[rows]
        x = codes[rows, :max(1, n.max())]
        logp = _label(p, x, n)
        on = np.arange(x.shape[1])[None, :] < n[:, None]
        np.add.at(sums, owner[rows], (logp * on[:, :, None]).sum(1))
        own = logp.argmax(2)
        for c in range(classes):
            np.add.at(votes[:, c], owner[rows], ((own == c) & on).sum(1))
    return sums, votes


def training_words(docs: DataFrame):
    """The bounded sample on the driver: words, class index per word, classes."""
    d = pick(docs, doc_id="bigint", text="string", lang="string")
    rows = d.where(F.col("text").isNotNull() & F.col("lang").isNotNull()
                   & (id_remainder(F.col("doc_id"), 4) != 2))
    total = rows.count()
    span = 1 << 30
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(span))
    # About a quarter more than needed passes the hash threshold.
    near = rows.where(mark < F.lit(int(span * min(1.0, 1.25 * SAMPLE_ROWS / max(total, 1)))))

    def spread(batches):
        for b in batches:
            words = []
            for text in b.column("text").to_pylist():
                own = text.encode("utf-8").split()
                words.append([own[i * len(own) // WORDS_PER_ROW] for i in range(WORDS_PER_ROW)]
                             if len(own) > WORDS_PER_ROW else own)
            yield pa.RecordBatch.from_arrays(
                [b.column("mark"), b.column("lang"), pa.array(words, pa.list_(pa.binary()))],
                names=["mark", "lang", "words"])

    got = (near.select(mark.alias("mark"), "lang", "text")
           .mapInArrow(spread, "mark bigint, lang string, words array<binary>")
           .orderBy("mark", "lang", "words").limit(SAMPLE_ROWS).collect())
    classes = sorted({r["lang"] for r in got})
    place = {c: i for i, c in enumerate(classes)}
    pairs = [(bytes(w), place[r["lang"]]) for r in got for w in r["words"]]
    return [w for w, _ in pairs], np.array([c for _, c in pairs], np.int64), classes


OUT = ("held_out boolean, has_letter boolean, lang_pred string, score double, label_share double, "
       "accepted boolean")


def identify(docs: DataFrame, with_rows: bool = False) -> DataFrame:
    """doc_id, held_out, has_letter, lang_pred, score, label_share (positions
    whose own label is the predicted one), accepted (a letter, and a share no
    smaller than an even split among the languages would give: below it the
    positions speak against the pooled language); ``with_rows`` carries the
    input row along as ``_row``."""
    small_batches(docs)
    words, labels, classes = training_words(docs)
    model = train(words, labels, len(classes)) if words else None
    d = stash(docs, doc_id="bigint", text="string")
    d = d.select(*(["_row"] if with_rows else []), "doc_id", "text",
                 (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
                 F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    kept = [c for c in d.columns if c in ("_row", "doc_id")]
    schema = StructType([d.schema[c] for c in kept] + list(StructType.fromDDL(OUT).fields))

    def run(batches):
        for batch in batches:
            for b in slices(batch, size=TOGETHER):
                yield _predict(b)

    def _predict(b):
        letter = b.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
        pred = np.full(b.num_rows, "und", object)
        score, share, accepted = np.zeros(b.num_rows), np.zeros(b.num_rows), letter
        if model is not None:
            t = Tokens(b.column("text"))
            sums, votes = word_scores(model, t.vocabulary, len(classes))
            k = len(classes)
            pooled = np.stack([np.bincount(t.doc, sums[t.index, c], b.num_rows)
                               for c in range(k)], 1)
            ballots = np.stack([np.bincount(t.doc, votes[t.index, c], b.num_rows)
                                for c in range(k)], 1)
            x = POOL * pooled
            prob = np.exp(x - x.max(1, keepdims=True))
            prob /= prob.sum(1, keepdims=True)
            best = prob.argmax(1)
            rows = np.arange(b.num_rows)
            pred = np.where(letter, np.array(classes, object)[best], "und")
            score = np.where(letter, prob[rows, best], 0.0)
            share = np.where(letter, ballots[rows, best] / np.maximum(1, ballots.sum(1)), 0.0)
            accepted = letter & (k * ballots[rows, best] >= ballots.sum(1))
        return pa.RecordBatch.from_arrays(
            [*[b.column(c) for c in kept], b.column("held_out"), b.column("has_letter"),
             pa.array(pred.tolist(), pa.string()), pa.array(score), pa.array(share),
             pa.array(accepted)],
            names=[*kept, "held_out", "has_letter", "lang_pred", "score", "label_share", "accepted"])

    return d.mapInArrow(run, schema)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language the network is sure of (``accepted``),
    with the input's columns.  Without any language to learn from only
    texts without a letter go."""
    found = identify(docs, with_rows=True).where("accepted")
    return unstash(found, docs)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))
