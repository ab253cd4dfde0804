"""Operator 5: toxicity by weak supervision.

Voters: words of a small lexicon, and words and word beginnings (patterns
of PREFIXES letters) mined from a bounded sample of labelled rows by how
much likelier they are among the words of toxic texts.  A voter votes on a
text if its hits reach the voter's share of the text's words.  A generative
label model estimates, by expectation maximisation over the sample's votes,
how often each voter fires on toxic and on clean texts (its accuracies) and
how the voters hang together given the class (their correlations);
correlated voters share their say.  Its posterior labels train a linear
classifier (logistic regression in numpy) on the votes and hit rates, which
scores every whole text.

Labels are learned from at most SAMPLE_ROWS labelled rows (lowest hash of
doc_id), never from held-out ones; lang, source and doc_id are no inputs.
Without toxic labels the lexicon alone votes.  Null text: as the empty text.
Null id: remainder of the empty id, no label.  Several labels of an id: the
largest.  Repeated rows get equal scores.  Empty table: no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.llm.common import Tokens, checkpoint, id_remainder, pick, read_table, slices

SAMPLE_ROWS = 12_000     # bound of the labelled sample
PREFIXES = (3, 4, 5, 6, 7, 8)
MAX_CANDIDATES = 20_000  # mined words and beginnings that are counted in clean texts
MAX_VOTERS = 64          # mined voters besides the lexicon
MIN_SUPPORT = 10         # toxic sample texts a mined voter occurs in
MIN_RATIO = 4.0          # how much likelier it is among the words of toxic texts
MIN_GAIN = 25.0          # nats of likelihood it gains at least
MIN_CORRELATION = 0.4    # below it voters count as independent
COST = 5                 # a false vote weighs so many right ones in a voter's threshold
PREDICT_AT = 0.3
EM_ROUNDS, TRAIN_ROUNDS = 15, 400

# The built-in lexicon.
LEXICON = ("clown", "disgusting", "dumb", "fool", "garbage", "idiot", "loser", "moron",
           "pathetic", "scum", "stupid", "trash", "ugly", "vermin", "worthless")

_LETTERS = re.compile(r"[^\W\d_]+")


def _features(word: bytes) -> list[str]:
    """Words of letters inside a token, and their beginnings."""
    out = []
    for w in _LETTERS.findall(word.decode("utf-8").lower()):
        out.append(w)
        out.extend(w[:k] + "*" for k in PREFIXES if len(w) >= k)
    return out


def sample_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic of the bounded labelled sample; checkpointed."""
    marked = (pick(labels, doc_id="bigint", toxic="int")
              .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)
                     & (id_remainder(F.col("doc_id"), 4) != 2))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS))
    d = pick(docs, doc_id="bigint", text="string").where("text is not null")
    return checkpoint(d.join(F.broadcast(marked), "doc_id")  # SAMPLE_ROWS rows at most
                      .select("doc_id", "text", "toxic"))


def mine(sample: DataFrame) -> tuple[list[str], float]:
    """Voters mined from the sample, and the share of toxic rows."""
    words = F.size(F.split("text", " "))
    share = sample.agg(F.sum("toxic").alias("t"), F.count("*").alias("n"),
                       F.sum(F.col("toxic") * words).alias("tw"), F.sum(words).alias("w")).first()
    toxic, rows = share["t"] or 0, share["n"]
    if not toxic or toxic == rows:
        return [], 0.05 if not toxic else 0.95
    in_toxic, in_clean = max(1, share["tw"]), max(1, share["w"] - share["tw"])

    def count(only):
        def run(batches):
            for batch in batches:
                seen: dict[str, list[int]] = {}
                for text in batch.column("text").to_pylist():
                    here: dict[str, int] = {}
                    for w, n in Counter(text.encode("utf-8").split()).items():
                        for f in _features(w):
                            if only is None or f in only:
                                here[f] = here.get(f, 0) + n
                    for f, n in here.items():
                        c = seen.setdefault(f, [0, 0])
                        c[0] += n
                        c[1] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen), pa.string()),
                     pa.array([c[0] for c in seen.values()], pa.int64()),
                     pa.array([c[1] for c in seen.values()], pa.int64())], names=["f", "n", "docs"])
        return run

    sums = [F.sum("n").alias("n"), F.sum("docs").alias("docs")]
    kind = "f string, n bigint, docs bigint"
    hot = (sample.where("toxic = 1").select("text").mapInArrow(count(None), kind)
           .groupBy("f").agg(*sums).where(F.col("docs") >= MIN_SUPPORT)
           .orderBy(F.col("docs").desc(), "f").limit(MAX_CANDIDATES).collect())
    only = {r["f"] for r in hot}
    cold = {r["f"]: r["n"] for r in sample.where("toxic = 0").select("text")
            .mapInArrow(count(only), kind).groupBy("f").agg(*sums).collect()}
    gains = []
    for r in hot:
        mine_, other = r["n"] / in_toxic, (cold.get(r["f"], 0) + 0.5) / in_clean
        if mine_ >= MIN_RATIO * other:  # gain in likelihood of telling the rates apart
            gains.append((r["n"] * np.log(mine_ / other) - in_toxic * (mine_ - other), r["f"]))
    chosen: list[str] = []
    for _, f in sorted((g for g in gains if g[0] >= MIN_GAIN), key=lambda g: (-g[0], g[1])):
        bare = f.rstrip("*")
        if any(bare.startswith(c.rstrip("*")) or (f.endswith("*") and c.startswith(bare))
               for c in chosen):
            continue
        chosen.append(f)
        if len(chosen) == MAX_VOTERS:
            break
    return chosen, toxic / rows


def thresholds(count: np.ndarray, words: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Per voter the rate of hits from which it votes: of the sample's
    rates the one with most right votes less COST times the false ones."""
    rate = count / np.maximum(1, words)[:, None]
    out = np.full(count.shape[1], 1e-9)
    for j in range(count.shape[1]):
        on = np.flatnonzero(count[:, j])
        if not len(on) or not (toxic[on] == 0).any():
            continue
        order = on[np.argsort(-rate[on, j], kind="stable")]
        gain = np.cumsum(np.where(toxic[order] == 1, 1, -COST))
        best = int(gain.argmax())
        out[j] = rate[order[best], j] if gain[best] > 0 else np.inf
    return out


def voters(mined: list[str]) -> dict[str, int]:
    return {f: i for i, f in enumerate(dict.fromkeys([*LEXICON, *mined]))}


def hits(texts: pa.Array, which: dict[str, int]):
    """(hits per text and voter, words per text)."""
    t = Tokens(texts)
    rows, cols = [], []
    for i, word in enumerate(t.words()):
        for f in _features(word):
            if f in which:
                rows.append(i)
                cols.append(which[f])
    table = np.zeros((len(t.vocabulary) + 1, len(which)), np.int32)
    np.add.at(table, (np.array(rows, np.int64), np.array(cols, np.int64)), 1)
    some = np.flatnonzero(table.any(1))
    out = np.zeros((len(texts), len(which)), np.int64)
    on = np.isin(t.index, some)
    np.add.at(out, t.doc[on], table[t.index[on]])
    return out, t.counts


class LabelModel:
    """Latent class model of the votes: a voter fires at one rate on toxic
    texts and at another on clean ones, and abstains otherwise; that no
    voter fires is evidence of its own.  Voters that are correlated given
    the class share their say."""

    def __init__(self, votes: np.ndarray, prior: float):
        votes = votes.astype(np.float64)
        m = votes.shape[1]
        self.prior = prior
        post = np.where(votes.any(1), 0.8, 0.02)
        for _ in range(EM_ROUNDS):
            on, off = post.sum(), (1 - post).sum()
            self.fire = (votes.T @ post + 0.5) / (on + 10.0)            # given toxic
            self.false = (votes.T @ (1 - post) + 0.05) / (off + 10.0)   # given clean
            rest = votes - post[:, None] * self.fire - (1 - post[:, None]) * self.false
            spread = np.sqrt((rest ** 2).mean(0)) + 1e-9
            self.correlation = (rest.T @ rest) / len(rest) / spread[:, None] / spread[None, :]
            strong = np.where(self.correlation >= MIN_CORRELATION, self.correlation, 0.0)
            together = np.clip(strong - np.eye(m), 0, 1).sum(1)
            self.weight = np.log(self.fire / self.false) / (1 + together)
            silent = ~votes.any(1)
            self.silence = np.log((silent @ post + 0.5) / (on + 1)) - np.log(
                (silent @ (1 - post) + 0.5) / (off + 1))
            post = self.posterior(votes)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        x = np.log(self.prior / (1 - self.prior)) + votes @ self.weight \
            + np.where(votes.any(1), 0.0, self.silence)
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def inputs(count: np.ndarray, words: np.ndarray, least: np.ndarray):
    """(votes, classifier inputs): votes, hit rates relative to the
    thresholds, any vote, the largest relative rate, constant."""
    rate = count / np.maximum(1, words)[:, None]
    votes = rate >= least[None, :]
    ratio = np.where(count > 0, np.minimum(2.0, rate / np.maximum(least, 1e-3)[None, :]), 0.0)
    return votes, np.column_stack([votes, ratio, votes.any(1), ratio.max(1), np.ones(len(count))]
                                  ).astype(np.float64)


def train(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression on soft labels (gradient descent, L2)."""
    w = np.zeros(x.shape[1])
    momentum = np.zeros_like(w)
    for _ in range(TRAIN_ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        momentum = 0.9 * momentum + x.T @ (p - y) / len(y) + 1e-4 * np.append(w[:-1], 0)
        w = w - 0.5 * momentum
    return w


def fit(docs: DataFrame, labels: DataFrame):
    """(voters, their thresholds, classifier weights) from the sample."""
    sample = sample_rows(docs, labels)
    mined, prior = mine(sample)
    which = voters(mined)

    def vote(batches):
        for batch in batches:
            for b in slices(batch):
                count, words = hits(b.column("text"), which)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(count.tolist(), pa.list_(pa.int64())), pa.array(words),
                     b.column("toxic"), b.column("doc_id")],
                    names=["count", "words", "toxic", "doc_id"])

    rows = sample.mapInArrow(vote, "count array<bigint>, words bigint, toxic int, doc_id bigint"
                             ).orderBy("doc_id").toArrow()  # SAMPLE_ROWS rows at most
    m = len(which)
    if not mined:
        x = np.zeros(2 * m + 3)
        x[2 * m], x[-1] = 6.0, -3.0  # any vote of the lexicon decides
        return which, np.full(m, 1e-9), x
    count = np.array(rows.column("count").to_pylist(), np.int64).reshape(rows.num_rows, m)
    words, toxic = rows.column("words").to_numpy(), rows.column("toxic").to_numpy()
    least = thresholds(count, words, toxic)
    votes, x = inputs(count, words, least)
    model = LabelModel(votes, float(np.clip(prior, 0.01, 0.99)))
    return which, least, train(x, model.posterior(votes.astype(np.float64)))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_votes for every document."""
    which, least, weights = fit(docs, labels)
    d = pick(docs, doc_id="bigint", text="string").select(
        "doc_id", "text", (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"))

    def run(batches):
        for batch in batches:
            for b in slices(batch):
                count, words = hits(b.column("text"), which)
                votes, x = inputs(count, words, least)
                p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("held_out"), pa.array(p),
                     pa.array((p >= PREDICT_AT).astype(np.int32)), pa.array(votes.sum(1))],
                    names=["doc_id", "held_out", "score", "predicted", "n_votes"])

    return d.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int, "
                        "n_votes bigint")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
