"""The dealt operators against brute force, round trips and edge cases."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

SF = "/root/testdata/sf0.001"


def words(text, lower=False):
    raw = (text or "").encode("utf-8")
    return (raw.lower() if lower else raw).split()


def rows(df):
    return [r.asDict() for r in df.collect()]


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# ---- shared helpers ---------------------------------------------------------

def test_word_hashes_agree_with_split():
    from carestar.llm.common import WordHashes
    texts = ["", None, " a\x0bb ", "A a", "x" * 3_000_000 + " a", "é b c"]
    for lower in (False, True):
        t = WordHashes(pa.array(texts).slice(1), lower=lower)
        expected = [w for x in texts[1:] for w in words(x, lower)]
        assert len(t.hash) == len(expected)
        seen = {}
        for w, h in zip(expected, t.hash.tolist()):
            assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_running_totals_and_components(spark):
    from carestar.llm.common import components, running
    df = spark.range(1000).selectExpr("(id * 37) % 1000 as k", "id % 7 as v").repartition(5)
    got = sorted(rows(running(df, ["k"], ["v"])), key=lambda r: r["k"])
    total = 0
    for i, r in enumerate(got):
        assert (r["rank"], r["before_v"]) == (i, total)
        total += r["v"]
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r["v"]: r["component"] for r in rows(components(
        spark.createDataFrame(edges, "a long, b long")))}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# ---- 1: mixing --------------------------------------------------------------

def test_mix_budgets_and_edges(spark, documents, no_documents):
    from carestar.llm.mixing import mix, plan_mix
    got = rows(plan_mix(documents))
    assert len(got) == documents.count()
    size = {s: sum(r["size"] for r in got if r["skey"] == s) for s in {r["skey"] for r in got}}
    for r in got:
        assert r["source_size"] == size[r["skey"]] and 0 <= r["taken"] <= 2 * r["size"]
        assert r["target"] <= 2 * r["source_size"]
    assert sum({r["skey"]: r["target"] for r in got}.values()) == pytest.approx(
        1.5 * sum(size.values()))
    for s in size:
        mine = [r for r in got if r["skey"] == s]
        assert sum(r["taken"] for r in mine) == int(mine[0]["target"])
    out = mix(documents)
    assert out.columns == documents.columns
    assert sum(len(words(r["text"])) for r in rows(out)) == sum(r["taken"] for r in got)
    assert mix(no_documents).count() == 0 and plan_mix(no_documents).count() == 0


# ---- 2: fingerprints --------------------------------------------------------

def test_fingerprints(spark, documents, no_documents):
    from carestar.llm import simhash
    simhash_rows, simhash.BLOCK_ROWS = simhash.BLOCK_ROWS, 3  # several order blocks
    try:
        got = rows(simhash.fingerprints(documents))
    finally:
        simhash.BLOCK_ROWS = simhash_rows
    order = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")
                    for r in rows(documents)))
    expected = Counter()
    for k, (null, i, text) in enumerate(order):
        other = order[(k + 1) % len(order)][2]
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        expected[(None if null else i, len(text), hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == expected
    prints = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints.setdefault(r["doc_id"], set()).add((r["f1"], r["f2"]))
    assert prints[0] == prints[1] == prints[13] and prints[5] == prints[6] == prints[7] == {(0, 0)}
    assert simhash.fingerprints(no_documents).count() == 0


def test_fingerprint_search_finds_all(spark):
    from carestar.llm.simhash import RADIUS, near_fingerprints
    rng = np.random.default_rng(3)
    base = rng.integers(-2**62, 2**62, (12, 2))
    out = []
    for a, b in base.tolist():
        for flips in range(9):
            x, y = a, b
            for bit in rng.choice(127, flips, replace=False).tolist():
                if bit < 63:
                    x ^= 1 << bit
                elif bit < 126:
                    y ^= 1 << (bit - 63)
            out.append((x, y))
    df = spark.createDataFrame(out, "f1 long, f2 long")
    got = {(r["q1"], r["q2"], r["f1"], r["f2"]) for r in rows(near_fingerprints(df, df))}
    far = lambda p, q: sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(p, q))
    assert got == {(*p, *q) for p in set(out) for q in set(out) if 0 < far(p, q) <= RADIUS}


def test_fingerprint_tables_are_never_broadcast(spark):
    """F1 of round 4: the tables' rows are exploded, their size is Spark's guess from before."""
    from pyspark.sql import functions as F
    from carestar.llm.simhash import near_fingerprints
    prints = spark.range(4000).select(F.xxhash64("id", F.lit(1)).alias("f1"),
                                      F.xxhash64("id", F.lit(2)).alias("f2"))
    near = near_fingerprints(prints, prints.limit(40))
    near.collect()
    assert "BroadcastExchange" not in near._jdf.queryExecution().executedPlan().toString()


# ---- 3: LM ------------------------------------------------------------------

def test_lm_scores_are_probabilities(spark):
    from carestar.llm import pitman_yor as lm
    train = ["a b c a b", "a b d", "b b c", ""] * 3
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(train)], "doc_id long, text string")
    model = lm.learn(docs)
    table = rows(model.table)
    assert model.vocabulary == 5 and model.tokens == sum(len(t.split()) + 1 for t in train)
    for context in range(lm.CONTEXTS):  # every context's words and the unknown one add up to 1
        up = context // lm.CHILDREN
        total = 0.0
        for r in [*table, None]:
            a0 = r["a0"] if r else 0.0
            a1 = dict(zip(r["par"], r["a1"])).get(up, 0.0) if r else 0.0
            a2 = dict(zip(r["ctx"], r["a2"])).get(context, 0.0) if r else 0.0
            total += a2 + model.g2[context] * (a1 + model.g1[up] * (a0 + model.unseen))
        assert total == pytest.approx(1.0)


def test_lm_learns_the_preceding_word(spark):
    from carestar.llm import pitman_yor as lm
    train = ["the cat", "she dog"] * 20 + ["a cat b dog", ""]
    held = ["the cat", "the dog", "she dog", "she cat", "never seen cat"]  # the, she: one class
    docs = spark.createDataFrame([(i, t, i >= len(train)) for i, t in enumerate(train + held)],
                                 "doc_id long, text string, held_out boolean")
    model = lm.learn(docs.where("not held_out"))
    w, _, doc = lm.token_stream(pa.array(train))
    h, prev = lm.bigrams_of(w, doc)
    pairs = {r["h"]: r for r in rows(model.pairs)}
    before = {r["prev"]: r for r in rows(model.before)}
    assert {k: r["n"] for k, r in pairs.items()} == Counter(h.tolist())
    assert {k: r["total"] for k, r in before.items()} == Counter(prev.tolist())
    for p, r in before.items():  # a restaurant's words and its back-off add up to 1
        mass = sum(pairs[x]["mass"] for x in set(h[prev == p].tolist()))
        assert mass / (lm.WORD_STRENGTH + r["total"]) + r["back"] == pytest.approx(1.0)
    results = []
    for hot in (lm.HOT_WORDS, 0):  # also with all terms joined
        was, lm.HOT_WORDS = lm.HOT_WORDS, hot
        try:
            results.append({r["doc_id"]: r["score"] for r in rows(lm.score(docs, model))})
        finally:
            lm.HOT_WORDS = was
    assert results[0] == pytest.approx(results[1], abs=1e-4)
    the_cat, the_dog, she_dog, she_cat, _ = [results[0][len(train) + k] for k in range(5)]
    assert the_cat > the_dog + 0.5 and she_dog > she_cat + 0.5
    assert results[0][0] == pytest.approx(the_cat)  # trained or held out: one probability


def test_lm_keeps_only_what_the_held_out_texts_ask_for(spark):
    """op3_lm_score of round 3: disk.  Scores are those with every bigram kept."""
    import os
    from carestar.llm import pitman_yor as lm
    from carestar.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    train = ["a b c a b", "a b d", "rare one here", "b b c", "other rare words", ""]
    held = ["a b rare one", "unseen c a", "here b", ""]
    docs = spark.createDataFrame([(i, t, i >= len(train)) for i, t in enumerate(train + held)],
                                 "doc_id long, text string, held_out boolean")
    learned, asked = docs.where("not held_out"), docs.where("held_out")
    before = set(os.listdir(folder))
    model, whole = lm.learn(learned, asked), lm.learn(learned)
    left = {name for new in set(os.listdir(folder)) - before if new.startswith("lm-")
            for name in os.listdir(os.path.join(folder, new))}
    assert left == {str(lm.PASSES), f"seats{lm.PASSES}", f"before{lm.PASSES}"}
    w, _, doc = lm.token_stream(pa.array(train))
    counts = Counter(lm.bigrams_of(w, doc)[0].tolist())
    w, _, doc = lm.token_stream(pa.array(held))
    wanted = set(lm.bigrams_of(w, doc)[0].tolist())
    assert {r["h"]: r["n"] for r in rows(whole.pairs)} == counts
    assert {r["h"]: r["n"] for r in rows(model.pairs)} == {
        h: n for h, n in counts.items() if n > 1 or h in wanted}
    results = []
    for m, hot in ((whole, lm.HOT_WORDS), (model, lm.HOT_WORDS), (model, 0)):
        was, lm.HOT_WORDS = lm.HOT_WORDS, hot
        try:
            results.append({r["doc_id"]: r["score"] for r in rows(lm.score(docs, m))})
        finally:
            lm.HOT_WORDS = was
    assert results[0] == pytest.approx(results[1]) and results[0] == pytest.approx(results[2], abs=1e-4)


def test_lm_bigrams_that_pass_a_filter_were_learned_once(spark, monkeypatch):
    """F3 of round 4: a learned bigram that a filter let pass by mistake lost its own mass."""
    from carestar.llm import pitman_yor as lm
    train = ["a b c a b", "a b d", "rare one here", "b b c", "other rare words", ""]
    held = ["a b rare one", "unseen c a", "here b", ""]
    docs = spark.createDataFrame([(i, t, i >= len(train)) for i, t in enumerate(train + held)],
                                 "doc_id long, text string, held_out boolean")
    learned, asked = docs.where("not held_out"), docs.where("held_out")
    expected = {r["doc_id"]: r["score"] for r in rows(lm.score(docs, lm.learn(learned)))}
    monkeypatch.setattr(lm, "HOT_WORDS", 0)
    monkeypatch.setattr(lm, "_filter", lambda ids, column: np.full(1024, -1))  # lets everything pass
    got = {r["doc_id"]: r["score"] for r in rows(lm.score(docs, lm.learn(learned, asked)))}
    assert got == pytest.approx(expected, abs=1e-4)


def test_lm_bigrams_are_averaged_over_samples(spark):
    """F3 of round 4: the tables of bigrams were drawn once, now as often as the levels above."""
    from carestar.llm import pitman_yor as lm
    train = [f"a w{i % 40} b w{i % 7}" for i in range(900)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(train)], "doc_id long, text string")
    model = lm.learn(docs)
    pairs = rows(model.pairs)
    tables = [(r["n"] - r["mass"]) / lm.WORD_DISCOUNT for r in pairs]
    assert all(1 - 1e-9 <= t <= r["n"] + 1e-9 for t, r in zip(tables, pairs))
    parts = [round(t * lm.SAMPLES, 6) % lm.SAMPLES for t in tables]
    assert {0, 1} <= set(parts) and set(parts) <= set(range(lm.SAMPLES))
    w, _, doc = lm.token_stream(pa.array(train))
    h, prev = lm.bigrams_of(w, doc)
    of = {r["h"]: r["mass"] for r in pairs}
    for r in rows(model.before):  # a restaurant's words and its back-off still add up to 1
        mass = sum(of[x] for x in set(h[prev == r["prev"]].tolist()))
        assert mass / (lm.WORD_STRENGTH + r["total"]) + r["back"] == pytest.approx(1.0)


def test_table_draws_follow_the_conditional():
    from carestar.llm.pitman_yor import _stirling, draw_tables
    c, d, weight, n = 5, 0.6, 1.7, 40_000
    got = draw_tables(np.full(n, c), np.full(n, weight), d, np.arange(n, dtype=np.uint64) * np.uint64(7919))
    logit = _stirling(d)[c, 1:c + 1] + np.arange(1, c + 1) * np.log(weight)
    p = np.exp(logit - np.logaddexp.reduce(logit))
    assert np.abs(np.bincount(got, minlength=c + 1)[1:] / n - p).max() < 0.01
    big = draw_tables(np.array([100_000]), np.array([50.0]), 0.5, np.array([1], np.uint64))
    assert 1 <= big[0] <= 100_000


def test_lm_base_score_and_hot_words(spark, documents, no_documents):
    from pyspark.sql import functions as F
    from carestar.llm import pitman_yor as lm
    d = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2)
    counts = Counter()
    for r in rows(d):
        if not r["held_out"]:
            counts.update(words(r["text"], True) + ["end"])
    total, distinct = sum(counts.values()), len(counts)
    model = lm.learn(d.where("not held_out"))
    results = []
    for hot in (lm.HOT_WORDS, 0):
        before, lm.HOT_WORDS = lm.HOT_WORDS, hot
        try:
            results.append(sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"],
                                   round(r["base_score"], 6), round(r["score"], 2))
                                  for r in rows(lm.score(d, model))))
        finally:
            lm.HOT_WORDS = before
    assert results[0] == results[1]
    expected = sorted((r["doc_id"] is None, r["doc_id"] or 0, len(w := words(r["text"], True) + ["end"]),
                       sum(counts[x] > 0 for x in w),
                       round(sum(np.log10((counts[x] + 1) / (total + distinct + 1)) for x in w), 6))
                      for r in rows(d))
    assert [r[:5] for r in results[0]] == expected
    assert lm.score(d.where("1 = 0"), lm.learn(d.where("1 = 0"))).count() == 0


# ---- 4: BPE -----------------------------------------------------------------

def test_bpe_matches_tiktoken_and_round_trips(spark, documents, no_documents):
    import public_tokenizers as P
    import tiktoken
    from carestar.llm.bpe import Codec, Utf8Stream, encode_documents
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = Codec()
    rng = np.random.default_rng(5)
    letters = "abcdehinorst étïñß 漢字🙂\n\t'0123 .,<|>\x1c\x85  "
    texts = ["".join(rng.choice(list(letters), n)) for n in rng.integers(0, 300, 150)]
    texts += ["a" * 5000, "antidisestablishment" * 300, "=" * 999, " " * 777 + "x", "\r\n\r\n it's"]
    for t in texts:
        ids = codec.encode(t)
        assert ids == enc.encode_ordinary(t)
        assert codec.decode(ids) == t
    raw = "añ漢🙂z".encode()
    stream = Utf8Stream()
    assert "".join(stream.feed(raw[i:i + 1]) for i in range(len(raw))) + stream.end() == raw.decode()
    got = rows(encode_documents(documents))
    assert Counter(r["decoded_sha256"] for r in got) == Counter(
        hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in rows(documents))
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    assert encode_documents(no_documents).count() == 0


# ---- 5: toxicity ------------------------------------------------------------

def test_toxicity_held_out_accuracy(spark):
    from carestar.llm.toxicity import op5_toxicity
    sf = "/root/testdata/sf0.1"
    got = op5_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    held = [r for r in rows(got.where("held_out"))]
    hit = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in held)
    assert hit / sum(r["toxic"] for r in held) >= 0.85
    assert hit / sum(r["predicted"] for r in held) >= 0.9


def test_toxicity_edges(spark, documents, no_documents):
    from carestar.llm.toxicity import score
    labels = spark.createDataFrame([(0, None), (None, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in rows(score(documents, labels))}
    assert got[100]["predicted"] == 1 and got[0]["predicted"] == 0 and got[5]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert got[8]["held_out"] == (zlib.crc32(b"8") % 4 == 2)
    assert score(no_documents, labels).count() == 0


# ---- 6: chat ----------------------------------------------------------------

def test_chat_round_trip(spark):
    from carestar.llm.chat import END, START, expand, read_back
    nasty = ["<|im_end|>", "<\\|im_start|>x", "<", "|", "<\\\\|", "a\\", "", None, "\n<|im_end|>\n"]
    turns = [(c, t, ("user", "assistant", None, "sys\\tem\nrole")[(c + t) % 4], nasty[(c * 5 + t) % 9])
             for c in (1, 2, 3) for t in range(9)]
    turns += [(4, 0, "user", "no answer"), (None, 0, "user", "q"), (None, 1, "assistant", "a"),
              (0, 1, "assistant", "same turn"), (0, 1, "assistant", "same turn"), (0, None, "user", "z")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    key = lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or "")
    expected = {}
    for c in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == c), key=key)
        told = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        expected[c] = (len(own), hashlib.sha256(told.encode()).hexdigest(), len(loss),
                       hashlib.sha256(loss.encode()).hexdigest())
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
           for r in rows(read_back(expand(df)))}
    assert got == expected
    for r in rows(expand(df)):  # a context is all turns before: only whole turns, one span each
        assert r["formatted"].startswith(START) and r["formatted"].endswith(f"{END}\n")
        if r["loss_end"] > r["loss_start"]:
            assert r["formatted"][r["loss_end"]:] == f"{END}\n"
    assert read_back(expand(df.where("1 = 0"))).count() == 0


# ---- 7: cover tree ----------------------------------------------------------

def test_embedding_links_of_extreme_magnitudes(spark):
    """Cosine does not depend on length: 1e200 and 1e-200 link as 1 does,
    and what does not link at length 1 does not link there."""
    from carestar.llm import covertree
    base, near, far = [1.0, 2.0, 3.0], [1.0, 2.0, 3.3], [3.0, -1.0, 0.5]
    data = [(10 * k + i, [x * size for x in v]) for k, size in enumerate((1.0, 1e200, 1e-200, 1e-308))
            for i, v in enumerate((base, near, far))]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows(covertree.near_links(df))}
    for i, _ in data:
        assert got[i] == ((3, 2) if i % 10 == 2 else (7, 0)), (i, got[i])


def test_embedding_links_against_brute_force(spark):
    from carestar.llm import covertree
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    v = np.concatenate([c + rng.normal(scale=s, size=(60, 8))
                        for c, s in zip(centres, (0.01, 0.2, 0.5, 0.6, 0.8, 2.0))])
    data = [(i, [float(y) for y in x]) for i, x in enumerate(v)]
    data += [(1000 + i, data[i][1]) for i in range(20)] + [(1100, [2 * y for y in data[0][1]])]
    odd = [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [float("nan")] * 8),
           (2004, [float("inf")] + [1.0] * 7), (2005, [None] + [1.0] * 7), (2006, [1.0, 2.0]),
           (2007, [1.0, 2.0])]
    df = spark.createDataFrame([(i, x, "z") for i, x in data + odd],
                               "vec_id long, embedding array<double>, rep string")
    before = covertree.BLOCK, covertree.PIVOTS
    covertree.BLOCK, covertree.PIVOTS = 100, 40
    try:
        got = {r["vec_id"]: r for r in rows(covertree.near_links(df))}
    finally:
        covertree.BLOCK, covertree.PIVOTS = before
    ids = [i for i, _ in data] + [2006, 2007]
    vec = [np.array(x) for _, x in data] + [np.array([1.0, 2.0])] * 2
    links = {i: set() for i in ids}
    for a in range(len(ids)):
        for b in range(a):
            if len(vec[a]) == len(vec[b]) and vec[a] @ vec[b] >= 0.9 * np.sqrt(
                    (vec[a] @ vec[a]) * (vec[b] @ vec[b])):
                links[ids[a]].add(ids[b])
                links[ids[b]].add(ids[a])
    comp = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            low = min([comp[i], *(comp[j] for j in links[i])])
            changed |= low != comp[i]
            comp[i] = low
    for i in ids:
        assert (got[i]["n_links"], got[i]["component_id"]) == (len(links[i]), comp[i])
        assert got[i]["kept"] == (comp[i] == i)
    for i in range(2000, 2006):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert covertree.near_links(df.where("1 = 0")).count() == 0


def test_dual_traversal_loses_no_pair():
    from carestar.llm.covertree import dual_traversal, unit
    rng = np.random.default_rng(4)
    a = unit(np.concatenate([rng.normal(size=(1, 6)) + rng.normal(scale=0.1, size=(300, 6)),
                             rng.normal(size=(300, 6))]))
    b = unit(rng.normal(size=(500, 6)))
    for x, y, same in ((a, b, False), (a, a, True)):
        found = np.zeros((len(x), len(y)), bool)

        def visit(p, q):
            found[np.ix_(p, q)] = True
            if same:
                found[np.ix_(q, p)] = True

        dual_traversal(x, y, 0.9, same, visit)
        assert found[(x @ y.T) >= 0.9].all()


# ---- 8: Jaccard -------------------------------------------------------------

def brute_components(docs):
    sets = []
    for i, text in docs:
        w = words(text, True)
        grams = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        sets.append((i, grams))
    comp = list(range(len(sets)))
    linked = [(a, b) for a in range(len(sets)) for b in range(a)
              if sets[a][1] and sets[b][1] and 100 * len(sets[a][1] & sets[b][1])
              >= 80 * len(sets[a][1] | sets[b][1])]
    for _ in range(len(sets)):
        for a, b in linked:
            comp[a] = comp[b] = min(comp[a], comp[b])
    low = {}
    for (i, _), c in zip(sets, comp):
        low[c] = min(low.get(c, i), i)
    return {i: (len(s), low[c]) for (i, s), c in zip(sets, comp)}


def test_jaccard_against_brute_force(spark):
    from carestar.llm.jaccard import join_documents
    rng = np.random.default_rng(8)
    vocabulary = [f"t{i}" for i in range(200)]
    docs = []
    for k in range(160):
        if k % 4 and docs:  # an edited copy of an earlier text
            w = docs[int(rng.integers(len(docs)))].split()
            for _ in range(int(rng.integers(0, 4))):
                if w:
                    w[int(rng.integers(len(w)))] = str(rng.choice(vocabulary))
            docs.append(" ".join(w[int(rng.integers(0, 2)):]).upper() if k % 8 == 1 else " ".join(w))
        else:
            docs.append(" ".join(rng.choice(vocabulary, int(rng.choice([1, 4, 5, 6, 9, 14, 40, 300])))))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(join_documents(df))}
    assert got == brute_components(list(enumerate(docs)))


def test_jaccard_blocks_lose_no_linked_pair():
    from carestar.llm.jaccard import signatures
    rng = np.random.default_rng(9)
    for size in (1, 2, 3, 4, 5, 8, 9, 18, 45, 100, 127, 128, 900):
        for _ in range(20):
            common = rng.integers(0, 2**63, size, dtype=np.uint64)
            spare = (size * 2) // 9  # differences so that J stays at or above 0.8
            left = int(rng.integers(0, spare // 2 + 1))
            a = common[left:]
            b = np.concatenate([common, rng.integers(0, 2**63, max(0, spare // 4 - left), dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if not len(a) or 100 * both < 80 * (len(a) + len(b) - both):
                continue
            key, doc = signatures(np.concatenate([a, b]), None, np.array([len(a), len(b)]))
            assert set(key[doc == 0].tolist()) & set(key[doc == 1].tolist())


def test_jaccard_links_against_brute_force(spark, documents, monkeypatch):
    from carestar.llm import jaccard
    rng = np.random.default_rng(12)
    base = [f"b{i}" for i in range(70)]
    docs = []
    for k in range(90):  # near copies of one text, most of them linked with each other
        w = list(base)
        for _ in range(int(rng.integers(0, 3))):
            w[int(rng.integers(70))] = f"e{int(rng.integers(9))}"
        docs.append(" ".join(w))
    docs += [" ".join(rng.choice([f"z{i}" for i in range(40)], int(rng.choice([3, 20, 60]))))
             for _ in range(20)]
    docs += docs[-3:] + [None, "", docs[0].upper()]
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
            for w in (words(t, True) for t in docs)]
    pairs = {(a, b) for b in range(len(sets)) for a in range(b)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    expected = Counter(x for p in pairs for x in p)
    assert len(pairs) > 1000
    first = {}
    low = [first.setdefault(frozenset(x), i) for i, x in enumerate(sets)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    expected_pairs = {(low[a], low[b]) if low[a] < low[b] else (low[b], low[a])
                      for a, b in pairs if low[a] != low[b]}
    for chunk in (jaccard.CHUNK, 16):  # also with the component cut into chunk pairs
        monkeypatch.setattr(jaccard, "CHUNK", chunk)
        got = {r["doc_id"]: r["n_links"] for r in rows(jaccard.join_documents(df))}
        assert got == {i: expected[i] for i in range(len(docs))}
    found = [(r["a"], r["b"]) for r in rows(jaccard.linked_pairs(df))]
    assert len(found) == len(set(found)) and set(found) == expected_pairs
    # The lists and the bit sets find the same; rows without an id have no links.
    values = np.array([1, 2, 3, 4, 5, 1, 2, 3, 4, 5, 6, 7, 8, 9], np.int64)
    far = np.concatenate([values, np.repeat(np.arange(100, 400), 2)])
    sizes = np.array([5, 5, 4, *[1] * 600])
    at = np.arange(3)
    assert [(x, r.tolist()) for x, r in jaccard._links(far, sizes, at, at, True)] == [(0, [1])]
    assert [(x, r.tolist()) for x, r in jaccard._links(values, sizes[:3], at, at, True)] == [(0, [1])]
    edges = {r["doc_id"]: r["n_links"] for r in rows(jaccard.join_documents(documents))}
    assert edges[None] == 0 and edges[5] == edges[6] == 0 and edges[8] == edges[9] == 1


def test_jaccard_edges(spark, documents, no_documents):
    from carestar.llm.jaccard import join_documents, keep_one
    got = rows(join_documents(documents))
    by = {r["doc_id"]: r for r in got}
    assert len(got) == documents.count()
    assert by[1]["component_id"] == by[13]["component_id"] == by[2]["component_id"] == 0
    assert by[9]["component_id"] == 8 and by[5]["component_id"] == 5 and by[6]["n_shingles"] == 0
    kept = keep_one(documents)
    assert kept.columns == documents.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows(kept))
    assert [i for n, i in ids if not n and i in (0, 1, 2, 13)] == [0] and (True, 0) in ids
    assert keep_one(no_documents).count() == 0


# ---- 9: substring dedup -----------------------------------------------------

def test_substring_against_brute_force(spark, documents, no_documents):
    from carestar.llm import substring
    rng = np.random.default_rng(10)
    words_ = [f"v{i}" for i in range(50)]
    passages = [" ".join(rng.choice(words_, n)) for n in (13, 14, 30, 200)]
    texts = []
    for k in range(80):
        parts = [" ".join(rng.choice(words_, int(rng.integers(0, 30))))]
        parts += [passages[int(rng.integers(4))] for _ in range(int(rng.integers(0, 3)))]
        parts.append(" ".join(rng.choice(words_, int(rng.integers(0, 30)))))
        texts.append("\n".join(parts))
    texts += [texts[3], None, "", "z " * 300, "z " * 20]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    first = {}
    for i, t in enumerate(texts):
        w = words(t)
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k:k + 13]), i)
    expected = {}
    for i, t in enumerate(texts):
        w = words(t)
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < i for j in range(k, k + 13)}
        expected[i] = (len(w), len(gone), hashlib.sha256(
            b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest())
    for share in (substring.HOT_SHARE, 10**9):  # also with every minimizer spread
        before, places = substring.HOT_SHARE, substring.SHARD_PLACES
        substring.HOT_SHARE = share
        substring.SHARD_PLACES = 40 if share == before else 1
        try:
            got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
                   for r in rows(substring._cut(df, shown=False))}
        finally:
            substring.HOT_SHARE, substring.SHARD_PLACES = before, places
        assert got == expected
    cut = substring.cut_repeats(documents)
    assert cut.columns == documents.columns
    kept = {r["doc_id"]: r["text"] for r in rows(cut)}
    assert 1 not in kept and kept[0] is not None and kept[4] == "tail words here" and 5 in kept
    assert kept[None] == "row without an id"
    assert substring.cut_repeats(no_documents).count() == 0


def test_substring_hot_minimizer_is_split_over_shards():
    from carestar.llm import substring as sub
    from carestar.llm.common import WordHashes
    rng = np.random.default_rng(11)
    passage = " ".join(f"p{i}" for i in range(14))  # other words after it in every document
    texts = pa.array([passage + " " + " ".join(f"d{k}x{i}" for i in range(12)) for k in range(600)])
    w = WordHashes(texts)
    grams, start, place = sub.minimizers(w)
    own = grams[place].view(np.int64)
    value, n = np.unique(own, return_counts=True)
    hot = value[n >= 600]
    gram, lo, hi, seg = sub._segments(w, np.full(4, -1, np.int64), hot)  # a filter that lets all by
    is_hot = np.isin(gram, hot)
    # Every window of a hot minimizer travels alone.
    assert len(hot) and is_hot.any() and (hi - lo)[is_hot].max() == sub.WINDOW
    value, n = np.unique(seg[is_hot], return_counts=True)
    common = value[n >= 600]
    shards, text_id = 8, rng.integers(0, 2**62, len(texts))[w.doc[lo]]
    lookups, to, rows_ = sub.route(gram, seg, text_id, w.doc[lo], hot, common, shards)
    held = {}
    for s, r in zip(to.tolist(), rows_.tolist()):
        if is_hot[r]:
            held.setdefault(s, set()).add(int(seg[r]))
    distinct = len(value)
    assert distinct > 600 and max(map(len, held.values())) < distinct / 8
    # Every lookup finds its window's entry in its shard.
    assert all(int(x) in held[int(s)] for s, x in zip(lookups[is_hot], seg[is_hot]))


# ---- 10: language -----------------------------------------------------------

def test_language_held_out_accuracy(spark):
    from carestar.llm.langid import identify
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = rows(identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out"))
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) >= 0.98


def test_language_edges(spark, documents, no_documents):
    from carestar.llm.langid import identify, keep_identified
    got = {r["doc_id"]: r for r in rows(identify(documents))}
    for i in (5, 6, 7, 14):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert got[0]["lang_pred"] in ("en", "fr", "de") and 0 < got[0]["score"] <= 1
    kept = keep_identified(documents)
    assert kept.columns == documents.columns
    assert {r["doc_id"] for r in rows(kept)}.isdisjoint({5, 6, 7, 14})
    assert all(r["accepted"] == (r["has_letter"] and r["label_share"] >= 1 / 3 - 1e-9)
               for r in got.values())
    assert identify(no_documents).count() == 0 and keep_identified(no_documents).count() == 0


def test_gru_gradients():
    from carestar.llm import langid
    rng = np.random.default_rng(1)
    shape = {"embed": (256, langid.EMBED)}
    for s in "fb":
        shape |= {s + "x": (langid.EMBED, 3 * langid.HIDDEN), s + "h": (langid.HIDDEN, 3 * langid.HIDDEN),
                  s + "b": (3 * langid.HIDDEN,)}
    shape |= {"of": (langid.HIDDEN, 3), "ob": (langid.HIDDEN, 3), "o": (3,)}
    p = {k: rng.normal(0, 0.3, s) for k, s in shape.items()}
    codes, n, owner = langid.segments(pa.array([b"abc", b"zebra", b"q"], pa.large_binary()))
    codes = codes[:, :5]
    y = np.array([0, 1, 2])[owner]
    mask = np.arange(5)[None, :] < n[:, None]

    def loss(q):
        logp = langid._label(q, codes, n)
        return -(logp[np.arange(3), :, y] * mask).sum()

    logp, f, b, back, at, sf, sb = langid._label(p, codes, n, keep=True)
    g = np.exp(logp)
    g[np.arange(3)[:, None], np.arange(5)[None, :], y[:, None]] -= 1
    g *= mask[:, :, None]
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    turned = np.zeros((3, 5, langid.HIDDEN))
    np.add.at(turned, (np.arange(3)[:, None], at), g @ p["ob"].T)
    langid._backward(p, "f", codes, sf, g @ p["of"].T, grads)
    langid._backward(p, "b", back, sb, turned, grads)
    for k in ("fx", "fh", "fb", "bx", "bh", "bb", "embed"):
        i = tuple(rng.integers(0, s) for s in p[k].shape) if k != "embed" else (ord("b"), 3)
        q = {**p, k: p[k].copy()}
        q[k][i] += 1e-6
        assert (loss(q) - loss(p)) / 1e-6 == pytest.approx(grads[k][i], abs=1e-4)


# ---- pipeline ---------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark, tmp_path):
    import corpus_pipeline
    docs = read(spark, "documents")
    frames = []
    cur = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, cur, SF)
        out.write.parquet(str(tmp_path / str(i)))
        cur = spark.read.parquet(str(tmp_path / str(i)))
        frames.append(cur)
        if i < 4:
            assert cur.columns == docs.columns
    start = {r["doc_id"]: r["text"] for r in rows(docs)}
    named = {r["doc_id"]: r["text"] for r in rows(frames[0])}
    assert named == {i: t for i, t in start.items() if re.search(r"[^\W\d_]", t)}
    one = {r["doc_id"]: r["text"] for r in rows(frames[1])}
    comp = brute_components(list(named.items()))
    assert one == {i: t for i, t in named.items() if comp[i][1] == i or not comp[i][0]}
    first, cut = {}, {}
    for i in sorted(one):
        w = words(one[i])
        gone = set()
        for k in range(len(w) - 12):
            if first.setdefault(tuple(w[k:k + 13]), i) < i:
                gone.update(range(k, k + 13))
        if not gone:
            cut[i] = one[i]
        elif len(gone) < len(w):
            cut[i] = b" ".join(x for j, x in enumerate(w) if j not in gone).decode()
    assert {r["doc_id"]: r["text"] for r in rows(frames[2])} == cut
    mixed = rows(frames[3])
    total = sum(len(words(t)) for t in cut.values())
    assert abs(sum(len(words(r["text"])) for r in mixed) - 1.5 * total) <= 30
    assert set(r["doc_id"] for r in mixed) <= set(cut)
    done = rows(frames[4])
    assert Counter(r["decoded_sha256"] for r in done) == Counter(
        hashlib.sha256(r["text"].encode()).hexdigest() for r in mixed)
    assert corpus_pipeline.run(spark, SF).count() == len(done)


def test_pipeline_on_awkward_and_empty_documents(spark, documents, no_documents, tmp_path):
    import corpus_pipeline
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    for name, docs in (("some", documents), ("none", no_documents)):
        root = tmp_path / name
        docs.select(plain).write.parquet(f"{root}/documents.parquet")
        out = rows(corpus_pipeline.run(spark, str(root)))
        if name == "none":
            assert out == []
            continue
        ids = {r["doc_id"] for r in out}
        # Letterless and null texts went, of equal texts one stayed at most.
        assert ids.isdisjoint({5, 6, 7, 14}) and len(ids & {0, 1, 2, 13}) <= 1
        assert all(r["n_tokens"] == len(r["ids"]) for r in out)


def test_queries_with_sql(spark):
    import duckdb
    from carestar.llm.registry import ORACLE, QUERIES
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, SF)
        cur = con.execute(sql)
        cols = [c[0] for c in cur.description]
        assert sorted(cols) == sorted(df.columns)
        assert sorted(map(tuple, df.select(*cols).collect())) == sorted(cur.fetchall())


def test_bpe_word_borders_and_long_pieces_match_tiktoken(monkeypatch):
    """Splitting at spaces, emission inside a long piece and full memos
    change nothing."""
    import random

    import public_tokenizers as P
    import tiktoken

    from carestar.llm import bpe
    monkeypatch.setattr(bpe, "STRETCH", 40)
    monkeypatch.setattr(bpe, "SETTLE", 64)
    monkeypatch.setattr(bpe, "MEMO_BYTES", 100_000)
    monkeypatch.setattr(bpe, "MACHINE_BYTES", 400_000)
    monkeypatch.setattr(bpe, "PAIR_BYTES", 20_000)
    codec = bpe.Codec()
    exact = tiktoken.Encoding("exact", pat_str=P.PATTERN, mergeable_ranks=codec.ranks,
                              special_tokens={})
    rnd = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", " \n", "'s", "é", "日本", "😀", "1", ".", "...", " the",
             " a", "\x1c", "\x85", "　", "aaaa"]
    for _ in range(2_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 120)))
        ids = codec.encode(text)
        assert ids == exact.encode_ordinary(text)
        assert codec.decode(ids) == text
    letters = "".join(rnd.choice("abcdefgh") for _ in range(3_000))
    for text in (letters, "a" * 3_000, "ab" * 1_500, "é" * 1_000, " " * 1_000):
        assert codec.encode(text) == exact.encode_ordinary(text)


def test_bpe_new_pieces_of_a_slice_read_side_by_side(spark, monkeypatch):
    """Words met for the first time do not go through the transducer one by
    one, and get the ids that tiktoken gives."""
    import random

    import public_tokenizers as P
    import tiktoken

    from carestar.llm import bpe
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abehinorstéñß日") for _ in range(rnd.randint(1, 14)))
    texts = [" ".join(word() + rnd.choice(["", "", ",", ".\n" + word(), " "])
                      for _ in range(60)) for _ in range(60)]
    texts += ["".join(rnd.choice("abehinorst") for _ in range(bpe.ABREAST + k)) for k in (-1, 0, 1)]
    texts += ["", " ", "日本" * 700 + " x", "q" * (bpe.ABREAST * 3)]
    singly = []
    one = bpe.Transducer.encode
    monkeypatch.setattr(bpe.Transducer, "encode", lambda self, p: singly.append(p) or one(self, p))
    codec = bpe.Codec()
    exact = tiktoken.Encoding("whole", pat_str=P.PATTERN, mergeable_ranks=codec.ranks,
                              special_tokens={})
    for limits in ({}, {"TOGETHER": 50, "MACHINE_BYTES": 20_000, "MEMO_BYTES": 5_000, "STRETCH": 300}):
        for name, value in limits.items():
            monkeypatch.setattr(bpe, name, value)
        codec.forget()
        singly.clear()
        got = [[i for ids in runs for i in ids.tolist()] for runs in codec.runs_of(texts)]
        assert got == [exact.encode_ordinary(t) for t in texts]
        if not limits:
            assert len(singly) < 100       # of some 4,000 pieces
    monkeypatch.undo()
    d = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string").coalesce(1)
    for r in bpe.encode_documents(d).collect():
        text = "" if r["doc_id"] == len(texts) else texts[r["doc_id"]]
        ids = exact.encode_ordinary(text)
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
