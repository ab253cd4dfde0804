"""Periodic runs: enumeration, collapsed words and the query, by brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from carestar.llm import runs


def brute_runs(words, min_length=6, exponent=4):
    """Every stretch q-periodic and maximal, by scanning each period."""
    n, least = len(words), {}
    for q in range(1, n // exponent + 1):
        x = 0
        while x < n - q:
            if words[x] != words[x + q]:
                x += 1
                continue
            start = x
            while x < n - q and words[x] == words[x + q]:
                x += 1
            length = x - start + q
            if length >= max(min_length, exponent * q):
                least.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in least.items())


def random_words(rng, n, letters):
    w = [rng.randint(0, letters) for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), rng.randint(1, 9)
        w = [w[i] if i < a else w[a + (i - a) % min(p, n - a)] for i in range(n)]
    return w


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(80):
        docs = [random_words(rng, rng.choice([0, 1, 5, 6, 7, 25, 70, 160]), rng.randint(0, 3))
                for _ in range(rng.randint(1, 6))]
        index = np.array([x for d in docs for x in d], np.int64)
        doc, start, length, period = runs.runs_of(index, np.array([len(d) for d in docs], np.int64))
        for j, d in enumerate(docs):
            on = doc == j
            got = list(zip(start[on].tolist(), length[on].tolist(), period[on].tolist()))
            assert sorted(got) == brute_runs(d)
            assert got == sorted(got, key=lambda r: (r[0], r[2]))


def test_other_bounds():
    rng = random.Random(9)
    for _ in range(80):
        w = random_words(rng, 60, 2)
        doc, start, length, period = runs.runs_of(np.array(w), np.array([60]), 5, 2)
        assert sorted(zip(start.tolist(), length.tolist(), period.tolist())) == brute_runs(w, 5, 2)


def test_common_extension_is_exact():
    rng = np.random.default_rng(3)
    for letters in (1, 2, 30):
        w = np.concatenate([rng.integers(1, letters + 1, 300), [99]])
        lce = runs.CoverLCE(w)
        x, y = np.triu_indices(len(w), 1)
        want = []
        for a, b in zip(x.tolist(), y.tolist()):
            t = 0
            while b + t < len(w) and w[a + t] == w[b + t]:
                t += 1
            want.append(t)
        assert lce.extend(x, y).tolist() == want


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = None
    for s, length, q in found:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *(best or (None,) * 3),
            None if best is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
           "collapsed_sha256"]


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_query_equals_brute_force(spark, documents, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(f"v{rng.randint(0, 4)}" for _ in range(rng.randint(0, 90))))
            for i in range(300, 420)]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    table = documents.unionByName(extra, allowMissingColumns=True)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = runs.op11_periodic_runs(spark, str(tmp_path)).select(COLUMNS).collect()
    want = [expected(r["doc_id"], r["text"]) for r in table.collect()]
    assert key(map(tuple, got)) == key(want)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)


def test_whole_table_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in docs if len(r["text"] or "") < 12_000]  # brute force is quadratic
    got = {r["doc_id"]: tuple(r) for r in
           runs.op11_periodic_runs(spark, d).select(COLUMNS).collect()}
    assert len(got) == len(docs)
    for r in short:
        assert got[r["doc_id"]] == expected(r["doc_id"], r["text"])


def test_empty_table_and_a_text_of_several_slices(spark, no_documents, tmp_path):
    assert runs.collapse_runs(no_documents).collect() == []
    text = "a b c " * 10 + " ".join(f"w{i}" for i in range(1_500_000)) + " z" * 20  # over 8 MB
    df = spark.createDataFrame([(1, text), (2, "x " * 9), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in runs.collapse_runs(df).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 30, 3), (1_500_030, 20, 1)]
    assert got[1]["collapsed"] == "a b c " + " ".join(f"w{i}" for i in range(1_500_000)) + " z"
    assert [tuple(x) for x in got[2]["runs"]] == [(0, 9, 1)] and got[2]["collapsed"] == "x"
    assert got[3]["runs"] == [] and got[3]["collapsed"] == "" and got[3]["n_words"] == 0
