"""Exact top-k search and hard negatives against brute force in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carestar.llm import segments, vectors, voronoi

LONG = (-2 ** 63, 2 ** 63 - 1)
SCHEMA = "vec_id long, embedding array<double>, label int, Vec_ID string, node int"


def whole(e):
    """Whole-number components, or None where the row takes no part."""
    if not e or any(x is None or not math.isfinite(x) or not abs(256 * x) < 2.0 ** 500 for x in e):
        return None
    return [math.floor(256 * x) for x in e]


def product(a, b):
    return min(max(sum(x * y for x, y in zip(a, b)), LONG[0]), LONG[1])


def rows_of(table, labelled=False):
    out = {}
    for i, e, label in table:
        v = whole(e)
        if i is None or v is None or (labelled and label is None):
            continue
        own = ([float(x) for x in v], label if label is not None else -1)
        if i not in out or own < out[i][1]:
            out[i] = (v, own, label)
    return {i: (v, label) for i, (v, _, label) in out.items()}


def brute_top(table, asks, k):
    rows, out = rows_of(table), []
    for q, (v, _) in rows.items():
        if asks(q):
            best = sorted((-product(v, w), i) for i, (w, _) in rows.items()
                          if i != q and len(w) == len(v))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def brute_mined(table, asks, positives=5, negatives=10):
    rows, out = rows_of(table, True), []
    for a, (v, label) in rows.items():
        if not asks(a):
            continue
        other = [(-product(v, w), i, g) for i, (w, g) in rows.items() if i != a and len(w) == len(v)]
        for p, i, g in sorted(x for x in other if x[2] == label)[:positives]:
            fit = sorted((s, j) for s, j, h in other
                         if h != label and 30 * -p <= 100 * -s <= 90 * -p)[:negatives]
            out += [(a, i, r + 1, j, -p, -s) for r, (s, j) in enumerate(fit)]
    return sorted(out)


def sample(seed, n=240, dim=12, clusters=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    out = []
    for i in range(n):
        c = int(rng.integers(clusters))
        out.append((i, (centres[c] + 0.3 * rng.normal(size=dim)).tolist(), c))
    return out


def awkward():
    table = sample(1)
    hot = table[3][1]
    table += [(1000 + i, hot, i % 3) for i in range(120)]                    # a third are copies
    table += [(2000, None, 1), (2001, [], 1), (2002, [None] * 12, 1), (2003, [float("nan")] * 12, 1),
              (2004, [float("inf")] + [0.0] * 11, 2), (2005, [1e300] * 12, 2), (None, hot, 1),
              (2006, [0.0] * 12, None), (2007, [0.0] * 12, 0), (2008, [-0.0] * 12, 0),
              (2010, [1e30] + [1.0] * 11, 1), (2011, [-1e30] + [2.0] * 11, 1), (2012, [1e12] * 12, 2),
              (2013, [1e100] * 12, 4), (2050, [1e7] * 12, 4),
              (2100, [1.0, 2.0], 1), (2101, [1.0, 2.5], 1), (2102, [0.9, 1.0], 2), (2150, [1.0, 1.0], 1),
              (2200, [3.0], 1),                                               # alone in its length
              (0, hot, 5), (0, hot, 5), (7, [9.0] * 12, 0), (50, [5.0] * 12, 3)]  # repeated ids
    random.Random(2).shuffle(table)
    return table


@pytest.fixture()
def small_units(monkeypatch):
    """Many groups, chunks and pivots also for a small table."""
    monkeypatch.setattr(vectors, "GROUP", 7)
    monkeypatch.setattr(vectors, "CHUNK", 50)
    monkeypatch.setattr(voronoi, "ROWS_PER_PIVOT", 8)


def frame(spark, table):
    return spark.createDataFrame([(i, e, g, "x", 1) for i, e, g in table], SCHEMA).toDF(
        "vec_id", "embedding", "label", "Vec_ID", "node")


def exact(df, **kinds):
    names = list(df.columns)
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.where(f"c0 % {kinds['ask']} = 0").toDF(*names)


@pytest.mark.parametrize("make", [awkward, lambda: sample(4, 300, 64, 40)])
def test_top_k_equals_brute_force(spark, small_units, make):
    table = make()
    df = frame(spark, table)
    got = voronoi.voronoi_join(exact(df, ask=10), df, 5).collect()
    assert sorted(map(tuple, got)) == brute_top(table, lambda i: i % 10 == 0, 5)


@pytest.mark.parametrize("make", [awkward, lambda: sample(5, 300, 64, 4)])
def test_hard_negatives_equal_brute_force(spark, small_units, make):
    table = make()
    df = frame(spark, table)
    got = segments.hard_negatives(df, F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == brute_mined(table, lambda i: i % 10 == 0)
    assert got


def test_fewer_rows_than_asked(spark):
    df = frame(spark, [(0, [1.0, 1.0], 0), (1, [1.0, 0.5], 0), (2, [0.5, 0.5], 1)])
    assert [tuple(r) for r in voronoi.voronoi_join(exact(df, ask=50), df).orderBy("rank").collect()] == \
        [(0, 1, 1, 98304), (0, 2, 2, 65536)]
    assert [tuple(r) for r in segments.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()] == \
        [(0, 1, 1, 2, 98304, 65536)]


def test_empty_tables(spark):
    df = frame(spark, [(0, [1.0], 0)])
    none = df.where("1 = 0")
    assert voronoi.voronoi_join(none, none).collect() == []
    assert voronoi.voronoi_join(df, none).collect() == []
    assert voronoi.voronoi_join(df, df).collect() == []
    assert segments.hard_negatives(none, F.col("vec_id") % 100 == 0).collect() == []
    assert segments.hard_negatives(df, F.col("vec_id") % 100 == 0).collect() == []


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_queries_equal_sql(spark, name):
    import duckdb
    d = f"/root/testdata/{name}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{d}/embeddings.parquet')")
    for job, sql in ((voronoi.op12_exact_top_k, voronoi.ORACLE_SQL),
                     (segments.op13_hard_negatives, segments.ORACLE_SQL)):
        assert sorted(map(tuple, job(spark, d).collect())) == sorted(con.sql(sql).fetchall())


def test_segment_bounds_hold_and_tighten():
    rng = np.random.default_rng(7)
    for dim in (1, 3, 12, 64):
        x = np.floor(rng.normal(size=(40, dim)) * 100 + rng.normal(size=(40, 1)) * 300)
        true = x @ x.T
        last = None
        for m, d in segments.levels(*segments.summary(x, 8), dim) + [segments.summary(x, 16)]:
            base, room = m @ m.T, d @ d.T
            assert (np.abs(true - base) <= room + 1e-6 * (1 + np.abs(true).max())).all()
            if last is not None:
                assert (base + room <= last + 1e-6 * (1 + np.abs(last).max())).all()
            last = base + room


def test_cells_prune_rows_of_far_clusters():
    """On tight clusters a query's bound keeps rows of other cells away."""
    rng = np.random.default_rng(0)
    centres = np.eye(4) * 1000
    x = np.floor(np.repeat(centres, 30, 0) + rng.normal(size=(120, 4)))
    norm = np.sqrt((x * x).sum(1))
    space = voronoi.Space(centres, np.full(4, 1000.0), norm.max())
    q = x[:5]
    fifth = np.sort(vectors.scores(q, x), 1)[:, -6]
    limit = space.queries(q)[:, 0].max() + space.reach(norm[:5], fifth).max()
    need = space.rows(x, norm)[:, 0] <= limit
    assert need[:30].all() and not need[30:].any()


def test_scores_are_exact_and_bounded():
    a = np.array([[2.0 ** 30, 3.0], [1.0, 2.0], [2.0 ** 400, 1.0]])
    b = np.array([[2.0 ** 30, 1.0], [5.0, 7.0], [-(2.0 ** 400), 0.0]])
    want = [[product([int(x) for x in p], [int(x) for x in q]) for q in b] for p in a]
    assert vectors.scores(a, b).tolist() == want


def test_best_keeps_ties_by_smaller_id():
    best = vectors.Best(2, 3)
    ids = np.arange(100)[::-1].copy()
    best.add(np.array([0, 1]), np.ones((2, 100), np.int64), ids, np.ones((2, 100), bool))
    best.add(np.array([1]), np.full((1, 1), 9), np.array([500]), np.ones((1, 1), bool))
    row, found, score = best.found()
    assert found[row == 0].tolist() == [0, 1, 2] and found[row == 1].tolist() == [500, 0, 1]


def test_percent_rounds_outwards_without_overflow():
    p = np.array([0, 1, 10, 333, -1, -7, LONG[1], LONG[0]])
    assert segments.percent(p, 30, True).tolist() == [-((-30 * int(x)) // 100) for x in p.tolist()]
    assert segments.percent(p, 90, False).tolist() == [90 * int(x) // 100 for x in p.tolist()]
