"""Vantage-point search against brute force."""

import numpy as np
import pytest

from sentinela.llm.vptree import build_tree, nearest_neighbours, search_tree


def _brute(ids, v, q_ids, q, k):
    out = []
    for i, x in zip(q_ids, q):
        d = np.sqrt(((v - x) ** 2).sum(1))
        rows = sorted((a, b) for a, b in zip(d, ids) if b != i)[:k]
        out.append(rows)
    return out


@pytest.mark.parametrize("copies", [0, 900])
def test_factor_one_is_exact(copies):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(2500, 8)) + rng.integers(0, 6, (2500, 1)) * 4
    v[:copies] = v[0]
    ids = rng.permutation(5000)[:2500].astype(np.int64)
    q_ids, q = ids[::50], v[::50]
    best = search_tree(build_tree(ids, v), q_ids, q, 10, 1.0)
    want = _brute(ids, v, q_ids, q, 10)
    for n, rows in enumerate(want):
        assert list(zip(best.dist[n], best.ids[n])) == rows


def test_spark_search_and_recall(spark):
    rng = np.random.default_rng(5)
    v = (rng.normal(size=(3000, 16)) + rng.integers(0, 5, (3000, 1)) * 2).astype(np.float32)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS score", "0 AS rank")
    want = {r[0]: None for r in rows if r[0] % 100 == 0}
    big = v.astype(np.float64)
    brute = _brute(np.arange(3000), big, list(want), big[::100], 10)
    for factor, least in ((1.0, 1.0), (1.15, 0.95)):
        got = nearest_neighbours(spark, df, lambda i: i % 100 == 0, factor=factor, shard_rows=700, block_rows=9).collect()
        by = {q: [] for q in want}
        for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
            by[r.query_id].append((r.score, r.vec_id))
        assert all(len(x) == 10 for x in by.values())
        hits = sum(len(set(by[q]) & set(b)) for q, b in zip(want, brute))
        assert hits >= least * 300
        if factor == 1.0:
            assert list(by.values()) == [[(float(d), int(i)) for d, i in b] for b in brute]


def test_edges(spark):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (6, []), (7, [1.0]), (8, [2.0, 0.0]), (9, [2.0, 0.0]), (None, [1.0, 1.0]), (0, [3.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest_neighbours(spark, df, lambda i: i % 100 == 0, factor=1.0).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [
        (0, 1, 100, 0.0), (0, 2, 8, 1.0), (0, 3, 9, 1.0),
        (100, 1, 0, 0.0), (100, 2, 8, 1.0), (100, 3, 9, 1.0), (100, 4, 0, 2.0),
    ]
    assert nearest_neighbours(spark, df.limit(0), lambda i: i % 100 == 0).count() == 0
