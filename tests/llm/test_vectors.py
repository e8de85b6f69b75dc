"""Exact and approximate search against brute force."""

from __future__ import annotations

import math

import numpy as np

from tariffmart.llm.nearest import grow, nearest
from tariffmart.llm.top_search import exact_top_k

NAN, INF = float("nan"), float("inf")


def brute(rows, every, k, score):
    usable = [(i, np.asarray(v, "f4").astype("f8")) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in {i: v for i, v in usable if i % every == 0}.items():
        best = sorted(((-score(v, w), i) for i, w in usable if i != q))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def integers(a, b):
    n = min(len(a), len(b))
    return int(np.floor(256 * a[:n]) @ np.floor(256 * b[:n]))


def test_exact_search_over_many_tiles_and_rounds(vectors):
    rng = np.random.default_rng(0)
    data = [(i, (rng.standard_normal(8) * 3).astype("f4").tolist()) for i in range(400)]
    data += [(400 + i, data[0][1]) for i in range(60)]  # a common vector: ties far beyond k
    got = exact_top_k(vectors(*data), k=5, every=20, bins=16, rows_per_tile=64, queries_per_tile=8)
    assert sorted(map(tuple, got.collect())) == brute(data, 20, 5, integers)


def test_exact_search_edges(vectors):
    data = [(0, [1.0, 2.0]), (50, [0.0, 0.0]), (1, None), (2, [1.0, None]), (3, [NAN, 1.0]), (4, [INF, 1.0]), (None, [1.0, 1.0]), (5, [3.0, 1.0])]
    assert sorted(map(tuple, exact_top_k(vectors(*data)).collect())) == brute(data, 50, 5, integers)
    assert exact_top_k(vectors()).collect() == []
    assert exact_top_k(vectors((0, [1.0]))).collect() == []
    large = [(0, [3e6, 1.0]), (1, [3e6, 2.0]), (2, [3e6, 2.0]), (3, [-3e6, 2.0])]  # products beyond 2**53
    assert sorted(map(tuple, exact_top_k(vectors(*large)).collect())) == brute(large, 50, 5, integers)
    twice = exact_top_k(vectors((0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0])))
    assert [tuple(r)[:3] for r in twice.orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 1)]


def test_exact_search_asks_with_every_vector_of_an_id(vectors):
    data = [(0, [1.0, 0.0]), (0, [0.0, 5.0]), (1, [1.0, 1.0]), (2, [3.0, 0.0])]
    one = 256 * 256
    assert sorted(map(tuple, exact_top_k(vectors(*data)).collect())) == [(0, 1, 1, 5 * one), (0, 2, 2, 3 * one), (0, 3, 1, one), (0, 4, 2, 0)]
    rng = np.random.default_rng(3)
    data = [(i % 40, rng.standard_normal(4).tolist()) for i in range(400)]  # ten vectors an id
    got = exact_top_k(vectors(*data), every=20, bins=16, rows_per_tile=64, queries_per_tile=4)
    pairs = [(i, -integers(np.asarray(v, "f4").astype("f8"), np.asarray(w, "f4").astype("f8")), j) for i, v in data if i % 20 == 0 for j, w in data if i != j]
    want = [(q, r + 1, j, -s) for q in (0, 20) for r, (s, j) in enumerate(sorted((s, j) for i, s, j in pairs if i == q)[:5])]
    assert sorted(map(tuple, got.collect())) == want


def test_tree_order_visits_every_leaf_once():
    tree = grow(np.random.default_rng(1).standard_normal((500, 6)), 4, 10)
    assert sorted(tree.order(np.ones(6))) == list(range(tree.leaves))
    assert set(tree.assign(np.random.default_rng(2).standard_normal((50, 6)))) <= set(range(tree.leaves))


def test_near_search_recall_and_scores(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = {r["vec_id"]: np.asarray(r["embedding"], "f8") for r in given.collect()}
    got = nearest(given, sample_rows=1000, leaf_rows=24, tile_rows=200, tile_queries=32).collect()
    ids = np.array(sorted(data))
    all_ = np.array([data[i] for i in ids])
    hits = []
    for q in ids[ids % 20 == 0]:
        own = [(r["rank"], r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])]
        assert [r for r, *_ in own] == list(range(1, 21)) and [(-s, v) for _, v, s in own] == sorted((-s, v) for _, v, s in own)
        assert all(abs(s - data[v] @ data[q]) < 1e-12 for _, v, s in own)
        scores = np.where(ids == q, -9, all_ @ data[q])
        hits.append(np.mean([v in set(ids[np.argsort(-scores)[:20]]) for _, v, _ in own]))
    assert np.mean(hits) >= 0.9


def test_near_search_edges(vectors):
    few = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [NAN, 1.0]), (20, [0.9, 0.1]), (None, [1.0, 1.0])]
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in nearest(vectors(*few)).collect())
    assert got == [(0, 1, 20), (0, 2, 1), (20, 1, 0), (20, 2, 1)]
    same = [(i, [0.6, 0.8]) for i in range(100)]  # one vector everywhere: the smallest ids
    got = nearest(vectors(*same), tile_rows=16).collect()
    for q in (0, 20, 80):
        assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == [i for i in range(21) if i != q][:20]
    assert nearest(vectors()).collect() == []
