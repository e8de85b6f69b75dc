"""Whitening against a dense eigensolver."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tariffmart.llm.whitening import jacobi_davidson, minres, whiten

NAN, INF = float("nan"), float("inf")


def check(got, data, components=32):
    """Rows of ``got`` against the covariance of ``data`` in full."""
    usable = [(i, v) for i, v in data if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max(len(v) for _, v in usable)
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (dims - len(v)) for _, v in usable])
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = [k for k in range(min(components, dims)) if values[k] > 1e-11 * values[0]]
    rows = sorted(map(tuple, got.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert len(rows) == n * len(kept)
    white = np.array([r[4] for r in rows]).reshape(n, len(kept))
    order = sorted(range(n), key=lambda k: (usable[k][0] is None, usable[k][0] or 0))
    deviation = [sum(int(d) ** 2 for d in n * x[k] - sums) for k in order]
    assert [r[3] for r in rows] == [v for v in deviation for _ in kept]
    assert {r[2] for r in rows} <= {n} and [r[1] for r in rows] == [k + 1 for _ in range(n) for k in kept]
    for k in kept:
        assert rows[k][5] == pytest.approx(values[k] / values.sum(), rel=1e-9)
        gaps = [abs(values[k] - values[j]) for j in range(dims) if j != k]
        if not gaps or min(gaps) > 1e-3 * values[0]:
            exact = centred[order] @ vectors[:, k] / np.sqrt(values[k])
            assert min(np.abs(white[:, k] - exact).max(), np.abs(white[:, k] + exact).max()) < 1e-8
    assert np.abs(white.T @ white / n - np.eye(len(kept))).max() < 1e-8 and all(0 <= r[6] < 1e-8 for r in rows)


def test_given_embeddings(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = whiten(given)
    assert got.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint")] + [(c, "double") for c in ("whitened", "explained", "identity_error")]
    check(got, [(r["vec_id"], r["embedding"]) for r in given.collect()])


def test_edges(vectors):
    rng = np.random.default_rng(1)
    data = [(i, (rng.standard_normal(5) * 3).astype("f4").tolist()) for i in range(60)]
    data += [(200 + i, data[0][1]) for i in range(30)] + [(None, data[1][1]), (90, None), (91, [1.0, None, 1.0, 1.0, 1.0]), (92, [NAN] * 5), (93, [1.0, INF]), (94, [1.0, 2.0]), (95, [])]
    check(whiten(vectors(*data), components=3, part_bytes=500), data, 3)
    flat = [(i, [float(i % 7), float(i % 7), 0.0]) for i in range(50)]  # one direction only
    check(whiten(vectors(*flat)), flat)
    twice = whiten(vectors((1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 1.0]))).collect()  # repeated rows stay
    assert sorted((r["vec_id"], r["component"], r["n"]) for r in twice) == [(1, 1, 3), (1, 1, 3), (2, 1, 3)]
    assert whiten(vectors()).collect() == []
    assert whiten(vectors((1, [1.0, 2.0]))).collect() == [] and whiten(vectors(*[(i, [0.5]) for i in range(9)])).collect() == []
    assert whiten(vectors((1, None), (2, [NAN]))).collect() == [] and whiten(vectors((1, []), (2, []))).collect() == []


def test_integers_of_any_size(vectors):
    data = [(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [3e15, 2.0]), (4, [3e38, 1.0])]
    got = sorted(map(tuple, whiten(vectors(*data)).collect()))
    assert {r[0] for r in got} == {1, 2, 3}  # the fourth one's integer has more than 62 bits
    assert {r[3] for r in got} == {None}  # squares beyond 64 bits
    assert got[0][4] == pytest.approx(0, abs=1e-6) and got[0][5] == pytest.approx(1)


@pytest.mark.parametrize("dims,wanted", [(300, 12), (40, 32), (5, 5), (1, 1), (120, 3)])
def test_jacobi_davidson_reaches_double_precision(dims, wanted):
    rng = np.random.default_rng(dims)
    basis, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    spectrum = np.sort(1.0 / np.arange(1, dims + 1) ** 1.2)[::-1]
    spectrum[1:3] = spectrum[min(1, dims - 1)]  # a repeated eigenvalue
    matrix = (basis * spectrum) @ basis.T
    passes = []
    values, vectors = jacobi_davidson(lambda c: passes.append(1) or matrix @ c, dims, wanted)
    assert np.abs(values - spectrum[:wanted]).max() < 1e-13 and len(passes) < 200
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 and np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-13


def test_minres_solves_in_step():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    shifts, right = np.array([0.3, -0.7, 5.0]), rng.standard_normal((20, 3))
    x = minres(lambda c: a @ c - c * shifts, right, 40, 1e-13)
    assert np.abs(a @ x - x * shifts - right).max() < 1e-6
