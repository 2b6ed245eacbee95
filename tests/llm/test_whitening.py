"""Exact whitening against numpy, rational arithmetic and matrices with known roots."""

import math
from fractions import Fraction

import numpy as np
import pytest

from fieldrank.llm import whitening as wh


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS n", "1 AS component")


def leibniz(m):
    """Characteristic polynomial by traces in rational numbers (coefficients of x^0 on)."""
    dim = len(m)
    a = [[Fraction(int(v)) for v in row] for row in m]
    product = [[Fraction(i == j) for j in range(dim)] for i in range(dim)]
    out = [Fraction(1)]
    for k in range(1, dim + 1):
        product = [[sum(a[i][t] * product[t][j] for t in range(dim)) for j in range(dim)] for i in range(dim)]
        c = -sum(product[i][i] for i in range(dim)) / k
        out.append(c)
        for i in range(dim):
            product[i][i] += c
    return [int(c) for c in reversed(out)]


def matrix(seed, dim, size):
    g = np.random.default_rng(seed).integers(-size, size, (dim, dim)).astype(object)
    return g.T @ g


@pytest.mark.parametrize("dim,size", [(1, 9), (2, 5), (5, 10**6), (9, 10**12)])
def test_polynomial_is_exact(spark, dim, size):
    m = matrix(dim, dim, size)
    assert wh.characteristic(spark, m) == leibniz(m)


def test_hessenberg_with_zero_pivots(spark):
    m = np.array([[2, 0, 0, 1], [0, 3, 0, 0], [0, 0, 3, 0], [1, 0, 0, 2]], object)
    assert wh.characteristic(spark, m) == leibniz(m)


def test_roots_with_multiplicity():
    poly = [1]
    for r in (0, 0, 3, 7, 7, 7, 10**12):  # product of (x - r)
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    found = [num / 2**bits for num, bits in wh.largest_roots(poly, 6)]
    assert found == pytest.approx([10**12, 7, 7, 7, 3], rel=1e-15)
    assert [wh.roots_above(poly, x, 0) for x in (0, 2, 3, 6, 7, 10**12 - 1, 10**12)] == [5, 5, 4, 4, 1, 1, 0]


def check(vectors, out, components=8):
    """All columns against numpy in double precision and integers."""
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    apart = n * x - s
    cov = (apart.T @ apart).astype(float) / n**3
    values, columns = np.linalg.eigh(cov)
    values, columns = values[::-1], columns[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    rows = {(r.vec_id, r.component): r for r in out.collect()}
    assert len(rows) == n * k
    white = np.array([[rows[i, c].whitened for c in range(1, k + 1)] for i, _ in vectors])
    want = apart.astype(float) / n @ columns[:, :k] / np.sqrt(values[:k])
    assert {rows[i, c].deviation for (i, _), c in zip(vectors, [1] * n, strict=True)} == set((apart * apart).sum(axis=1))
    assert all(rows[i, 1].deviation == d for (i, _), d in zip(vectors, (apart * apart).sum(axis=1), strict=True))
    got = [next(rows[i, c].explained for i, _ in vectors) for c in range(1, k + 1)]
    assert got == pytest.approx(list(values[:k] / np.trace(cov)), rel=1e-9)
    assert np.abs(white.T @ white / n - np.eye(k)).max() < 1e-9 and all(r.identity_error < 1e-9 and r.n == n for r in rows.values())
    return white, want


def test_table_equals_numpy(spark, sf):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    white, want = check(vectors, wh.op12_whitening(spark, sf))
    assert np.abs(np.abs(white) - np.abs(want)).max() < 1e-6


def test_equal_variances_give_a_basis(spark):
    vectors = [(k, v) for k, v in enumerate([[a, b, c, 5.0] for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)])]
    check(vectors, wh.whitened(frame(spark, vectors)))


def test_odd_vectors_are_dropped(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0]), (2, [2.0, -1.0]), (3, [0.0, 0.25]), (3, [4.0, 1.0])]
    odd = [(5, None), (6, [nan, 1.0]), (7, [1.0, -inf]), (8, [None, 1.0]), (9, []), (10, [1.0]), (11, [1.0, 2.0, 3.0]), (12, [1e300, 1.0])]
    rows = wh.whitened(frame(spark, good + odd + [(None, [1.0, 1.0])])).collect()
    assert sorted((r.vec_id or 0, r.component) for r in rows) == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 1), (3, 2), (3, 2)]
    assert {r.n for r in rows} == {5}


def test_large_entries_stay_exact(spark):
    g = np.random.default_rng(2)
    vectors = [(k, (g.normal(size=3) * 2.0**k).tolist()) for k in range(50)]
    rows = wh.whitened(frame(spark, vectors)).collect()
    x = [[math.floor(1024 * c) for c in v] for _, v in vectors]
    s = [sum(c) for c in zip(*x, strict=True)]
    for r in rows:
        want = sum((50 * a - b) ** 2 for a, b in zip(x[r.vec_id], s, strict=True))
        assert r.deviation_exact == (want if want < 10**38 else None) and r.deviation == (want if want < 2**63 else None)
    assert max(r.identity_error for r in rows) < 1e-9


def test_nothing_varies(spark):
    assert wh.whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert wh.whitened(frame(spark, [(1, [1.0, 2.0])])).collect() == []
    assert wh.whitened(frame(spark, [(1, None)])).collect() == []
    assert wh.whitened(frame(spark, [(1, [1.0])]).where("vec_id > 1")).collect() == []
