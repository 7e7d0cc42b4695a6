import math

import numpy as np
import pytest

from cartcast.llm import whiten


def _scatter(x):
    c = x - x.mean(axis=0)
    return c.T @ c


@pytest.mark.parametrize("d,n", [(1, 5), (3, 200), (8, 60), (24, 300)])
def test_updates_and_merges_equal_the_dense_scatter(d, n):
    rng = np.random.default_rng(d)
    x = np.floor(rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 256)
    one, a, b = (whiten.Spectrum.empty(d) for _ in range(3))
    for k, row in enumerate(x):
        one.add(row)
        (a if k % 3 else b).add(row)
    a.merge(b)
    want = _scatter(x)
    for s in (one, a):
        assert s.n == n and np.allclose(s.mean, x.mean(axis=0), rtol=1e-12, atol=1e-9)
        assert np.abs(s.vectors * s.values @ s.vectors.T - want).max() < 1e-12 * np.abs(want).max() * d
        assert np.abs(s.vectors.T @ s.vectors - np.eye(d)).max() < 1e-12


def test_deflation_of_equal_and_missing_directions():
    x = np.repeat(np.eye(6) * 512, 5, axis=0)
    x[:, 5] = 0
    s = whiten.Spectrum.empty(6)
    for row in x:
        s.add(row)
    assert np.abs(s.vectors * s.values @ s.vectors.T - _scatter(x)).max() < 1e-8
    assert s.values[0] == 0 and np.abs(s.vectors.T @ s.vectors - np.eye(6)).max() < 1e-13


def _frame(spark, vectors, ddl="vec_id long, embedding array<float>, label int, x string"):
    return spark.createDataFrame([(k, v, 1, "x") for k, v in enumerate(vectors)], ddl)


def test_rows_equal_a_dense_eigendecomposition(spark, monkeypatch):
    monkeypatch.setattr(whiten, "FAN", 3)
    rng = np.random.default_rng(4)
    base = (rng.normal(size=(700, 12)) * np.linspace(2, 0.3, 12) @ np.linalg.qr(rng.normal(size=(12, 12)))[0]).astype(np.float32)
    base[100:350] = base[99]                                      # one vector with a third of all rows
    vectors = [[float(c) for c in v] for v in base] + [None, [], [1.0], [float("nan")] + [0.0] * 11, [None] + [0.0] * 11, [float("inf")] * 12]
    got = whiten.whitened(_frame(spark, vectors).repartition(7)).collect()
    x = np.floor(base.astype(float) * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    cov = c.T @ c / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    assert len(got) == 4 * len(x) and {r.n for r in got} == {n}
    want = (x - sums / n) @ v / np.sqrt(e)
    out = {(r.vec_id, r.component): r for r in got}
    for k in range(4):
        sign = np.sign(want[0, k]) * np.sign(out[0, k + 1].whitened)
        assert max(abs(out[i, k + 1].whitened - sign * want[i, k]) for i in range(len(x))) < 1e-10
        assert abs(out[0, k + 1].explained - e[k] / np.trace(cov)) < 1e-12
    assert all(out[i, 1].deviation == sum((n * int(p) - int(s)) ** 2 for p, s in zip(x[i], sums)) for i in range(len(x)))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_few_rows_and_low_rank(spark):
    assert whiten.whitened(_frame(spark, [])).collect() == []
    assert whiten.whitened(_frame(spark, [None, []])).collect() == []
    assert whiten.whitened(_frame(spark, [[1.0, 2.0]] * 3)).collect() == [], "equal vectors have no component"
    line = whiten.whitened(_frame(spark, [[1.0, 2.0], [2.0, 4.0], [4.0, 8.0], [4.0, 8.0]])).collect()
    assert [(r.vec_id, r.component) for r in sorted(line)] == [(0, 1), (1, 1), (2, 1), (3, 1)]
    assert line[0].n == 3 and math.isclose(line[0].explained, 1) and line[0].identity_error < 1e-12


def test_sums_beyond_a_long(spark):
    rows = whiten.whitened(_frame(spark, [[1e12, 0.0], [0.0, 1e12], [5e11, 3.0]], "vec_id long, embedding array<double>, label int, x string")).collect()
    assert rows and all(r.deviation is None for r in rows) and rows[0].identity_error < 1e-6


def test_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [3.0, 1.0])], "vec_id long, embedding array<double>")
    rows = whiten.whitened(df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in rows) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (2, 1), (2, 2)]
