"""SMOTE neighbours against brute force, exact weighted draws, scans with many bounds and null keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartcast.operators import scan as SC
from cartcast.operators import smote as SM
from cartcast.operators import split as SP


def _points(n, d, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * (1 + 5 * (rng.random((n, 1)) < 0.2)) + 8 * rng.integers(0, 4, (n, 1))
    x[: n // 3] = x[0]                  # a third of the rows are equal
    return x


def _brute(ids, x, k):
    out = {}
    for i, v in zip(ids, x):
        d = np.sqrt(((x - v) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(d[j])) for j in order]
    return out


@pytest.mark.parametrize("n,block", [(1, 50), (4, 50), (400, 50), (700, 4000)])
def test_neighbours_equal_brute_force(spark, monkeypatch, n, block):
    monkeypatch.setattr(SM, "BLOCK", block)
    x = _points(n, 3, n)
    ids = np.random.default_rng(1).permutation(10 * n)[:n]
    rows = [(int(i), *map(float, v), 1) for i, v in zip(ids, x)]
    extra = [(10**6, None, 1.0, 1.0, 1), (None, 1.0, 1.0, 1.0, 1)] if n > 1 else []
    df = spark.createDataFrame(rows + extra, "customer_id long, a double, b double, c double, label int").repartition(3)
    got: dict = {}
    for r in SM.nearest(df, "customer_id", ["a", "b", "c"], 5).orderBy("customer_id", "rank").collect():
        got.setdefault(r.customer_id, []).append((r.neighbour, r.distance))
    want = {i: w for i, w in _brute(ids, x, 5).items() if w}
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert [j for j, _ in got[i]] == [j for j, _ in w] and np.allclose([d for _, d in got[i]], [d for _, d in w], atol=1e-9)


def test_synthetic_rows_lie_between_neighbours(spark):
    x = _points(60, 2, 5)
    rows = [(i, *map(float, v), 1 if i < 20 else 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "customer_id long, a double, b double, label int")
    near = _brute(np.arange(20), x[:20], 5)
    got = SM.smote(df, ["a", "b"]).collect()
    assert len(got) == 20 and sorted(r.synthetic for r in got) == list(range(20))
    for r in got:
        assert r.neighbour in [j for j, _ in near[r.base]] and 0 <= r.gap < 1 and r.label == 1
        assert np.allclose([r.a, r.b], x[r.base] + r.gap * (x[r.neighbour] - x[r.base]))
    again = SM.smote(df.repartition(5), ["a", "b"]).collect()
    assert sorted(got) == sorted(again)
    assert SM.smote(df.where("label = 0"), ["a", "b"]).collect() == []


def test_exactly_n_draws_by_the_weights(spark):
    rows = [(i, [0.0, 1.0, 2.0, 7.0][i % 4] if i else None, "x") for i in range(400)]
    df = spark.createDataFrame(rows, "k long, w double, _w string")
    df = df.withColumnRenamed("_w", "note")
    out = SP.weighted_resample(df, "w", "k", seed=3, num_samples=30_000)
    counts = {r.k: r["count"] for r in out.groupBy("k").count().collect()}
    assert sum(counts.values()) == 30_000 and out.columns == ["k", "w", "note", "_copy"]
    total = sum(w or 0 for _, w, _ in rows)
    assert all(w for k, w, _ in rows if k in counts)
    chi = sum((counts.get(k, 0) - 30_000 * w / total) ** 2 / (30_000 * w / total) for k, w, _ in rows if w)
    n = sum(1 for _, w, _ in rows if w) - 1
    assert abs(chi - n) < 5 * (2 * n) ** 0.5                   # as a chi-squared law has it
    again = SP.weighted_resample(df.repartition(7), "w", "k", seed=3, num_samples=30_000)
    assert {r.k: r["count"] for r in again.groupBy("k").count().collect()} == counts
    assert SP.weighted_resample(df, "w", "k").count() == 400 and SP.weighted_resample(df.limit(0), "w", "k").count() == 0


def test_two_levels_of_bounds(spark, monkeypatch):
    monkeypatch.setattr(SC, "FIRST_LEVEL", 7)
    df = spark.range(3000).select(F.lit("k").alias("k"), "id", F.lit(1.0).alias("v"))
    for ranges in (5, 8, 60):
        out = SC.ordered_scan(df, "k", ["id"], SC.ScanSpec(cumsum={"c": "v"}), num_partitions=ranges)
        assert out.where("c <> id + 1 or c is null").count() == 0 and out.count() == 3000
    bounds = SC.range_bounds(df, "k", ["id"], 60)
    ranged = SC._with_range(df, ["k", "id"], bounds, "r").groupBy("r").agg(F.min("id").alias("a"), F.count("*").alias("n")).orderBy("r").collect()
    assert [r.r for r in ranged] == list(range(len(bounds) + 1)) and [r.a for r in ranged[1:]] == [b[1] for b in bounds]


def test_rows_without_a_key_are_spread(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"), "id", F.lit(1.0).alias("v"))
    bounds = SC.range_bounds(df, "k", ["id"], 16)
    out = SC.ordered_scan(df, "k", ["id"], SC.ScanSpec(cumsum={"c": "v"}), num_partitions=16)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and out.where("k is null and c is not null").count() == 0
    spread = -1 - F.pmod(F.xxhash64("id"), F.lit(len(bounds) + 1))
    assert max(r["count"] for r in df.where("k is null").groupBy(spread).count().collect()) < 200


def test_bounds_need_no_task_over_all_rows(spark):
    """The sample is a filter on a hash: no global top-k."""
    df = spark.range(200_000).select(F.lit(0).alias("k"), "id")
    assert 16 <= len(SC.range_bounds(df, "k", ["id"], 24)) <= 30
