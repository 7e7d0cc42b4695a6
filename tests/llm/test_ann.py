import math

import numpy as np
from pyspark.sql import functions as F

from cartcast.llm import ann


def _rows(n=4000, d=16, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(25, d)) * 1.5
    x = (centres[rng.integers(25, size=n)] + rng.normal(size=(n, d))).astype(np.float32)
    x[100:1500] = x[99]  # one vector with a third of all rows
    return [(int(k), [float(c) for c in v]) for k, v in enumerate(x)]


def _truth(rows, k=5):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 16 and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i % 50 == 0:
            ok = ids != i
            s = (x[ok] * v).sum(axis=1) / (np.sqrt((x[ok] ** 2).sum(axis=1)) * np.sqrt((v * v).sum()))
            at = np.lexsort((ids[ok], -s))[:k]
            out[i] = list(zip(ids[ok][at].tolist(), s[at].tolist()))
    return out


def test_recall_scores_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 300)
    rows = _rows()
    n = len(rows)
    rows += [(n, None), (n + 50, [0.0] * 16), (n + 100, [float("nan")] + [1.0] * 15), (n + 150, [None] + [1.0] * 15), (n + 200, [1.0]), (n + 250, [float("inf")] * 16), (None, [1.0] * 16), (n + 301, [1e-30] * 16)]
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, label int, score double")
    got: dict = {}
    for r in ann.search(df, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    want = _truth([(i, v if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows])
    assert got.keys() == want.keys()
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    assert hit >= 0.9 * sum(map(len, want.values()))
    exact = {q: dict(w) for q, w in want.items()}
    for q, w in got.items():
        assert all(abs(exact[q].get(i, s) - s) < 1e-12 for i, s in w)
    assert [i for i, _ in got[100]] == [99, 101, 102, 103, 104], "ties to the smaller id"


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in ann.search(df, F.col("id") % 50 == 0).collect())
    assert got == [(0, 1, 1, 0.707107), (0, 2, 50, 0.0), (50, 1, 1, 0.707107), (50, 2, 0, 0.0)]
    assert ann.search(df.limit(0), F.col("id") % 50 == 0).collect() == []
    assert ann.search(df.limit(1), F.col("id") % 50 == 0).collect() == []


def test_tree_leads_each_vector_to_one_leaf(monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 64)
    x = np.array([v for _, v in _rows(2000)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    t = ann.fit(x)
    leaf = t.descend(x)
    assert len(set(leaf.tolist())) > 10
    order = t.best_bins(x[0], np.ones(len(t.leaf_of)), float("inf"))
    assert sorted(order) == sorted(t.leaf_of.values()) and order[0] == leaf[0]


def test_repeated_query_rows(spark):
    """A query row that comes twice still gets five different neighbours."""
    rows = [(50, [1.0, 0.0])] * 2 + [(k, [1.0, 0.1 * k]) for k in range(1, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r["rank"], r.vec_id) for r in ann.search(df, F.col("id") % 50 == 0).collect() if r.query_id == 50)
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]


def test_vectors_alike_in_their_first_dimensions():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6000, 16))
    x[:, :4] = 0.5
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:, :4] = x[:, :4].round(1)
    t = ann.fit(x)
    assert len(t.leaf_of) > 20 and len(set(t.descend(x).tolist())) > 20
