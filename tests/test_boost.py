"""Histogram boosting on real rows: one tree against brute-force splits, patience, folds, saving."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartcast.operators import boost as BO
from cartcast.operators import model as MD
from cartcast.plans import features as FE
from cartcast.session import checkpoint_dir
from cartcast.sources.tables import transactions
from tests.conftest import SF01


@pytest.fixture(scope="module")
def base(spark):
    fs = FE.fe_baseline(transactions(spark, SF01, description=False, country=False), "2001-07")
    tr = fs.train.persist()
    te = fs.test.persist()
    yield fs, tr, te
    tr.unpersist()
    te.unpersist()


def _brute_tree(x, y, base, p):
    """The best cut of every node over all features and all bins, by trying each."""
    q = 1 / (1 + np.exp(-base))
    g, h = q - y, np.full(len(y), q * (1 - q))
    worth = lambda s: g[s].sum() ** 2 / h[s].sum()
    tree, nodes = {}, {0: np.ones(len(y), bool)}
    for node in range(2**p.depth - 1):
        rows = nodes.get(node)
        if rows is None:
            continue
        best = (1e-10, None)
        for f in range(x.shape[1]):
            for cut in range(p.bins - 1):
                left, right = rows & (x[:, f] <= cut), rows & (x[:, f] > cut)
                if min(left.sum(), right.sum()) >= p.min_rows and min(h[left].sum(), h[right].sum()) >= p.min_hessian:
                    gain = worth(left) + worth(right) - worth(rows)
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, (f, cut, left, right))
        if best[1]:
            f, cut, left, right = best[1]
            tree[node] = (f, best[0])
            nodes[2 * node + 1], nodes[2 * node + 2] = left, right
    leaves = {n: -p.step * g[r].sum() / h[r].sum() for n, r in nodes.items()}
    return tree, nodes, leaves


def test_one_tree_equals_brute_force(spark, base):
    fs, tr, _ = base
    p = BO.BoostParams(trees=1, depth=3, bins=12, feature_share=1.0, row_share=1.0)
    for repartition in (1, 5):
        b = BO.fit(tr.withColumn("fold", F.lit(1)).repartition(repartition), fs.features, models=[0], params=p)
        rows = b.binned(tr, ["label", "customer_id"]).orderBy("customer_id").collect()
        x = np.array([list(r.bins) for r in rows])
        y = np.array([r.label for r in rows], float)
        tree, nodes, leaves = _brute_tree(x, y, b.base[0], p)
        got = b.trees[0]
        assert {n for n in range(7) if got["feature"][0, n] >= 0} == set(tree)
        margins = {r.customer_id: r.margins[0] - b.base[0] for r in b.margins(tr, ["customer_id"]).collect()}
        at = np.zeros(len(y), int)
        for n, member in nodes.items():
            at[member] = n
        assert max(abs(margins[r.customer_id] - leaves[at[i]]) for i, r in enumerate(rows)) < 1e-9


def test_folds_stop_by_their_patience(spark, base):
    fs, tr, te = base
    p = BO.BoostParams(patience=4, chunk=3, trees=200)
    res = MD.oof_predictions(tr, te, fs.features, folds=3, params=p)
    by: dict = {}
    for m, t, s in res.booster.scores:
        by.setdefault(m, []).append((t, s))
    for k, m in enumerate(res.booster.models):
        scores = [s for _, s in sorted(by[m])]
        best = res.booster.best[k]
        assert scores[best - 1] == max(scores) and scores.index(max(scores)) == best - 1
        assert 4 <= len(scores) - best <= 4 + 2 * p.chunk, "the patience ended it, at the end of a chunk"
    n = tr.count()
    oof = {r.customer_id: r for r in res.oof.collect()}
    assert len(oof) == n and all(0 < r.p < 1 for r in oof.values())
    # the held-out scores of the last kept tree are those of the returned predictions
    for r in res.fold_auc.collect():
        assert abs(r.auc - max(s for _, s in by[r.fold])) < 1e-9
    auc = res.oof_auc.first().auc
    pos = np.array([r.p for r in oof.values() if r.label == 1])
    neg = np.array([r.p for r in oof.values() if r.label == 0])
    brute = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert abs(auc - brute) < 1e-9
    assert res.test.count() == te.count() and res.test_folds.count() == 3 * te.count()
    imp = res.importance.groupBy("fold").agg(F.sum("importance").alias("s")).collect()
    assert all(r.s > 0 for r in imp) and len(imp) == 3


def test_partitions_make_no_difference(spark, base, monkeypatch):
    fs, tr, _ = base
    p = BO.BoostParams(trees=4, patience=4, chunk=4)
    named = tr.withColumn("fold", F.pmod(F.col("customer_id"), F.lit(2)).cast("int"))
    one = BO.fit(named.coalesce(1), fs.features, models=[0, 1], params=p)
    monkeypatch.setattr(BO, "TASK_CELLS", 5000)
    monkeypatch.setattr(BO, "FAN", 2)
    many = BO.fit(named.repartition(6), fs.features, models=[0, 1], params=p)
    for a, b in zip(one.trees, many.trees):
        assert (a["feature"] == b["feature"]).all() and (a["split"] == b["split"]).all() and np.allclose(a["value"], b["value"], atol=1e-9)


def test_saved_models_score_alike(spark, base):
    fs, tr, te = base
    path = f"{checkpoint_dir(spark)}/test-booster-{id(fs)}"
    r = MD.save_load_roundtrip(tr, te, fs.features, path, params=BO.BoostParams(trees=5)).first()
    assert r.rows == te.count() and r.differing == 0


def test_regression_and_odd_rows(spark):
    rows = [(k, float(k % 10) if k % 7 else None, float("nan") if k % 5 == 0 else float(k % 3), 3.0 * (k % 10) + (k % 3 == 2), None if k == 9 else 1.0) for k in range(800)]
    df = spark.createDataFrame(rows, "customer_id long, a double, b double, y double, z double")
    p = BO.BoostParams(trees=150, patience=20)
    out = MD.regression_scores(df, df, ["a", "b"], ["y", "z"], "customer_id", p).orderBy("customer_id").collect()
    y = np.array([r[3] for r in rows])
    known = np.array([r[1] is not None for r in rows])
    pred = np.array([r.pred_y for r in out])
    assert np.abs(pred - y)[known].mean() < 0.7 and len(out) == 800 and all(abs(r.pred_z - 1.0) < 1e-9 for r in out)
    empty = BO.fit(df.limit(0).withColumn("fold", F.lit(0)), ["a", "b"], label="y", params=p, edges=BO.unit_edges(["a", "b"], 8))
    assert empty.trees == [] and empty.scored(df, ["customer_id"]).count() == 800


def test_model_choice(spark, base):
    fs, tr, _ = base
    p = BO.BoostParams(trees=10, patience=5)
    scores = MD.candidate_scores(tr, fs.features, folds=2, params=p)
    assert {r.model: r["count"] for r in scores.groupBy("model").count().collect()} == dict.fromkeys(["gbt", "logistic_regression", "random_forest"], tr.count())
    out = MD.model_selection(tr, fs.features, folds=2, params=p).collect()
    assert len(out) == 3 and sum(r.best for r in out) == 1 and max(out, key=lambda r: r.cv_auc).best


def test_every_model_of_a_small_table_is_a_task(spark, monkeypatch):
    """Models of a table that a task can hold grow side by side in one job a chunk, the same trees as by exchanged sums."""
    rng = np.random.default_rng(3)
    rows = [(k, float(a), float(b), int(a + 0.3 * c > 0), k % 3) for k, (a, b, c) in enumerate(rng.normal(size=(900, 3)))]
    df = spark.createDataFrame(rows, "customer_id long, a double, b double, label int, fold int")
    p = BO.BoostParams(trees=6, patience=6, chunk=3)
    edges = BO.unit_edges(["a", "b"], 8)
    jobs = []
    grown = BO._grown_by_model
    monkeypatch.setattr(BO, "_grown_by_model", lambda state, out, live, *a: jobs.append(list(live)) or grown(state, out, live, *a))
    one = BO.fit(df, ["a", "b"], models=[0, 1, 2], params=p, edges=edges)
    assert jobs == [[0, 1, 2]]
    monkeypatch.setattr(BO, "MODEL_SHARE", 0)
    many = BO.fit(df.repartition(5), ["a", "b"], models=[0, 1, 2], params=p, edges=edges)
    assert jobs == [[0, 1, 2]] and one.best == many.best
    for a, b in zip(one.trees, many.trees, strict=True):
        assert (a["feature"] == b["feature"]).all() and (a["split"] == b["split"]).all() and np.allclose(a["value"], b["value"], atol=1e-9)


def test_margins_of_held_out_rows_move_as_arrays(spark, monkeypatch):
    """Exchanged sums: a group a model and tree has the held-out margins, without an ordered scan; beyond ``HELD_ROWS`` the scan gives the same."""
    rng = np.random.default_rng(6)
    rows = [(k, float(a), float(b), int(a + 0.3 * c > 0), k % 4) for k, (a, b, c) in enumerate(rng.random((1200, 3)) - 0.5)]
    df = spark.createDataFrame(rows, "customer_id long, a double, b double, label int, fold int").repartition(3)
    monkeypatch.setattr(BO, "MODEL_SHARE", 0)
    monkeypatch.setattr(BO, "ROWS_AT_ONCE", 256)
    asked, auc = [], BO.roc_auc
    monkeypatch.setattr(BO, "roc_auc", lambda *a, **k: asked.append(k) or auc(*a, **k))
    for objective in ("binary", "squared"):
        p = BO.BoostParams(trees=4, chunk=2, objective=objective)
        one = BO.fit(df, ["a", "b"], models=[0, 1], params=p, edges=BO.unit_edges(["a", "b"], 8))
        assert not asked
        with monkeypatch.context() as m:
            m.setattr(BO, "HELD_ROWS", 10)
            two = BO.fit(df, ["a", "b"], models=[0, 1], params=p, edges=BO.unit_edges(["a", "b"], 8))
        assert len(one.scores) == 8 and [s[:2] for s in one.scores] == [s[:2] for s in two.scores]
        assert np.allclose([s[2] for s in one.scores], [s[2] for s in two.scores], atol=1e-9)
        assert bool(asked) == (objective == "binary")
        asked.clear()


def test_small_models_wait_for_no_other(spark, monkeypatch):
    """Models of a small table run at the same time, not one after the other, and each in one job to its end."""
    import threading

    rng = np.random.default_rng(4)
    rows = [(k, float(a), int(a + c > 0), k % 3) for k, (a, c) in enumerate(rng.normal(size=(600, 2)))]
    df = spark.createDataFrame(rows, "customer_id long, a double, label int, fold int")
    meet, collect, kind, jobs = threading.Barrier(3), type(df).collect, type(df), []

    def met(self):
        if "tree" in self.columns:
            jobs.append(self)
            meet.wait(60)
        return collect(self)

    monkeypatch.setattr(kind, "collect", met)
    b = BO.fit(df, ["a"], models=[0, 1, 2], params=BO.BoostParams(trees=30, patience=3, chunk=1), edges=BO.unit_edges(["a"], 8))
    assert len(jobs) == 3 and len(b.trees) == max(b.best)


def test_out_of_fold_scores_need_no_auc(spark, monkeypatch):
    rows = [(k, k % 10 / 10, int(k % 10 > 4)) for k in range(400)]
    df = spark.createDataFrame(rows, "customer_id long, a double, label int")
    asked, auc = [], MD.roc_auc
    monkeypatch.setattr(MD, "roc_auc", lambda *a, **k: asked.append(k) or auc(*a, **k))
    r = MD.oof_predictions(df, df, ["a"], folds=2, params=BO.BoostParams(trees=2), edges=BO.unit_edges(["a"], 8))
    assert r.oof.count() == 400 and not asked
    assert r.oof_auc.first().auc > 0.9 and len(asked) == 1


def test_targets_grow_side_by_side(spark, monkeypatch):
    """Each target's model waits for the other's: one after the other they would never meet."""
    import threading

    rows = [(k, float(k % 10), int(k % 10 > 4), int(k % 3 == 0)) for k in range(300)]
    df = spark.createDataFrame(rows, "customer_id long, a double, y int, z int")
    meet, fit = threading.Barrier(2), BO.fit
    monkeypatch.setattr(BO, "fit", lambda *a: meet.wait(60) is None or fit(*a))
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    out = MD.multitask_scores(df, df, ["a"], ["y", "z"], "customer_id", BO.BoostParams(trees=2), edges=BO.unit_edges(["a"], 8))
    assert out.columns == ["customer_id", "p_y", "p_z", "p_mean"] and out.count() == 300
    assert spark.conf.get(setting) == before


def test_sums_a_feature_at_a_time():
    rng = np.random.default_rng(5)
    p, n = BO.BoostParams(bins=8), 20_000
    bins, at = rng.integers(0, 8, (n, 3), dtype=np.uint8), rng.integers(1, 7, n)
    g, h, rows = rng.normal(size=n), rng.random(n), np.arange(n)
    got = BO._sums(at, g, h, bins.T, rows, np.array([0, 2]), 2, p).reshape(3, 4, 2, 8)
    for node in range(4):
        for j, f in enumerate((0, 2)):
            for b in range(8):
                here = (at == 3 + node) & (bins[:, f] == b)
                assert np.allclose(got[:, node, j, b], [g[here].sum(), h[here].sum(), here.sum()])
