"""Metrics, quantiles, encoding, folds and weights against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartcast.operators import metrics as MT
from cartcast.operators import prep as PR
from cartcast.operators import report as RP
from cartcast.operators import split as SP


def _auc_brute(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_ties_and_invariance(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300).tolist()
    s = (rng.integers(0, 20, 300) / 20.0).tolist()          # many ties
    df = spark.createDataFrame(list(zip(range(300), y, s)), "id long, label int, score double")
    a = MT.roc_auc(df).first().auc
    assert a == pytest.approx(_auc_brute(y, s), abs=1e-12)
    b = MT.roc_auc(df.withColumn("score", F.exp(F.col("score") * 3))).first().auc   # monotone transform
    assert b == pytest.approx(a, abs=1e-12)
    one = MT.roc_auc(df.withColumn("label", F.lit(1))).first().auc
    assert one is None
    g = MT.gini(df).first().gini
    assert g == pytest.approx(max(2 * a - 1, 0), abs=1e-12)


def test_threshold_and_multiclass(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.1), (1, 0.7)], "label int, score double")
    r = MT.threshold_metrics(df).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (2, 1, 1, 1)
    assert r.precision == pytest.approx(2 / 3) and r.recall == pytest.approx(2 / 3) and r.f1 == pytest.approx(2 / 3)
    mc = spark.createDataFrame([(0, [2.0, 1.0, 0.0]), (1, [0.0, 0.0, 3.0]), (2, [0.0, 1.0, 5.0]), (2, [1.0, 1.0, 0.0])],
                               "label int, z array<double>")
    mc = mc.withColumn("proba", MT.softmax(F.col("z"))).withColumn("pred", MT.argmax(F.col("proba")))
    assert [r.pred for r in mc.collect()] == [0, 2, 2, 0]
    assert MT.accuracy(mc).first().accuracy == pytest.approx(0.5)
    assert MT.balanced_accuracy(mc).first().balanced_accuracy == pytest.approx((1 + 0 + 0.5) / 3)
    z = np.array([[2.0, 1.0, 0.0], [0.0, 0.0, 3.0], [0.0, 1.0, 5.0], [1.0, 1.0, 0.0]])
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    ll = -np.mean(np.log(p[np.arange(4), [0, 1, 2, 2]]))
    assert MT.log_loss(mc).first().logloss == pytest.approx(ll)


def test_regression_and_registry(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0), (0.0, -1.0)], "y double, pred double")
    r = MT.regression_metrics(df).first()
    e = np.array([1.0, -2.0, -1.0])
    assert r.mae == pytest.approx(np.abs(e).mean()) and r.mse == pytest.approx((e ** 2).mean())
    le = np.log1p([2.0, 1.0, 0.0]) - np.log1p([1.0, 3.0, 0.0])
    assert r.rmsle == pytest.approx((le ** 2).mean())
    with pytest.raises(ValueError):
        MT.get_metrics(["nope"])
    assert MT.get_metrics(["auc"])[0].maximize


def test_exact_quantiles_vs_numpy(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=257) * 10, 1)            # ties
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    t = {r.j: r.q for r in PR.quantile_table(df, ["x"], 11).collect()}
    exp = np.percentile(x, np.linspace(0, 100, 11))
    for j in range(11):
        assert t[j] == pytest.approx(exp[j], abs=1e-9)
    med = PR.exact_medians(spark.createDataFrame([(1.0,), (1.0,), (2.0,), (2.0,)], "x double"), ["x"]).first().median
    assert med == 1.5                                       # S11


def _sk_uniform(train, test, nq):
    refs = np.linspace(0, 1, nq)
    q = np.maximum.accumulate(np.percentile(train, refs * 100))
    out = 0.5 * (np.interp(test, q, refs) - np.interp(-test, -q[::-1], -refs[::-1]))
    out[test + 1e-7 > q[-1]] = 1
    out[test - 1e-7 < q[0]] = 0
    return out


def test_quantiles_of_a_column_in_many_ranges(spark, monkeypatch):
    """Columns of more values than a range holds are cut; ties, nulls and NaN among them change nothing."""
    rng = np.random.default_rng(2)
    a, b = np.round(rng.normal(size=3000), 2), np.where(rng.random(3000) < 0.8, 0.0, rng.normal(size=3000))
    rows = [(float(x) if k % 11 else None, float(y) if k % 7 else float("nan"), k if k < 5 else None) for k, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c int").repartition(3)
    want = {"a": a[np.arange(3000) % 11 > 0], "b": b[np.arange(3000) % 7 > 0], "c": np.arange(5.0)}
    for most in (PR.RANGE_VALUES, 100):
        monkeypatch.setattr(PR, "RANGE_VALUES", most)
        monkeypatch.setattr(PR, "CHUNK_CELLS", 600)
        got = PR.fit_quantiles(df, ["a", "b", "c"], 101)
        assert set(got) == set(want)
        for c, x in want.items():
            refs, q = got[c]
            assert len(q) == min(101, len(x)) and np.allclose(q, np.quantile(x, refs), atol=1e-12), (c, most)
    assert PR.quantile_table(df.limit(0), ["a"], 5).count() == 0


def test_values_of_quantiles_move_as_arrays(spark):
    """No row a value is made, and no running window sorts them."""
    df = spark.range(2000).select(F.rand(1).alias("a"), F.rand(2).alias("b"))
    plan = PR.quantile_table(df, ["a", "b"], 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan


def test_quantile_transform_vs_formula(spark):
    rng = np.random.default_rng(6)
    tr = np.round(rng.exponential(size=400) * 5, 2)
    te = np.round(rng.exponential(size=50) * 5, 2)
    a = spark.createDataFrame([(i, float(v)) for i, v in enumerate(tr)], "id long, x double")
    b = spark.createDataFrame([(i, float(v)) for i, v in enumerate(te)], "id long, x double")
    _, out = PR.quantile_transform(a, b, ["x"], n_quantiles=100)
    got = np.array([r.x for r in out.orderBy("id").collect()])
    assert np.allclose(got, _sk_uniform(tr, te, 100), atol=1e-9)


def test_label_encode_and_unseen(spark):
    tr = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    te = spark.createDataFrame([("c",), ("a",)], "c string")
    both = tr.unionByName(te)
    codes = {r.c_src: r.c for r in PR.label_encode(both.withColumn("c_src", F.col("c")), ["c"], both).collect()}
    assert codes == {"a": 0, "b": 1, "c": 2, None: None}
    assert [r.c for r in PR.unseen_labels(tr, te, "c").collect()] == ["c"]


def test_folds_balanced(spark):
    rng = np.random.default_rng(8)
    y = rng.integers(0, 2, 503).tolist()
    df = spark.createDataFrame(list(zip(range(503), y)), "id long, label int")
    f = SP.stratified_folds(df, "label", "id", 10)
    sizes = f.groupBy("label", "fold").count().toPandas()
    for _, g in sizes.groupby("label"):
        assert g["count"].max() - g["count"].min() <= 1 and len(g) == 10
    assert f.count() == 503


def test_class_weights(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1)], "id long, label int")
    w = {r.id: r.weight for r in SP.class_weights(df, "label", 1).collect()}
    assert w == {1: pytest.approx(1 / 3), 2: pytest.approx(1 / 3), 3: pytest.approx(1 / 3), 4: 1.0}
    with pytest.raises(ValueError):
        SP.class_weights(df, "label", 2)
    d = {r.id: r.weight for r in SP.class_weights(df, "label", {0: 0.5, 1: 2.0}).collect()}
    assert d[4] == 2.0


def test_importance_reports(spark):
    fi = spark.createDataFrame([("a", 1, 3.0), ("a", 2, 1.0), ("b", 1, 1.0), ("b", 2, 1.0), ("c", 1, 0.0), ("c", 2, 4.0)],
                               "feature string, fold int, importance double")
    r = RP.importance_ranked(RP.importance_mean(fi)).orderBy("rank").collect()
    assert [x.feature for x in r] == ["a", "c", "b"]
    assert r[-1].cumulative_importance == pytest.approx(1.0)
    roll = RP.importance_rollup(fi, spark.createDataFrame([("a", "s1"), ("b", "s1"), ("c", "s2")], "feature string, source string"))
    assert sum(x.importance for x in roll.collect()) == pytest.approx(1.0)


def test_masked_reconstruction(spark):
    rows = [(i, j, float(i * j % 5), 2.0, int((i + j) % 3 == 0)) for i in range(6) for j in range(3)]
    df = spark.createDataFrame(rows, "id long, col int, x double, pred double, mask int")
    got = MT.masked_reconstruction(df).first().unsup_loss
    X = np.zeros((6, 3)); M = np.zeros((6, 3))
    for i, j, x, _, m in rows:
        X[i, j], M[i, j] = x, m
    var = X.var(0, ddof=1) + 1e-9
    exp = np.mean(((M * (2.0 - X) ** 2) / var).sum(1) / (M.sum(1) + 1e-9))
    assert got == pytest.approx(exp)


def test_poisson_counts_have_the_right_mean():
    import numpy as np

    from cartcast.operators.split import _poisson_counts

    u = (np.arange(4000) + 0.5) / 4000
    for rate in (0.1, 3.0, 800.0, 50_000.0):
        k = _poisson_counts(np.full(4000, rate), u)
        assert abs(k.mean() - rate) < 6 * (rate / 4000) ** 0.5 + 0.01, rate
        assert k.max() > rate


def test_normal_quantiles_as_the_standard_library():
    from statistics import NormalDist

    import numpy as np

    from cartcast.operators.prep import normal_quantiles

    p = np.concatenate([10.0 ** -np.arange(1, 300, 7), np.linspace(0.001, 0.999, 999)])
    assert np.abs(normal_quantiles(p) - [NormalDist().inv_cdf(x) for x in p]).max() < 1e-13


def test_target_type_of_strings(spark):
    from cartcast.operators.profile import target_type

    df = spark.createDataFrame([("a", "x", 1), ("b", "x", 0), ("c", "x", 1)], "three string, one string, n int")
    assert [target_type(df, [c]).first()[1] for c in ("three", "one", "n")] == ["multiclass", "binary", "binary"]
    assert target_type(df, ["three", "n"]).first()[1] == "multiclass-multioutput"
