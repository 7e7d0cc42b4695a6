"""Mergeable states against pandas, and that builders neither shuffle aggregation buffers nor repeat months per window."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cartcast.functions.stats import STATS7
from cartcast.operators.scan import ScanSpec, ordered_scan
from cartcast.operators.states import anchor_stats
from cartcast.operators.windows import trend_features
from cartcast.plans import features as FE
from cartcast.sources.tables import transactions
from tests.conftest import SF001


def _rows():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        who = [None, 1, 2, 3, 4][i % 5] if i % 7 else 1
        x = None if i % 11 == 0 else 1e6 + float(rng.integers(-500, 500)) / 100
        rows.append((who, dt.datetime(2001, 1 + int(rng.integers(0, 7)), 3), float(i), x, 5.0 if who == 2 else float(rng.normal())))
    return rows + [(9, dt.datetime(2001, 6, 1), 1.0, None, 2.0)]


def test_states_as_pandas(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "customer_id long, order_date timestamp_ntz, _rn double, x double, y double").repartition(3)
    spec = [("x", STATS7), ("y", ["first", "last", "skew", "std"])]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        got = anchor_stats(df, ["2001-07", "2001-06"], spec).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100000")
    pdf = pd.DataFrame(rows, columns=["c", "d", "rn", "x", "y"])
    n = 0
    for anchor in ("2001-06", "2001-07"):
        for who, g in pdf[pdf.d < pd.Timestamp(f"{anchor}-01")].groupby("c", dropna=False):
            one = got[(got.year_month == anchor) & (got.customer_id.isna() if np.isnan(who) else got.customer_id == who)]
            assert len(one) == 1
            one, g, n = one.iloc[0], g.sort_values("rn"), n + 1
            want = {"x-mean": g.x.mean(), "x-max": g.x.max(), "x-min": g.x.min(), "x-sum": g.x.sum(), "x-count": g.x.count(), "x-std": g.x.std(),
                    "x-skew": g.x.skew(), "y-first": g.y.iloc[0], "y-last": g.y.iloc[-1], "y-skew": g.y.skew(), "y-std": g.y.std()}
            for k, v in want.items():
                np.testing.assert_allclose(float(one[k]), float(v), rtol=1e-7, atol=1e-9, err_msg=f"{anchor} {who} {k}")
    assert n == len(got)


def test_full_builder_shuffles_one_state_a_key(spark):
    """No aggregation buffers of the wide statistics are shuffled: they were over 200 columns a customer and month."""
    log = transactions(spark, SF001, description=False, country=False)
    p = FE.fe_full(log, "2001-07", encode=False).frame._jdf.queryExecution().optimizedPlan().toString()
    assert "skewness(cumsum" not in p and "var_pop(cumsum" not in p and "MapInArrow" in p


def test_windows_repeat_no_months(spark):
    """A customer's months are merged to all windows at once: one explode (to the anchors), no pivot."""
    log = transactions(spark, SF001, description=False, country=False)
    p = trend_features(log, ["2001-06", "2001-07"])._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Generate explode") == 1 and "pivotfirst" not in p.lower()


def test_only_cut_keys_are_searched(spark):
    """Keys smaller than a range stay whole in range 0; a hot key is still cut and its sums carried."""
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("k"), "id", F.lit(1.0).alias("v"))
    out = ordered_scan(df, "k", ["id"], ScanSpec(cumsum={"c": "v"}), num_partitions=12)
    small = ordered_scan(df.where("k >= 0"), "k", ["id"], ScanSpec(cumsum={"c": "v"}), num_partitions=12)
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan(out) and "aggregate(" not in plan(small) and "_crid" not in plan(small)
    assert out.where("k = -1 and c <> id / 3 + 1").count() == 0
    assert {r.n for r in out.groupBy("k").agg((F.max("c") - F.count("*")).alias("n")).collect()} == {0.0}
