"""Split invariants."""

from pyspark.sql import functions as F

from cartcast.operators import split as SP


def test_hash_splits(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    c = {r.Set: r["count"] for r in SP.random_split(df, "k", seed=3).groupBy("Set").count().collect()}
    assert abs(c["train"] / 20000 - 0.8) < 0.02 and abs(c["test"] / 20000 - 0.1) < 0.02
    again = SP.random_split(df, "k", seed=3).groupBy("Set").count().collect()
    assert {r.Set: r["count"] for r in again} == c                     # repeatable
    t = {r.Set: r["count"] for r in SP.two_step_split(df, "k").groupBy("Set").count().collect()}
    assert abs(t["test"] / 20000 - 0.2) < 0.02


def test_weighted_resample_balances(spark):
    rows = [(i, 1 if i % 10 == 0 else 0) for i in range(5000)]
    df = SP.class_weights(spark.createDataFrame(rows, "k long, label int"), "label", 1)
    out = SP.weighted_resample(df, "weight", "k", seed=1)
    assert out.count() == 5000
    share = out.agg(F.avg("label")).first()[0]
    assert 0.4 < share < 0.6                                            # classes drawn equally
