"""Ordered scan vs plain windows, with a hot key split over many ranges."""

import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartcast.functions.stats import skew
from cartcast.operators.scan import ScanSpec, ordered_scan, range_bounds


def _table(spark, n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else (None if i % 37 == 0 else f"k{rnd.randint(0, 12)}")
        v = None if i % 11 == 0 else float(rnd.randint(-50, 50))
        rows.append((k, i, v, rnd.random() < 0.4))
    return spark.createDataFrame(rows, "k string, o long, v double, c boolean")


def test_scan_matches_window(spark):
    for ranges in (1, 2, 9, 150):
        df = _table(spark)
        spec = ScanSpec(cumsum={"cs": "v"}, lag={"lg": "v"}, last_before={"lb": ("v", "c")})
        got = ordered_scan(df, "k", ["o"], spec, num_partitions=ranges)
        w = W.partitionBy("k").orderBy("o")
        exp = df.select(
            "o",
            F.when(F.col("v").isNull(), None).otherwise(
                F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0))).alias("e_cs"),
            F.lag("v").over(w).alias("e_lg"),
            F.last(F.when(F.col("c"), F.col("v")), ignorenulls=True).over(
                w.rowsBetween(W.unboundedPreceding, -1)).alias("e_lb"))
        j = got.join(exp, ["o"])
        bad = j.where(
            F.col("k").isNotNull() & (
                ~F.col("cs").eqNullSafe(F.col("e_cs")) | ~F.col("lg").eqNullSafe(F.col("e_lg"))
                | ~F.col("lb").eqNullSafe(F.col("e_lb")))).count()
        assert j.count() == 600
        assert bad == 0
        # pandas semantics: rows with a null key get no running values
        assert got.where(F.col("k").isNull() & F.col("cs").isNotNull()).count() == 0


def test_hot_key_spread(spark):
    """The hot key lands in several ranges (no single-task group)."""
    df = _table(spark, 900)
    bounds = range_bounds(df, "k", ["o"], 9)
    assert 6 <= len(bounds) <= 9 and sum(b[0] == "hot" for b in bounds) >= 2


def test_sums_of_a_key_carry_nothing_of_other_keys(spark):
    """One-line orders of 2.55 sum to 2.55 exactly, and an infinite value stays with its key."""
    df = spark.createDataFrame([(f"c{i % 500:03d}", i, 2.55, float("inf") if i % 500 == 0 else 1.0) for i in range(3000)], "c string, o long, v double, x double")
    df = df.withColumn("k", F.concat("c", F.lit("-"), F.col("o").cast("string")))
    got = ordered_scan(df, "k", ["o"], ScanSpec(cumsum={"cs": "v"}), num_partitions=16)
    assert got.where("cs <> 2.55D").count() == 0
    assert got.groupBy("c").agg(skew("cs").alias("s")).where("s <> 0 or s is null").count() == 0
    inf = ordered_scan(df, "c", ["o"], ScanSpec(cumsum={"cs": "x"}), num_partitions=16)
    assert inf.where("c <> 'c000' and (cs is null or cs > 6)").count() == 0
    assert inf.where("c = 'c000' and cs <> double('inf')").count() == 0


def test_result_does_not_depend_on_partitions(spark):
    """A scan inside a union, recomputed after its cache is dropped, keeps its values."""
    df = spark.createDataFrame([("hot", i, 1.0) for i in range(200)], "k string, o long, v double").repartition(7)
    scan = ordered_scan(df, "k", ["o"], ScanSpec(cumsum={"cs": "v"}), num_partitions=6).cache()
    scan.count()
    other = spark.createDataFrame([("x", -1, 0.0, 0.0)], "k string, o long, v double, cs double").repartition(3)
    both = other.unionByName(scan)
    scan.unpersist(blocking=True)
    assert both.where("k = 'hot' and cs <> o + 1").count() == 0 and both.count() == 201


def test_lazy(spark):
    """Building a scan persists nothing."""
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    ordered_scan(_table(spark), "k", ["o"], ScanSpec(lag={"l": "v"}))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def _row_values(df, spark):
    cols = [f"cumsum_{v}_by_{k}" for k in ("order_id", "cust_id", "prod_id") for v in ("total", "quantity", "price")]
    return {r.l_linenumber: tuple(None if r[c] is None else round(r[c], 6) for c in cols) for r in df.collect()}


def test_sums_by_order_inside_the_customers_scan(spark, monkeypatch):
    """Orders of one customer take no exchange of their own; those of several, of none and of a customer that is cut are right as well."""
    import cartcast.operators.rowfeat as RF
    import cartcast.operators.scan as SC
    from tests.fixtures import LOG_SCHEMA, d

    def rows(odd):
        out = []
        for k in range(400):
            c = 7 if k % 2 else k % 40
            o = "x" if odd and k % 23 == 0 else None if odd and k % 29 == 0 else f"{c}-{k % 9}"
            out.append((o, str(k % 11), "i", float(k % 5), d(2001, 1 + k % 6, 1 + k % 20), 2.0 if k % 13 else None, None if odd and k % 17 == 0 else c, "X", 2.0 * (k % 5), k // 3, k, k % 11, 1, float(k)))
        return spark.createDataFrame(out, LOG_SCHEMA)

    order = ["order_date", "l_orderkey", "l_linenumber"]
    for odd in (False, True):
        log = rows(odd)
        want = log
        for key in ("product_id", "order_id", "customer_id"):
            want = SC.ordered_scan(want, key, order, RF.cumsum_spec(key))
        want = _row_values(want, spark)
        for loose, ranges, made in ((10_000, 6, RF.row_features), (0, None, RF.cumsum_features))[:1 + odd]:
            monkeypatch.setattr(RF, "LOOSE_ORDERS", loose)
            assert _row_values(made(log, order, ranges), spark) == want, (odd, loose, ranges)
    # no customer is cut, and none shares an order: rows are dealt by product and by customer only
    calm = rows(False).where("customer_id <> 7")
    plan = RF.cumsum_features(calm, order)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "order_id" in x]
