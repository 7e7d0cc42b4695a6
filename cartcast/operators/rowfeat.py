"""Row-level features.

Running sums per customer, product and order; differences to the previous row
of the customer; time gap between positive rows.  All three keys go through
the skew-safe ``ordered_scan`` (range partitioned, carries between ranges), so
a hot product or customer is split over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartcast.functions.months import unix_seconds, year_month
from cartcast.operators.scan import Inside, ScanSpec, cut_keys, ordered_scan, range_bounds
from cartcast.session import cleaned
from cartcast.sources.tables import LOG_ORDER

VALUES = ["total", "quantity", "price"]
LOOSE_ORDERS = 10_000   # orders of several customers that are named in the plan
# The reference's names for the running-sum keys.
KEY_TAGS = {"customer_id": "cust_id", "product_id": "prod_id", "order_id": "order_id"}


def cumsum_spec(key: str) -> ScanSpec:
    tag = KEY_TAGS.get(key, key)
    return ScanSpec(cumsum={f"cumsum_{v}_by_{tag}": v for v in VALUES})


def cumsum_by(log: DataFrame, key: str, order=LOG_ORDER, num_partitions=None) -> DataFrame:
    """Running sum of total, quantity, price per ``key`` in log order."""
    return ordered_scan(log, key, list(order), cumsum_spec(key), num_partitions)


def with_order_ts(log: DataFrame) -> DataFrame:
    return log.withColumn("order_ts", unix_seconds("order_date"))


def customer_scan(log: DataFrame, order=LOG_ORDER, with_cumsum=True, num_partitions=None, plain: DataFrame | None = None, **scan) -> DataFrame:
    """One scan by customer: running sums, previous-row values, last positive time.  ``plain``: the same rows without columns of
    other scans, for the bounds; ``scan``: see ``ordered_scan``."""
    ready = lambda d: with_order_ts(d).withColumn("_pos", F.col("total") > 0).withColumn("_one", F.lit(1.0))
    df = ready(log)
    cums = {f"cumsum_{v}_by_cust_id": v for v in VALUES} if with_cumsum else {}
    # _rn: position of the row in its customer's history (log order); a
    # fixed-width ordering for first/last keeps the aggregates hash-based.
    cums["_rn"] = "_one"
    spec = ScanSpec(
        cumsum=cums,
        lag={f"_prev_{c}": c for c in ["order_ts", "quantity", "price", "total"]},
        last_before={"_prev_pos_ts": ("order_ts", "_pos")},
    )
    out = ordered_scan(df, "customer_id", list(order), spec, num_partitions, None if plain is None else ready(plain), **scan)
    return (out.withColumn("order_ts_diff", F.col("order_ts") - F.col("_prev_order_ts"))
               .withColumn("quantity_diff", F.col("quantity") - F.col("_prev_quantity"))
               .withColumn("price_diff", F.col("price") - F.col("_prev_price"))
               .withColumn("total_diff", F.col("total") - F.col("_prev_total"))
               .withColumn("order_ts_plus", F.when(F.col("_pos"), F.col("order_ts")).otherwise(F.lit(0.0)))
               .withColumn("order_ts_plus_diff",
                           F.coalesce(F.when(F.col("_pos"), F.col("order_ts") - F.col("_prev_pos_ts")),
                                      F.lit(0.0)))
               .drop("_prev_order_ts", "_prev_quantity", "_prev_price", "_prev_total", "_prev_pos_ts", "_pos", "_one"))


def _chain(df: DataFrame, log: DataFrame, keys, order, num_partitions) -> DataFrame:
    """Scans by several keys one after another; bounds come from the plain log."""
    for key in keys:
        df = ordered_scan(df, key, list(order), cumsum_spec(key), num_partitions, bounds_from=log)
    return df


def _by_order(df: DataFrame, log: DataFrame, order, num_partitions) -> tuple[DataFrame, dict]:
    """``df`` prepared for running sums by order, and what the scan by customer needs to make them (see ``ordered_scan``).

    An order lies whole among the rows of one customer, so its running sums are made where the customers' scan has put them.  Only rows of
    customers that are cut, of none, and of orders that several customers share go through a scan by order; with over ``LOOSE_ORDERS`` shared orders all do."""
    keys, spec = list(order), cumsum_spec("order_id")
    found = range_bounds(log, "customer_id", keys, num_partitions)
    who = F.col("customer_id")
    nobody = bool(log.where(who.isNull()).limit(1).count())
    some = [F.min(who).alias("lo"), F.max(who).alias("hi"), *([F.count(who).alias("n"), F.count("*").alias("all")] if nobody else [])]
    orders = log.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(*some).where("lo <> hi" + (" or (n > 0 and n <> all)" if nobody else ""))
    with cleaned(log.sparkSession):
        shared = orders.select("order_id").limit(LOOSE_ORDERS + 1).collect()
    if len(shared) > LOOSE_ORDERS:
        return ordered_scan(df, "order_id", keys, spec, num_partitions, bounds_from=log), {"found": found}
    cut, shared = cut_keys(found), [r.order_id for r in shared]
    if not cut and not shared and not nobody:
        return df, {"found": found, "inside": Inside("order_id", spec.cumsum)}
    loose = F.coalesce(who.isNull() | who.isin(cut) | F.coalesce(F.col("order_id").isin(shared), F.lit(False)), F.lit(False))
    given = ordered_scan(df.where(loose), "order_id", keys, spec, num_partitions, bounds_from=log.where(loose))
    rest = df.where(~loose).withColumns({o: F.lit(None).cast("double") for o in spec.cumsum})
    return rest.unionByName(given), {"found": found, "inside": Inside("order_id", spec.cumsum, loose)}


def row_features(log: DataFrame, order=LOG_ORDER, num_partitions=None) -> DataFrame:
    """All row-level columns used by the full builder (K4)."""
    # the customers' scan comes last: its many columns are never shuffled, and a customer's rows stay together
    df, scan = _by_order(_chain(log, log, ["product_id"], order, num_partitions), log, order, num_partitions)
    df = customer_scan(df, order, True, num_partitions, log, **scan)
    return (df.withColumn("month-mode", F.month("order_date"))
              .withColumn("year_month-mode", year_month("order_date")))


def cumsum_features(log: DataFrame, order=LOG_ORDER, num_partitions=None) -> DataFrame:
    """Running sums by customer, product and order (K3 inputs)."""
    df, scan = _by_order(_chain(log, log, ["product_id"], order, num_partitions), log, order, num_partitions)
    return ordered_scan(df, "customer_id", list(order), cumsum_spec("customer_id"), num_partitions, bounds_from=log, **scan)
