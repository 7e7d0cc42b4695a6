"""Labels and monthly spend.

``label_month`` is one scan and one shuffle: rows before the end of month M are
grouped by customer once, computing "seen before M" and "spend in M" together,
instead of a distinct + an aggregate + a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartcast.functions.months import before, in_month, month_start, ym_shift, year_month

TOTAL_THRES = 300.0


def monthly_spend(log: DataFrame, keys=("customer_id",)) -> DataFrame:
    """Total spend per key and ``year_month``."""
    return (log.withColumn("year_month", year_month("order_date"))
               .groupBy(*keys, "year_month")
               .agg(F.sum("total").alias("total")))


def customers_before(log: DataFrame, ym: str) -> DataFrame:
    """Distinct customers with a row before month ``ym``."""
    return log.filter(before(ym)).select("customer_id").distinct()


def label_month(log: DataFrame, ym: str, threshold: float = TOTAL_THRES, spend: dict[str, str] | None = None) -> DataFrame:
    """K1: one row per customer seen before ``ym``; label = spend in ``ym`` > threshold.

    Output: customer_id, year_month, total, label (int), and for each name in ``spend`` the spend in its month (not after
    ``ym``; null without rows there), from the same pass over the log.
    """
    nxt = month_start(ym_shift(ym, 1))
    g = (log.filter(F.col("order_date") < nxt)
            .groupBy("customer_id")
            .agg(F.max(before(ym).cast("int")).alias("_seen"),
                 F.sum(F.when(in_month(ym), F.col("total"))).alias("_spend"),
                 *[F.sum(F.when(in_month(m), F.col("total"))).alias(name) for name, m in (spend or {}).items()]))
    total = F.coalesce(F.col("_spend"), F.lit(0.0))
    return (g.filter(F.col("_seen") == 1)
             .select("customer_id", F.lit(ym).alias("year_month"), total.alias("total"),
                     (total > F.lit(float(threshold))).cast("int").alias("label"), *(spend or {})))


def label_months(log: DataFrame, months: list[str], threshold: float = TOTAL_THRES) -> DataFrame:
    """Labels for several months in one pass: spend per customer and month, and these rows for the months they concern."""
    months = sorted(months)
    last = month_start(ym_shift(months[-1], 1))
    spend = (log.filter(F.col("order_date") < last).groupBy("customer_id", year_month("order_date").alias("_ym"))
                .agg(F.sum("total").alias("_t")))
    arr = F.array(*[F.lit(m) for m in months])
    # each row counts as "seen before m" for every m after its month, and as spend in its own month
    ex = spend.withColumn("year_month", F.explode(F.filter(arr, lambda m: m >= F.col("_ym"))))
    g = (ex.groupBy("customer_id", "year_month")
           .agg(F.max((F.col("_ym") < F.col("year_month")).cast("int")).alias("_seen"),
                F.sum(F.when(F.col("_ym") == F.col("year_month"), F.col("_t"))).alias("_spend")))
    total = F.coalesce(F.col("_spend"), F.lit(0.0))
    return (g.filter(F.col("_seen") == 1)
             .select("customer_id", "year_month", total.alias("total"),
                     (total > F.lit(float(threshold))).cast("int").alias("label")))
