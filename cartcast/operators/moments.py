"""Mergeable moments per customer and month.

Count, sum, extremes and central moments of a column are aggregated once per
(customer, month); every anchor and window is a sum over a few of these rows, so
no log row is ever repeated per window.  Moments are taken about the mean of their own
group before they are added, which keeps the digits of small spreads around large values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartcast.functions.months import month_index

STATS = ("mean", "max", "min", "sum", "count", "std", "skew")


def ordered_parts(c: str, place: str) -> list[Column]:
    """First and last value of a column in a month, with their places in the customer's history."""
    x = F.col(c)
    at = F.when(x.isNotNull(), F.col(place))
    return [F.min_by(x, at).alias(f"{c}_f"), F.min(at).alias(f"{c}_fp"), F.max_by(x, at).alias(f"{c}_l"), F.max(at).alias(f"{c}_lp")]


def month_moments(log: DataFrame, cols: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """(customer_id, _mi, parts of each column, ``extra``): one aggregate over the log, one row per
    customer and month (``_mi`` counts months)."""
    aggs = list(extra)
    for c in cols:
        x = F.col(c).cast("double")
        n = F.count(x)
        m2 = F.var_pop(x) * n
        m3 = F.try_divide(F.skewness(x) * F.pow(m2, F.lit(1.5)), F.sqrt(n))
        aggs += [n.alias(f"{c}_n"), F.coalesce(F.sum(x), F.lit(0.0)).alias(f"{c}_s"), F.min(x).alias(f"{c}_lo"), F.max(x).alias(f"{c}_hi"),
                 F.coalesce(m2, F.lit(0.0)).alias(f"{c}_m2"), F.coalesce(F.nanvl(m3, F.lit(0.0)), F.lit(0.0)).alias(f"{c}_m3")]
    # all that follows needs a customer's months together: at most one row a month
    return log.groupBy("customer_id", month_index("order_date").alias("_mi")).agg(*aggs).repartition("customer_id")


def centred(months: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Moments about the mean of each group ``keys``, ready to be added up."""
    w = Window.partitionBy(*keys)
    g = months.withColumns({f"{c}_c": F.coalesce(F.try_divide(F.sum(f"{c}_s").over(w), F.sum(f"{c}_n").over(w)), F.lit(0.0)) for c in cols})
    parts = {}
    for c in cols:
        n, m2 = F.col(f"{c}_n"), F.col(f"{c}_m2")
        d = F.coalesce(F.try_divide(F.col(f"{c}_s"), n) - F.col(f"{c}_c"), F.lit(0.0))
        parts |= {f"{c}_q1": n * d, f"{c}_q2": m2 + n * d * d, f"{c}_q3": F.col(f"{c}_m3") + 3 * d * m2 + n * d * d * d}
    return g.withColumns(parts).drop(*[f"{c}_{k}" for c in cols for k in ("m2", "m3", "c")])


def merged(c: str, stat: str) -> Column:
    """Aggregate expression: ``stat`` of column ``c`` over the rows of several months."""
    if stat == "first":
        return F.min_by(f"{c}_f", f"{c}_fp")
    if stat == "last":
        return F.max_by(f"{c}_l", f"{c}_lp")
    n = F.sum(f"{c}_n")
    if stat == "count":
        return n
    if stat == "sum":
        return F.sum(f"{c}_s")
    if stat == "min":
        return F.min(f"{c}_lo")
    if stat == "max":
        return F.max(f"{c}_hi")
    if stat == "mean":
        return F.try_divide(F.sum(f"{c}_s"), n)
    q1, q2, q3 = (F.sum(f"{c}_q{k}") for k in (1, 2, 3))
    constant = F.min(f"{c}_lo") == F.max(f"{c}_hi")
    m2 = F.greatest(q2 - F.try_divide(q1 * q1, n), F.lit(0.0))
    if stat == "std":
        return F.when(n < 2, F.lit(None).cast("double")).when(constant, F.lit(0.0)).otherwise(F.sqrt(F.try_divide(m2, n - 1)))
    if stat == "skew":
        m3 = q3 - F.try_divide(3 * q1 * q2, n) + F.try_divide(2 * q1 * q1 * q1, n * n)
        value = F.try_divide(F.try_divide(m3, n) * F.sqrt(n * (n - 1)), F.pow(F.try_divide(m2, n), F.lit(1.5)) * (n - 2))
        return F.when(n < 3, F.lit(None).cast("double")).when(constant, F.lit(0.0)).otherwise(value)
    raise ValueError(f"no merged form of {stat!r}")
