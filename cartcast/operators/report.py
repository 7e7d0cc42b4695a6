"""Importance and fold reports.

Importance tables are long: (feature, fold, importance).  Their size is the
number of feature columns times the number of folds, a bound set by the
schema, so the global orderings below run on at most that many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EPS = 2.220446049250313e-16  # numpy float64 machine epsilon


def importance_mean(fi: DataFrame, feature="feature", value="importance") -> DataFrame:
    """Mean importance over folds."""
    return fi.groupBy(feature).agg(F.avg(value).alias("importance"))


def importance_wide(fi: DataFrame, folds, feature="feature", value="importance") -> DataFrame:
    """One row a feature with a column ``fold_{k}`` for each fold."""
    wide = fi.groupBy(feature).pivot("fold", [int(k) for k in folds]).agg(F.first(value))
    return wide.withColumnsRenamed({str(k): f"fold_{k}" for k in folds})


def mean_across(cols: list[str]):
    """Mean of several columns of a row, nulls left out."""
    values = F.filter(F.array(*[F.col(f"`{c}`") for c in cols]), lambda v: v.isNotNull())
    return F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), F.size(values))


def importance_ranked(imp: DataFrame, feature="feature", value="importance") -> DataFrame:
    """Sort descending, normalise to 1, cumulative share."""
    w = Window.orderBy(F.desc(value), F.asc(feature))
    tot = F.sum(value).over(Window.partitionBy())
    out = imp.select(feature, value, (F.col(value) / tot).alias("importance_normalized"))
    return (out.withColumn("rank", F.row_number().over(w))
               .withColumn("cumulative_importance",
                           F.sum("importance_normalized").over(w.rowsBetween(Window.unboundedPreceding, 0))))


def importance_top(imp: DataFrame, n: int = 20, feature="feature", value="importance") -> DataFrame:
    """The n most important features (``limit(n)``, not the reference's n+1)."""
    return importance_ranked(imp, feature, value).orderBy("rank").limit(n)


def importance_rollup(fi: DataFrame, mapping: DataFrame, feature="feature", source="source",
                      value="importance") -> DataFrame:
    """Fold importances of expanded columns back to source features
    (mapping: feature -> source), normalised to sum 1."""
    g = fi.join(mapping, feature).groupBy(source).agg(F.sum(value).alias("_s"))
    return g.select(source, (F.col("_s") / F.sum("_s").over(Window.partitionBy())).alias("importance"))


def fold_average(preds: DataFrame, key: str, value: str = "p") -> DataFrame:
    """Arithmetic mean of the fold predictions per key."""
    return preds.groupBy(key).agg(F.avg(value).alias("probability"))


def fold_geomean(preds: DataFrame, key: str, value: str = "p", eps: float = EPS) -> DataFrame:
    """Geometric mean of (prediction + eps) over folds."""
    return preds.groupBy(key).agg(F.exp(F.avg(F.ln(F.col(value) + F.lit(eps)))).alias("probability"))
