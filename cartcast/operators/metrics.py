"""Metrics as DataFrame aggregates.

All metrics reduce on Spark: partial aggregation on the map side, one row (or
one row per ``by`` group) out.  ROC AUC needs the rank of every score; it is
computed from per-score counts and a running count of negatives along the
score order done with the range-partitioned ordered scan, so neither a global
sort into one task nor a collect is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartcast.operators.scan import ScanSpec, ordered_scan

LOGLOSS_EPS = 1e-15


def _by(by) -> list[str]:
    return [] if by is None else ([by] if isinstance(by, str) else list(by))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by=None) -> DataFrame:
    """Mann-Whitney AUC with tie-averaged ranks (null if one class only)."""
    keys = _by(by)
    y = F.col(label).cast("double")
    g = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
           .groupBy(*keys, F.col(score).cast("double").alias("_s"))
           .agg(F.sum(y).alias("_p"), F.sum(1.0 - y).alias("_n")))
    key = "_g"
    g = g.withColumn(key, F.to_json(F.struct(*[F.col(k) for k in keys])) if keys else F.lit(""))
    c = ordered_scan(g, key, ["_s"], ScanSpec(cumsum={"_cn": "_n"}))
    below = F.col("_cn") - F.col("_n")
    agg = c.groupBy(*keys).agg(
        F.sum(F.col("_p") * (below + 0.5 * F.col("_n"))).alias("_u"),
        F.sum("_p").alias("_P"), F.sum("_n").alias("_N"))
    auc = F.when((F.col("_P") > 0) & (F.col("_N") > 0), F.col("_u") / (F.col("_P") * F.col("_N")))
    return agg.select(*keys, auc.alias("auc"))


def gini(df: DataFrame, label="label", score="score", by=None) -> DataFrame:
    """max(2*AUC - 1, 0)."""
    a = roc_auc(df, label, score, by)
    return a.select(*_by(by), F.greatest(2 * F.col("auc") - 1, F.lit(0.0)).alias("gini"))


def threshold_metrics(df: DataFrame, label="label", score="score", threshold: float = 0.5, by=None) -> DataFrame:
    """O2: accuracy, precision, recall, F1 of ``score > threshold`` (0 where undefined, as sklearn)."""
    y = F.col(label).cast("int")
    p = (F.col(score) > F.lit(threshold)).cast("int")
    g = df.groupBy(*_by(by)).agg(
        F.sum((p * y)).alias("tp"), F.sum(p * (1 - y)).alias("fp"),
        F.sum((1 - p) * y).alias("fn"), F.sum((1 - p) * (1 - y)).alias("tn"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    g = g.select(*_by(by), "tp", "fp", "fn", "tn",
                 ((F.col("tp") + F.col("tn")) / n).alias("accuracy"),
                 prec.alias("precision"), rec.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return g.withColumn("f1", f1)


# ------------------------------------------------------------ class scores

def softmax(scores: Column) -> Column:
    """I8: row-wise softmax of an array column (max-shifted)."""
    m = F.array_max(scores)
    e = F.transform(scores, lambda x: F.exp(x.cast("double") - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)


def argmax(scores: Column) -> Column:
    """Index of the first maximum (0-based), as numpy."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def accuracy(df: DataFrame, label="label", pred="pred", by=None) -> DataFrame:
    """O3: share of rows with pred == label."""
    return df.groupBy(*_by(by)).agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def balanced_accuracy(df: DataFrame, label="label", pred="pred", by=None) -> DataFrame:
    """Mean over true classes of the per-class recall."""
    keys = _by(by)
    per = df.groupBy(*keys, label).agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("_r"))
    return per.groupBy(*keys).agg(F.avg("_r").alias("balanced_accuracy"))


def log_loss(df: DataFrame, label="label", proba="proba", eps: float = LOGLOSS_EPS, by=None) -> DataFrame:
    """Mean negative log of the (clipped, renormalised) probability of the true class.
    ``proba`` is an array over classes 0..k-1 (binary: probability of class 1 as a double)."""
    dt = dict(df.dtypes)[proba]
    if dt.startswith("array"):
        clipped = F.transform(F.col(proba), lambda x: F.least(F.greatest(x.cast("double"), F.lit(eps)), F.lit(1 - eps)))
        tot = F.aggregate(clipped, F.lit(0.0), lambda a, x: a + x)
        p = F.element_at(clipped, F.col(label).cast("int") + 1) / tot
    else:
        q = F.least(F.greatest(F.col(proba).cast("double"), F.lit(eps)), F.lit(1 - eps))
        p = F.when(F.col(label) == 1, q).otherwise(1 - q)
    return df.groupBy(*_by(by)).agg((-F.avg(F.ln(p))).alias("logloss"))


# ------------------------------------------------------------- regression

def regression_metrics(df: DataFrame, y="y", pred="pred", by=None) -> DataFrame:
    """MAE, MSE, RMSE and RMSLE (named as the reference: the mean
    squared log error, no root, predictions clipped at 0) plus its root."""
    e = F.col(pred).cast("double") - F.col(y).cast("double")
    le = F.log1p(F.greatest(F.col(pred).cast("double"), F.lit(0.0))) - F.log1p(F.col(y).cast("double"))
    g = df.groupBy(*_by(by)).agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                                 F.avg(le * le).alias("rmsle"))
    return g.withColumn("rmse", F.sqrt("mse")).withColumn("rmsle_root", F.sqrt("rmsle"))


def masked_reconstruction(long: DataFrame, row="id", col="col", x="x", pred="pred", mask="mask",
                          eps: float = 1e-9) -> DataFrame:
    """O9 on a long matrix (row, col, x, pred, mask): per row
    sum(mask * (pred - x)^2 / (var_samp(x of col) + eps)) / (sum(mask) + eps), averaged over rows."""
    var = long.groupBy(col).agg(F.var_samp(x).alias("_v"))
    j = long.join(var, col)
    err = F.col(mask) * F.pow(F.col(pred) - F.col(x), 2) / (F.coalesce(F.col("_v"), F.lit(0.0)) + eps)
    per = j.groupBy(row).agg(F.sum(err).alias("_l"), F.sum(mask).alias("_m"))
    return per.agg(F.avg(F.col("_l") / (F.col("_m") + eps)).alias("unsup_loss"))


# ------------------------------------------------------------ registry J2

@dataclass(frozen=True)
class Metric:
    """A named metric: DataFrame -> one-row DataFrame with column ``name``."""

    name: str
    fn: Callable[..., DataFrame]
    maximize: bool


_REGISTRY: dict[str, Metric] = {}


def register(name: str, maximize: bool):
    def deco(fn):
        _REGISTRY[name] = Metric(name, fn, maximize)
        return fn
    return deco


def get_metrics(names: Sequence[str | Metric]) -> list[Metric]:
    out = []
    for n in names:
        if isinstance(n, Metric):
            out.append(n)
        elif n in _REGISTRY:
            out.append(_REGISTRY[n])
        else:
            raise ValueError(f"unknown metric {n!r}; registered: {', '.join(sorted(_REGISTRY))}")
    return out


@register("auc", True)
def _m_auc(df, label="label", score="score", by=None):
    return roc_auc(df, label, score, by).withColumnRenamed("auc", "value")


@register("accuracy", True)
def _m_acc(df, label="label", score="score", by=None):
    return accuracy(df.withColumn("_pred", (F.col(score) > 0.5).cast("int")), label, "_pred", by) \
        .withColumnRenamed("accuracy", "value")


@register("balanced_accuracy", True)
def _m_bacc(df, label="label", score="score", by=None):
    return balanced_accuracy(df.withColumn("_pred", (F.col(score) > 0.5).cast("int")), label, "_pred", by) \
        .withColumnRenamed("balanced_accuracy", "value")


@register("logloss", False)
def _m_ll(df, label="label", score="score", by=None):
    return log_loss(df, label, score, by=by).withColumnRenamed("logloss", "value")


@register("mse", False)
def _m_mse(df, label="label", score="score", by=None):
    return regression_metrics(df, label, score, by).select(*_by(by), F.col("mse").alias("value"))


@register("rmse", False)
def _m_rmse(df, label="label", score="score", by=None):
    return regression_metrics(df, label, score, by).select(*_by(by), F.col("rmse").alias("value"))


@register("mae", False)
def _m_mae(df, label="label", score="score", by=None):
    return regression_metrics(df, label, score, by).select(*_by(by), F.col("mae").alias("value"))


@register("rmsle", False)
def _m_rmsle(df, label="label", score="score", by=None):
    return regression_metrics(df, label, score, by).select(*_by(by), F.col("rmsle").alias("value"))


@register("gini", True)
def _m_gini(df, label="label", score="score", by=None):
    return gini(df, label, score, by).withColumnRenamed("gini", "value")


def custom_2auc() -> Metric:
    """The reference's customisation example: twice the AUC, maximised."""
    return Metric("custom", lambda df, label="label", score="score", by=None:
                  roc_auc(df, label, score, by).select(*_by(by), (2 * F.col("auc")).alias("value")), True)


def metric_table(df: DataFrame, metrics: Sequence[str | Metric], eval_col: str = "eval_set",
                 label="label", score="score", task_col: str | None = None) -> DataFrame:
    """Every metric for every eval set, named ``{set}_{metric}``; with
    several tasks the value is the mean over tasks."""
    parts = []
    for m in get_metrics(metrics):
        keys = [eval_col] + ([task_col] if task_col else [])
        r = m.fn(df, label, score, keys)
        if task_col:
            r = r.groupBy(eval_col).agg(F.avg("value").alias("value"))
        parts.append(r.select(eval_col, F.concat(F.col(eval_col), F.lit("_" + m.name)).alias("metric"),
                              F.col("value").cast("double").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
