"""Training, scoring and explanation.

Boosted trees come from ``operators/boost.py``: all folds grow together, every level of the trees is one pass over the rows,
and each fold stops by its own patience.  Logistic regression and random forests are Spark ML's.  Only fitted
models and per-feature importances (a vector as long as the feature list) live on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartcast.operators import boost
from cartcast.operators.boost import Booster, BoostParams
from cartcast.operators.metrics import roc_auc
from cartcast.operators.split import stratified_folds
from cartcast.session import cleaned, kept

SEED = 42
PARALLEL = 4    # models whose jobs are under way at a time


def assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def p1(col: str = "probability"):
    """Probability of class 1 from an ML probability vector."""
    return vector_to_array(F.col(col))[1]


@dataclass
class OofResult:
    oof: DataFrame          # key, fold, label, p  (out-of-fold prediction of each train row)
    test_folds: DataFrame   # key, fold, p         (each fold's prediction of the test rows)
    test: DataFrame         # key, probability     (fold average)
    importance: DataFrame   # feature, fold, importance (number of splits)
    label: str
    booster: Booster

    # the scans behind these run jobs, so only those that are asked for are built
    @cached_property
    def fold_auc(self) -> DataFrame:
        """fold, auc"""
        return roc_auc(self.oof, self.label, "p", by="fold")

    @cached_property
    def oof_auc(self) -> DataFrame:
        """auc over all OOF rows"""
        return roc_auc(self.oof, self.label, "p")


def folded(train: DataFrame, key: str, label: str, folds: int, shuffle: bool = True) -> DataFrame:
    """``train`` with its stratified fold numbers (one row a key)."""
    numbers = kept(stratified_folds(train.select(key, label), label, key, folds, shuffle=shuffle, seed=SEED).select(key, "fold"), "folds")
    return train.join(numbers, key)


def oof_predictions(train: DataFrame, test: DataFrame, features: Sequence[str], key: str = "customer_id",
                    label: str = "label", folds: int = 10, params: BoostParams | None = None, shuffle: bool = True,
                    edges: list | None = None) -> OofResult:
    """K-fold out-of-fold scoring with a fold-averaged test prediction.  ``edges``: see ``boost.fit``."""
    tr = folded(train.select(key, label, *[F.col(f"`{c}`") for c in features]), key, label, folds, shuffle)
    b = boost.fit(tr, features, label, "fold", key, list(range(folds)), params, edges)
    oof = kept(b.scored(tr, [key, "fold", label]).select(key, "fold", label, F.get("p", "fold").alias("p")), "oof")
    scores = kept(b.scored(test, [key]), "test-scores")
    importance = train.sparkSession.createDataFrame(b.importance(), "feature string, fold int, importance double")
    return OofResult(oof, scores.select(key, F.posexplode("p").alias("fold", "p")),
                     scores.select(key, (F.aggregate("p", F.lit(0.0), lambda a, v: a + v) / float(folds)).alias("probability")),
                     importance, label, b)


def _validation(df: DataFrame, key: str, share: float) -> DataFrame:
    """``df`` with ``fold``: 0 for a hashed share of the keys, 1 for the others."""
    return df.withColumn("fold", F.when(F.pmod(F.xxhash64(F.col(key), F.lit(SEED)), F.lit(1000)) < share * 1000, 0).otherwise(1))


def gbt_scores(train: DataFrame, test: DataFrame, features: Sequence[str], key="customer_id", label="label",
               params: BoostParams | None = None, valid_frac: float = 0.1, edges: list | None = None) -> DataFrame:
    """One boosted model with a hashed validation share for early stopping."""
    b = boost.fit(_validation(train, key, valid_frac), features, label, "fold", key, [0], params, edges)
    return b.scored(test, [key]).select(key, F.get("p", F.lit(0)).alias("probability"))


def learning_curve(train: DataFrame, features: Sequence[str], key="customer_id", label="label",
                   params: BoostParams | None = None, valid_frac: float = 0.2, edges: list | None = None) -> DataFrame:
    """Validation AUC after each tree until the patience ends it; the best iteration is flagged."""
    b = boost.fit(_validation(train, key, valid_frac), features, label, "fold", key, [0], params, edges)
    return train.sparkSession.createDataFrame([(t, float(v), t == b.best[0]) for _, t, v in b.scores],
                                              "iteration int, valid_auc double, best boolean")


def predict_class(model: PipelineModel, df: DataFrame, key: str, names: DataFrame | None = None) -> DataFrame:
    """Class prediction and probability vector; class names through
    a dictionary table (class, name) when given."""
    out = model.transform(df).select(key, F.col("prediction").cast("int").alias("pred"),
                                     vector_to_array("probability").alias("proba"))
    if names is not None:
        out = out.join(names, out.pred == names["class"], "left").drop("class")
    return out


def fit_multiclass(df: DataFrame, features: Sequence[str], label: str, num_trees: int = 50,
                   max_depth: int = 8) -> PipelineModel:
    """Random forest over many classes."""
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth, seed=SEED)
    return Pipeline(stages=[assembler(features), rf]).fit(df)


def regression_scores(train: DataFrame, test: DataFrame, features: Sequence[str], targets: Sequence[str],
                      key: str, params: BoostParams | None = None, valid_frac: float = 0.1, edges: list | None = None) -> DataFrame:
    """One boosted regressor per target; predictions as ``pred_{target}``."""
    return _each_target(train, test, features, targets, key, replace(params or BoostParams(), objective="squared"), valid_frac, edges, "pred_")


def multitask_scores(train: DataFrame, test: DataFrame, features: Sequence[str], tasks: Sequence[str], key: str,
                     params: BoostParams | None = None, valid_frac: float = 0.1, edges: list | None = None) -> DataFrame:
    """One classifier per binary task; per-task scores and their mean."""
    out = _each_target(train, test, features, tasks, key, params or BoostParams(), valid_frac, edges, "p_")
    mean = sum([F.col(f"p_{t}") for t in tasks][1:], F.col(f"p_{tasks[0]}")) / float(len(tasks))
    return out.withColumn("p_mean", mean)


def _each_target(train, test, features, targets, key, params, valid_frac, edges, prefix) -> DataFrame:
    """A model a target (rows without it are left out), grown side by side and applied one after the other: no join."""
    edges = boost.fit_edges(train, features, params.bins) if edges is None else edges
    named = _validation(train, key, valid_frac)
    out, done = test.select(key, *[F.col(f"`{c}`") for c in features]), []
    # no thread may find the setting as another has set it for a while, so it's on for all
    with cleaned(train.sparkSession), ThreadPoolExecutor(max_workers=PARALLEL) as pool:
        models = list(pool.map(lambda t: boost.fit(named, features, t, "fold", key, [0], params, edges), targets))
    for t, b in zip(targets, models):
        out = b.scored(out, out.columns).withColumn(f"{prefix}{t}", F.get("p", F.lit(0))).drop("p")
        done.append(f"{prefix}{t}")
    return out.select(key, *done)


def candidate_scores(train: DataFrame, features: Sequence[str], key: str = "customer_id", label: str = "label", folds: int = 5,
                     params: BoostParams | None = None, edges: list | None = None, parallel: int = 4) -> DataFrame:
    """Held-out probabilities of logistic regression, random forest and boosted trees on the same stratified folds, in
    one long table (model, key, fold, label, p)."""
    tr = folded(train.select(key, label, *[F.col(f"`{c}`") for c in features]), key, label, folds)
    b = boost.fit(tr, features, label, "fold", key, list(range(folds)), params, edges)
    out = b.scored(tr, [key, "fold", label]).select(F.lit("gbt").alias("model"), key, "fold", label, F.get("p", "fold").alias("p"))
    rows = kept(assembler(features).transform(tr).select(key, "fold", F.col(label).cast("double").alias(label), "features"), "candidates")
    others = {"logistic_regression": LogisticRegression(labelCol=label, maxIter=50),
              "random_forest": RandomForestClassifier(labelCol=label, numTrees=30, seed=SEED)}
    jobs = [(name, est, k) for name, est in others.items() for k in range(folds)]
    with ThreadPoolExecutor(max_workers=parallel) as ex:
        models = list(ex.map(lambda j: j[1].fit(rows.where(F.col("fold") != j[2])), jobs))
    for (name, _, k), m in zip(jobs, models):
        scored = m.transform(rows.where(F.col("fold") == k))
        out = out.unionByName(scored.select(F.lit(name).alias("model"), key, "fold", F.col(label).cast(train.schema[label].dataType).alias(label), p1().alias("p")))
    return kept(out, "candidate-scores")


def model_selection(train: DataFrame, features: Sequence[str], key: str = "customer_id", label: str = "label", folds: int = 5,
                    params: BoostParams | None = None, edges: list | None = None) -> DataFrame:
    """Each candidate's mean AUC over the folds; the best is flagged (ties: the first name)."""
    auc = roc_auc(candidate_scores(train, features, key, label, folds, params, edges), label, "p", by=["model", "fold"])
    means = auc.groupBy("model").agg(F.avg("auc").alias("cv_auc"))
    best = means.agg(F.max_by("model", F.struct("cv_auc", F.expr("-ascii(model)"))).alias("_best"))  # one row
    return means.join(F.broadcast(best), F.col("model") == F.col("_best"), "left").select("model", "cv_auc", F.col("_best").isNotNull().alias("best"))


def save_load_roundtrip(train: DataFrame, test: DataFrame, features: Sequence[str], path: str, key: str = "customer_id",
                        label: str = "label", params: BoostParams | None = None, edges: list | None = None) -> DataFrame:
    """Fit, save, load and score again: the scores must be equal."""
    spark = train.sparkSession
    b = boost.fit(_validation(train, key, 0.1), features, label, "fold", key, [0], params, edges)
    b.save(spark, path)
    a = b.scored(test, [key]).select(key, F.get("p", F.lit(0)).alias("p_fit"))
    j = a.join(Booster.load(spark, path).scored(test, [key]).select(key, F.get("p", F.lit(0)).alias("p_loaded")), key)
    return j.agg(F.count("*").alias("rows"), F.max(F.abs(F.col("p_fit") - F.col("p_loaded"))).alias("max_abs_diff"),
                 F.sum((F.col("p_fit") != F.col("p_loaded")).cast("int")).alias("differing"))
