"""Splits, folds, class weights and weighted resampling (M1-M5).

Assignments come from a hash of the row key and a seed, so they are repeatable
and need no shuffle.  Stratified folds number the rows of each class along a
key with the range-partitioned ordered scan: a class holding most rows is
still split over many tasks.
"""

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartcast.operators.hashing import hash_place, hash_uniform
from cartcast.operators.scan import ScanSpec, ordered_scan
from cartcast.session import kept

MAX_CLASSES = 10_000


def random_split(df: DataFrame, key: str, probs=(0.8, 0.1, 0.1), names=("train", "valid", "test"),
                 seed: int = 0, col: str = "Set") -> DataFrame:
    """M1: assign each row to one of ``names`` with the given probabilities."""
    u = hash_uniform(key, seed)
    edges, acc = [], 0.0
    for p in probs[:-1]:
        acc += p
        edges.append(acc)
    expr = F.lit(names[-1])
    for e, n in reversed(list(zip(edges, names[:-1]))):
        expr = F.when(u < F.lit(e), F.lit(n)).otherwise(expr)
    return df.withColumn(col, expr)


def two_step_split(df: DataFrame, key: str, test_size: float = 0.2, valid_size: float = 0.2 / 0.6,
                   seed: int = 0, col: str = "Set") -> DataFrame:
    """M3: a test share first, then a validation share of the rest."""
    u1, u2 = hash_uniform(key, seed), hash_uniform(key, seed + 1)
    return df.withColumn(col, F.when(u1 < test_size, "test").when(u2 < valid_size, "valid").otherwise("train"))


def stratified_folds(df: DataFrame, label: str, key: str, n_splits: int = 10, shuffle: bool = False,
                     seed: int = 42, col: str = "fold") -> DataFrame:
    """M2: fold = (row number of the row within its class along ``key``) mod k.
    Per class the fold sizes differ by at most one.  ``shuffle`` orders by a
    seeded hash of the key instead (ties broken by the key)."""
    order = [key]
    src = df
    if shuffle:
        src = df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
        order = ["_h", key]
    src = src.withColumn("_one", F.lit(1.0))
    r = ordered_scan(src, label, order, ScanSpec(cumsum={"_rn": "_one"}))
    out = r.withColumn(col, F.pmod(F.col("_rn").cast("long") - 1, F.lit(n_splits)).cast("int"))
    return out.drop("_one", "_rn", "_h")


def class_weights(df: DataFrame, label: str, weights=1, col: str = "weight") -> DataFrame:
    """M4/M5: per-row sample weight.  ``1`` = inverse class frequency,
    ``0`` = no weighting (1.0), a dict = weight per class, a column name = given
    weights.  Other values raise, as the reference's argument checks do."""
    if isinstance(weights, bool) or (isinstance(weights, int) and weights not in (0, 1)):
        raise ValueError("weights must be 0, 1, a dict or a column name")
    if isinstance(weights, int):
        if weights == 0:
            return df.withColumn(col, F.lit(1.0))
        cnt = df.groupBy(label).agg((1.0 / F.count("*")).alias(col))
        # one row per class; a class with most rows must not become one partition of a join
        if cnt.limit(MAX_CLASSES + 1).count() <= MAX_CLASSES:
            cnt = F.broadcast(cnt)
        return df.join(cnt, label, "left")
    if isinstance(weights, dict):
        m = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
        return df.withColumn(col, m[F.col(label)])
    if isinstance(weights, str):
        return df.withColumn(col, F.col(weights).cast("double"))
    raise ValueError("weights must be 0, 1, a dict or a column name")


def weighted_resample(df: DataFrame, weight: str, key: str, seed: int = 0, num_samples: int | None = None) -> DataFrame:
    """M4: exactly ``num_samples`` (default: as many as there are rows) draws with replacement, proportional to ``weight``.

    Draw ``i`` falls on a place of the running weights along ``key`` (unique) by a hash of ``i``; rows and draws are put in one order by
    the ordered scan, which hands every draw the last row that begins at or before its place.  So the number of copies of a row follows the
    multinomial law, whatever the partitions are, and another run draws the same.  Rows whose weight is null or not
    positive are never drawn.  Adds ``_copy``, from 1, to each copy of a row."""
    w = F.col(weight).cast("double")
    use = df.where(w > 0).withColumn("_w", w).withColumn("_k", F.lit(0)).withColumn("_one", F.lit(1.0))
    places = ordered_scan(use, "_k", [key], ScanSpec(cumsum={"_upto": "_w", "_no": "_one"}))
    places = kept(places.withColumn("_no", F.col("_no").cast("long")).drop("_k", "_one"), "resample-places")
    stats = places.agg(F.count("*").alias("n"), F.max("_upto").alias("w")).first()
    total = df.count() if num_samples is None else num_samples
    spark = df.sparkSession
    draws = spark.range(total if stats.n else 0).select(
        (hash_place(F.col("id"), seed) * F.lit(stats.w or 0.0)).alias("_place"), F.lit(1).alias("_side"), F.col("id").alias("_i"), F.lit(None).cast("double").alias("_row"))
    marks = places.select((F.col("_upto") - F.col("_w")).alias("_place"), F.lit(0).alias("_side"), F.col("_no").alias("_i"), F.col("_no").cast("double").alias("_row"))
    both = marks.unionByName(draws).withColumn("_k", F.lit(0)).withColumn("_is", F.col("_side") == 0)
    hit = ordered_scan(both, "_k", ["_place", "_side", "_i"], ScanSpec(last_before={"_taken": ("_row", "_is")}))
    copies = hit.where("_side = 1").groupBy(F.col("_taken").cast("long").alias("_no")).agg(F.count("*").alias("_copies"))
    out = places.join(copies, "_no").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], "_copy")


_SMALL_RATE = 500.0


def _poisson_counts(lam, u):
    """Poisson draws: the distribution function inverted at ``u`` for rates up to
    ``_SMALL_RATE``, a generator seeded by ``u`` beyond it."""
    import numpy as np

    lam = np.asarray(lam, dtype="float64")
    u = np.asarray(u, dtype="float64")
    k = np.zeros(len(lam), dtype="int64")
    small = lam <= _SMALL_RATE
    p = np.exp(-np.where(small, lam, 0.0))
    cdf = p.copy()
    active = small & (u > cdf)
    i = 0
    while active.any():  # ends: the terms fall below the last bit of the sum
        i += 1
        p = np.where(active, p * lam / i, p)
        more = cdf + p
        active &= (more > cdf) | (i < lam)
        cdf = np.where(active, more, cdf)
        k = np.where(active, i, k)
        active &= u > cdf
    for at in np.flatnonzero(~small):
        k[at] = np.random.Generator(np.random.Philox(int(u[at] * 2**28))).poisson(lam[at])
    return k


def unique_labels(*frames_cols: tuple[DataFrame, str]) -> DataFrame:
    """Sorted union of the label values of several frames, with their index."""
    parts = [f.select(F.col(c).cast("string").alias("label")) for f, c in frames_cols]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    from cartcast.operators.prep import dense_codes

    return dense_codes(u, "label").withColumnRenamed("_code", "index")


def columns_of_type(df: DataFrame, kinds: Sequence[type]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, tuple(kinds))]


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    """The columns whose name matches the regular expression ``pattern``, in order."""
    return [c for c in df.columns if re.search(pattern, c)]
