"""Preprocessing (L1-L9): encoding, imputing, quantile scaling, masking.

Fitting happens on Spark (distinct values, exact quantiles by rank); only
per-column scalars come back to the driver (medians, means), and the quantile
table (columns x n_quantiles doubles: a size fixed by the caller) is broadcast
to one ``mapInArrow`` pass that applies the interpolation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartcast.operators.hashing import hash_uniform
from cartcast.operators.scan import ScanSpec, ordered_scan
from cartcast.session import kept

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
BOUNDS_THRESHOLD = 1e-7


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


# ---------------------------------------------------------------- ranks / L1

def dense_codes(values: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of ``col`` -> (value, code 0..n-1).

    The rank is a running count over the sorted distinct values done with the
    range-partitioned ordered scan, so no single task sorts all values.
    """
    d = values.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull()).distinct()
    d = d.select(F.lit(0).alias("_k"), "_v", F.lit(1.0).alias("_one"))
    r = ordered_scan(d, "_k", ["_v"], ScanSpec(cumsum={"_rank": "_one"}))
    return r.select(F.col("_v").alias(col), (F.col("_rank") - 1).cast("long").alias("_code"))


def label_encode(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None, few: bool = False) -> DataFrame:
    """L1: replace each string column by the index of its value among the sorted
    distinct values of ``fit_on`` (default: ``df`` itself, i.e. train and test
    together as in the reference).  Nulls stay null.  ``few``: the values are few, such as months, so wide rows aren't moved to them."""
    fit_on = df if fit_on is None else fit_on
    out = df
    for c in cols:
        codes = dense_codes(fit_on, c)
        codes = F.broadcast(codes) if few else codes
        out = (out.join(codes, c, "left")
                  .withColumn(c, F.col("_code")).drop("_code"))
    return out.select(*df.columns)


def unseen_labels(train: DataFrame, valid: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` in ``valid`` that never occur in ``train``."""
    return (valid.select(col).where(F.col(col).isNotNull()).distinct()
                 .join(train.select(col).distinct(), col, "left_anti"))


# ------------------------------------------------------ exact quantiles by rank

RANGE_VALUES = 4_000_000   # values of a column that one group holds, about
CHUNK_CELLS = 8_000_000    # rows x columns whose values are counted at once
_SAMPLED = 32              # values a range that its bounds are taken from


def _value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(k, n, v, c): in every chunk of rows the sorted distinct values ``v`` of column ``k``, how often each occurs ``c`` (empty: once) and the number of
    all ``n``, without nulls and NaN; arrays as bytes."""
    src = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_v{k}") for k, c in enumerate(cols)])
    most = max(1, CHUNK_CELLS // max(1, len(cols)))

    def run(batches):
        import pyarrow as pa

        held, count = [], 0
        for b in batches:
            held.append(b)
            count += b.num_rows
            if count >= most:
                yield from counted(pa.Table.from_batches(held))
                held, count = [], 0
        if count:
            yield from counted(pa.Table.from_batches(held))

    def counted(table):
        import numpy as np

        for k in range(table.num_columns):
            x = table.column(k).to_numpy()
            x = x[~np.isnan(x)] + 0.0  # no minus zero
            if len(x):
                yield _counts_row([k], len(x), *np.unique(x, return_counts=True))

    return src.mapInArrow(run, "k int, n long, v binary, c binary")


def _counts_row(keys: list, n: int, v, c):
    import pyarrow as pa

    c = b"" if n == len(v) else c.astype("int32").tobytes()
    return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int32()) for x in keys), pa.array([n], pa.int64()), pa.array([v.tobytes()], pa.binary()), pa.array([c], pa.binary())],
                                      names=["k", "r"][:len(keys)] + ["n", "v", "c"])


def _counts_of(v, c):
    """Values and counts of one row of ``_value_counts``."""
    import numpy as np

    v = np.frombuffer(v)
    return v, np.frombuffer(c, np.int32) if c else np.ones(len(v), np.int32)


def _value_bounds(counts: DataFrame, totals: dict) -> dict:
    """For columns of more than ``RANGE_VALUES`` values: values that cut each into ranges of about so many."""
    import numpy as np

    step = max(1, RANGE_VALUES // _SAMPLED)
    if not (large := [k for k, n in totals.items() if n > RANGE_VALUES]):
        return {}

    def run(batches):
        import pyarrow as pa

        seen: dict = {}
        for b in batches:
            for k, v, c in zip(*(b.column(i).to_pylist() for i in range(3))):
                v, c = _counts_of(v, c)
                before, upto = seen.get(k, 0), seen.get(k, 0) + np.cumsum(c, dtype=np.int64)
                hit = upto // step > np.concatenate([[before], upto[:-1]]) // step
                seen[k] = int(upto[-1])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(hit.sum(), k), pa.int32()), pa.array(v[hit])], names=["k", "v"])

    by: dict = {k: [] for k in large}
    for r in counts.where(F.col("k").isin(large)).select("k", "v", "c").mapInArrow(run, "k int, v double").collect():
        by[r.k].append(r.v)
    return {k: np.unique(np.sort(v)[_SAMPLED::_SAMPLED]) for k, v in by.items()}


def quantile_table(df: DataFrame, cols: Sequence[str], n_quantiles: int) -> DataFrame:
    """Exact quantiles at references j/(Q-1), j=0..Q-1, per column, with linear
    interpolation between order statistics (numpy ``linear``; DuckDB
    ``quantile_cont``).  Q = min(n_quantiles, rows of the column), as sklearn.

    Distributed: values are counted per chunk of rows and column and written once; a column of more than ``RANGE_VALUES`` values is cut at sampled bounds, and one
    group adds the counts of a (column, range).  With the number of values in the ranges before, its running counts are ranks, and
    it emits only the order statistics that fall in it.  Output: (col, j, ref, q).
    """
    import numpy as np

    cols = list(cols)
    counts = kept(_value_counts(df, cols), "value-counts")
    totals = {r.k: r.n for r in counts.groupBy("k").agg(F.sum("n").alias("n")).collect()}  # a row a column
    bounds = _value_bounds(counts, totals)
    ranged, before = counts.select("k", F.lit(0).alias("r"), "n", "v", "c"), {}
    if bounds:
        def cut(batches):
            for b in batches:
                for k, n, v, c in zip(*(b.column(i).to_pylist() for i in range(4))):
                    v, c = _counts_of(v, c)
                    at = np.concatenate([[0], np.searchsorted(v, bounds[k], side="left"), [len(v)]]) if k in bounds else [0, len(v)]
                    for r, (a, z) in enumerate(zip(at, at[1:])):
                        if z > a:
                            yield _counts_row([k, r], int(c[a:z].sum()), v[a:z], c[a:z])

        ranged = counts.mapInArrow(cut, "k int, r int, n long, v binary, c binary")
        sizes: dict = {(r.k, r.r): r.n for r in ranged.groupBy("k", "r").agg(F.sum("n").alias("n")).collect()}  # a row a range
        for k in totals:
            upto = 0
            for r in range(len(bounds.get(k, ())) + 1):
                before[k, r] = upto
                upto += sizes.get((k, r), 0)

    def found(key, table):
        import pyarrow as pa

        k, r = key[0].as_py(), key[1].as_py()
        parts = [_counts_of(v, c) for v, c in zip(table.column("v").to_pylist(), table.column("c").to_pylist())]
        v, place = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
        upto = np.cumsum(np.bincount(place, np.concatenate([c for _, c in parts])).astype(np.int64))
        # positions h_j = (N-1) j / (Q-1): the order statistics floor(h_j) and ceil(h_j)
        total, first = totals[k], before.get((k, r), 0)
        many = min(int(n_quantiles), total)
        j = np.arange(many)
        down = (total - 1) * j // max(many - 1, 1)
        up = -(-(total - 1) * j // max(many - 1, 1))
        sides = []
        for h in (down, up):
            here = (h >= first) & (h < first + upto[-1])
            sides.append((j[here], v[np.searchsorted(upto, h[here] - first, side="right")]))
        (jl, lo), (jh, hi) = sides
        nothing = lambda n: pa.nulls(n, pa.float64())
        return pa.table({"k": pa.array(np.full(len(jl) + len(jh), k), pa.int32()), "j": pa.array(np.concatenate([jl, jh]), pa.int64()),
                         "vlo": pa.chunked_array([pa.array(lo), nothing(len(jh))]), "vhi": pa.chunked_array([nothing(len(jl)), pa.array(hi)])})

    ends = ranged.groupBy("k", "r").applyInArrow(found, "k int, j long, vlo double, vhi double")
    g = ends.groupBy("k", "j").agg(F.max("vlo").alias("vlo"), F.max("vhi").alias("vhi"))
    # a row a column
    names = df.sparkSession.createDataFrame([(k, cols[k], n, min(int(n_quantiles), n)) for k, n in totals.items()], "k int, col string, _tot long, Q long")
    g = g.join(F.broadcast(names), "k")
    den = (F.col("Q") - 1).cast("double")
    ref = F.when(F.col("Q") == 1, F.lit(0.0)).otherwise(F.col("j").cast("double") / den)
    # exact fraction of the position (N-1) j / (Q-1)
    frac = F.when(F.col("Q") == 1, F.lit(0.0)).otherwise(
        F.pmod((F.col("_tot") - 1) * F.col("j"), F.col("Q") - 1).cast("double") / den)
    q = F.when(F.col("vhi") == F.col("vlo"), F.col("vlo")).otherwise(
        F.col("vlo") + frac * (F.col("vhi") - F.col("vlo")))
    return g.select("col", "j", ref.alias("ref"), q.alias("q"))


def exact_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact median per column (mean of the two middle values)."""
    t = quantile_table(df, cols, 3)
    # with Q = 3 the middle reference is 0.5; with one row Q = 1 and j = 0
    return (t.where(F.col("ref") == 0.5).select("col", F.col("q").alias("median"))
             .unionByName(t.groupBy("col").agg(F.count("*").alias("_n"), F.first("q").alias("median"))
                           .where(F.col("_n") == 1).select("col", "median")))


def _collect_map(df: DataFrame, k: str, v: str) -> dict:
    # one row per feature column: bounded by the schema width
    return {r[k]: r[v] for r in df.collect()}


def null_counts(df: DataFrame, cols: Sequence[str]) -> dict:
    r = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols]).first()
    return r.asDict()


def median_impute(train: DataFrame, test: DataFrame | None, cols: Sequence[str],
                  skip_if_complete: bool = True):
    """L2: fill nulls with the train median of each column; same fill on test.

    Columns without nulls on either side are left alone (the fill would be a
    no-op), which skips the quantile job on the 0-filled main path (S12).
    """
    need = list(cols)
    if skip_if_complete:
        both = train if test is None else train.select(*[F.col(f"`{c}`") for c in cols]).unionByName(
            test.select(*[F.col(f"`{c}`") for c in cols]))
        nc = null_counts(both, cols)
        need = [c for c in cols if nc[c] > 0]
    if not need:
        return train, test, {}
    med = _collect_map(exact_medians(train, need), "col", "median")
    fill = {c: float(med[c]) for c in need if med.get(c) is not None}
    tr = train.fillna(fill)
    te = test.fillna(fill) if test is not None else None
    return tr, te, fill


def mean_fill(train: DataFrame, test: DataFrame | None, cols: Sequence[str]):
    """Fill nulls of each numeric column with its own train mean."""
    r = train.agg(*[F.avg(F.col(f"`{c}`")).alias(c) for c in cols]).first().asDict()
    fill = {c: float(v) for c, v in r.items() if v is not None}
    return train.fillna(fill), (test.fillna(fill) if test is not None else None), fill


def fill_constants(df: DataFrame, numeric: float = 0.0, text: str | None = None) -> DataFrame:
    """Constant fill of numeric (and optionally string) columns."""
    out = df.fillna(numeric, subset=numeric_columns(df))
    if text is not None:
        out = out.fillna(text, subset=string_columns(df))
    return out


def encode_categoricals(train: DataFrame, test: DataFrame, cols: Sequence[str],
                        missing: str = "VV_likely"):
    """Per categorical column fill missing with a marker, then label-encode
    over train and test values together."""
    tr = train.fillna(missing, subset=list(cols))
    te = test.fillna(missing, subset=list(cols))
    both = tr.select(*cols).unionByName(te.select(*cols))
    return label_encode(tr, cols, both), label_encode(te, cols, both)


# ------------------------------------------------------------ L3 / L4 quantile

def fit_quantiles(df: DataFrame, cols: Sequence[str], n_quantiles: int = 1000) -> dict:
    """Quantile arrays per column, made monotone as sklearn does."""
    import numpy as np

    t = quantile_table(df, cols, n_quantiles).select("col", "j", "ref", "q").toArrow()  # len(cols) x n_quantiles values
    t = t.sort_by([("col", "ascending"), ("j", "ascending")])
    names, ref, q = t.column("col").combine_chunks().dictionary_encode(), t.column("ref").to_numpy(), t.column("q").to_numpy()
    at = np.searchsorted(names.indices.to_numpy(), np.arange(len(names.dictionary) + 1))  # the columns are numbered as they come
    return {c: (ref[a:z], np.maximum.accumulate(q[a:z])) for c, a, z in zip(names.dictionary.to_pylist(), at, at[1:])}


# Wichura's rational approximations (algorithm AS 241) for the middle, the tails
# and the far tails; numerator and denominator, constant term first.
_MIDDLE = ((3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
            4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
           (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
            2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3))
_TAIL = ((1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
          1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
         (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
          1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9))
_FAR = ((6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
         2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
        (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
         7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15))


def normal_quantiles(p):
    """Inverse of the standard normal distribution function for an array in (0, 1)."""
    import numpy as np

    p = np.asarray(p, dtype="float64")

    def ratio(form, x):
        up, down = (np.polynomial.polynomial.polyval(x, c) for c in form)
        return up / down

    q = p - 0.5
    r = np.sqrt(-np.log(np.minimum(p, 1 - p)))
    tail = np.where(r <= 5, ratio(_TAIL, r - 1.6), ratio(_FAR, r - 5))
    return np.where(np.abs(q) <= 0.425, q * ratio(_MIDDLE, 0.180625 - q * q), np.copysign(tail, q))


def _transform(fitted_bc, names, cols, normal):
    """Arrow batches of the columns ``names`` with those of ``cols`` mapped through their quantiles."""
    cols = set(cols)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        fitted = fitted_bc.value
        eps = np.spacing(1)
        lo_c, hi_c = normal_quantiles([BOUNDS_THRESHOLD - eps, 1 - (BOUNDS_THRESHOLD - eps)])
        # the tolerance at both ends belongs to the normal output; uniform asks for equality
        slack = BOUNDS_THRESHOLD if normal else 0.0

        def mapped(c, x):
            refs, q = fitted[c]
            fin = ~np.isnan(x)
            lower = x - slack < q[0] if normal else x == q[0]
            upper = x + slack > q[-1] if normal else x == q[-1]
            xf = x[fin]
            x[fin] = 0.5 * (np.interp(xf, q, refs) - np.interp(-xf, -q[::-1], -refs[::-1]))
            x[upper & fin] = 1.0
            x[lower & fin] = 0.0
            if normal:
                y = x.copy()
                ok = fin & (y > 0) & (y < 1)
                y[ok] = normal_quantiles(y[ok])
                y[fin & (x <= 0)] = lo_c
                y[fin & (x >= 1)] = hi_c
                x = np.clip(y, lo_c, hi_c)
            return x

        for b in batches:
            out = []
            for c, column in zip(names, b.columns):
                if c in cols:
                    x = column.to_numpy(zero_copy_only=False).astype("float64")
                    column = pa.array(mapped(c, x) if c in fitted else x, from_pandas=True)  # no value stays none
                out.append(column)
            yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def quantile_transform(train: DataFrame, test: DataFrame | None, cols: Sequence[str],
                       n_quantiles: int = 1000, output: str = "uniform", refit_on_test: bool = False):
    """L3/L4: map each column through its train quantiles to [0, 1] (or to a
    standard normal).  ``refit_on_test=True`` fits the test side on itself, as
    the reference does."""
    spark = train.sparkSession
    cols = list(cols)

    def apply(df, fitted):
        bc = spark.sparkContext.broadcast(fitted)
        schema = T.StructType([T.StructField(f.name, T.DoubleType(), True) if f.name in cols else f
                               for f in df.schema.fields])
        src = df.select(*[F.col(f"`{c}`").cast("double").alias(c) if c in cols else F.col(f"`{c}`")
                          for c in df.columns])
        return src.mapInArrow(_transform(bc, df.columns, cols, output == "normal"), schema)

    f_tr = fit_quantiles(train, cols, n_quantiles)
    tr = apply(train, f_tr)
    te = None
    if test is not None:
        te = apply(test, fit_quantiles(test, cols, n_quantiles) if refit_on_test else f_tr)
    return tr, te


# ----------------------------------------------------------------- L7 L8 L9

def mask_features(df: DataFrame, id_col: str, cols: Sequence[str], ratio: float, seed: int = 0):
    """Bernoulli(ratio) mask per (row, column) from a hash (repeatable);
    masked values become 0.  Returns the frame with ``{c}`` masked and
    ``{c}__mask`` (1 = masked)."""
    out = []
    for c in cols:
        u = hash_uniform(F.concat_ws("/", F.col(id_col).cast("string"), F.lit(c)), seed)
        m = (u < F.lit(ratio)).cast("int")
        out += [F.when(m == 1, F.lit(0.0)).otherwise(F.col(f"`{c}`").cast("double")).alias(c),
                m.alias(f"{c}__mask")]
    keep = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    return df.select(*keep, *out)


def multi_target(df: DataFrame, target: str, n: int) -> DataFrame:
    """The same target repeated ``n`` times as ``{target}_{i}`` columns."""
    return df.select("*", *[F.col(target).alias(f"{target}_{i}") for i in range(n)])


def random_int_target(df: DataFrame, id_col: str, lo: int = 10, hi: int = 15, seed: int = 0,
                      name: str = "rand_target") -> DataFrame:
    """Repeatable integer target in [lo, hi) from a hash of the id."""
    return df.withColumn(name, (F.lit(lo) + F.floor(hash_uniform(id_col, seed) * (hi - lo))).cast("int"))
