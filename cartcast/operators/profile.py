"""Profiling and data checks.

Column-wise profiles are computed in long form: rows are unpivoted to
(column, value) once and aggregated by column, so one shuffle serves every
column instead of one aggregate per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartcast.operators.prep import NUMERIC, quantile_table


def histogram(df: DataFrame, col: str) -> DataFrame:
    """Value counts sorted by value."""
    return df.groupBy(col).count().orderBy(col)


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, quartiles (exact, linear interpolation), max per column."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v"))
                                         for c in cols])).alias("_p")).select("_p.*")
    base = long.groupBy("column").agg(F.count("v").alias("count"), F.avg("v").alias("mean"),
                                      F.stddev_samp("v").alias("std"), F.min("v").alias("min"),
                                      F.max("v").alias("max"))
    q = quantile_table(df, cols, 5)
    qw = (q.where(F.col("j").isin(1, 2, 3)).groupBy(F.col("col").alias("column"))
           .agg(*[F.max(F.when(F.col("j") == j, F.col("q"))).alias(n) for j, n in [(1, "p25"), (2, "p50"), (3, "p75")]]))
    return base.join(qw, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def column_cardinality(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct non-null values per column, in long form."""
    cols = list(cols or df.columns)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("v"))
                                         for c in cols])).alias("_p")).select("_p.*")
    return (long.where(F.col("v").isNotNull()).distinct()
                .groupBy("column").agg(F.count("*").alias("nunique")))


def categorical_columns(df: DataFrame, max_card: int = 200, cols: Sequence[str] | None = None) -> DataFrame:
    """A column is categorical if it is a string or has fewer than ``max_card`` values."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    card = column_cardinality(df, cols)
    is_str = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(isinstance(types[c], T.StringType)))])
    return card.select("column", "nunique",
                       (is_str[F.col("column")] | (F.col("nunique") < max_card)).alias("categorical"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """D15."""
    return df.groupBy(label).count()


def id_patterns(df: DataFrame, col: str) -> DataFrame:
    """Digits -> '_' pattern of an id, with rows, distinct ids and
    whether the pattern is non-numeric."""
    pat = F.regexp_replace(F.col(col), "[0-9]", "_")
    return (df.select(F.col(col), pat.alias("pattern"))
              .groupBy("pattern")
              .agg(F.count("*").alias("rows"), F.count_distinct(col).alias("ids"),
                   (~F.col("pattern").rlike("^_+$")).alias("nonnumeric")))


def target_type(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Type of target like scikit-learn's ``type_of_target`` for one or
    several target columns: binary, multiclass, continuous, and the
    -multioutput / multilabel-indicator forms for several columns.  Strings are
    classes: their number of distinct values decides, never a cast."""
    cols = list(cols)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}

    def entry(c):
        number = F.lit(None).cast("double") if c in text else F.col(f"`{c}`").cast("double")
        return F.struct(F.col(f"`{c}`").cast("string").alias("s"), number.alias("v"))

    long = df.select(F.explode(F.array(*[entry(c) for c in cols])).alias("_p")).select("_p.*").where("s is not null")
    frac = F.max(F.coalesce((F.col("v") != F.floor("v")).cast("int"), F.lit(0)))
    g = long.agg(frac.alias("frac"), F.count_distinct(F.coalesce(F.col("v").cast("string"), F.col("s"))).alias("nuniq"),
                 F.max(F.when(F.col("v").isin(0.0, 1.0), 0).otherwise(1)).alias("non01"))
    if len(cols) == 1:
        t = (F.when(F.col("frac") == 1, "continuous")
              .when(F.col("nuniq") <= 2, "binary").otherwise("multiclass"))
    else:
        t = (F.when((F.col("non01") == 0) & (F.col("nuniq") <= 2) & (F.col("nuniq") > 1), "multilabel-indicator")
              .when(F.col("frac") == 1, "continuous-multioutput").otherwise("multiclass-multioutput"))
    return g.select(F.lit(",".join(cols)).alias("target"), t.alias("target_type"))


def nonfinite_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P5: null, NaN and infinite values per numeric column (long form)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and (cols is None or f.name in cols)]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v"))
                                         for c in cols])).alias("_p")).select("_p.*")
    inf = F.col("v").isin(float("inf"), float("-inf"))
    return long.groupBy("column").agg(F.count_if(F.col("v").isNull()).alias("nulls"),
                                      F.count_if(F.isnan("v")).alias("nans"),
                                      F.count_if(inf).alias("infs"))


def schema_check(train: DataFrame, evals: dict[str, DataFrame], features: Sequence[str],
                 targets: Sequence[str], key: str = "customer_id") -> DataFrame:
    """Every eval set has the train feature columns with the same types, the
    same number of target columns, and one target for each feature row; one report row per
    (set, check).  The pairing is counted over all rows."""
    spark = train.sparkSession
    ttypes = {f.name: f.dataType.simpleString() for f in train.schema.fields}
    out = None
    for name, df in evals.items():
        etypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        missing = [c for c in features if c not in etypes]
        wrong = [c for c in features if c in etypes and etypes[c] != ttypes.get(c)]
        have = [t for t in targets if t in etypes]
        fixed = spark.createDataFrame([(name, "features_present", not missing, ",".join(missing)), (name, "feature_types", not wrong, ",".join(wrong)),
                                       (name, "target_count", len(have) == len(targets), str(len(have)))], "eval_set string, check string, ok boolean, detail string")
        paired = F.count_if(F.col(key).isNotNull() & (F.lit(len(have) == len(targets)) if not have else F.greatest(*[F.col(t).isNull().cast("int") for t in have], F.lit(0)) == 0))
        rows = df.agg(F.count("*").alias("rows"), paired.alias("paired")).select(
            F.lit(name).alias("eval_set"), F.lit("row_pairing").alias("check"), (F.col("rows") == F.col("paired")).alias("ok"),
            F.concat_ws("/", F.col("paired").cast("string"), F.col("rows").cast("string")).alias("detail"))
        part = fixed.unionByName(rows)
        out = part if out is None else out.unionByName(part)
    return out


def target_type_mix(df: DataFrame, col: str) -> DataFrame:
    """Numeric vs non-numeric values of a string column (mixed types fail
    the reference's single-type check)."""
    num = F.col(col).try_cast("double").isNotNull()
    return df.agg(F.count_if(num).alias("numeric"), F.count_if(~num & F.col(col).isNotNull()).alias("non_numeric"),
                  ((F.count_if(num) > 0) & (F.count_if(~num & F.col(col).isNotNull()) > 0)).alias("mixed"))


def table_info(df: DataFrame) -> DataFrame:
    """Columns, types, non-null counts and row count, in long form."""
    types = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    r = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"),
                                               F.col(f"`{c}`").isNotNull().cast("long").alias("nn"))
                                      for c, t in types])).alias("_p")).select("_p.*")
    return r.groupBy("column", "dtype").agg(F.sum("nn").alias("non_null"), F.count("*").alias("rows"))
