"""CSV sources and sinks.

Scratch output goes under the shared folder named by ``spark.checkpoint.dir``
(never a machine-local temp folder), one fresh sub-folder per write.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartcast.session import checkpoint_dir

# Schema of the reference's transaction log (train.csv).
LOG_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("country", T.StringType()),
    T.StructField("total", T.DoubleType()),
])
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/cartcast-io/{name}-{uuid.uuid4().hex}"


def read_log_csv(spark: SparkSession, path: str, schema: T.StructType = LOG_SCHEMA) -> DataFrame:
    """A1: header CSV with a parsed timestamp column, fixed schema (no inference pass)."""
    return (spark.read.schema(schema).option("header", True)
                 .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
                 .csv(path))


def write_csv(df: DataFrame, path: str, header: bool = True, compression: str | None = None) -> str:
    """A5: CSV without index; one part file per partition (no coalesce to one task)."""
    w = df.write.mode("overwrite").option("header", header).option("timestampNTZFormat", TS_FORMAT)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def read_headerless_csv(spark: SparkSession, path: str, names: Sequence[str], types: Sequence[T.DataType],
                        glob: str | None = None, partitions: int | None = None) -> DataFrame:
    """Headerless (possibly gzip) CSV with given column names; ``glob``
    picks files by name.  Gzip files are not splittable, so the result is
    repartitioned when asked."""
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])
    r = spark.read.schema(schema).option("header", False)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.csv(path)
    return df.repartition(partitions) if partitions else df


def write_feature_list(spark: SparkSession, features: Sequence[str], path: str) -> DataFrame:
    """The feature names, one per line, in order."""
    df = spark.createDataFrame([(i, f) for i, f in enumerate(features)], "position int, feature string")
    df.select("feature").write.mode("overwrite").option("header", False).csv(path)
    return df


def submission(template: DataFrame, preds: DataFrame, key: str = "customer_id",
               value: str = "probability") -> DataFrame:
    """A4: the template's keys with the predicted probability (left join on key,
    never by position)."""
    return template.select(key).join(preds.select(key, F.col(value).alias("probability")), key, "left")


def read_value_csv(spark: SparkSession, path: str, key: str, value: str, kind: T.DataType) -> DataFrame:
    """A3: a header CSV of a key and one value, such as labels or predictions."""
    schema = T.StructType([T.StructField(key, T.LongType()), T.StructField(value, kind)])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
