"""Session helpers.

The cluster names a shared checkpoint folder in ``spark.checkpoint.dir``; only a local
session, whose tasks all run on this machine, gets one of its own when it is missing.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # wide feature rows are CPU-heavy per byte: do not let AQE fold small
    # shuffles of them into a single task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "100000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "cartcast", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder; on a cluster without one this is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cartcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


#: Spark's setting by which the shuffle files of a query go once it has ended.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned(spark: SparkSession):
    """Queries run inside leave no shuffle files once they have ended."""
    before = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN_UP, before)


def kept(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage and
    survives lost executors, and a result used twice is computed once."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with cleaned(spark):
        df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of ``kept`` tables after their last reader."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.kept_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
