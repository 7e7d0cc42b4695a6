"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartcast.session import cleaned, dropped, kept  # noqa: F401

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Rows in a batch that goes to Python: whole texts are long, and a batch is held on both sides.
TEXT_ROWS = "1000"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession, rows: str = TEXT_ROWS) -> None:
    """Asks the session for batches of at most ``rows`` rows, unless it has smaller ones."""
    if int(spark.conf.get(_BATCH)) > int(rows):
        spark.conf.set(_BATCH, rows)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))
