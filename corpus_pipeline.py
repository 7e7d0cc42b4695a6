"""From raw documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and
returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartcast.llm import bpe, jaccard, mix, pii, toxic
from cartcast.llm.common import WORD, dropped, fresh, kept, table, text_batches

#: Scores come from a fitted kernel machine: no stage after it has SQL for the same rows.
ORACLE_SQL = None

#: Rows of a batch that goes to Python: its workers live through all stages and keep what they once held.
ROWS = "400"
#: At most so many ids are sent to all tasks (about 50 MB there); more are joined.
BROADCAST_IDS = 1_000_000


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string kernel machine doesn't call toxic."""
    text_batches(spark, ROWS)
    model = toxic.fit(docs, table(spark, sf_dir, "labels"))
    names = [f"column_{k}" for k in range(len(docs.columns))]  # a column of any name may stand beside the score
    out = toxic.scores(docs.toDF(*names), model, col=names[docs.columns.index("text")])
    return out.where("predicted = 0").select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: the one whose id is the smallest.  Rows without words and rows
    without an id stand alone; of several rows with that id and with words, the one whose text has the smallest
    md5 (equal texts: the smallest hash of the row) stays."""
    text_batches(spark, ROWS)
    mark, place = fresh(docs, "mark_", "place_")
    found = kept(jaccard.near_duplicates(docs).where("n_shingles > 0 and doc_id is not null"), "pipeline-groups")
    ids = found.groupBy("doc_id").agg(F.max(F.col("doc_id") != F.col("component_id")).alias("gone"), (F.count("*") > 1).alias("several"))
    marks = kept(ids.where("gone or several").select(F.col("doc_id").alias("marked_id"), "gone"), "pipeline-marks")
    n, several = (marks.where(c).count() for c in ("true", "not gone"))
    # few ids go to all tasks, so that the texts stay where they are
    small = F.broadcast(marks) if n <= BROADCAST_IDS else marks
    words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows = docs.join(small.select("marked_id", F.col("gone").alias(mark)), docs["doc_id"] == F.col("marked_id"), "left").drop("marked_id")
    out = rows.where(F.col(mark).isNull() | ~words)
    if several:
        again = rows.where(~F.col(mark) & words)
        first = Window.partitionBy("doc_id").orderBy(F.md5(F.col("text").cast("binary")), F.xxhash64(*docs.columns))
        out = out.unionByName(again.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(place))
    return out.drop(mark)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every span of personal data replaced by its kind; ``n_chars`` follows."""
    out = pii.redact(docs, pii.fit(docs))
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))
    return out.select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: each document as often as the mix takes it.  A pass over a document
    counts when it takes at least half of its words; only the last document of a source's stream is cut at all."""
    key, copy, times = fresh(docs, "key_", "copy_", "times_")
    # rows that agree in id and text are copies of each other
    docs = docs.withColumn(key, F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    _, taken = mix.mix(docs, id_col=key)
    taken = kept(taken.select(F.col("id").alias("its_key"), F.col("source").alias("its_source"), F.col("copy").alias("its_copy"),
                              F.coalesce(F.floor(F.try_divide("taken", "size") + 0.5), F.lit(0)).cast("int").alias(times)), "pipeline-taken")
    same = (docs[key] == F.col("its_key")) & docs["source"].eqNullSafe(F.col("its_source"))
    # a key with one row needs no numbers: its text moves once, and only if it has to
    copies = taken.groupBy("its_key", "its_source").agg(F.count("*").alias("rows"), F.sum(times).cast("int").alias(times)).where(F.col(times) > 0)
    out = docs.join(copies.where("rows = 1").drop("rows"), same).drop("its_key", "its_source")
    many = kept(copies.where("rows > 1").select("its_key", "its_source"), "pipeline-copies")
    if not many.isEmpty():
        numbered = docs.join(many, same, "left_semi").withColumn(copy, F.row_number().over(Window.partitionBy(key, "source").orderBy(F.xxhash64(*docs.columns))) - 1)
        which = (numbered[key] == F.col("its_key")) & numbered["source"].eqNullSafe(F.col("its_source")) & (numbered[copy] == F.col("its_copy"))
        wanted = taken.where(F.col(times) > 0)
        out = out.unionByName(numbered.join(wanted, which).drop("its_key", "its_source", "its_copy", copy))
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(key, copy, times)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, their digest, and the digest of what they decode to."""
    import public_tokenizers as P

    text_batches(spark, ROWS)
    return bpe.token_digests(docs.select("doc_id", "source", "text"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, ids="ids").drop("text")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("private_data", private_data),
    ("mixture", mixture),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
        dropped(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
