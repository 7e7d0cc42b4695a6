"""Operator 6: mixing sources to target weights by a low-discrepancy schedule.

Every source's documents, in an order drawn by hash and drawn anew for each of up
to ``MOST`` passes, form a stream of words that is cut into blocks of equal
size.  The mix is a row of slots; slot ``k`` goes to the source in whose part of the
cumulative targets the van der Corput point of ``k`` (its bits reversed) falls, so
that every stretch of the mix holds each source close to its share.  The ``r``-th
slot of a source takes the ``r``-th block of its stream: a join on
(source, rank).

A source takes exactly its target, rounded to whole words: its last block is cut there, and blocks for which the
schedule has no slot (those of sources smaller than a block, or one or two of a large source) are settled each at the slot that a
golden-ratio point of the source and block names, so that small sources are spread over the whole mix as well.

Targets: sources in code point order, null last, weigh ``weights`` in turn and share all words;
none gets more than ``MOST`` times its size, the excess goes to the others by weight.
With limits ``c`` and weights ``w`` that is ``min(c, w * x)`` for the level ``x`` that uses all
words up, which sums over the sources sorted by ``c / w`` give.

Scale: at most ``2**SLOT_BITS`` slots (blocks grow with the corpus, from ``LEAST_BLOCK``
words up); running sums over sources by the skew-safe ordered scan, and over documents in ``4096`` ranges of the hash per source and pass, so a
source with a third of all rows is spread like all others; only totals over all sources reach
single rows.  Draws depend on id, copy and pass only: reruns agree.

Defined results: null texts have size 0 and are never taken; a null source is one
source, a null id an id like others; repeated rows are separate copies; rows of equal
hash are ordered by id, size and copy; extra columns are ignored; empty tables or tables
without words give targets and takings of 0.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartcast.llm.common import WORD, kept
from cartcast.operators.scan import ScanSpec, ordered_scan

WEIGHTS = (5, 2, 1)
MOST = 3
SLOT_BITS = 22
LEAST_BLOCK = 16
_CHUNK = 4096
GOLDEN = (5**0.5 - 1) / 2


def sizes(docs: DataFrame, id_col: str = "doc_id", col: str = "text", source: str = "source") -> DataFrame:
    """(id, source, size, copy): one row per row of ``docs``."""
    n = F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), n.alias("size"))
    return (rows.groupBy("id", "source", "size").agg(F.count("*").alias("n"))
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).drop("n"))


def _running(df: DataFrame, order: list[str], **sums: str) -> DataFrame:
    """``df`` with running sums along ``order``: name = column."""
    out = ordered_scan(df.withColumn("k", F.lit(0)), "k", order, ScanSpec(cumsum=sums))
    return out.drop("k")


def targets(rows: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, place, source_size, target, below): ``below`` is the sum of the targets of the sources before."""
    by_source = kept(rows.groupBy("source").agg(F.sum("size").alias("source_size"))
                     .withColumn("last", F.col("source").isNull()).withColumn("one", F.lit(1.0)), "mix-sources")
    placed = _running(by_source, ["last", "source"], at="one").withColumn("place", F.col("at").cast("long") - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    s = placed.withColumn("w", w).withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("full", F.col("cap") / F.col("w"))
    s = kept(s.select("source", "place", "source_size", "w", "cap", "full"), "mix-places")
    whole = s.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w")).first()
    up = _running(s, ["full", "place"], caps="cap", ws="w")
    level = (F.lit(float(whole["size"] or 0)) - (F.col("caps") - F.col("cap"))) / (F.lit(whole["w"] or 1.0) - F.col("ws") + F.col("w"))
    top = up.agg(F.max(level).alias("x")).first().x
    s = s.withColumn("target", F.least(F.col("cap"), F.col("w") * F.lit(top)))
    return _running(s, ["place"], upto="target").withColumn("below", F.col("upto") - F.col("target")).select(
        "source", "place", "source_size", "target", "below")


def _ranges(n):
    """The numbers of ``n`` chunks, in an array column."""
    return F.sequence(F.lit(0).cast("long"), n)


def schedule(goal: DataFrame, slots: int) -> DataFrame:
    """(slot, place, rank): which source each slot of the mix takes, and its how manieth block."""
    bits = max(1, math.ceil(math.log2(max(slots, 2))))
    whole = 1 << bits
    whole_goal = goal.where("target > 0").agg(F.sum("target").alias("total"), F.max("place").alias("last")).first()
    parts = goal.withColumn("total", F.lit(whole_goal.total).cast("double")).where("total > 0 and target > 0")
    edge = lambda x: F.least(F.ceil(x / F.col("total") * whole), F.lit(whole)).cast("long")
    last = F.col("place") == F.lit(whole_goal["last"])
    parts = parts.select("place", edge(F.col("below")).alias("lo"), F.when(last, F.lit(whole)).otherwise(edge(F.col("below") + F.col("target"))).cast("long").alias("hi"))
    # points lo to hi - 1, unfolded in two steps so that no array is long
    chunk = parts.where("hi > lo").withColumn("c", F.explode(_ranges(F.floor((F.col("hi") - 1 - F.col("lo")) / _CHUNK))))
    chunk = chunk.repartition("place", "c")
    first = F.col("lo") + F.col("c") * _CHUNK
    point = chunk.select("place", F.explode(F.sequence(first, F.least(first + _CHUNK, F.col("hi")) - 1)).alias("point"))
    slot = F.lit(0).cast("long")
    for k in range(bits):
        slot = slot + F.shiftleft(F.shiftright(F.col("point"), k).bitwiseAND(F.lit(1).cast("long")), bits - 1 - k)
    taken = point.select("place", slot.alias("slot")).where(F.col("slot") < slots).withColumn("c", F.floor(F.col("slot") / _CHUNK))
    counts = taken.groupBy("place", "c").agg(F.count("*").alias("n"))
    before = Window.partitionBy("place").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("place", "c", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("place", "c").orderBy("slot")) - 1
    return taken.withColumn("own", rank).join(starts.hint("merge"), ["place", "c"]).select("slot", "place", (F.col("start") + F.col("own")).alias("rank"))


def stream(rows: DataFrame, passes: int = MOST) -> DataFrame:
    """Adds ``pass``, ``start`` and ``stop``: each row's words in its source's stream."""
    each = rows.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    key = F.concat_ws(":", F.col("pass").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.col("copy").cast("string"))
    each = each.withColumn("h", F.md5(key.cast("binary"))).withColumn("c", F.substring("h", 1, 3))
    counts = each.groupBy("place", "pass", "c").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("place", "pass").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("place", "pass", "c", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("below_c"))
    own = Window.partitionBy("place", "pass", "c").orderBy("h", "id", "size", "copy")
    inside = F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0))
    at = each.withColumn("inside", inside).join(starts, ["place", "pass", "c"])
    stop = F.col("pass") * F.col("source_size") + F.col("below_c") + F.col("inside")
    return at.withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("size")).drop("h", "c", "inside", "below_c")


def mix(docs: DataFrame, id_col: str = "doc_id", col: str = "text", source: str = "source", weights=WEIGHTS, most: int = MOST):
    """Two tables: pieces of the mix (slot, id, source, copy, pass, first word, words), in the order of
    (slot, block, at), and the result per row (id, source, copy, size, source_size, target, taken)."""
    rows = kept(sizes(docs, id_col, col, source), "mix-sizes")
    goal = kept(targets(rows, weights, most), "mix-targets")
    total = goal.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    block = max(LEAST_BLOCK, -(-total // (1 << SLOT_BITS)))
    n_slots = max(1, round(total / block))
    slots = schedule(goal, n_slots)
    info = goal.select("source", "place", "source_size", "target", F.floor(F.col("target") + 0.5).alias("used"))
    placed = rows.join(info.withColumnRenamed("source", "its_source"), F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    placed = kept(placed, "mix-placed")
    pieces = stream(placed, most).where("start < used").withColumn("stop", F.least("stop", "used")).withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("stop") - 1) / block))))
    lo = F.greatest("start", F.col("block") * block)
    pieces = pieces.select("id", "source", "copy", "size", "place", "pass", "block", lo.alias("at"), (lo - F.col("start")).alias("first"),
                           (F.least(F.col("stop"), (F.col("block") + 1) * block) - lo).alias("words"))
    # the planner can't see how many slots unfold from the few sources, so it must not broadcast them
    pieces = pieces.join(slots.withColumnRenamed("rank", "block").hint("merge"), ["place", "block"], "left")
    point = F.pmod(F.col("place") * GOLDEN + F.col("block") * GOLDEN * GOLDEN, F.lit(1.0))
    pieces = pieces.withColumn("slot", F.coalesce("slot", F.floor(point * n_slots)))
    key = ["id", "source", "copy", "size", "place", "source_size", "target"]
    words = pieces.groupBy("id", "source", "copy", "size", "place").agg(F.sum("words").alias("words"))
    # one row of each is there with no words, so that documents which aren't taken stay
    rest = placed.select(*key, F.lit(0).cast("long").alias("words"))
    named = words.join(goal.select("place", "source_size", "target"), "place").select(*key, "words")
    taken = rest.unionByName(named).groupBy(*key).agg(F.sum("words").alias("taken"))
    return pieces, taken.drop("place")
