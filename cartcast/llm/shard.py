"""Operator 4: a uniform shuffle into shards of exact sizes, in DataFrame expressions only.

Rows are dealt to ``P`` parts by a hash of their key, and the parts are counted.  A
communication matrix says how many rows each part sends to each shard; it is drawn from the
hypergeometric law, part by part, from the room left in the shards, so
columns sum to the shard sizes exactly (row counts differ by one at most) and the matrix is
distributed as under a uniform random permutation.  Each part permutes its rows (order of a
seeded hash) and cuts them at the matrix's running sums; rows are exchanged, and
each shard permutes what it got (another seeded hash) and numbers its slots.

The matrix has at most ``MAX_PARTS`` rows and one column a shard: only it and the part counts
pass through the driver.  Ranks within parts and shards are sums over ranges of the
hash plus a row number within a range, so neither a part nor a shard is ever one
task.  Placement depends on keys, seed and counts only: a lost task gives the same rows again.

Defined results: null keys hash like a value; rows with equal keys are told apart by their
copy number (``copies``), and swapping them changes nothing; empty tables give empty
shards.  Text sizes: null counts as no bytes, its crc32 is that of the empty text.
The law of this operator is ``rows``; equal texts need not share a shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartcast.llm.common import fresh, kept

MAX_PARTS = 4096
ROWS = 20_000  # rows that a range of the hash holds on average


def hypergeometric(rng, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good.  Weights follow from
    the mode outwards by their exact ratios; what lies over 12 deviations out weighs under 1e-30."""
    import numpy as np

    lo, hi = max(0, n - bad), min(n, good)
    if lo == hi:
        return lo
    total = good + bad
    mode = (n + 1) * (good + 1) // (total + 2)
    reach = int(12 * math.sqrt(n * (good / total) * (bad / total) * (total - n) / max(total - 1, 1))) + 12
    lo, hi = max(lo, mode - reach), min(hi, mode + reach)
    k = np.arange(lo, hi, dtype=float)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(steps)])
    share = np.cumsum(np.exp(weight - weight.max()))
    return lo + int(np.searchsorted(share, rng.random() * share[-1], side="right"))


def communication_matrix(parts: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows from each part to each shard, with these row and column sums."""
    import numpy as np

    rng, room, out = np.random.default_rng(seed), list(shards), []
    for n in parts:
        left, rest, row = n, sum(room), []
        for r in room:
            rest -= r
            x = hypergeometric(rng, r, rest, left)
            row.append(x)
            left -= x
        room = [r - x for r, x in zip(room, row, strict=True)]
        out.append(row)
    return out


def _ranked(df: DataFrame, group: str, h: str, ties: list[Column], ranges: int, out: str) -> DataFrame:
    """Adds each row's place (from 0) in the order of hash ``h`` within ``group``."""
    r, before, own = fresh(df, "range_", "before_", "own_")
    df = df.withColumn(r, F.pmod(F.shiftright(F.col(h), 20), F.lit(ranges)))
    sums = df.groupBy(group, r).agg(F.count("*").alias(before))
    w = Window.partitionBy(group).orderBy(r).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn(before, F.coalesce(F.sum(before).over(w), F.lit(0)))
    df = df.withColumn(own, F.row_number().over(Window.partitionBy(group, r).orderBy(h, *ties)) - 1)
    return df.join(sums, [group, r]).withColumn(out, F.col(before) + F.col(own)).drop(r, before, own)


def place(df: DataFrame, key: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Adds ``shard`` and ``slot`` to every row of ``df``, which is read more than once."""
    if clash := {"shard", "slot"} & {c.lower() for c in df.columns}:
        raise ValueError(f"the table already has {sorted(clash)}")
    columns = df.columns
    part, h, rank, ends = fresh(df, "part_", "hash_", "rank_", "ends_")
    ties = [F.col(c) for c in key]
    n = df.count()
    p = min(MAX_PARTS, max(1, -(-n // ROWS)))
    df = df.withColumn(part, F.pmod(F.xxhash64(F.lit(seed), *ties), F.lit(p)).cast("int"))
    found = {r[part]: r["count"] for r in df.groupBy(part).count().collect()}  # at most MAX_PARTS rows
    counts = [found.get(k, 0) for k in range(p)]
    sizes = [n // shards + (k < n % shards) for k in range(shards)]
    rows = []
    for k, row in enumerate(communication_matrix(counts, sizes, seed)):
        sums, s = [], 0
        for x in row:
            s += x
            sums.append(s)
        rows.append((k, sums))
    matrix = df.sparkSession.createDataFrame(rows, f"{part} int, {ends} array<bigint>")
    df = df.withColumn(h, F.xxhash64(F.lit(seed + 1), *ties))
    df = _ranked(df, part, h, ties, max(1, n // p // ROWS), rank)
    # bounded by MAX_PARTS rows of one number a shard
    df = df.join(F.broadcast(matrix), part).withColumn("shard", F.size(F.filter(ends, lambda x: x <= F.col(rank))).cast("int"))
    df = df.drop(part, h, rank, ends).withColumn(h, F.xxhash64(F.lit(seed + 2), *ties))
    return _ranked(df, "shard", h, ties, max(1, -(-n // shards // ROWS)), "slot").select(*columns, "shard", "slot")


def copies(df: DataFrame, out: str = "copy") -> DataFrame:
    """Equal rows numbered from 0, without bringing them together."""
    (n,) = fresh(df, "n_")
    return df.groupBy(*df.columns).agg(F.count("*").alias(n)).withColumn(out, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))).drop(n)


def text_shards(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = kept(copies(rows), "shard-rows")
    return place(rows, ["doc_id", "size", "text_crc32", "copy"], shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
