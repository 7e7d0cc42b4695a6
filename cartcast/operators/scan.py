"""Skew-safe ordered scan: running sums, lag and "last matching value before"
per key, in a total row order.

A plain ``Window.partitionBy(key).orderBy(order)`` sends every row of a key to
one task; with one product or customer holding a third of the log that task
holds a third of the data.  Instead:

1. Bounds of (key, order) are taken once from the rows whose hash is below a threshold, chosen for
   about ``_SAMPLE_PER_RANGE`` rows a range over the whole table (a count and this sample are the only
   jobs that building the plan starts).  A row's range number is the number of
   bounds that are not above it: a function of the row, whatever partition it is in.
   Ranges grow with the rows; many bounds are searched in two levels.
2. Only a key with several bounds holds more rows than a range: it is cut at them.  Every other key
   is whole in range 0, so that its rows need no search among the bounds.
3. ``Window.partitionBy(range, key)`` computes the running values in the JVM.  For the keys that are
   cut, totals per (key, range) are summed over the ranges before: at most two rows a bound, which is
   the only thing broadcast (beside the second level of bounds, if there is one).

Rows without a key have no running values; they are spread over groups by a hash of their order.

Nothing is persisted and the result is lazy; a lost task gives the same rows again.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_A_RANGE = 4_000_000   # at most about so many rows of a key in one task
FIRST_LEVEL = 1024         # bounds that are written into the plan itself
_SAMPLE_PER_RANGE = 32


@dataclass
class ScanSpec:
    """What to compute per key along the order.

    cumsum:      out -> value column; running sum including the current row
                 (null where the value is null, like pandas ``cumsum``).
    lag:         out -> value column; value of the previous row of the key.
    last_before: out -> (value column, condition column); last non-null value
                 among earlier rows of the key whose condition is true.
    """

    cumsum: dict = field(default_factory=dict)
    lag: dict = field(default_factory=dict)
    last_before: dict = field(default_factory=dict)


@dataclass
class Inside:
    """Running sums ``cumsum`` by a second key ``key``, each of whose values lies whole in one group of range and key of the scan; rows where
    ``given`` holds bring their own."""

    key: str
    cumsum: dict
    given: Column | None = None


def cut_keys(bounds: list) -> list:
    """The keys with several bounds; one with one at most has fewer rows than two ranges and isn't cut."""
    many = Counter(b[0] for b in bounds)
    return [k for k, n in many.items() if n > 1]


def range_bounds(df: DataFrame, key: str, order: list[str], ranges: int | None = None) -> list:
    """Rows of (key, *order) that cut ``df`` into at least ``ranges`` ranges of similar size, and into more if they
    would have over ``ROWS_A_RANGE`` rows."""
    cols = [key, *order]
    rows = df.select(key).where(F.col(key).isNotNull()).count()
    n = max(ranges or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_RANGE))
    share = min(1.0, n * _SAMPLE_PER_RANGE / max(rows, 1))
    hashed = F.pmod(F.xxhash64(*cols), F.lit(1 << 40))
    sample = df.select(*cols).where(F.col(key).isNotNull()).where(hashed < int(share * (1 << 40)))
    found = sample.orderBy(*cols).collect()
    step = max(1, len(found) // n)
    return list(dict.fromkeys(tuple(r) for r in found[step::step]))


def _search(array: Column, size: Column | int, steps: int, row: Column) -> Column:
    """How many entries of the sorted ``array`` are not above ``row``: a search by halves."""

    def half(low, step):
        at = low + step
        return F.when(at > size, low).when(F.get(array, at - 1) <= row, at).otherwise(low)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(steps - 1, -1, -1)]), F.lit(0), half)


def _within(df: DataFrame, cols: list[str], bounds: list) -> Column:
    """How many of ``bounds``, written into the plan, are not above a row of ``cols``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    array = F.array(*[F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(cols, b, strict=True)]) for b in bounds])
    return _search(array, len(bounds), len(bounds).bit_length(), F.struct(*[F.col(f"`{c}`") for c in cols]))


def _with_range(df: DataFrame, cols: list[str], bounds: list, name: str) -> DataFrame:
    """``df`` with the number of ``bounds`` that are not above its row of ``cols``."""
    if not bounds:
        return df.withColumn(name, F.lit(0))
    types = {f.name: f.dataType for f in df.schema.fields}
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    step = -(-len(bounds) // FIRST_LEVEL)
    first = bounds[step - 1::step]
    coarse = _within(df, cols, first) if first else F.lit(0)
    if step == 1:
        return df.withColumn(name, coarse)
    # the bounds after each of the first level's, one short list a row
    lists = [(i, bounds[i * step:(i + 1) * step - 1] if i < len(first) else bounds[i * step:]) for i in range(len(first) + 1)]
    entry = T.StructType([T.StructField(c, types[c]) for c in cols])
    table = df.sparkSession.createDataFrame(lists, T.StructType([T.StructField("_coarse", T.IntegerType()), T.StructField("_fine", T.ArrayType(entry))]))
    out = df.withColumn("_coarse", coarse).join(F.broadcast(table), "_coarse")
    fine = _search(F.col("_fine"), F.size("_fine"), step.bit_length(), row)
    return out.withColumn(name, F.col("_coarse") * step + fine).select(*[F.col(f"`{c}`") for c in df.columns], name)


def _number(c: str) -> Column:
    v = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(v), v)


def ordered_scan(df: DataFrame, key: str, order: list[str], spec: ScanSpec,
                 num_partitions: int | None = None, bounds_from: DataFrame | None = None, range_col: str | None = None,
                 found: list | None = None, inside: Inside | None = None) -> DataFrame:
    """Add the running columns of ``spec`` to ``df`` (see module doc).

    ``range_col`` names a column that is added for the row's range: rising along the order of a key, and what the result is
    dealt by together with the key, so that an aggregate by both and more moves no row.

    ``bounds_from`` is a cheaper frame with the same rows' key, order and spec columns, when
    ``df`` already carries expensive columns: bounds and carries come from it.  ``found``: the bounds, if they're known.
    ``inside``: running sums by a second key, where this scan has put the rows."""
    cols = [key, *order]
    if found is None:
        found = range_bounds(bounds_from if bounds_from is not None else df, key, order, num_partitions)
    spread = -1 - F.pmod(F.xxhash64(*order), F.lit(len(found) + 1)).cast("int")
    cut = cut_keys(found)
    bounds = [b for b in found if b[0] in set(cut)]

    def ranged(frame):
        hot = F.col(key).isin(cut)
        if len(bounds) <= FIRST_LEVEL:
            place = F.when(hot, _within(frame, cols, bounds)).otherwise(0) if bounds else F.lit(0)
            return frame.withColumn("_rid", F.when(F.col(key).isNull(), spread).otherwise(place))
        out = _with_range(frame, cols, bounds, "_rid")
        return out.withColumn("_rid", F.when(F.col(key).isNull(), spread).when(hot, F.col("_rid")).otherwise(0))

    d = ranged(df)
    w = Window.partitionBy("_rid", key).orderBy(*order)
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    null_key = F.col(key).isNull()
    match = {o: F.when(F.col(cond), _number(c)) for o, (c, cond) in spec.last_before.items()}
    local = {**{o: F.sum(_number(c)).over(upto) for o, c in spec.cumsum.items()},
             **{o: F.lag(_number(c)).over(w) for o, c in spec.lag.items()},
             **{o: F.last(m, ignorenulls=True).over(before) for o, m in match.items()},
             "_at": F.row_number().over(w)}
    rows = d.withColumns(local)
    if inside:
        # above the other windows, so that the exchange by range and key serves it too
        w2 = Window.partitionBy("_rid", key, inside.key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        for o, c in inside.cumsum.items():
            value = F.when(F.col(inside.key).isNotNull() & _number(c).isNotNull(), F.sum(_number(c)).over(w2))
            rows = rows.withColumn(o, value if inside.given is None else F.when(inside.given, F.col(o)).otherwise(value))
    hit = F.lit(False)
    if cut:
        # the place within the range as one number keeps the aggregate hash-based
        totals = (d if bounds_from is None else ranged(bounds_from)).where(F.col(key).isin(cut)).withColumn("_at", F.row_number().over(w)).groupBy(F.col(key).alias("_ckey"), F.col("_rid").alias("_crid")).agg(
            *[F.sum(_number(c)).alias(f"_c_{o}") for o, c in spec.cumsum.items()],
            *[F.max_by(_number(c), F.col("_at")).alias(f"_c_{o}") for o, c in spec.lag.items()],
            *[F.max_by(match[o], F.when(match[o].isNotNull(), F.col("_at"))).alias(f"_c_{o}") for o in match],
            F.count("*").alias("_n"))
        wk = Window.partitionBy("_ckey").orderBy("_crid")
        earlier = wk.rowsBetween(Window.unboundedPreceding, -1)
        carry = totals.select(
            "_ckey", "_crid", (F.row_number().over(wk) > 1).alias("_hit"),
            *[F.sum(f"_c_{o}").over(earlier).alias(f"_c_{o}") for o in spec.cumsum],
            *[F.lag(f"_c_{o}").over(wk).alias(f"_c_{o}") for o in spec.lag],
            *[F.last(f"_c_{o}", ignorenulls=True).over(earlier).alias(f"_c_{o}") for o in match])
        # at most two rows a bound
        rows = rows.join(F.broadcast(carry.where("_hit")), (F.col("_ckey") == F.col(key)) & (F.col("_crid") == F.col("_rid")), "left")
        hit = F.coalesce(F.col("_hit"), F.lit(False))

    def carried(o):
        return F.col(f"_c_{o}") if cut else F.lit(None).cast("double")

    out = []
    for o, c in spec.cumsum.items():
        out.append(F.when(~null_key & _number(c).isNotNull(), F.col(o) + F.coalesce(carried(o), F.lit(0.0))).alias(o))
    for o in spec.lag:
        out.append(F.when(~null_key, F.when(hit & (F.col("_at") == 1), carried(o)).otherwise(F.col(o))).alias(o))
    for o in match:
        out.append(F.when(~null_key, F.coalesce(F.col(o), carried(o))).alias(o))
    out += [F.col(o) for o in (inside.cumsum if inside else ()) if o not in df.columns]
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *out, *([F.col("_rid").alias(range_col)] if range_col else []))
