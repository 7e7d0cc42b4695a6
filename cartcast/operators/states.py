"""Statistics per customer and anchor or window from mergeable states.

A state holds number, sum, extremes and central moments of each column, and first and last value by place.  Rows become one state per
key in every Arrow batch, so a scan that leaves a customer's rows together gives hardly more than one state a customer; then a
customer's few states are merged for every anchor or window at once.  Nothing is repeated per anchor, and a
state is one binary value instead of hundreds of aggregation buffers.  Moments are taken about the mean of their own
group, as in ``moments.py``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartcast.functions.months import month_index, ym_index
from cartcast.functions.stats import spec_names

PARTS = ("n", "s", "lo", "hi", "m2", "m3")
MERGED_ROWS = 20_000    # states and rows that are merged at once, at least


def _codes(column):
    """Numbers that are equal where the column is; null is a value of its own."""
    import pyarrow.compute as pc

    return pc.dictionary_encode(column, null_encoding="encode").indices.to_numpy()


def _whole(batches, keys: int, least: int = 1):
    """Record batches with all rows of the keys (the first columns) in them, of ``least`` rows or more but for the last; the rows come sorted by key."""
    import numpy as np
    import pyarrow as pa

    held, parts = None, []
    for b in batches:
        if not b.num_rows:
            continue
        parts.append(b)
        if sum(p.num_rows for p in parts) < least:
            continue
        t, parts = pa.concat_batches(parts if held is None else [held, *parts]), []
        last = int(_starts(t, keys)[-1])
        if last:
            yield t.slice(0, last)
        held = t.slice(last)
    if held is not None or parts:
        yield pa.concat_batches(parts if held is None else [held, *parts])


def _starts(batch, keys: int):
    import numpy as np

    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for k in range(keys):
        new[1:] |= np.diff(_codes(batch.column(k))) != 0
    return np.flatnonzero(new)


def _row_state(x, valid, starts, group):
    """States (PARTS, group, column) of the rows of each group."""
    import numpy as np

    add = lambda v: np.add.reduceat(v, starts, axis=0)
    n, s = add(valid.astype(float)), add(np.where(valid, x, 0.0))
    lo = np.fmin.reduceat(np.where(valid, x, np.nan), starts, axis=0)
    hi = np.maximum.reduceat(np.where(valid, x, -np.inf), starts, axis=0)
    d = np.where(valid, x - (s / np.maximum(n, 1))[group], 0.0)
    return np.stack([n, s, lo, hi, add(d * d), add(d * d * d)])


def _merged_state(parts, use, starts, group):
    """One state (PARTS, group, column) from the states ``parts`` (PARTS, row, column) of the rows in ``use``."""
    import numpy as np

    add = lambda v: np.add.reduceat(v, starts, axis=0)
    n, s, lo, hi, m2, m3 = parts
    own = use[:, None] & (n > 0)
    n, s, m2, m3 = (np.where(own, v, 0.0) for v in (n, s, m2, m3))
    total, whole = add(n), add(s)
    d = np.where(own, s / np.maximum(n, 1) - (whole / np.maximum(total, 1))[group], 0.0)
    q1, q2, q3 = add(n * d), add(m2 + n * d * d), add(m3 + 3 * d * m2 + n * d * d * d)
    some = np.maximum(total, 1)
    return np.stack([total, whole, np.fmin.reduceat(np.where(own, lo, np.nan), starts, axis=0), np.maximum.reduceat(np.where(own, hi, -np.inf), starts, axis=0),
                     np.maximum(q2 - q1 * q1 / some, 0.0), q3 - 3 * q1 * q2 / some + 2 * q1 * q1 * q1 / (some * some)])


def _statistic(state, stat: str):
    """Values of a statistic and where they are defined."""
    import numpy as np

    n, s, lo, hi, m2, m3 = state
    constant = (lo == hi) | (np.isnan(lo) & np.isnan(hi))
    if stat in ("count", "sum"):
        return (n if stat == "count" else s), np.ones(n.shape, bool)
    if stat in ("min", "max", "mean"):
        return {"min": lo, "max": hi, "mean": s / np.maximum(n, 1)}[stat], n > 0
    if stat == "std":
        return np.where(constant, 0.0, np.sqrt(m2 / np.maximum(n - 1, 1))), n >= 2
    if stat == "skew":
        below = (m2 / np.maximum(n, 1)) ** 1.5 * (n - 2)
        return np.where(constant, 0.0, m3 / np.maximum(n, 1) * np.sqrt(n * np.maximum(n - 1, 0)) / np.where(below == 0, 1.0, below)), (n >= 3) & (constant | (below != 0))
    raise ValueError(f"no merged form of {stat!r}")


def _edge(value, place, use, starts, group, last: bool):
    """Value at the first (last) place of each group, and whether there is one."""
    import numpy as np

    at = np.where(use & ~np.isnan(place), -place if last else place, np.inf)
    best = np.minimum.reduceat(at, starts)
    row = np.minimum.reduceat(np.where((at == best[group]) & (at < np.inf), np.arange(len(at)), len(at)), starts)
    found = row < len(at)
    row = np.where(found, row, 0)
    return value[row], place[row], found


def _matrix(batch, first: int, count: int):
    import numpy as np

    if not count:
        return np.zeros((batch.num_rows, 0)), np.ones((batch.num_rows, 0), bool)
    cols = [batch.column(first + k) for k in range(count)]
    return (np.stack([c.to_numpy(zero_copy_only=False) for c in cols], axis=1),
            np.stack([np.ones(len(c), bool) if not c.null_count else c.is_valid().to_numpy(zero_copy_only=False) for c in cols], axis=1))


def row_states(rows: DataFrame, key: str, anchors: list[str], numbers: list[str], ordered: list[str], place: str, monthly: Sequence[str] = (), since: int = 0) -> DataFrame:
    """(key, _kind, _b, state).  Kind 1: states by key and ``_b``, the number of anchors that a row's month isn't before.  Kind 2: states
    of the columns ``monthly`` (among ``numbers``) by key and month ``_b``, not before ``since``.  One or more a pair."""
    number = lambda c: F.col(f"`{c}`").cast("double")
    of_row = sum([(month_index("order_date") >= ym_index(a)).cast("int") for a in sorted(anchors)], F.lit(0))
    src = rows.select(
        key, of_row.cast("int").alias("_b"), month_index("order_date").cast("int").alias("_mi"), (number(place) if ordered else F.lit(None).cast("double")).alias("_place"),
        *[number(c).alias(f"_x{k}") for k, c in enumerate([*numbers, *ordered])])
    width, edges, own = len(numbers), len(ordered), [list(numbers).index(c) for c in monthly]
    schema = T.StructType([src.schema.fields[0], T.StructField("_kind", T.IntegerType()), T.StructField("_b", T.IntegerType()), T.StructField("state", T.BinaryType())])

    def grouped(b, by):
        """The rows in order of key and ``by``, where its groups start and each row's group."""
        import numpy as np

        by = np.unique(by, return_inverse=True)[1]
        code = _codes(b.column(0)).astype(np.int64) * (by.max() + 1) + by
        order = np.argsort(code, kind="stable")
        new = np.diff(code[order], prepend=-1) != 0
        return order, np.flatnonzero(new), np.cumsum(new) - 1

    def batch(b, kind, by, rows, state):
        import numpy as np
        import pyarrow as pa

        state = np.ascontiguousarray(state)
        return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), kind), pa.int32()), pa.array(by[rows], pa.int32()),
                                           pa.array([v.tobytes() for v in state], pa.binary())], names=schema.names)

    def run(batches):
        import numpy as np

        for b in batches:
            if not b.num_rows:
                continue
            bucket, month = b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)
            x, valid = _matrix(b, 4, width + edges)
            spot = b.column(3).to_numpy(zero_copy_only=False)
            with np.errstate(all="ignore"):
                order, starts, group = grouped(b, bucket)
                state = [_row_state(x[order, :width], valid[order, :width], starts, group).swapaxes(0, 1).reshape(len(starts), -1)]
                for k in range(width, width + edges):
                    for last in (False, True):
                        value, at, found = _edge(x[order, k], spot[order], valid[order, k], starts, group, last)
                        state.append(np.stack([value, np.where(found, at, np.nan)], axis=1))
                yield batch(b, 1, bucket, order[starts], np.concatenate(state, axis=1))
                late = np.flatnonzero(month >= since) if own else []
                if len(late):
                    some = b.take(late)
                    order, starts, group = grouped(some, month[late])
                    at = np.ix_(late[order], own)
                    state = _row_state(x[at], valid[at], starts, group).swapaxes(0, 1).reshape(len(starts), -1)
                    yield batch(some, 2, month[late], order[starts], state)

    return src.mapInArrow(run, schema)


def with_stats(table: DataFrame, rows: DataFrame, anchors: list[str], spec, windows: Sequence[tuple[str, int, int]] = (), window_spec=(), place: str = "_rn",
               key: str = "customer_id", null_key: bool = False) -> DataFrame:
    """``table`` (key, year_month among the anchors, ...) with the statistics of ``spec`` over all of a key's ``rows`` before the anchor's month, and those of
    ``window_spec`` over the months from a to b before it for each window (name, a, b).  Nulls where there are no rows, or no key unless ``null_key`` takes rows without one for those of one more key.

    The table's rows and the states come together by key in one exchange, and the wide rows are made behind it: they're never moved."""
    anchors = sorted(anchors)
    numbers = list(dict.fromkeys([*[c for c, stats in spec if set(stats) - {"first", "last"}], *[c for c, _ in window_spec]]))
    ordered = [c for c, stats in spec if {"first", "last"} & set(stats)]
    monthly = [c for c, _ in window_spec]
    since = ym_index(anchors[0]) - max((b for _, _, b in windows), default=0)
    rows = rows if null_key else rows.where(F.col(key).isNotNull())
    states = row_states(rows, key, anchors, numbers, ordered, place, monthly, since)
    others = [c for c in table.columns if c != key]
    own = table.select(key, F.lit(0).alias("_kind"), F.lit(None).cast("int").alias("_b"), F.lit(None).cast("binary").alias("state"), *[F.col(f"`{c}`") for c in others])
    none = [F.lit(None).cast(table.schema[c].dataType).alias(c) for c in others]
    both = own.unionByName(states.select(key, "_kind", "_b", "state", *none)).repartition(key).sortWithinPartitions(key)
    wanted, wide = [(c, s) for c, stats in spec for s in stats], [(c, s) for c, stats in window_spec for s in stats]
    fields = [T.StructField(name, T.LongType() if s == "count" else T.DoubleType()) for name, (_, s) in zip(spec_names(spec), wanted, strict=True)]
    fields += [T.StructField(f"{name}-{w}", T.DoubleType()) for w, _, _ in windows for name in spec_names(window_spec)]
    schema = T.StructType([table.schema[key], *[table.schema[c] for c in others], *fields])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    width, months, at_month = len(numbers), len(monthly), 4 + others.index("year_month")

    def part(b, kind, kinds, group):
        """Of the rows of a kind: the groups that have any, where these start, each row's place among them, ``_b`` and the states."""
        import numpy as np

        at = np.flatnonzero(kinds == kind)
        groups, starts, place = np.unique(group[at], return_index=True, return_inverse=True)
        return groups, starts, place, b.column(2).take(at).to_numpy(), np.frombuffer(b"".join(b.column(3).take(at).to_pylist())).reshape(len(at), -1)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in _whole(batches, 1, MERGED_ROWS):
            first = _starts(b, 1)
            group = np.repeat(np.arange(len(first)), np.diff(first, append=b.num_rows))
            kinds = b.column(1).to_numpy()
            rows = np.flatnonzero(kinds == 0)
            if not len(rows):
                continue
            mine = b.take(pa.array(rows))
            value, known = np.zeros((len(fields), len(rows))), np.zeros((len(fields), len(rows)), bool)
            for k, anchor in enumerate(anchors):
                here = np.flatnonzero(pc.equal(mine.column(at_month), anchor).to_numpy(zero_copy_only=False).astype(bool))
                for kind in (1, 2) if windows else (1,):
                    groups, starts, place, by, flat = part(b, kind, kinds, group)
                    if not len(groups) or not len(here):
                        continue
                    spot = np.minimum(np.searchsorted(groups, group[rows[here]]), len(groups) - 1)
                    has = groups[spot] == group[rows[here]]
                    cells = _merged(flat, by, k, starts, place) if kind == 1 else _windowed(flat, ym_index(anchor) - by, starts, place)
                    for i, (v, ok) in enumerate(cells, 0 if kind == 1 else len(wanted)):
                        value[i, here], known[i, here] = v[spot], ok[spot] & has
            arrays = [_column(v, ok, f.dataType == T.LongType()) for v, ok, f in zip(value, known, fields)]
            yield pa.RecordBatch.from_arrays([mine.column(0), *(mine.column(4 + k) for k in range(len(others))), *arrays], names=schema.names)

    def _merged(flat, bucket, k, starts, group):
        import numpy as np

        parts, use = flat[:, :6 * width].reshape(-1, 6, width).swapaxes(0, 1), bucket <= k
        seen, out = np.maximum.reduceat(use, starts), {}
        with np.errstate(all="ignore"):
            state = _merged_state(parts, use, starts, group)
            for s in {s for _, s in wanted} - {"first", "last"}:
                value, ok = _statistic(state, s)
                out |= {(c, s): (value[:, i], ok[:, i] & seen) for i, c in enumerate(numbers)}
        for i, c in enumerate(ordered):
            for j, s in enumerate(("first", "last")):
                at = 6 * width + 4 * i + 2 * j
                value, _, found = _edge(flat[:, at], flat[:, at + 1], use, starts, group, s == "last")
                out[c, s] = value, found
        return [out[w] for w in wanted]

    def _windowed(flat, back, starts, group):
        import numpy as np

        parts, cells = flat.reshape(-1, 6, months).swapaxes(0, 1), []
        for _, low, high in windows:
            use = (back >= low) & (back <= high)
            has = np.maximum.reduceat(use, starts)
            with np.errstate(all="ignore"):
                state = _merged_state(parts, use, starts, group)
                found = {s: _statistic(state, s) for s in {s for _, s in wide}}
            cells += [(found[s][0][:, monthly.index(c)], found[s][1][:, monthly.index(c)] & has) for c, s in wide]
        return cells

    return both.mapInArrow(run, schema)


def anchor_stats(rows: DataFrame, anchors: list[str], spec, place: str = "_rn", key: str = "customer_id") -> DataFrame:
    """(key, year_month, statistics of ``spec``): one row a key and anchor from all rows before the anchor's month."""
    at = F.explode(F.array(*[F.struct(F.lit(a).alias("year_month"), F.lit(ym_index(a)).alias("i")) for a in sorted(anchors)])).alias("_a")
    seen = rows.groupBy(key).agg(F.min(month_index("order_date")).alias("_m")).select(key, "_m", at)
    return with_stats(seen.where(F.col("_m") < F.col("_a.i")).select(key, "_a.year_month"), rows, anchors, spec, place=place, key=key, null_key=True)


def _column(value, ok, whole: bool = False):
    import pyarrow as pa

    return pa.array(value.astype("int64") if whole else value, mask=~ok, from_pandas=False)


def window_stats(months: DataFrame, keys: Sequence[str], windows: Sequence[tuple[str, int, int]], spec) -> DataFrame:
    """(keys, statistics named ``{column}-{statistic}-{window}``) from month moments with ``back``, all rows of a key in
    one partition: window (name, a, b) has the months from a to b back.  A window without months has nulls, keys without any window are left out."""
    columns = [c for c, _ in spec]
    src = months.select(*keys, F.col("back").cast("int"), *[F.col(f"{c}_{p}").cast("double") for p in PARTS for c in columns]).sortWithinPartitions(*keys)
    wanted = [(c, s) for c, stats in spec for s in stats]
    n = len(keys)
    schema = T.StructType([*src.schema.fields[:n], *[T.StructField(f"{name}-{w}", T.DoubleType()) for w, _, _ in windows for name in spec_names(spec)]])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in _whole(batches, n):
            starts = _starts(b, n)
            group = np.repeat(np.arange(len(starts)), np.diff(starts, append=b.num_rows))
            back = b.column(n).to_numpy()
            parts = np.moveaxis(_matrix(b, n + 1, 6 * len(columns))[0].reshape(b.num_rows, 6, -1), 1, 0)
            cells, seen = [], np.zeros(len(starts), bool)
            for _, low, high in windows:
                use = (back >= low) & (back <= high)
                has = np.maximum.reduceat(use, starts)
                seen |= has
                with np.errstate(all="ignore"):
                    state = _merged_state(parts, use, starts, group)
                    found = {s: _statistic(state, s) for s in {s for _, s in wanted}}
                cells += [(found[s][0][:, columns.index(c)], found[s][1][:, columns.index(c)] & has) for c, s in wanted]
            if seen.any():
                at = pa.array(starts[seen])
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(at) for k in range(n)), *(_column(v[seen], ok[seen]) for v, ok in cells)], names=schema.names)

    return src.mapInArrow(run, schema)
