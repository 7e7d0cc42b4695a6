"""Oversampling of a small class by exact nearest neighbours.

Neighbours: about the square root of the rows are pivots and every row belongs to the nearest one's cell.  The ``k`` nearest
rows in its own block of the cell bound how far a row's true neighbours can be; by the triangle inequality only cells whose
pivot, less the cell's radius, is within that bound can hold a nearer one.  Rows meet the blocks of the cells they have to visit, in groups
of at most ``BLOCK`` rows on either side, and each group gives its ``k`` best; those of all groups are merged.  There is no limit on
candidates: a row that can't exclude a cell visits it.

Synthetic rows: row ``i`` draws its base row, one of the base's neighbours and the place between them from hashes of ``i``, so
another run gives the same rows.

Pivots, and a row a pivot, are broadcast: their number grows with the root of the class only, up to ``MOST_PIVOTS``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartcast.operators.hashing import hash_uniform
from cartcast.operators.scan import ScanSpec, ordered_scan
from cartcast.session import kept

BLOCK = 2048
MOST_PIVOTS = 16_384     # beyond about 270 million rows the cells grow instead; the result is the same


def _distances(a, b):
    """Distances of all rows of ``a`` to all of ``b``, each as a sum of squares in one fixed order."""
    import numpy as np

    total = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        d = a[:, k, None] - b[None, :, k]
        total += d * d
    return np.sqrt(total)


def _matrix(column, dims: int):
    import numpy as np

    return np.asarray(column.flatten()).reshape(-1, dims)


def _best(ids_a, a, ids_b, b, k: int):
    """(row of a, row of b, distance) of the ``k`` nearest of ``b`` for each of ``a`` (ties: the smaller id); never itself."""
    import numpy as np

    out = []
    for start in range(0, len(a), 256):
        d = _distances(a[start:start + 256], b)
        d[ids_a[start:start + 256, None] == ids_b[None, :]] = np.inf
        for i, line in enumerate(d):
            near = np.flatnonzero(line <= np.partition(line, min(k, len(line)) - 1)[min(k, len(line)) - 1])
            near = near[np.isfinite(line[near])]
            near = near[np.lexsort((ids_b[near], line[near]))][:k]
            out += [(start + i, int(j), float(line[j])) for j in near]
    return out


def nearest(df: DataFrame, key: str, features: Sequence[str], k: int = 5) -> DataFrame:
    """``key, rank, neighbour, distance``: the ``k`` nearest other rows of every row by Euclidean distance (all, if there are
    fewer), ties by the smaller key.  Keys are integers, unique and not null; rows with a missing feature take no part."""
    import numpy as np

    dims = len(features)
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    rows = kept(df.select(F.col(key).cast("long").alias("id"), x.alias("x")).where("id is not null").where(~F.exists("x", lambda v: v.isNull() | F.isnan(v))), "smote-rows")
    n = rows.count()
    wanted = min(MOST_PIVOTS, int(np.ceil(np.sqrt(n))))
    # a hash below a fixed share of the range: about ``wanted`` rows, whatever the partitions are
    share = min(1.0, 2 * wanted / max(n, 1))
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(2**40)) < int(share * 2**40)).orderBy(F.xxhash64("id")).limit(wanted).collect()
    if not sample:
        sample = rows.limit(1).collect()
    out_schema = "id long, neighbour long, distance double"
    if not sample:
        return df.sparkSession.createDataFrame([], f"{key} long, rank int, neighbour long, distance double")
    pivots = np.array([r.x for r in sample])

    def to_cells(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column(1), dims)
            d = _distances(v, pivots)
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell, pa.int32()), pa.array(d[np.arange(len(v)), cell])], names=["id", "x", "cell", "r"])

    placed = rows.mapInArrow(to_cells, "id long, x array<double>, cell int, r double")
    sizes = kept(placed.groupBy("cell").agg(F.min("r").alias("low"), F.max("r").alias("high"), F.ceil(F.count("*") / BLOCK).alias("parts")), "smote-sizes")
    about = {r.cell: r for r in sizes.collect()}     # one row a pivot
    parts = F.broadcast(sizes.select("cell", "parts"))
    placed = kept(placed.join(parts, "cell").select("id", "x", "cell", "r", F.pmod(F.xxhash64("id", F.lit(1)), "parts").cast("int").alias("block")), "smote-cells")

    def own_block(key, table):
        import pyarrow as pa

        ids, v = table.column("id").to_numpy(), _matrix(table.column("x").combine_chunks(), dims)
        bound = np.full(len(ids), np.inf)
        had = np.zeros(len(ids), int)
        for i, _, d in _best(ids, v, ids, v, k):
            had[i] += 1
            if had[i] == k:
                bound[i] = d
        return table.select(["id", "x", "cell", "r"]).append_column("bound", pa.array(bound))

    bounded = kept(placed.groupBy("cell", "block").applyInArrow(own_block, "id long, x array<double>, cell int, r double, bound double"), "smote-bounds")
    cells = np.array(sorted(about))
    low, high = (np.array([getattr(about[c], f) for c in cells.tolist()]) for f in ("low", "high"))

    def visits(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column(1), dims)
            d = _distances(v, pivots[cells])
            r, bound = (b.column(c).to_numpy()[:, None] for c in (3, 4))
            slack = 1e-9 * (d + high + np.where(np.isfinite(bound), bound, 0) + 1)
            go = (d - high <= bound + slack) & (low - d <= bound + slack) & (d - r <= 2 * bound + slack)
            row, cell = np.nonzero(go)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(cells[cell], pa.int32())], names=["id", "x", "cell"])

    asked = kept(bounded.mapInArrow(visits, "id long, x array<double>, cell int"), "smote-visits")
    # every block of a visited cell, and as many query blocks as keep groups small; one row a pivot
    turns = F.broadcast(asked.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("turns")))
    asked = asked.join(parts, "cell").join(turns, "cell").select(
        "id", "x", "cell", F.pmod(F.xxhash64("id", F.lit(2)), "turns").cast("int").alias("turn"), F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("block"))
    held = placed.join(turns, "cell").select("id", "x", "cell", "block", F.explode(F.sequence(F.lit(0), F.col("turns").cast("int") - 1)).alias("turn"))
    group = ["cell", "block", "turn"]

    def meet(left, right):
        import pyarrow as pa

        if not left.num_rows or not right.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "neighbour": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})
        a, b = left.column("id").to_numpy(), right.column("id").to_numpy()
        found = _best(a, _matrix(left.column("x").combine_chunks(), dims), b, _matrix(right.column("x").combine_chunks(), dims), k)
        return pa.table({"id": pa.array([int(a[i]) for i, _, _ in found], pa.int64()), "neighbour": pa.array([int(b[j]) for _, j, _ in found], pa.int64()),
                         "distance": pa.array([d for _, _, d in found], pa.float64())})

    found = asked.groupBy(*group).cogroup(held.groupBy(*group)).applyInArrow(meet, out_schema)
    w = Window.partitionBy("id").orderBy("distance", "neighbour")
    best = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.select(F.col("id").alias(key), "rank", "neighbour", "distance")


def smote(df: DataFrame, features: Sequence[str], label: str = "label", key: str = "customer_id", minority=1, k: int = 5,
          rows: int | None = None, seed: int = 0) -> DataFrame:
    """``synthetic, base, neighbour, gap``, the features and ``label``: new rows of the class ``minority`` between a row and one of its ``k``
    nearest in the class; by default as many as make the classes equal (none if the class has fewer than two rows)."""
    small = df.where(F.col(label) == minority)
    near = kept(nearest(small, key, features, k), "smote-nearest")
    counts = df.agg(F.count_if(F.col(label) == minority).alias("few"), F.count_if(F.col(label) != minority).alias("many")).first()
    members = near.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("rank", "neighbour"))).alias("_near"))  # at most k a row
    numbered = ordered_scan(members.withColumn("_k", F.lit(0)).withColumn("_one", F.lit(1.0)), "_k", [key], ScanSpec(cumsum={"_no": "_one"}))
    numbered = kept(numbered.select(F.col(key).alias("base"), "_near", (F.col("_no").cast("long") - 1).alias("_no")), "smote-numbered")
    n = numbered.count()
    wanted = max(0, counts.many - counts.few) if rows is None else rows
    draws = df.sparkSession.range(wanted if n else 0).select(
        F.col("id").alias("synthetic"), F.floor(hash_uniform("id", seed) * n).alias("_no"), hash_uniform("id", seed + 1).alias("_pick"), hash_uniform("id", seed + 2).alias("gap"))
    picked = draws.join(numbered, "_no").select("synthetic", "base", "gap", F.get("_near", F.floor(F.col("_pick") * F.size("_near")).cast("int"))["neighbour"].alias("neighbour"))
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    vectors = kept(small.select(F.col(key).cast("long").alias("_id"), x.alias("_x")), "smote-vectors")
    out = picked.join(vectors.toDF("base", "_a"), "base").join(vectors.toDF("neighbour", "_b"), "neighbour")
    value = lambda i: F.get("_a", F.lit(i)) + F.col("gap") * (F.get("_b", F.lit(i)) - F.get("_a", F.lit(i)))
    return out.select("synthetic", "base", "neighbour", "gap", *[value(i).alias(c) for i, c in enumerate(features)], F.lit(minority).alias(label))
