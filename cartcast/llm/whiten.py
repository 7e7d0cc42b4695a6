"""Operator 11: whitening of embeddings by an incremental eigendecomposition.

Entries become whole numbers, ``x = floor(SCALE * c)``; the fit list holds each distinct ``x`` vector once.
Every partition of the fit list reads its vectors one at a time and keeps their number, mean and the spectrum of
their scatter matrix: a vector is a centred rank-one update, whose eigenvalues are the roots of a
secular equation (small and equal entries are deflated, the update vector is computed anew from the roots, so that the
eigenvectors stay orthogonal).  The spectra are combined in a tree, ``FAN`` at a time, each eigenpair being
one more rank-one update, and the difference of the means another.  The leading vectors start a distributed Rayleigh-Ritz
refinement: a pass over the fit list multiplies the centred covariance with the basis, the small projected problem
gives the Ritz vectors, and passes go on until the residual stops falling.

What goes through the driver or one task are spectra (dimensions squared) and bases (dimensions times
``COMPONENTS + SPARE``), whose size doesn't depend on the number of rows.

Defined results: vectors that are null or empty, hold null or non-finite entries, or have another length than most, take no
part; rows with a null id do; repeated rows give their results each; components whose eigenvalue is zero up to rounding are left
out, so equal vectors, a single vector and empty tables give no rows; a deviation beyond a long is null; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartcast.llm.common import kept

SCALE = 256
COMPONENTS = 4
SPARE = 8        # basis vectors beside the wanted ones
FAN = 32         # spectra or partial sums that one task adds
PASSES = 12      # a basis that still gets better after these is an error
_EPS = 2.220446049250313e-16

_STATE = "part long, n long, sums array<string>, squares array<string>, mean array<double>, values array<double>, vectors binary"


def _roots(d, z2, rho):
    """The roots of ``1 + rho * sum(z2 / (d - x)) = 0`` for rising ``d``: for each the number of the
    nearest pole and the distance from it."""
    import numpy as np

    k = len(d)
    right = np.append(d[1:], d[-1] + rho * z2.sum() * (1 + 4 * _EPS))
    if k == 1:
        return np.zeros(1, int), np.array([rho * z2[0]])
    width = right - d
    at = np.arange(k)
    near = at.copy()
    middle = 1 + rho * (z2[None, :] / (d[None, :] - (d + width / 2)[:, None])).sum(axis=1)
    near[:-1] += middle[:-1] < 0          # the root lies in the right half
    gap = d[None, :] - d[near][:, None]   # poles seen from each root's origin
    low = np.where(near == at, 0.0, -width / 2)
    high = np.where(near == at, np.where(at == k - 1, width, width / 2), 0.0)
    t = (low + high) / 2
    below = at[None, :] <= at[:, None]
    one, two = np.minimum(at, k - 2), np.minimum(at, k - 2) + 1
    live = np.ones(k, bool)
    for _ in range(90):
        off = gap - t[:, None]
        off[off == 0] = 1e-300
        share = rho * z2[None, :] / off
        f = 1 + share.sum(axis=1)
        slopes = share / off
        size = 1 + np.abs(share).sum(axis=1)
        low, high = np.where(f < 0, t, low), np.where(f >= 0, t, high)
        live &= (np.abs(f) > 4 * _EPS * size) & (high - low > 2 * _EPS * np.maximum(np.abs(low), np.abs(high)))
        if not live.any():
            break
        # a rational function with the two poles around the root, of the same value and slopes
        p, q = off[at, one], off[at, two]
        left = np.where(below, slopes, 0.0).sum(axis=1) if k > 2 else slopes[:, 0]
        left = np.where(at == k - 1, left - slopes[:, k - 1], left)
        rest = slopes.sum(axis=1) - left
        c = f - p * left - q * rest
        a = (p + q) * f - p * q * (left + rest)
        b = p * q * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(at < k - 1, np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root)),
                            np.where(a >= 0, (a + root) / (2 * c), 2 * b / (a - root)))  # the last root lies beyond its poles
            new = t + step
            live &= ~(np.abs(step) <= _EPS * np.abs(t))
        new = np.where(np.isfinite(new) & (new > low) & (new < high), new, (low + high) / 2)
        t = np.where(live, new, t)
    return near, t


def rank_one(values, vectors, rho: float, v):
    """The spectrum of ``vectors diag(values) vectors' + rho v v'`` for rising ``values`` and ``rho >= 0``."""
    import numpy as np

    z = vectors.T @ v
    norm = np.sqrt(z @ z)
    if not rho * norm * norm > 0:
        return values, vectors
    z, rho = z / norm, rho * norm * norm
    tol = 8 * _EPS * max(abs(values[0]), abs(values[-1]), rho)
    vectors, z = vectors.copy(), z.copy()
    z[rho * np.abs(z) <= tol] = 0.0
    use = np.flatnonzero(z)
    turns = np.abs(z[use[:-1]] * z[use[1:]] / (z[use[:-1]] ** 2 + z[use[1:]] ** 2) * np.diff(values[use])) <= tol
    for i, j in zip(use[:-1], use[1:]) if turns.any() else ():   # equal values: turn the pair so that one entry is zero
        r = np.hypot(z[i], z[j])
        c, s = z[j] / r, z[i] / r
        if abs(c * s * (values[j] - values[i])) <= tol:
            vectors[:, [i, j]] = np.stack([c * vectors[:, i] - s * vectors[:, j], s * vectors[:, i] + c * vectors[:, j]], axis=1)
            z[i], z[j] = 0.0, r
    use = np.flatnonzero(z)
    d = values[use].copy()
    for i in np.flatnonzero(np.diff(d) <= 0) + 1:  # deflation leaves gaps above rounding; keep the order strict all the same
        d[i] = np.nextafter(d[i - 1], np.inf)
    near, t = _roots(d, z[use] ** 2, rho)
    off = (d[None, :] - d[near][:, None]) - t[:, None]     # off[j, i] = d[i] - root[j]
    # the update vector for which these roots are exact
    ratio = -off
    between = d[None, :] - d[:, None]                      # d[i] - d[j]
    np.fill_diagonal(between, 1.0)
    k = len(d)
    with np.errstate(all="ignore"):
        part = ratio / -between
        part[np.arange(k), np.arange(k)] = ratio[np.arange(k), np.arange(k)]
        anew = np.sqrt(np.abs(np.prod(part, axis=0) / rho)) * np.sign(z[use])
        turn = anew[None, :] / off
    turn[~np.isfinite(turn)] = 0.0
    turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
    values = values.copy()
    values[use] = d[near] + t
    vectors[:, use] = vectors[:, use] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number, mean and scatter spectrum (rising values, vectors as columns) of the vectors read so far."""

    n: int
    mean: object
    values: object
    vectors: object

    @staticmethod
    def empty(dims: int) -> "Spectrum":
        import numpy as np

        return Spectrum(0, np.zeros(dims), np.zeros(dims), np.eye(dims))

    def add(self, x) -> None:
        """A centred rank-one update by one vector."""
        off = x - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n / (self.n + 1), off)
        self.mean = self.mean + off / (self.n + 1)
        self.n += 1

    def merge(self, other: "Spectrum") -> None:
        """One rank-one update for each eigenpair of ``other`` and one for the difference of the means."""
        if not other.n:
            return
        off, n = other.mean - self.mean, self.n + other.n
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, float(value), vector)
        self.values, self.vectors = rank_one(self.values, self.vectors, self.n * other.n / n, off)
        self.mean, self.n = self.mean + off * (other.n / n), n


def vectors_of(df: DataFrame, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """``vec_id`` and whole-number vectors ``x`` of the rows that take part."""
    v = df.select(F.col(id_col).alias("vec_id"), F.col(col).cast("array<double>").alias("v"))
    v = v.where(F.size("v") > 0).where(~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    lengths = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dims = lengths[0].d if lengths else 0
    return v.where(F.size("v") == dims).select("vec_id", F.transform("v", lambda c: F.floor(c * float(SCALE)).cast("long")).alias("x"))


def _matrix(column, dtype):
    import numpy as np

    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return np.asarray(flat.flatten()).reshape(len(flat), -1).astype(dtype, copy=False)


def _state_row(part, s: Spectrum, sums, squares):
    return {"part": part, "n": s.n, "sums": [str(int(v)) for v in sums], "squares": [str(int(v)) for v in squares],
            "mean": s.mean.tolist(), "values": s.values.tolist(), "vectors": s.vectors.tobytes()}


def _arrow_schema(ddl: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def spectra(fit_list: DataFrame) -> DataFrame:
    """One row a partition: number, exact sums and squares of its vectors, and their spectrum."""
    schema = _arrow_schema(_STATE)

    def read(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        s = sums = squares = None
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(0), np.int64)
            if s is None:
                s, sums, squares = Spectrum.empty(x.shape[1]), np.zeros(x.shape[1], object), np.zeros(x.shape[1], object)
            small = int(np.abs(x).max()) ** 2 * len(x) < 2**62
            whole = x if small else x.astype(object)
            sums, squares = sums + whole.sum(axis=0).astype(object), squares + (whole * whole).sum(axis=0).astype(object)
            for row in x.astype(float):
                s.add(row)
        if s is not None:
            yield pa.RecordBatch.from_pylist([_state_row(TaskContext.get().partitionId(), s, sums, squares)], schema=schema)

    return fit_list.select("x").mapInArrow(read, _STATE)


def _folded(df: DataFrame, fold, schema: str, name: str) -> DataFrame:
    """``fold`` adds up to ``FAN`` rows into one, level by level, until one row is left."""
    df = kept(df, name)
    while (tops := df.agg(F.count("*").alias("n"), F.max("part").alias("top")).first()).n > 1:
        width = max(FAN, -(-(tops.top + 1) // max(1, -(-tops.n // FAN))))  # numbers may have gaps
        df = kept(df.withColumn("group", F.expr(f"part div {width}")).groupBy("group").applyInArrow(fold, schema), name)
    return df


def combine(states: DataFrame) -> DataFrame:
    """The spectra of all partitions as one row."""
    schema = _arrow_schema(_STATE)

    def fold(key, table):
        import numpy as np
        import pyarrow as pa

        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        total = sums = squares = None
        for r in rows:
            d = len(r["mean"])
            s = Spectrum(r["n"], np.array(r["mean"]), np.array(r["values"]), np.frombuffer(r["vectors"]).reshape(d, d))
            a, b = np.array([int(v) for v in r["sums"]], object), np.array([int(v) for v in r["squares"]], object)
            if total is None:
                total, sums, squares = s, a, b
            else:
                total.merge(s)
                sums, squares = sums + a, squares + b
        return pa.Table.from_pylist([_state_row(key[0].as_py(), total, sums, squares)], schema=schema)

    return _folded(states, fold, _STATE, "whiten-spectra")


def _added(df: DataFrame, each, shape, name: str):
    """The sum over all rows of ``df`` of ``each(x as doubles)``, added per task and then in a tree."""
    import numpy as np

    ddl = "part long, m binary"
    schema = _arrow_schema(ddl)

    def read(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        total = np.zeros(shape)
        for b in batches:
            if b.num_rows:
                total += each(_matrix(b.column(0), np.int64).astype(float))
        yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "m": total.tobytes()}], schema=schema)

    def fold(key, table):
        import pyarrow as pa

        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        total = sum((np.frombuffer(r["m"]) for r in rows[1:]), np.frombuffer(rows[0]["m"]))
        return pa.Table.from_pylist([{"part": key[0].as_py(), "m": total.tobytes()}], schema=schema)

    row = _folded(df.select("x").mapInArrow(read, ddl), fold, ddl, name).first()
    return np.frombuffer(row.m).reshape(shape).copy() if row else np.zeros(shape)


@dataclass
class Whitening:
    """``components`` holds unit eigenvectors as columns, ``values`` their eigenvalues; ``sums`` are exact."""

    n: int
    sums: list
    values: object
    components: object
    explained: list
    identity_error: float
    residual: float


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the vectors in column ``x``; None if there are none or all are equal."""
    import numpy as np

    fit_list = kept(x.select("x").distinct(), "whiten-fit")
    state = combine(spectra(fit_list)).first()
    if state is None:
        return None
    n, d = state.n, len(state.mean)
    sums, squares = [int(v) for v in state.sums], [int(v) for v in state.squares]
    trace = sum(n * q - s * s for q, s in zip(squares, sums))
    if trace == 0:
        return None
    trace = trace / (n * n)
    mean = np.array([s / n for s in sums])
    width = min(d, components + SPARE)
    basis = np.linalg.qr(np.frombuffer(state.vectors).reshape(d, d)[:, ::-1][:, :width])[0]
    best = None
    for _ in range(PASSES):
        q = basis

        def product(rows):
            off = rows - mean
            return off.T @ (off @ q)

        image = _added(fit_list, product, (d, width), "whiten-ritz") / n
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz = q @ turn
        wanted = min(components, width)
        residual = float(np.abs(image @ turn - ritz * values)[:, :wanted].max() / values[0])
        if best is not None and residual > best[0] / 2:
            break
        best = (residual, values[:wanted], ritz[:, :wanted])
        basis = np.linalg.qr(image @ turn)[0]
    else:
        raise RuntimeError(f"The basis still gets better after {PASSES} passes (residual {residual})")
    residual, values, vectors = best
    real = values > d * 64 * _EPS * values[0]
    values, vectors = values[real], vectors[:, real]
    vectors = vectors / np.sqrt((vectors * vectors).sum(axis=0))
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])

    def spread(rows):
        w = (rows - mean) @ vectors / np.sqrt(values)
        return w.T @ w

    k = len(values)
    error = float(np.abs(_added(fit_list, spread, (k, k), "whiten-check") / n - np.eye(k)).max())
    return Whitening(n, sums, values, vectors, (values / trace).tolist(), error, residual)


def whitened(df: DataFrame, id_col: str = "vec_id", col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """For each row that takes part and each component: ``vec_id, component, n, deviation, whitened,
    explained, identity_error``."""
    x = vectors_of(df, id_col, col)
    w = fit(x, components)
    ddl = f"vec_id {x.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if w is None:
        return df.sparkSession.createDataFrame([], ddl)
    schema = _arrow_schema(ddl)

    def project(batches):
        import numpy as np
        import pyarrow as pa

        sums = np.array(w.sums, object)
        mean = np.array([s / w.n for s in w.sums])
        k = len(w.values)
        for b in batches:
            if not b.num_rows:
                continue
            rows = _matrix(b.column(1), np.int64)
            top = max(w.n * int(np.abs(rows).max()) + max(map(abs, w.sums)), 1)
            if top * top * len(w.sums) < 2**62:
                off = w.n * rows - sums.astype(np.int64)
                far = (off * off).sum(axis=1)
            else:
                far = [v if v < 2**63 else None for v in ((w.n * rows.astype(object) - sums) ** 2).sum(axis=1)]
            out = (rows - mean) @ w.components / np.sqrt(w.values)
            m = len(rows)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, w.n), pa.int64()),
                pa.array([v for v in far for _ in range(k)], pa.int64()),
                pa.array(out.reshape(-1)),
                pa.array(np.tile(np.array(w.explained), m)),
                pa.array(np.full(m * k, w.identity_error))], schema=schema)

    return x.mapInArrow(project, ddl)
