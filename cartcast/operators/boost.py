"""Boosted trees over histograms, for all folds at once.

Features are cut into at most ``bins`` ordered classes once and kept as one byte each, in blocks of ``ROWS_AT_ONCE`` rows by feature.  Model ``m``
learns from the rows whose ``fold`` isn't ``m``; all models grow their next tree together.  A level of the trees is one pass: every task adds
gradients, second derivatives and rows by (model, node, feature, bin), the sums are added up by (model, block of
features), and each group gives the best split of every node, so that only split candidates come to the driver.

Margins are kept with the blocks.  After ``chunk`` trees they are written anew, together with each held-out row's
margin after every one of these trees; the exact score of every model (AUC by ranks, or the mean squared error) follows from
that table: one group a model and tree, or the ordered scan if a model has more than ``HELD_ROWS`` held-out rows.  (Of a table of at most ``MODEL_SHARE * TASK_CELLS`` cells every model is a task that grows all its trees, which needs neither exchange nor that table.)  A model ends when its score hasn't been better for ``patience`` trees and keeps the trees up to the best:
no tree is ever grown twice.

Row and feature samples come from hashes of row and tree, so a task that runs again gives the same sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartcast.operators.metrics import roc_auc
from cartcast.session import dropped, kept

FAN = 64                 # partial sums that one group adds
BLOCK = 64               # features of a group
TASK_CELLS = 8_000_000   # rows x features that make a task of their own
MODEL_SHARE = 5          # so many of them are a task where each model is one
ROWS_AT_ONCE = 8192      # rows of a block, whose cells are added together
READ_CELLS = 64_000_000  # rows x features that a task reads at most
HELD_ROWS = 4_000_000    # held-out rows of a model up to which one group has its margins after a tree


@dataclass
class BoostParams:
    """Boosting set-up; the first five are the reference's."""

    trees: int = 10_000
    patience: int = 100
    step: float = 0.1
    feature_share: float = 0.8
    row_share: float = 0.8
    depth: int = 4
    bins: int = 32
    min_rows: int = 20
    min_hessian: float = 1e-3
    l2: float = 0.0
    seed: int = 42
    chunk: int = 10
    objective: str = "binary"    # or "squared"


@dataclass
class Booster:
    """Trees of each model as arrays by heap number: ``feature`` (-1: a leaf), ``split`` (bins up to it go left), ``value``."""

    features: list
    edges: list                   # rising inner edges of each feature's bins
    models: list                  # the fold that each model didn't see
    base: list                    # margin before the first tree
    trees: list = field(default_factory=list)   # one a step: dict of arrays (models, nodes)
    best: list = field(default_factory=list)    # trees that count, one number a model
    objective: str = "binary"
    scores: list = field(default_factory=list)  # (model, tree from 1, score)

    # ------------------------------------------------------------- applying

    def binned(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` and ``bins``, one byte a feature; 0 stands for a missing value."""
        edges, n = self.edges, len(keep)
        src = df.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"`{c}`").cast("double").alias(f"_f{k}") for k, c in enumerate(self.features)])
        schema = T.StructType([*src.schema.fields[:n], T.StructField("bins", T.BinaryType())])

        def run(batches):
            import numpy as np
            import pyarrow as pa

            for b in batches:
                out = np.empty((b.num_rows, len(edges)), np.uint8)
                for k, e in enumerate(edges):
                    x = b.column(n + k).to_numpy(zero_copy_only=False)
                    out[:, k] = np.where(np.isnan(x), 0, 1 + np.searchsorted(e, x, side="left"))
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(n)), pa.array([r.tobytes() for r in out], pa.binary())],
                                                 names=[*keep, "bins"])

        return src.mapInArrow(run, schema)

    def blocks(self, df: DataFrame) -> DataFrame:
        """Rows of (``_y``, ``_fold``, ``_h``, features) in blocks of up to ``ROWS_AT_ONCE``: labels, folds, hashes and bins by feature as bytes, and
        margins by model (none yet)."""
        edges, dims = self.edges, len(self.features)
        src = df.select("_y", "_fold", "_h", *[F.col(f"`{c}`").cast("double").alias(f"_f{k}") for k, c in enumerate(self.features)])

        def run(batches):
            import numpy as np

            held, count = [], 0
            for b in batches:
                bins = np.empty((dims, b.num_rows), np.uint8)
                for k, e in enumerate(edges):
                    x = b.column(3 + k).to_numpy(zero_copy_only=False)
                    bins[k] = np.where(np.isnan(x), 0, 1 + np.searchsorted(e, x, side="left"))
                held.append((*(b.column(k).to_numpy(zero_copy_only=False) for k in range(3)), bins))
                count += b.num_rows
                while count >= ROWS_AT_ONCE:
                    whole = [np.concatenate(c, axis=-1) for c in zip(*held)]
                    yield _block(*(c[..., :ROWS_AT_ONCE] for c in whole))
                    held, count = [tuple(c[..., ROWS_AT_ONCE:] for c in whole)], count - ROWS_AT_ONCE
            if count:
                yield _block(*(np.concatenate(c, axis=-1) for c in zip(*held)))

        return src.mapInArrow(run, _BLOCKS)

    def margins(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` and ``margins``: one value a model, from the trees that count."""
        keep = list(keep)
        rows = self.binned(df, keep)
        schema = T.StructType([*rows.schema.fields[:-1], T.StructField("margins", T.ArrayType(T.DoubleType()))])
        trees, best, base, dims = self.trees, self.best, self.base, len(self.features)

        def run(batches):
            import numpy as np
            import pyarrow as pa

            counts = np.array(best)
            for b in batches:
                bins = _bins(b.column(b.num_columns - 1), dims)
                out = np.tile(np.array(base, float), (len(bins), 1))
                for t, tree in enumerate(trees):
                    if (use := t < counts).any():
                        out += np.where(use, _leaf_values(tree, bins), 0.0)
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(b.num_columns - 1)), _lists(out)], names=[*keep, "margins"])

        return rows.mapInArrow(run, schema)

    def scored(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` and ``p``: one prediction a model (probabilities for the binary objective)."""
        m = self.margins(df, keep)
        p = F.transform("margins", lambda v: 1.0 / (1.0 + F.exp(-v))) if self.objective == "binary" else F.col("margins")
        return m.select(*[F.col(f"`{c}`") for c in keep], p.alias("p"))

    # ------------------------------------------------------------ reporting

    def importance(self) -> list[tuple[str, int, float]]:
        """(feature, model number from 1, number of splits)."""
        import numpy as np

        out = []
        for k in range(len(self.models)):
            used = np.zeros(len(self.features))
            for tree in self.trees[: self.best[k]]:
                f = tree["feature"][k]
                np.add.at(used, f[f >= 0], 1)
            out += [(name, k + 1, float(v)) for name, v in zip(self.features, used)]
        return out

    # ------------------------------------------------------- saving, loading

    def save(self, spark: SparkSession, path: str) -> None:
        """Two Parquet tables: the nodes and, a row each, features and models."""
        rows = [(t, k, node, int(tree["feature"][k, node]), int(tree["split"][k, node]), float(tree["value"][k, node]))
                for t, tree in enumerate(self.trees) for k in range(len(self.models)) if t < self.best[k] for node in range(tree["feature"].shape[1])]
        spark.createDataFrame(rows, "tree int, model int, node int, feature int, split int, value double").write.mode("overwrite").parquet(f"{path}/nodes")
        about = [("feature", k, name, 0.0, 0, [float(v) for v in e]) for k, (name, e) in enumerate(zip(self.features, self.edges))]
        about += [("model", k, self.objective, float(b), int(n), [float(m)]) for k, (b, n, m) in enumerate(zip(self.base, self.best, self.models))]
        spark.createDataFrame(about, "kind string, number int, name string, base double, best int, edges array<double>").write.mode("overwrite").parquet(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Booster":
        import numpy as np

        about = sorted(spark.read.parquet(f"{path}/about").collect(), key=lambda r: (r.kind, r.number))
        feats, models = [r for r in about if r.kind == "feature"], [r for r in about if r.kind == "model"]
        out = Booster([r.name for r in feats], [np.array(r.edges) for r in feats], [int(r.edges[0]) for r in models], [r.base for r in models],
                      best=[r.best for r in models], objective=models[0].name)
        nodes = spark.read.parquet(f"{path}/nodes").collect()  # trees x models x nodes, as long as the model itself
        size = 1 + max((r.node for r in nodes), default=0)
        for _ in range(max(out.best, default=0)):
            out.trees.append({"feature": np.full((len(models), size), -1), "split": np.zeros((len(models), size), int), "value": np.zeros((len(models), size))})
        for r in nodes:
            tree = out.trees[r.tree]
            tree["feature"][r.model, r.node], tree["split"][r.model, r.node], tree["value"][r.model, r.node] = r.feature, r.split, r.value
        return out


# ------------------------------------------------------------ inside the tasks


def _bins(column, dims: int):
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, dims)


def _lists(values):
    import numpy as np
    import pyarrow as pa

    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), pa.array(values.ravel()))


def _block(y, fold, h, bins, margins=None, staged=None):
    """One block as a row: of ``_BLOCKS``, or of ``_STAGED`` with ``staged``."""
    import numpy as np
    import pyarrow as pa

    cells = [np.ascontiguousarray(v, t).tobytes() for v, t in ((y, np.float64), (fold, np.int32), (h, np.int64), (bins, np.uint8))]
    cells += [b"" if v is None else np.ascontiguousarray(v, np.float64).tobytes() for v in ([margins] if staged is None else [margins, staged])]
    return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in cells], names=["y", "fold", "h", "bins", "margins", "staged"][:len(cells)])


def _blocks_of(batches, dims: int, base: list):
    """Labels, folds, hashes, bins (feature, row) and margins (model, row) of each block."""
    import numpy as np

    for b in batches:
        for row in zip(*(b.column(k) for k in range(5))):
            y, fold, h, bins, margins = (np.frombuffer(v.as_buffer(), t) for v, t in zip(row, (np.float64, np.int32, np.int64, np.uint8, np.float64)))
            margins = margins.reshape(len(base), -1) if len(margins) else np.repeat(np.array(base, float)[:, None], len(y), axis=1)
            yield y, fold, h, bins.reshape(dims, -1), margins


def _down(feature, split, flat, rows, at, levels: int, stride: int = 1):
    """The nodes of one model's tree to which rows at the nodes ``at`` come, ``levels`` further down at most; ``rows`` has the
    places in ``flat`` where the rows' bins start, which are ``stride`` apart."""
    import numpy as np

    for _ in range(levels):
        f = feature.take(at)
        inner = f >= 0
        if not inner.any():
            break
        at = np.where(inner, 2 * at + 1 + (flat.take(rows + f * stride) > split.take(at)), at)
    return at


def _leaves(tree: dict, k: int, bins, rows):
    """The value of model ``k``'s tree for ``rows`` of bins by (feature, row)."""
    import numpy as np

    depth = tree["feature"].shape[1].bit_length() - 1
    return tree["value"][k].take(_down(tree["feature"][k], tree["split"][k], bins.ravel(), rows, np.zeros(len(rows), np.int64), depth, bins.shape[1]))


def _nodes(tree, bins):
    """The node of each row in each model's tree, (rows, models)."""
    import numpy as np

    n, dims = bins.shape
    out, flat = np.empty((n, len(tree["feature"])), np.int64), bins.ravel()
    depth = tree["feature"].shape[1].bit_length() - 1
    for a in range(0, n, ROWS_AT_ONCE):
        rows = np.arange(a, min(a + ROWS_AT_ONCE, n)) * dims
        for k, (feature, split) in enumerate(zip(tree["feature"], tree["split"])):
            out[a:a + len(rows), k] = _down(feature, split, flat, rows, np.zeros(len(rows), np.int64), depth)
    return out


def _leaf_values(tree, bins):
    import numpy as np

    return tree["value"][np.arange(len(tree["value"])), _nodes(tree, bins)]


def _drawn(h, tree: int, model: int, share: float, seed: int):
    """Whether each row (by its hash) is in the sample of a model's tree."""
    import numpy as np

    with np.errstate(over="ignore"):
        x = h.view(np.uint64) + np.uint64((seed * 1_000_003 + tree * 4096 + model + 1) * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) < share * 2**53


def feature_sample(dims: int, tree: int, model: int, p: BoostParams):
    import numpy as np

    n = max(1, int(np.ceil(dims * p.feature_share)))
    return np.sort(np.random.default_rng([p.seed, tree, model]).permutation(dims)[:n])


def derivatives(margin, label, objective: str):
    """First and second derivative of the loss."""
    import numpy as np

    if objective == "squared":
        return margin - label, np.ones_like(margin)
    q = 1 / (1 + np.exp(-margin))
    return q - label, q * (1 - q)


def best_splits(hist, p: BoostParams):
    """For sums (node, feature, bin, 3): per node gain, place of the feature, bin, the left side's sums and the node's."""
    import numpy as np

    total = hist[:, 0].sum(axis=1)                              # every feature has all rows
    left = hist.cumsum(axis=2)[:, :, :-1]
    right = total[:, None, None] - left
    ok = (left[..., 2] >= p.min_rows) & (right[..., 2] >= p.min_rows) & (left[..., 1] >= p.min_hessian) & (right[..., 1] >= p.min_hessian)
    with np.errstate(all="ignore"):
        worth = lambda s: s[..., 0] ** 2 / (s[..., 1] + p.l2)
        gain = np.where(ok, worth(left) + worth(right) - worth(total)[:, None, None], -np.inf)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    node = np.arange(len(gain))
    f, b = np.unravel_index(at, gain.shape[1:])
    return flat[node, at], f, b, left[node, f, b], total


# ------------------------------------------------------------------- fitting


def fit_edges(df: DataFrame, features: Sequence[str], bins: int) -> list:
    """Inner edges of equally filled bins, from exact quantiles."""
    import numpy as np

    from cartcast.operators.prep import fit_quantiles

    q = fit_quantiles(df, features, bins - 1)
    return [np.unique(q[c][1])[:-1] if c in q else np.zeros(0) for c in features]


def unit_edges(features: Sequence[str], bins: int) -> list:
    """Edges for features that are spread evenly over [0, 1] already (quantile-scaled ones)."""
    import numpy as np

    return [np.linspace(0, 1, bins - 1)[:-1] for _ in features]


def fit(train: DataFrame, features: Sequence[str], label: str = "label", fold: str = "fold", key: str = "customer_id",
        models: Sequence[int] = (0,), params: BoostParams | None = None, edges: list | None = None) -> Booster:
    """One model for each entry of ``models``: learned from the rows whose ``fold`` is another (a null fold is for all), held
    against the others.  A model without held-out rows, such as -1, grows all ``params.trees``.  Rows without a label are left out."""
    import numpy as np

    p = params or BoostParams()
    spark, features, models = train.sparkSession, list(features), list(models)
    train = train.where(F.col(label).isNotNull())
    edges = fit_edges(train, features, p.bins) if edges is None else edges
    named = train.select(F.col(label).cast("double").alias("_y"), F.coalesce(F.col(fold).cast("int"), F.lit(-2)).alias("_fold"), F.xxhash64(key).alias("_h"), *[F.col(f"`{c}`") for c in features])
    out = Booster(features, edges, models, [], objective=p.objective)
    seen = kept(out.blocks(named), "boost-bins", **_WRITTEN)
    sums = _fold_sums(seen)
    rows = sum(n for n, _ in sums.values())
    for m in models:
        n, y = (sum(v[k] for f, v in sums.items() if f != m) for k in range(2))
        mean = y / n if n else 0.0
        out.base.append(float(mean if p.objective == "squared" else np.log(max(mean, 1e-6) / max(1 - mean, 1e-6))))
    small = rows * len(features) <= MODEL_SHARE * TASK_CELLS
    state = seen
    if not small:
        cells, most = rows * len(features), spark.sparkContext.defaultParallelism
        tasks = int(max(2, min(most, cells * len(models) // TASK_CELLS), cells // READ_CELLS))
        state = kept(seen.repartition(tasks), "boost-rows", **_WRITTEN)  # as many files as tasks
        dropped(seen)
    live = [k for k in range(len(models)) if rows]
    history: list[list] = [[] for _ in models]
    pending: list[dict] = []
    if small:
        history, live = _grown_by_model(state, out, live, 2 * p.chunk, p), []
    while live and len(out.trees) < p.trees:
        splits = lambda *args: _level(state, out, pending, *args, len(out.trees), p).collect()
        pending.append(_grown(splits, len(models), len(features), live, len(out.trees), p))
        out.trees.append(pending[-1])
        if len(pending) < p.chunk and len(out.trees) < p.trees:
            continue
        state, scores = _settled(state, out, pending, max((sums[m][0] for m in models if m in sums), default=0), p)
        for k in live:
            history[k] += [scores.get((models[k], t)) for t in range(len(pending))]
        pending = []
        live = [k for k in live if not _ended(history[k], p.patience)]
    dropped(state)
    for k in range(len(models)):
        known = [v for v in history[k] if v is not None]
        out.best.append(_best(history[k]) + 1 if known else len(out.trees))
        out.scores += [(models[k], t + 1, v) for t, v in enumerate(history[k]) if v is not None]
    out.trees = out.trees[: max(out.best, default=0)]
    return out


def _fold_sums(blocks: DataFrame) -> dict:
    """Rows and sum of the labels by fold."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for y, fold in zip(b.column(0), b.column(1)):
                y, (folds, place) = np.frombuffer(y.as_buffer()), np.unique(np.frombuffer(fold.as_buffer(), np.int32), return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(folds), pa.array(np.bincount(place)), pa.array(np.bincount(place, y))], names=["fold", "n", "y"])

    found = blocks.select("y", "fold").mapInArrow(run, "fold int, n long, y double").groupBy("fold").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    return {r.fold: (r.n, r.y) for r in found.collect()}  # a row a fold


def _best(scores: list) -> int:
    """Place of the first best score (higher is better)."""
    return max(range(len(scores)), key=lambda t: (scores[t] if scores[t] is not None else float("-inf"), -t))


def _ended(scores: list, patience: int) -> bool:
    return any(v is not None for v in scores) and len(scores) - 1 - _best(scores) >= patience


_BLOCKS = "y binary, fold binary, h binary, bins binary, margins binary"
_STAGED = _BLOCKS + ", staged binary"
_WRITTEN = {"parquet.block.size": str(16 << 20)}  # so that few blocks are read at once
_SUMS = "model int, block int, part int, hist binary"
_SPLITS = "model int, node int, gain double, feature int, bin int, gl double, hl double, g double, h double"


def _grown(splits, n_models: int, dims: int, live: list, number: int, p: BoostParams) -> dict:
    """The next tree of all live models; ``splits(tree, nodes, features, level)`` gives the split candidates of a level."""
    import numpy as np

    size = 2 ** (p.depth + 1) - 1
    tree = {"feature": np.full((n_models, size), -1), "split": np.zeros((n_models, size), int), "value": np.zeros((n_models, size))}
    picked = {k: feature_sample(dims, number, k, p) for k in live}
    value = lambda g, h: -p.step * g / (h + p.l2) if h + p.l2 > 0 else 0.0
    open_nodes = {k: [0] for k in live}
    for level in range(p.depth):
        grown = {k: nodes for k, nodes in open_nodes.items() if nodes}
        if not grown:
            break
        found: dict = {}
        for k, node, gain, feature, cut, gl, hl, g, h in splits(tree, grown, picked, level):
            had = found.get((k, node))
            if had is None or (gain, -feature) > (had[0], -had[1]):
                found[k, node] = (gain, feature, cut, gl, hl, g, h)
        open_nodes = {k: [] for k in live}
        for (k, node), (gain, feature, cut, gl, hl, g, h) in sorted(found.items()):
            if level == 0:
                tree["value"][k, node] = value(g, h)
            if not gain > 1e-10:
                continue
            tree["feature"][k, node], tree["split"][k, node] = feature, cut
            tree["value"][k, 2 * node + 1], tree["value"][k, 2 * node + 2] = value(gl, hl), value(g - gl, h - hl)
            open_nodes[k] += [2 * node + 1, 2 * node + 2]
    return tree


def _add_rows(hist: dict, y, fold, h, bins, margins, pending: list, tree: dict, picked: dict, level: int, number: int, models: list, p: BoostParams) -> None:
    """Adds the block's gradients, second derivatives and numbers to ``hist``: by model (3, node x feature x bin).  ``pending``: trees
    that the margins don't have yet."""
    import numpy as np

    for k, sums in hist.items():
        rows = np.flatnonzero((fold != models[k]) & _drawn(h, number, k, p.row_share, p.seed))
        margin = margins[k].take(rows)
        for done in pending:
            margin += _leaves(done, k, bins, rows)
        at = _down(tree["feature"][k], tree["split"][k], bins.ravel(), rows, np.zeros(len(rows), np.int64), level, bins.shape[1])
        sums += _sums(at, *derivatives(margin, y[rows], p.objective), bins, rows, picked[k], level, p)


def _sums(at, g, second, columns, rows, chosen, level: int, p: BoostParams):
    """Sums (3, node x feature x bin) of the gradients ``g``, the second derivatives and the numbers of ``rows``, which are at the nodes
    ``at``; ``columns`` has the bins of all rows by feature.  A feature at a time, so that the cells that are added to stay few."""
    import numpy as np

    first, nodes = 2**level - 1, 2**level
    out = np.zeros((3, nodes, len(chosen), p.bins))
    here = np.flatnonzero(at >= first)
    for a in range(0, len(here), ROWS_AT_ONCE):
        use = here[a:a + ROWS_AT_ONCE]
        node, weights, row = (at[use] - first) * p.bins, (None, g[use], second[use]), rows[use]
        for j, f in enumerate(chosen):
            cell = node + columns[f].take(row)
            for i, weight in zip((2, 0, 1), weights[:2] if p.objective == "squared" else weights):
                out[i, :, j] += np.bincount(cell, weight, nodes * p.bins).reshape(nodes, p.bins)
    if p.objective == "squared":  # the second derivative is 1: its sums are the numbers
        out[1] = out[2]
    return out.reshape(3, -1)


def _candidates(hist, k: int, chosen, nodes: list, level: int, p: BoostParams) -> list:
    """Split candidates of model ``k`` at ``nodes`` for sums (3, node x feature x bin) of the features ``chosen``."""
    import numpy as np

    first = 2**level - 1
    cube = np.moveaxis(hist.reshape(3, 2**level, len(chosen), p.bins), 0, -1)
    gain, f, cut, left, whole = best_splits(cube, p)
    return [(k, node, float(gain[i]), int(chosen[f[i]]), int(cut[i]), *left[i, :2].tolist(), *whole[i, :2].tolist()) for node in nodes for i in (node - first,)]


def _score(y, margin, objective: str):
    """AUC with ties as halves, or minus the mean squared error; NaN where it isn't defined."""
    import numpy as np

    if objective == "squared":
        return -float(((y - margin) ** 2).mean()) if len(y) else np.nan
    value, place, n = np.unique(margin, return_inverse=True, return_counts=True)
    positive = np.bincount(place, y, len(value))
    negative = n - positive
    below = np.cumsum(negative) - negative
    pairs = positive.sum() * negative.sum()
    return float((positive * (below + 0.5 * negative)).sum() / pairs) if pairs else np.nan


def _grown_by_model(state: DataFrame, booster: Booster, live: list, chunk: int, p: BoostParams) -> list:
    """Trees of all models and scores by model, of a table so small (``MODEL_SHARE``) that a task can hold its bins: each live
    model is a job of one task, which ends by its own patience, so nothing is exchanged between levels or models.  (As one
    job over the union of the models' tables they would run one after the other: a union of tables in one partition each is one partition.)"""
    import numpy as np

    dims, models, base = len(booster.features), booster.models, booster.base

    def task(k: int):
        def run(batches):
            import pyarrow as pa

            parts = list(_blocks_of(batches, dims, base))
            if not parts:
                return
            y, fold, h, bins, margins = (np.concatenate(c, axis=-1) for c in zip(*parts))
            held, margin, everyone = fold == models[k], margins[k], np.arange(len(y))
            learn, flat = np.flatnonzero(~held), bins.ravel()
            scores: list = []
            while len(scores) < p.trees and not (len(scores) % chunk == 0 and _ended(scores, p.patience)):
                number = len(scores)
                # a tree's rows and their derivatives are the same at all its levels, and each level leads one step down
                rows = learn[_drawn(h[learn], number, k, p.row_share, p.seed)]
                found, at = derivatives(margin[rows], y[rows], p.objective), [np.zeros(len(rows), np.int64)]

                def splits(tree, grown, picked, level, rows=rows, found=found, at=at):
                    if level:
                        at[0] = _down(tree["feature"][k], tree["split"][k], flat, rows, at[0], 1, len(y))
                    return _candidates(_sums(at[0], *found, bins, rows, picked[k], level, p), k, picked[k], grown[k], level, p)

                tree = {c: v[[k]] for c, v in _grown(splits, len(models), dims, [k], number, p).items()}
                margin += _leaves(tree, 0, bins, everyone)
                score = _score(y[held], margin[held], p.objective)
                scores.append(None if np.isnan(score) else score)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *(pa.array([tree[c].tobytes()], pa.binary()) for c in ("feature", "split", "value")),
                                                  pa.array([scores[-1]], pa.float64())], names=["tree", "feature", "split", "value", "score"])

        return run

    rows = state.coalesce(1)
    grown = [rows.mapInArrow(task(k), "tree int, feature binary, split binary, value binary, score double") for k in live]
    with ThreadPoolExecutor(max_workers=max(1, len(grown))) as pool:
        found = list(pool.map(lambda table: sorted(table.collect()), grown))  # a model's trees
    history: list[list] = [[] for _ in models]
    size = 2 ** (p.depth + 1) - 1
    booster.trees = [{"feature": np.full((len(models), size), -1), "split": np.zeros((len(models), size), int), "value": np.zeros((len(models), size))}
                     for _ in range(max(map(len, found), default=0))]
    for k, own in zip(live, found):
        for r in own:
            for c, kind in (("feature", np.int64), ("split", np.int64), ("value", float)):
                booster.trees[r.tree][c][k] = np.frombuffer(r[c], kind)
            history[k].append(r.score)
    return history


def _level(state: DataFrame, booster: Booster, pending: list, tree: dict, grown: dict, picked: dict, level: int, number: int, p: BoostParams) -> DataFrame:
    """Split candidates (one a model, block and node) of the nodes ``grown``."""
    dims, models, base, nodes = len(booster.features), booster.models, booster.base, 2**level

    def sums(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        hist = {k: np.zeros((3, nodes * len(picked[k]) * p.bins)) for k in grown}
        for block in _blocks_of(batches, dims, base):
            _add_rows(hist, *block, pending, tree, picked, level, number, models, p)
        part = TaskContext.get().partitionId()
        for k, v in hist.items():
            v = v.reshape(3, nodes, -1, p.bins)
            for block, a in enumerate(range(0, v.shape[2], BLOCK)):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([block], pa.int32()), pa.array([part], pa.int32()),
                                                  pa.array([v[:, :, a:a + BLOCK].tobytes()], pa.binary())], names=["model", "block", "part", "hist"])

    def total(table):
        import numpy as np

        rows = sorted(zip(table.column("part").to_pylist(), table.column("hist").to_pylist()))
        return sum(np.frombuffer(h) for _, h in rows)

    def added(key, table):
        import pyarrow as pa

        return pa.table({"model": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         "part": pa.array([key[2].as_py()], pa.int32()), "hist": pa.array([total(table).tobytes()], pa.binary())})

    def splits(key, table):
        import pyarrow as pa

        k, block = key[0].as_py(), key[1].as_py()
        rows = _candidates(total(table), k, picked[k][block * BLOCK:(block + 1) * BLOCK], grown[k], level, p)
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), *[pa.float64()] * 4]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["model", "node", "gain", "feature", "bin", "gl", "hl", "g", "h"])

    parts = state.mapInArrow(sums, _SUMS)
    if state.sparkSession.sparkContext.defaultParallelism > FAN:
        parts = parts.withColumn("share", F.expr(f"part div {FAN}").cast("int")).groupBy("model", "block", "share").applyInArrow(added, _SUMS)
    return parts.groupBy("model", "block").applyInArrow(splits, _SPLITS)


def _settled(state: DataFrame, booster: Booster, pending: list, held_rows: int, p: BoostParams):
    """The blocks with the margins of the pending trees added, and the score of every model after each of them."""
    dims, models, base = len(booster.features), booster.models, booster.base
    trees = list(pending)

    def run(batches):
        import numpy as np

        for y, fold, h, bins, margins in _blocks_of(batches, dims, base):
            margins, everyone = margins.copy(), np.arange(len(y))
            held = [np.flatnonzero(fold == m) for m in models]
            staged = [np.empty((len(trees), len(rows))) for rows in held]
            for t, tree in enumerate(trees):
                for k, rows in enumerate(held):
                    margins[k] += _leaves(tree, k, bins, everyone)
                    staged[k][t] = margins[k].take(rows)
            yield _block(y, fold, h, bins, margins, np.concatenate([v.ravel() for v in staged]))

    new = kept(state.mapInArrow(run, _STAGED), "boost-rows", **_WRITTEN)
    dropped(state)

    def each(batches):
        """Labels and margins of each model's held-out rows in a block after each tree: (k, t, y, margin)."""
        import numpy as np

        for b in batches:
            for row in zip(*(b.column(k) for k in range(3))):
                y, fold, staged = (np.frombuffer(v.as_buffer(), t) for v, t in zip(row, (np.float64, np.int32, np.float64)))
                for k, m in enumerate(models):
                    own = y[fold == m]
                    mine, staged = staged[:len(trees) * len(own)].reshape(len(trees), -1), staged[len(trees) * len(own):]
                    if len(own):
                        yield from ((k, t, own, mine[t]) for t in range(len(trees)))

    def packed(batches):
        import pyarrow as pa

        for k, t, y, margin in each(batches):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([t], pa.int32()), pa.array([y.tobytes()], pa.binary()), pa.array([margin.tobytes()], pa.binary())], names=["_k", "_t", "y", "margin"])

    def single(batches):
        import pyarrow as pa

        for k, t, y, margin in each(batches):
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(y), pa.int32()), pa.array([t] * len(y), pa.int32()), pa.array(y), pa.array(margin)], names=["_k", "_t", "_y", "_margin"])

    def score(key, table):
        import numpy as np
        import pyarrow as pa

        y, margin = (np.frombuffer(b"".join(table.column(c).to_pylist())) for c in ("y", "margin"))
        value = _score(y, margin, p.objective)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([None if np.isnan(value) else value], pa.float64())], names=["_k", "_t", "s"])

    held = new.select("y", "fold", "staged")
    if held_rows <= HELD_ROWS:
        found = held.mapInArrow(packed, "_k int, _t int, y binary, margin binary").groupBy("_k", "_t").applyInArrow(score, "_k int, _t int, s double")
    else:
        held = held.mapInArrow(single, "_k int, _t int, _y double, _margin double")
        if p.objective == "binary":
            found = roc_auc(held, "_y", "_margin", by=["_k", "_t"]).select("_k", "_t", F.col("auc").alias("s"))
        else:
            found = held.groupBy("_k", "_t").agg((-F.avg((F.col("_y") - F.col("_margin")) ** 2)).alias("s"))
    # models x chunk numbers
    scores = {(models[r["_k"]], r["_t"]): r.s for r in found.collect()}
    out = new.drop("staged")
    out.kept_at = new.kept_at
    return out, scores
