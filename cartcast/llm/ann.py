"""Operator 10: nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample (about ``SAMPLE`` vectors, drawn by a hash of the id),
by splitting nodes into ``BRANCH`` spherical k-means clusters until a leaf has ``LEAF``
sample vectors or fewer.  Every vector is then led to its leaf, level by level.  A query walks the
tree with a priority queue: the open node whose centre is nearest comes next, so leaves come out
in the order of promise.  How many leaves are visited is calibrated: for about ``PROBES`` vectors
the true neighbours within the whole table are known (exact search, in blocks), and visits widen
until ``TARGET`` of them are found; the number is in terms of vectors seen, so that queries in small
leaves visit more of them.

Search: neighbouring leaves share a bin of up to ``BLOCK`` vectors, and larger leaves, such as a vector that
a third of all rows share, are cut into blocks of that size; queries meet the vectors of the leaves that they
visit in groups (bin, block, turn of at most about ``BLOCK`` queries), and each group gives its ``k`` best per query only.  The best of all groups are merged by (score, id).  Nothing is dropped: a query that met
fewer than ``k`` candidates goes to all leaves.  The tree, the probes and the queries' leaf lists
are bounded by the parameters or by the query set.

Scores are cosines of the original vectors in double precision, summed per row in one fixed order, so
equal vectors tie exactly; ties go to the smaller id.

Defined results: null vectors, zero vectors, and vectors with null or non-finite components or another length than
most take no part, as have rows with a null id; repeated ids are candidates each; equal query rows are one query, and an id with
several vectors gets the k best over all of them, a candidate once for each vector; a query never meets rows of its own id;
extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartcast.llm.common import kept

SAMPLE = 40_000
BRANCH = 8
LEAF = 256
BLOCK = 8192
QUERIES_AT_ONCE = 128
PROBES = 200
TARGET = 0.97
MARGIN = 1.3   # more visits than the calibration asks for


@dataclass
class Tree:
    """Centres of all nodes; children of node ``n`` are ``first[n]`` to ``first[n] + count[n] - 1``; leaves have none."""

    centres: object
    first: list
    count: list
    leaf_of: dict

    def descend(self, unit):
        """The leaf of each row of ``unit``."""
        import numpy as np

        at = np.zeros(len(unit), int)
        count = np.array(self.count)
        while (inner := np.flatnonzero(count[at] > 0)).size:
            for node in np.unique(at[inner]):
                rows = inner[at[inner] == node]
                c = slice(self.first[node], self.first[node] + self.count[node])
                at[rows] = self.first[node] + (unit[rows] @ self.centres[c].T).argmax(axis=1)
        return np.array([self.leaf_of[n] for n in at.tolist()], np.int64) if len(at) else np.zeros(0, np.int64)

    def best_bins(self, unit, sizes, enough: float) -> list[int]:
        """Leaves in best-bin-first order until ``enough`` vectors are in them."""
        queue, out, seen = [(0.0, 0)], [], 0.0
        near = self.centres @ unit
        while queue and seen < enough:
            _, node = heapq.heappop(queue)
            if self.count[node]:
                for child in range(self.first[node], self.first[node] + self.count[node]):
                    heapq.heappush(queue, (-float(near[child]), child))
            else:
                leaf = self.leaf_of[node]
                if sizes[leaf]:
                    out.append(leaf)
                    seen += sizes[leaf]
        return out


def _kmeans(x, k: int, rng):
    """Spherical k-means: unit centres and the cluster of each row."""
    import numpy as np

    c = x[rng.choice(len(x), k, replace=False)]
    own = None
    for _ in range(12):
        new = (x @ c.T).argmax(axis=1)
        if own is not None and (new == own).all():
            break
        own = new
        for j in range(k):
            s = x[own == j].sum(axis=0)
            n = np.linalg.norm(s)
            c[j] = s / n if n > 0 else x[rng.integers(len(x))]
    return c, own


def fit(sample, seed: int = 5) -> Tree:
    """A tree over the rows of ``sample``, unit vectors."""
    import numpy as np

    rng = np.random.default_rng(seed)
    centres, first, count, leaf_of = [np.zeros(sample.shape[1])], [0], [0], {}
    todo = [(0, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop()
        x = sample[rows]
        distinct = len(np.unique(x.round(6), axis=0)) if len(rows) > LEAF else 0
        if distinct < 2 * BRANCH:
            leaf_of[node] = len(leaf_of)
            continue
        c, own = _kmeans(x, BRANCH, rng)
        parts = [(j, rows[own == j]) for j in range(BRANCH) if (own == j).any()]
        if len(parts) < 2:
            leaf_of[node] = len(leaf_of)
            continue
        first[node], count[node] = len(centres), len(parts)
        for j, part in parts:
            todo.append((len(centres), part))
            centres.append(c[j])
            first.append(0)
            count.append(0)
    return Tree(np.array(centres), first, count, leaf_of)


def _matrix(column):
    """A list column as a matrix of doubles."""
    import numpy as np

    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _cosines(q, x):
    """Cosines of ``q`` with the rows of ``x``; each row is summed in the same order."""
    import numpy as np

    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def _best(ids, scores, k: int):
    """Positions of the k best, ties to the smaller id."""
    import numpy as np

    if len(ids) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))


def _usable(df: DataFrame, id_col: str, col: str) -> DataFrame:
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size(v) == (length["n"] if length else 0))


def _exact(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """True neighbours of few (broadcast) queries among all rows: each task keeps its k best."""
    import numpy as np
    import pyarrow as pa

    rows = queries.collect()
    sent = vectors.sparkSession.sparkContext.broadcast(([r["id"] for r in rows], np.array([r["v"] for r in rows], float)))

    def run(batches):
        qids, q = sent.value
        best: list = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))] * len(qids)
        for rb in batches:
            ids, leaf, x = rb.column(0).to_numpy(), rb.column(2).to_numpy(), _matrix(rb.column(1))
            for j, qid in enumerate(qids):
                ok = ids != qid
                s = np.concatenate([best[j][1], _cosines(q[j], x)[ok]])
                i = np.concatenate([best[j][0], ids[ok]])
                at = _best(i, s, k)
                best[j] = (i[at], s[at], np.concatenate([best[j][2], leaf[ok]])[at])
        for qid, (i, s, leaf) in zip(qids, best, strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), qid)), pa.array(i), pa.array(s), pa.array(leaf)], names=["query_id", "vec_id", "score", "leaf"])

    found = vectors.select("id", "v", "leaf").mapInArrow(run, "query_id long, vec_id long, score double, leaf long")
    return _merged(found, k)


def _merged(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _index(vectors: DataFrame, tree: Tree) -> DataFrame:
    import numpy as np
    import pyarrow as pa

    sent = vectors.sparkSession.sparkContext.broadcast(tree)

    def run(batches):
        for rb in batches:
            x = _matrix(rb.column(1))
            unit = x / np.linalg.norm(x, axis=1, keepdims=True) if len(x) else x
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(sent.value.descend(unit))], names=["id", "v", "leaf"])

    return vectors.mapInArrow(run, "id long, v array<double>, leaf long")


def calibrated(tree: Tree, sizes, probes: DataFrame, index: DataFrame, k: int, target: float) -> float:
    """How many vectors' leaves to visit so that ``target`` of the probes' true neighbours are in them."""
    import numpy as np

    truth: dict[int, list[int]] = {}
    for r in _exact(probes, index, k).collect():  # k rows a probe
        truth.setdefault(r["query_id"], []).append(r["leaf"])
    needs = []
    for r in probes.collect():
        v = np.array(r["v"], float)
        order = tree.best_bins(v / np.linalg.norm(v), sizes, float("inf"))
        place = {leaf: n for n, leaf in enumerate(order)}
        before = np.concatenate([[0.0], np.cumsum([sizes[leaf] for leaf in order])])
        needs += [before[place[leaf]] + 1 for leaf in truth.get(r["id"], [])]
    return float(np.quantile(needs, target)) * MARGIN if needs else float("inf")  # of all neighbours, each a draw of the recall


def _thinned(df: DataFrame, n: int, total: int, seed: int) -> DataFrame:
    """About ``n`` rows of ``total``, by a hash of the id: no task and no driver sorts more."""
    if total <= n:
        return df
    share = n / total
    return df.where(F.shiftrightunsigned(F.xxhash64("id", F.lit(seed)), 11) < F.lit(int(share * 2**53)))


def search(df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", col: str = "embedding", target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row where ``is_query`` (of column ``id``) holds."""
    import numpy as np
    import pyarrow as pa

    spark = df.sparkSession
    vectors = kept(_usable(df, id_col, col), "ann-vectors")
    schema = "query_id long, rank int, vec_id long, score double"
    total = vectors.count()
    picked = _thinned(vectors, SAMPLE, total, 0).orderBy("id")
    sample = np.array([r["v"] for r in picked.select("v").toLocalIterator()], float)
    if not len(sample):
        return spark.createDataFrame([], schema)
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    tree = fit(sample)
    index = kept(_index(vectors, tree), "ann-index")
    sizes = np.zeros(len(tree.leaf_of))
    for r in index.groupBy("leaf").count().collect():  # one row a leaf, bounded by the sample
        sizes[r["leaf"]] = r["count"]
    probes = kept(_thinned(vectors, PROBES, total, 1), "ann-probes")
    enough = calibrated(tree, sizes, probes, index, k, target)
    sent = spark.sparkContext.broadcast((tree, sizes))

    queries = vectors.where(is_query).select("id", "v").distinct()
    bin_of = _bins(sizes)
    found = _met(_visits(queries, lambda v: sent.value[0].best_bins(v / np.linalg.norm(v), sent.value[1], max(enough, 2 * k)), bin_of), index, sizes, bin_of, k)
    first = kept(_merged(found, k), "ann-found")
    # whoever met fewer than k goes to every leaf
    full = first.groupBy(F.col("query_id").alias("id")).count().where(F.col("count") >= k)
    short = kept(queries.join(full, "id", "left_anti"), "ann-short")
    rest = _merged(_met(_visits(short, lambda v: np.flatnonzero(sent.value[1]).tolist(), bin_of), index, sizes, bin_of, k), k)
    met = first.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti")
    columns = ["query_id", "rank", "vec_id", "score"]
    return met.select(columns).unionByName(rest.select(columns))


def _bins(sizes) -> list[int]:
    """A bin for each leaf: neighbouring leaves share one up to ``BLOCK`` vectors."""
    out, b, n = [], 0, 0
    for s in sizes.tolist():
        if n and n + s > BLOCK:
            b, n = b + 1, 0
        n += s
        out.append(b)
    return out


def _visits(queries: DataFrame, leaves_of, bin_of: list[int]) -> DataFrame:
    """(bin, query_ids, qs, counts, leaves): the queries that visit leaves of a bin, and which
    leaves each visits, as one row for each bin and block of queries."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                rb = whole.slice(at, BLOCK)
                ids, x = rb.column(0).to_numpy(), _matrix(rb.column(1))
                by_bin: dict[int, dict[int, list[int]]] = {}
                for j, v in enumerate(x):
                    for leaf in leaves_of(v):
                        by_bin.setdefault(bin_of[leaf], {}).setdefault(j, []).append(leaf)
                rows = [(b, ids[list(js)].tobytes(), x[list(js)].tobytes(), np.array([len(v) for v in js.values()], np.int32).tobytes(),
                         np.array([leaf for v in js.values() for leaf in v], np.int32).tobytes()) for b, js in by_bin.items()]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=["bin", "query_ids", "qs", "counts", "leaves"])

    return queries.select("id", "v").mapInArrow(run, "bin long, query_ids binary, qs binary, counts binary, leaves binary")


def _met(visits: DataFrame, index: DataFrame, sizes, bin_of: list[int], k: int) -> DataFrame:
    """The k best of each query among the leaves that it visits in a (bin, block)."""
    import numpy as np
    import pyarrow as pa

    total = np.bincount(bin_of, sizes)
    table = index.sparkSession.createDataFrame([(leaf, b, int(max(1, -(-total[b] // BLOCK)))) for leaf, b in enumerate(bin_of)], "leaf long, bin long, blocks int")
    # one row a leaf, bounded by the sample
    rows = index.join(F.broadcast(table), "leaf").withColumn("block", F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int")).select("bin", "block", "leaf", "id", "v")
    visits = kept(visits, "ann-visits")
    # a bin's queries go in turns of about BLOCK, each of which meets the bin's vectors in a group of its own; one row a bin
    turns = F.broadcast(visits.groupBy("bin").agg(F.ceil(F.sum(F.length("query_ids") / 8) / BLOCK).cast("int").alias("turns")))
    asked = visits.join(F.broadcast(table.select("bin", "blocks").distinct()), "bin").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    asked = asked.join(turns, "bin").withColumn("turn", F.pmod(F.xxhash64("query_ids"), F.col("turns")).cast("int")).drop("turns")
    rows = rows.join(turns, "bin").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")

    def run(left, right):
        ids, leaf, x = left.column("id").to_numpy(), left.column("leaf").to_numpy(), _matrix(left.column("v").combine_chunks())
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(ids):
            unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
            own, place = np.unique(leaf, return_inverse=True)  # the leaves of this block
            for qids, qs, counts, leaves in zip(*(right.column(c).to_pylist() for c in ("query_ids", "qs", "counts", "leaves")), strict=True):
                qids, qs = np.frombuffer(qids, np.int64), np.frombuffer(qs, float).reshape(-1, x.shape[1])
                row = np.repeat(np.arange(len(qids)), np.frombuffer(counts, np.int32))
                at = np.searchsorted(own, leaves := np.frombuffer(leaves, np.int32))
                here = (at < len(own)) & (own[np.minimum(at, len(own) - 1)] == leaves)
                visited = np.zeros((len(qids), len(own)), bool)
                visited[row[here], at[here]] = True
                for c in range(0, len(qids), QUERIES_AT_ONCE):
                    q, qi = qs[c:c + QUERIES_AT_ONCE], qids[c:c + QUERIES_AT_ONCE]
                    near = q @ unit.T / np.sqrt((q * q).sum(axis=1))[:, None]  # good to some last digits
                    near[~visited[c:c + QUERIES_AT_ONCE][:, place] | (qi[:, None] == ids[None, :])] = -np.inf
                    edge = np.partition(near, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(qi), -np.inf)
                    for j in range(len(qi)):
                        # whatever may be among the k best, scored exactly
                        some = np.flatnonzero((near[j] >= edge[j] - 1e-9) & (near[j] > -np.inf))
                        s = _cosines(q[j], x[some])
                        best = _best(ids[some], s, k)
                        out.append((np.full(len(best), qi[j]), ids[some][best], s[best]))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.table({"query_id": cols[0], "vec_id": cols[1], "score": cols[2]})

    return rows.groupBy("bin", "block", "turn").cogroup(asked.groupBy("bin", "block", "turn")).applyInArrow(run, "query_id long, vec_id long, score double")
