"""Operator 2: n-gram Jaccard join in size-banded tiles with hashed bitmaps.

A document's set holds the distinct ``n``-word shingles of its whole text (ASCII
lower case; with fewer words the whole sequence is its one shingle; without words
the set is empty and linked with nothing).  Two documents link when
``100 * |A and B| >= percent * |A or B|``.

1. Shingles are hashed to 64 bits (of the words' hashes, in order).  Equal
   sets, by a 64-bit digest of the sorted array, are one *class*; the row with its smallest
   id stands for it.  Copies are never paired.
2. All shingles are counted into ``2**COUNT_BITS`` counters over all documents.  A set is
   sorted by (counter, hash): rare shingles first.  Two sets that link have a
   common shingle among the first ``|A| - ceil(t |A|) + 1`` of each, for any
   common order, so the join key of a tile is such a shingle; passages that many
   documents share sort last and rarely become keys.
3. Only keys that several classes have go on, and of keys with the very same classes one.
   First, each key's classes are
   compared with one class of the key (a star: as many pairs as rows), exactly, on sorted
   arrays.  Linked classes form components; keys whose classes are by then all in one
   component are done, as no further link could change a component.  The other keys take
   another class, ``STARS`` times in all.  Groups of copies of any size mostly end here, in linear work.
4. The other keys become tiles (key, size band): a class of band ``b`` (bands grow by
   ``1/t``) meets its own band and the next larger one in tile ``(key, b)``, since linked sets
   differ by one band at most.  Large tiles are cut into blocks that meet
   pairwise, so no task holds a whole hot tile.  Inside, pairs of different
   components must pass the size filter and the bitmap bound: with ``x`` bits set
   in A's bitmap but not in B's, at least ``x`` shingles of A are not in B, so
   ``|A and B| <= min(|A| - x, |B| - y)``.  Bitmaps are as wide as the band needs (folded by halves).
   Only pairs that pass are intersected exactly: in a first round each class's most
   promising pair, one a class, in a second, in the keys that had any, all that still join two components.
5. Components are found by minimum labels over the links, in written rounds; later links join
   whole components, each two of them once, so links inside a component don't take part any more.

No link between different texts is lost; no cap on candidates.  Arrays of
shingles are not stored: they are made again from the text where needed.

Defined results: null, empty and white-space texts have size 0 and are their own
component, as have rows with a null id (which never link: an id is needed to name
a component; their component is null); repeated ids are joined into one node that
links with whatever any of its rows links with, and all its rows show that
component; extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartcast.llm.common import cleaned, dropped, kept, text_or_empty
from cartcast.llm.words import mix, word_hashes

COUNT_BITS = 20
#: Rows of a tile that are compared at a time; larger tiles are cut into such blocks.
BLOCK = 512
#: Classes of a key that all its others are compared with before its tiles are made.
STARS = 2
_WIDTHS = [64 << k for k in range(10)]  # bitmap widths, 64 to 32768 bits


#: An odd factor for each place in a shingle.
_FACTORS = [pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(64)]


def shingle_sets(texts: list[str], n: int) -> list:
    """Sorted distinct 64-bit shingle hashes of each text."""
    import numpy as np

    w, stops = word_hashes(texts)
    starts = np.concatenate([[0], stops[:-1]])
    out = [None] * len(texts)
    counts = np.maximum(stops - starts, 0)
    full = max(len(w) - n + 1, 0)
    h = w[:full] * np.uint64(_FACTORS[0]) + np.uint64(n)
    for j in range(1, n):
        h += w[j:full + j] * np.uint64(_FACTORS[j % 64])
    h = mix(h)
    for k, (a, c) in enumerate(zip(starts.tolist(), counts.tolist(), strict=True)):
        if c >= n:
            x = h[a:a + c - n + 1].copy()  # windows inside this text
            x.sort()
            out[k] = x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) > 1 else x
        elif c:
            x = np.uint64(c) + (w[a:a + c] * np.array(_FACTORS[:c], np.uint64)).sum(dtype=np.uint64)
            out[k] = mix(np.array([x], np.uint64))
        else:
            out[k] = np.zeros(0, np.uint64)
    return out


def _slot(h):
    import numpy as np

    return (h >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _need(size, percent: int):
    """Least intersection with a set of any size that can link: ceil(t * size)."""
    return -(-size * percent // 100)


def _bitmap(h, bits: int):
    import numpy as np

    out = np.zeros(bits, np.uint8)
    out[(h & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little")


def _width(band: int, percent: int) -> int:
    """Bits for the sets of a band: at least eight a shingle, within the widths."""
    most = (100 / percent) ** (band + 1)
    return next((w for w in _WIDTHS if w >= 8 * most), _WIDTHS[-1])


def _band(size: int, percent: int) -> int:
    return int(math.log(size) / math.log(100 / percent) + 1e-9)


def _digest(h) -> int:
    """Signed 64-bit name of a set, the same for equal sets."""
    import xxhash

    return xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(h)) - (1 << 63)


_PARTS = 256


def _sets(texts: DataFrame, n: int) -> DataFrame:
    """Per row: size and class (``node``) of its set."""
    import pyarrow as pa

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                rb = whole.slice(at, 512)
                sets = shingle_sets(rb.column(1).to_pylist(), n)
                yield pa.RecordBatch.from_arrays([
                    rb.column(0), pa.array([len(h) for h in sets], pa.int64()), pa.array([_digest(h) for h in sets], pa.int64())], names=["id", "n", "node"])

    return texts.mapInArrow(run, "id long, n long, node long")


def _counters(texts: DataFrame, n: int):
    """How many shingles (once a text) each counter has, over all texts; a task sends ``_PARTS`` rows."""
    import pyarrow as pa

    def run(batches):
        import numpy as np

        total = np.zeros(1 << COUNT_BITS, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                sets = shingle_sets(whole.slice(at, 512).column(1).to_pylist(), n)
                total += np.bincount(_slot(np.concatenate(sets)), minlength=len(total))
        if total.any():
            yield pa.RecordBatch.from_arrays([*_split(total)], names=["part", "counts"])

    return _gather(texts.mapInArrow(run, "part int, counts binary"), "int32")


def _split(total):
    import numpy as np
    import pyarrow as pa

    if total.dtype != np.uint8:
        total = np.minimum(total, 2**31 - 1).astype(np.int32)
    return pa.array(np.arange(_PARTS), pa.int32()), pa.array([x.tobytes() for x in total.reshape(_PARTS, -1)], pa.binary())


def _gather(rows: DataFrame, kind: str):
    """Adds up (or, for bits, joins) what the tasks counted, part by part; a
    fixed number of bytes reaches the driver, at any input size."""
    import numpy as np
    import pyarrow as pa

    def add(batches):
        sums: dict = {}
        for rb in batches:
            for p, c in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                c = np.frombuffer(c, kind)
                sums[p] = c if p not in sums else sums[p] | c if kind == "uint8" else np.minimum(sums[p].astype(np.int64) + c, 2**31 - 1).astype(np.int32)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["part", "counts"])

    with cleaned(rows.sparkSession):
        got = {r["part"]: r["counts"] for r in rows.select("part", "counts").repartition(16, "part").mapInArrow(add, "part int, counts binary").collect()}
    length = (1 << COUNT_BITS) if kind == "int32" else (1 << _FILTER_BITS) // 8
    part = np.zeros(length // _PARTS, kind).tobytes()
    return np.frombuffer(b"".join(bytes(got.get(p, part)) for p in range(_PARTS)), kind)


_FILTER_BITS = 24


def _filter(ids: DataFrame):
    """A fixed-size filter of the values in the first column: what it lacks isn't there."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        total = np.zeros(1 << _FILTER_BITS, bool)
        for rb in batches:
            total[_spot(rb.column(0).to_numpy())] = True
        if total.any():
            yield pa.RecordBatch.from_arrays([*_split(np.packbits(total))], names=["part", "counts"])

    return ids.sparkSession.sparkContext.broadcast(_gather(ids.coalesce(16).mapInArrow(run, "part int, counts binary"), "uint8"))


def _spot(ids):
    import numpy as np

    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def _in_filter(bits, ids):
    spot = _spot(ids)
    return (bits[spot >> 3] >> (7 - (spot & 7)) & 1).astype(bool)


def _keys(texts: DataFrame, counters, n: int, percent: int) -> DataFrame:
    """(key, node) for the first shingles of each set in the order of rarity."""
    import pyarrow as pa

    def run(batches):
        import numpy as np

        rare, done = counters.value, set()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                keys, nodes = [], []
                for h in shingle_sets(whole.slice(at, 512).column(1).to_pylist(), n):
                    node = _digest(h)
                    if not len(h) or node in done:
                        continue
                    if len(done) < 1_000_000:  # a class once a task; more rows only cost work
                        done.add(node)
                    k = len(h) - _need(len(h), percent) + 1
                    count = rare[_slot(h)]
                    if k < len(h):  # the k rarest, without sorting the others
                        edge = np.partition(count, k - 1)[k - 1]
                        below, on = np.flatnonzero(count < edge), np.flatnonzero(count == edge)
                        h_first = h[np.concatenate([below, on[:k - len(below)]])]  # h is sorted: ties by hash
                    else:
                        h_first = h
                    first = h_first.view(np.int64)
                    keys.append(first)
                    nodes.append(np.full(len(first), node))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, nodes)], names=["key", "node"])

    return texts.select("id", "text").mapInArrow(run, "key long, node long")


def _of_classes(live: DataFrame, texts: DataFrame, n: int, make, name: str) -> DataFrame:
    """(node, n, data) of the classes in ``live`` (rep, node, n): what ``make`` gives for their sets.
    A repeated row can bring a class twice, which only repeats work."""
    import pyarrow as pa

    wanted = _filter(live)

    def run(batches):
        for whole in batches:
            picked = whole.filter(pa.array(_in_filter(wanted.value, whole.column(0).to_numpy())))
            for at in range(0, picked.num_rows, 256):
                rb = picked.slice(at, 256)
                sets = shingle_sets(rb.column(1).to_pylist(), n)
                yield pa.RecordBatch.from_arrays(
                    [rb.column(0), pa.array([_digest(h) for h in sets], pa.int64()), pa.array([make(h) if len(h) else None for h in sets], pa.binary())],
                    names=["rep", "node", "data"])

    rows = texts.where("id is not null").select("id", "text").mapInArrow(run, "rep long, node long, data binary")
    # the filter may let others pass
    return kept(rows.join(live.withColumnRenamed("rep", "its_rep"), "node").where("rep = its_rep").select("node", "n", "data"), name)


def _bitmaps(live: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    return _of_classes(live, texts, n, lambda h: _bitmap(h, _width(_band(len(h), percent), percent)).tobytes(), "jaccard-bitmaps")


def _with_both(pairs: DataFrame, data: DataFrame) -> DataFrame:
    """(a, b, x, y, na, nb): the pairs with the data and sizes of both classes."""
    return (pairs.join(data.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("data").alias("x")), "a")
            .join(data.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("data").alias("y")), "b").select("a", "b", "x", "y", "na", "nb"))


def _chosen(rows: DataFrame, good, name: str) -> DataFrame:
    """The pairs of (a, b, x, y) whose data ``good`` accepts."""
    import pyarrow as pa

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                rb = whole.slice(at, 1024)
                keep = pa.array([good(x.as_buffer(), y.as_buffer()) for x, y in zip(rb.column(2), rb.column(3), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([rb.column(0).filter(keep), rb.column(1).filter(keep)], names=["a", "b"])

    return kept(rows.mapInArrow(run, "a long, b long"), name)


def _promising(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that size and the bitmap bound let pass."""
    import pyarrow as pa

    def run(batches):
        import numpy as np

        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                rb = whole.slice(at, 1024)
                na, nb = rb.column(4).to_numpy(), rb.column(5).to_numpy()
                good = []
                for x, y, p, q in zip(rb.column(2), rb.column(3), na.tolist(), nb.tolist(), strict=True):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    if len(x) != len(y):
                        short = min(len(x), len(y))
                        x, y = (np.bitwise_or.reduce(z.reshape(-1, short), axis=0) for z in (x, y))
                    most = min(p - int(np.bitwise_count(x & ~y).sum(dtype=np.int64)), q - int(np.bitwise_count(y & ~x).sum(dtype=np.int64)))
                    good.append(100 * most >= percent * (p + q - most))
                keep = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays([rb.column(0).filter(keep), rb.column(1).filter(keep)], names=["a", "b"])

    rows = _with_both(pairs, bitmaps).where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return kept(rows.mapInArrow(run, "a long, b long"), "jaccard-promising")


def _linked(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link, by exact intersection of their sorted arrays."""
    live = _live(nodes, pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
    sets = _of_classes(live, texts, n, lambda h: h.tobytes(), "jaccard-arrays")

    def exact(x, y):
        import numpy as np

        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        z = np.concatenate([x, y])
        z.sort()
        both = int((z[1:] == z[:-1]).sum())
        return 100 * both >= percent * (len(x) + len(y) - both)

    out = _chosen(_with_both(pairs, sets), exact, "jaccard-links")
    dropped(live, sets)
    return out


def _live(nodes: DataFrame, used: DataFrame) -> DataFrame:
    return kept(nodes.join(used.distinct(), "node").select("rep", "node", "n"), "jaccard-live")


def components(links: DataFrame) -> DataFrame:
    """(id, component): smallest id reachable, for all ids in ``links`` (a, b).
    Every round each node takes its neighbours' smallest label and that label's own
    (pointer jumping); rounds are written, so a lost executor repeats one only."""
    edges = kept(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = kept(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        via = edges.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = (labels.join(via, F.col("id") == F.col("a"))
                .select("id", F.col("label").alias("was"), F.least("label", "near").alias("label")))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("further"))
        # a label is an id of the component; its own label is at most as large
        new = kept(step.join(jump, "label", "left").select(
            "id", "was", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        dropped(labels)
        if new.where("label <> was").isEmpty():
            dropped(edges)
            return new.select("id", F.col("label").alias("component"))
        labels = new


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` (id, component), as :func:`components` gives it, after further ``links`` (a, b): of the links between
    the same two components, one is followed."""
    was = [parts.select(F.col("id").alias(x), F.col("component").alias(f"of_{x}")) for x in ("a", "b")]
    ends = links.join(was[0], "a", "left").join(was[1], "b", "left").select(F.coalesce("of_a", "a").alias("x"), F.coalesce("of_b", "b").alias("y"))
    pairs = kept(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if pairs.isEmpty():
        dropped(pairs)
        return parts
    up = components(pairs)
    dropped(pairs)
    # a component's label is one of its ids, so only ids without a component are new
    everyone = parts.select("id", "component").union(up.select("id", F.col("id").alias("component"))).distinct()
    further = up.select(F.col("id").alias("component"), F.col("component").alias("further"))
    return kept(everyone.join(further, "component", "left").select("id", F.coalesce("further", "component").alias("component")), "jaccard-parts")


def _groups(raw: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, node, n) of keys that several classes have; of keys with the very same classes,
    one.  The keys are exchanged once."""
    import pyarrow as pa

    by_key = Window.partitionBy("key")
    rows = raw.repartition("key").withColumn("low", F.min("node").over(by_key)).withColumn("high", F.max("node").over(by_key)).where("low < high")
    rows = rows.groupBy("key", "node").agg(F.lit(1).alias("one"))  # a class can come from several tasks
    members = F.xxhash64(*[F.bit_xor(F.xxhash64("node", F.lit(k))).over(by_key) for k in (0, 1)], F.count("*").over(by_key), F.min("node").over(by_key))
    named = kept(rows.select("key", "node", members.alias("members")), "jaccard-keys")
    one = kept(named.groupBy("members").agg(F.min("key").alias("key")).select("key"), "jaccard-one")
    wanted = _filter(one)

    def run(batches):
        for rb in batches:
            yield rb.filter(pa.array(_in_filter(wanted.value, rb.column(0).to_numpy())))

    rows = named.select("key", "node").mapInArrow(run, "key long, node long").join(one, "key", "left_semi")
    out = kept(rows.join(nodes.select("node", "n"), "node"), "jaccard-groups")
    dropped(named, one)
    return out


def _labelled(keys: DataFrame, part_of: DataFrame) -> DataFrame:
    """``keys`` with the component of each class; a class without one is its own."""
    return keys.join(part_of.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))


def _star(keys: DataFrame, part_of: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of one class of each key, another every ``turn``, and those of the key that aren't in its component:
    fewer pairs than rows.  The order is one for all keys, so that keys with the same classes mostly give the same pairs."""
    drawn = F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), F.col("node"), F.col("component"))
    rows = _labelled(keys, part_of).withColumn("first", F.min(drawn).over(Window.partitionBy("key"))).where("component <> first.component")
    return kept(rows.select(F.least("first.node", "node").alias("a"), F.greatest("first.node", "node").alias("b")).distinct(), "jaccard-star")


def _tiles(keys: DataFrame, part_of: DataFrame, percent: int) -> DataFrame:
    """Rows (key, tile, i, j, node, n, component, own, block) of the tiles that hold several components, in blocks."""
    labelled = kept(_labelled(keys, part_of), "jaccard-labelled")
    open_keys = (labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                 .where("low < high").select("key"))
    band = F.floor(F.log(F.col("n")) / math.log(100 / percent) + F.lit(1e-9)).cast("int")
    rows = (labelled.join(open_keys, "key").withColumn("own", band)
            .withColumn("tile", F.explode(F.array("own", F.col("own") - 1))).where("tile >= 0"))
    sizes = rows.groupBy("key", "tile").agg(F.count("*").alias("rows"), F.count_if(F.col("own") == F.col("tile")).alias("owners"),
                                            F.min("component").alias("low"), F.max("component").alias("high"))
    sizes = sizes.where("owners > 0 and low < high").select("key", "tile", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    cut = rows.join(sizes, ["key", "tile"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # block i meets every block j once, as the pair (smaller, larger)
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "tile", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "node", "n", "component", "own", "block")
    out = kept(met, "jaccard-tiles")
    dropped(labelled)
    return out


def _folded(maps: list, bits: int):
    """Bitmaps as rows of ``bits`` bits."""
    import numpy as np

    out = np.empty((len(maps), bits // 8), np.uint8)
    for length in {len(m) for m in maps}:
        at = [k for k, m in enumerate(maps) if len(m) == length]
        a = np.frombuffer(b"".join(maps[k] for k in at), np.uint8).reshape(len(at), -1, bits // 8)
        out[at] = np.bitwise_or.reduce(a, axis=1)
    return out.view(np.uint64)


def _pairs_of(group, tile, i, j, node, n, comp, own, block, maps, percent: int, best_only: bool):
    """Pairs of rows that may link, and how well, from rows sorted by group.  All groups are compared at once: at
    step d, each row meets the row d places on, if that is in its group."""
    import numpy as np

    out_a, out_b, out_s = [], [], []
    rows = np.arange(len(node))
    end = np.searchsorted(group, group, side="right")
    best, partner = np.zeros(len(node)), np.full(len(node), -1)
    live, d = rows, 0
    while True:
        d += 1
        live = live[live + d < end[live]]
        if not len(live):
            break
        x, y = live, live + d
        ok = (comp[x] != comp[y]) & ((own[x] == tile[x]) | (own[y] == tile[y])) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
        ok &= (i[x] == j[x]) | (block[x] != block[y])
        x, y = x[ok], y[ok]
        if not len(x):
            continue
        only_x = np.bitwise_count(maps[x] & ~maps[y]).sum(axis=1, dtype=np.int64)
        only_y = np.bitwise_count(maps[y] & ~maps[x]).sum(axis=1, dtype=np.int64)
        most = np.minimum(n[x] - only_x, n[y] - only_y)
        ok = 100 * most >= percent * (n[x] + n[y] - most)
        x, y, most = x[ok], y[ok], most[ok]
        score = most / (n[x] + n[y] - most)
        if best_only:
            for p, q in ((x, y), (y, x)):
                up = score > best[p]
                best[p[up]], partner[p[up]] = score[up], q[up]
        else:
            out_a.append(x)
            out_b.append(y)
            out_s.append(score)
    if best_only:
        at = np.flatnonzero(partner >= 0)
        return at, partner[at], best[at]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b]), np.concatenate([np.zeros(0), *out_s])


def _candidates(tiles: DataFrame, bitmaps: DataFrame, percent: int, best_only: bool) -> DataFrame:
    """(key, a, b, score): pairs of different components that size and bitmaps let pass; with
    ``best_only``, each class's (``a``) most promising one in its tile.  A key without a pair needs no further look."""
    import pyarrow as pa

    rows = tiles.join(bitmaps.select("node", "data"), "node").select("key", "tile", "i", "j", "node", "n", "component", "own", "block", "data")
    rows = rows.repartition("key", "tile", "i", "j").sortWithinPartitions("key", "tile", "i", "j")

    def emit(table):
        import numpy as np

        key, tile, i, j, node, n, comp, own, block = (table.column(k).to_numpy() for k in range(9))
        new = np.zeros(len(key), bool)
        for c in (key, tile, i, j):
            new[1:] |= c[1:] != c[:-1]
        group, maps = np.cumsum(new), table.column(9).to_pylist()
        width = np.array([_width(t, percent) for t in range(tile.max() + 1)])[tile]
        a, b, found, score = [], [], [], []
        for bits in np.unique(width).tolist():
            at = np.flatnonzero(width == bits)
            x, y, s = _pairs_of(*(c[at] for c in (group, tile, i, j, node, n, comp, own, block)), _folded([maps[k] for k in at], bits), percent, best_only)
            found.append(key[at][x])
            a.append(node[at][x])
            b.append(node[at][y])
            score.append(s)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found, a, b, score)], names=["key", "a", "b", "score"])

    def run(batches):
        import numpy as np

        held = None  # rows of a group that may go on in the next batch
        for rb in batches:
            for at in range(0, rb.num_rows, 4 * BLOCK):
                part = pa.Table.from_batches([rb.slice(at, 4 * BLOCK)])
                table = pa.concat_tables([held, part]).combine_chunks() if held is not None else part
                last = np.ones(table.num_rows, bool)
                for k in range(4):
                    c = table.column(k).to_numpy()
                    last &= c == c[-1]
                cut = table.num_rows - int(last.sum())
                if cut:
                    yield emit(table.slice(0, cut))
                held = table.slice(cut)
        if held is not None and held.num_rows:
            yield emit(held)

    out = kept(rows.mapInArrow(run, "key long, a long, b long, score double"), "jaccard-pairs")
    dropped(tiles)
    return out


def _to_compare(found: DataFrame, best_only: bool) -> DataFrame:
    """The pairs (a, b) of :func:`_candidates`, each once; with ``best_only`` the most promising one of each class over all tiles."""
    if best_only:
        found = found.groupBy("a").agg(F.max(F.struct("score", "b")).alias("best")).select("a", "best.b")
    return kept(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jaccard-more")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", col: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """(``id_col``, n_shingles, component_id) of each row of ``docs``."""
    if id_col.lower() in ("n_shingles", "component_id"):
        raise ValueError("the id column has the name of a result")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(col).alias("text"))
    context = docs.sparkSession.sparkContext
    counters = context.broadcast(_counters(texts, n))
    sets = kept(_sets(texts, n), "jaccard-sets")
    named = sets.where("n > 0 and id is not null")
    nodes = kept(named.groupBy("node").agg(F.min("id").alias("rep"), F.first("n").alias("n")), "jaccard-nodes")

    keys = _groups(_keys(texts.where("id is not null"), counters, n, percent), nodes)
    live = _live(nodes, keys.select("node"))
    bitmaps = _bitmaps(live, texts, n, percent)
    dropped(live)
    # rows of a repeated id can be in several classes, which are linked through the id
    twice = named.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z").select("id", "a")
    parts = components(named.join(twice, "id").where("node <> a").select("a", F.col("node").alias("b")))
    for turn in range(STARS):
        near = _star(keys, parts, turn)
        parts = _joined(parts, _linked(_promising(near, bitmaps, percent), nodes, texts, n, percent))
        dropped(near)
    for best_only in (True, False):
        found = _candidates(_tiles(keys, parts, percent), bitmaps, percent, best_only)
        keys = keys.join(found.select("key").distinct(), "key", "left_semi")
        parts = _joined(parts, _linked(_to_compare(found, best_only), nodes, texts, n, percent))
    labelled = nodes.join(parts.withColumnRenamed("id", "node"), "node", "left").select("node", "rep", F.coalesce("component", "node").alias("component"))
    lowest = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    named_parts = labelled.join(lowest, "component").select("node", "component_id")
    # rows without words or id stand alone and don't take part in the join on the class
    alone = sets.where("n = 0 or id is null").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return named.join(named_parts, "node").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id").unionByName(alone)
