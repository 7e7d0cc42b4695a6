"""Operator 13: ranked lexical search with bit-sliced Bloom signatures.

Index: documents of about the same number of keys share a block.  A key is a term together with a level of its
occurrences (at least 1, 2, 3, 5, 9, ... times); each sets ``HASHES`` bits of its document's signature.  A block stores the
signatures by slices: one bitmap over its documents for each bit, so that the documents that may
hold a key are the AND of a few bitmaps.  A signature may claim too much, never too little.

Search: the levels found bound a term's occurrences from above, the document's length is known, so the weighted sum of
the slices bounds a score from above.  The documents with the highest bounds are scored exactly; the tenth best exact
score is an item's threshold.  A second pass over the index hands on every document whose bound reaches it; all of them are scored exactly
from their texts.  Documents left out are proven to score less.

Items go in blocks of at most ``ITEMS`` items and about ``ITEM_BYTES`` of text: what a task holds of the queries is bounded, and
every block meets the whole index.  Number of documents, lengths and document frequencies cover all documents.

Defined results: a null text and a text without terms never match and count nowhere; rows with a null id are documents, last
among equal scores; rows that repeat an id are documents each and may come several times; equal item rows are one item, an id with several texts has
a ranking for each; an empty table on either side gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartcast.llm.common import kept

#: Bytes that belong to no term; A-Z become a-z, all others stay.
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]

LEVELS = [1, 2, *(2**k + 1 for k in range(1, 21))]   # at least so many occurrences
HASHES = 8
KEY_BITS = 20            # slices of a block for each key of its largest document; at least half of that is used
BLOCK = 512              # documents of a block
BLOCK_BITS = 1 << 24     # and bits of a block
MOST_SLICES = 1 << 22    # longer documents have denser signatures: looser bounds, the same results
ITEMS = 512
ITEM_BYTES = 1 << 21
BEST = 10
BROADCAST_ROWS = 100_000

_INDEX = "slices binary, n_slices int, ids array<{id}>, sums array<long>, words array<long>"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _table() -> bytes:
    table = bytearray(range(256))
    for b in SEPARATORS:
        table[b] = 0x20
    for b in range(0x41, 0x5B):
        table[b] = b + 0x20
    return bytes(table)


TABLE = _table()


def terms(text: str) -> list[bytes]:
    """The terms of a text, in order, as UTF-8."""
    return text.encode().translate(TABLE).split()


@contextmanager
def _batches(spark, rows: int):
    """Queries run inside hand at most ``rows`` rows to Python at once."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def _mixed(h):
    """A well spread 64-bit value of each entry of ``h`` (the finaliser of splitmix64, a public algorithm)."""
    import numpy as np

    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _places(crc, level: int, n_slices: int):
    """The slices of each term at one level, one row a term."""
    import numpy as np

    with np.errstate(over="ignore"):
        key = _mixed(crc.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
        step = np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
        return (_mixed(key[:, None] + step[None, :]) % np.uint64(n_slices)).astype(np.int64)


class _Band:
    """Documents of about the same number of keys, until they fill a block."""

    def __init__(self, keys: int):
        self.n_slices = min(keys * KEY_BITS, MOST_SLICES)
        self.most = max(1, min(BLOCK, BLOCK_BITS // self.n_slices))
        self.clear()

    def clear(self):
        self.crc, self.tf, self.ids, self.sums, self.words = [], [], [], [], []

    def row(self):
        import numpy as np

        d = len(self.ids)
        doc = np.repeat(np.arange(d), [len(c) for c in self.crc])
        crc, tf = np.concatenate(self.crc), np.concatenate(self.tf)
        bits = np.zeros((self.n_slices, -(-d // 8) * 8), bool)
        for level, least in enumerate(LEVELS):
            has = tf >= least
            if not has.any():
                break
            crc, tf, doc = crc[has], tf[has], doc[has]
            for a in range(0, len(crc), 1 << 16):
                bits[_places(crc[a:a + (1 << 16)], level, self.n_slices), doc[a:a + (1 << 16), None]] = True
        out = {"slices": np.packbits(bits, axis=1).tobytes(), "n_slices": self.n_slices, "ids": self.ids, "sums": self.sums, "words": self.words}
        self.clear()
        return out


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The blocks of all documents that have a term; the ids, check sums of the texts and lengths stand beside the slices."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    ddl = _INDEX.format(id=narrow.schema["doc_id"].dataType.simpleString())
    schema = to_arrow_schema(_parse_datatype_string(ddl))

    def read(batches):
        from collections import Counter
        from zlib import crc32

        import numpy as np
        import pyarrow as pa

        bands: dict[int, _Band] = {}
        rows = lambda band: pa.RecordBatch.from_pylist([band.row()], schema=schema)
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                raw = text.as_buffer().to_pybytes()
                words = raw.translate(TABLE).split()
                if not words:
                    continue
                counts = Counter(words)
                tf = np.fromiter(counts.values(), np.int64, len(counts))
                keys = int(np.searchsorted(LEVELS, tf, side="right").sum())
                size = 1 << max(4, (keys - 1).bit_length())
                band = bands.setdefault(size, _Band(size))
                band.crc.append(np.fromiter(map(crc32, counts), np.uint32, len(counts)))
                band.tf.append(tf)
                band.ids.append(doc_id)
                band.sums.append(crc32(raw))
                band.words.append(len(words))
                if len(band.ids) >= band.most:
                    yield rows(band)
        for size in sorted(bands):
            if bands[size].ids:
                yield rows(bands[size])

    return narrow.mapInArrow(read, ddl)


def frequencies(docs: DataFrame, wanted: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """In how many documents each of the ``wanted`` terms (those of one block of items) occurs."""
    wanted = frozenset(wanted)

    def read(batches):
        from collections import Counter

        import pyarrow as pa

        found: Counter = Counter()
        for b in batches:
            for text in b.column(0):
                found.update(wanted.intersection(text.as_buffer().to_pybytes().translate(TABLE).split()))
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], names=["term", "df"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null").mapInArrow(read, "term binary, df long")
    return {bytes(r.term): r.df for r in rows.groupBy("term").agg(F.sum("df").alias("df")).collect()}


@dataclass
class Queries:
    """A block of items: its distinct terms that occur, their weights, and each item's terms with their repeats."""

    n_docs: int
    n_words: int
    terms: list
    weights: list
    items: list

    def length_part(self, words):
        """``m`` of documents of so many words."""
        return 25 + (75 * words * self.n_docs) // self.n_words

    def bounds(self, row):
        """What no score of the block's documents exceeds: one line an item, one column a document."""
        from zlib import crc32

        import numpy as np

        words = np.array(row["words"], np.int64)
        d, n = len(words), row["n_slices"]
        slices = np.frombuffer(row["slices"], np.uint8).reshape(n, -1)
        m = self.length_part(words)
        gain = np.zeros((len(self.terms), d))
        at, crc = np.arange(len(self.terms)), np.array([crc32(t) for t in self.terms], np.uint32)
        may, before = None, 0
        for level in range(len(LEVELS)):
            if not len(at):
                break
            places = _places(crc[at], level, n)
            here = slices[places[:, 0]]
            for k in range(1, HASHES):
                here &= slices[places[:, k]]
            if may is not None:
                here &= may
            some = here.any(axis=1)
            at, may = at[some], here[some]
            most = np.minimum(LEVELS[level + 1] - 1, words) if level + 1 < len(LEVELS) else words
            worth = (10**9 * most) // (1000 * most + 8 * m)
            gain[at] += np.unpackbits(may, axis=1, count=d) * (worth - before)
            before = worth
        weights = np.array(self.weights, float)
        # whole numbers far below 2^53: the sums of doubles are exact
        return np.stack([(weights[t] * times) @ gain[t] for t, times in self.items]) if self.items else np.zeros((0, d))

    def score(self, counts, words: int, item: int) -> int:
        m = self.length_part(words)
        total = 0
        for t, times in zip(*(a.tolist() for a in self.items[item])):
            tf = counts.get(self.terms[t], 0)
            if tf:
                total += times * self.weights[t] * ((10**9 * tf) // (1000 * tf + 8 * m))
        return total


def queries(docs: DataFrame, texts: list[str], n_docs: int, n_words: int, text_col: str = "text") -> Queries:
    """The weights of the terms of ``texts`` over all documents."""
    from collections import Counter

    import numpy as np

    counts = [Counter(terms(t or "")) for t in texts]
    df = frequencies(docs, {t for c in counts for t in c}, text_col)
    known = sorted(df)
    place = {t: i for i, t in enumerate(known)}
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in known]
    items = []
    for c in counts:
        use = [(place[t], k) for t, k in c.items() if t in place]
        items.append((np.array([i for i, _ in use], np.int64), np.array([k for _, k in use], np.int64)))
    return Queries(n_docs, n_words, known, weights, items)


def _bounded(blocks: DataFrame, q: Queries, least: list[int] | None, id_type: str) -> DataFrame:
    """``item, doc_id, sum, bound``: without ``least`` the ``BEST`` highest bounds of each item in each task, with it every
    document whose bound is at least the item's."""

    def read(batches):
        import numpy as np
        import pyarrow as pa

        id_arrow = None
        best: dict[int, list] = {}

        def batch(item, ids, sums, bound):
            return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, id_arrow), pa.array(sums, pa.int64()), pa.array(bound, pa.int64())],
                                              names=["item", "doc_id", "sum", "bound"])

        for b in batches:
            id_arrow = b.schema.field("ids").type.value_type
            for i in range(b.num_rows):
                row = {name: b.column(name)[i].as_py() for name in ("n_slices", "ids", "sums", "words")}
                row["slices"] = b.column("slices")[i].as_buffer()
                bound = q.bounds(row)
                ids, sums = row["ids"], row["sums"]
                if least is None:
                    for item in np.flatnonzero(bound.max(axis=1, initial=0) > 0).tolist():
                        line, had = bound[item], best.setdefault(item, [])
                        floor = had[-1][0] if len(had) == BEST else 0
                        at = np.flatnonzero(line > floor)
                        if len(at) > BEST:
                            at = at[np.argpartition(-line[at], BEST - 1)[:BEST]]
                        had += [(int(line[j]), ids[j], sums[j]) for j in at.tolist()]
                        had.sort(key=lambda r: -r[0])
                        del had[BEST:]
                else:
                    item, at = np.nonzero((bound >= np.array(least)[:, None]) & (bound > 0))
                    if len(item):
                        yield batch(item, [ids[j] for j in at.tolist()], [sums[j] for j in at.tolist()], bound[item, at].astype(np.int64))
        rows = [(item, doc_id, s, bound) for item, had in best.items() for bound, doc_id, s in had]
        if rows:
            item, ids, sums, bound = zip(*rows)
            yield batch(item, ids, sums, bound)

    return blocks.mapInArrow(read, f"item int, doc_id {id_type}, sum long, bound long")


def _scored(docs: DataFrame, found: DataFrame, q: Queries, id_type: str) -> DataFrame:
    """Exact scores of the documents in ``found`` for the items they were found for."""
    found = found.groupBy("doc_id", "sum").agg(F.collect_set("item").alias("items"))
    found = kept(found.withColumnsRenamed({"doc_id": "found_id", "sum": "found_sum"}), "lexical-found")
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    on = docs["doc_id"].eqNullSafe(found["found_id"]) & (docs["sum"] == found["found_sum"])

    def read(batches):
        from collections import Counter

        import pyarrow as pa

        for b in batches:
            rows = []
            for doc_id, text, items in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                words = terms(text)
                counts = Counter(words)
                rows += [(item, doc_id, q.score(counts, len(words), item)) for item in items]
            item, ids, score = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, b.schema.field(0).type), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return docs.join(found, on).select("doc_id", "text", "items").mapInArrow(read, f"item int, doc_id {id_type}, score long")


def _first(df: DataFrame, by: str) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc(by), F.asc_nulls_last("doc_id"))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= BEST)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``BEST`` documents of each item."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    docs = docs.withColumn("sum", F.crc32(F.col("text").cast("binary")))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("text is not null").distinct()
    item_type = items.schema["item_id"].dataType.simpleString()
    empty = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")

    blocks = kept(index(docs), "lexical-index", **{"parquet.block.size": str(8 << 20)})
    size = blocks.agg(F.sum(F.size("words")).alias("n"), F.sum(F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + w)).alias("l")).first()
    asked = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    if not size.n or not asked.n:
        return empty
    parts = max(-(-asked.n // ITEMS), -(-asked.b // ITEM_BYTES))
    out = None
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        if not rows:
            continue
        q = queries(docs, [r.text for r in rows], size.n, size.l)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"item int, item_id {item_type}")
        with _batches(spark, 8):
            probes = kept(_first(_bounded(blocks, q, None, id_type), "bound").drop("rank"), "lexical-probes")
        tenth = _first(_scored(docs, probes, q, id_type), "score").where(F.col("rank") == BEST).select("item", "score").collect()
        least = [1] * len(rows)
        for r in tenth:
            least[r.item] = max(1, r.score)
        with _batches(spark, 8):
            found = kept(_bounded(blocks, q, least, id_type).select("item", "doc_id", "sum"), "lexical-bounds")
        best = kept(_first(_scored(docs, found, q, id_type).where("score > 0"), "score"), "lexical-best")
        best = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    return empty if out is None else out
