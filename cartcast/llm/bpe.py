"""Operator 1: byte-level BPE encoding and decoding by prefix dynamic programming.

For every byte prefix of a piece exactly one token can be the last one of that
prefix's encoding.  ``PrefixTable`` keeps these last tokens: the encoding of any
prefix is read by walking back through them, appending bytes only extends the
table (earlier entries never change), and after an edit only the entries from
the first changed byte on are computed anew.  A candidate token is the valid
last one when it and the last token of the prefix before it are *stable side by
side*: undoing their merges in the order of the ranks never shows a pair across
the border that would have merged earlier.

Texts are first cut into pieces by the tokenizer's pattern; pieces are encoded
separately, as the ``tiktoken`` library does, and cached per Python worker in a
dictionary of bounded size.  Rows need no shuffle.  The tables built from the
rank file are bounded by its vocabulary; the file's bytes travel to the workers
as a broadcast variable.

Defined results: null and empty texts have no ids (``n_tokens`` 0, digests of
the empty string); repeated rows and ties are encoded row by row; very long
texts are read in blocks of pieces, so that memory is bounded by the text
itself; other columns are passed through, and a column that has an output's name
is an error (``ValueError``) instead of being overwritten; empty tables give
empty results.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Most pieces that a worker remembers before it starts its dictionary anew.
CACHE_PIECES = 250_000
#: Pairs of tokens whose verdict a worker remembers.
CACHE_PAIRS = 250_000
#: Pieces that are held at a time while a text is read.
BLOCK_PIECES = 100_000


class Vocabulary:
    """Ranks of a ``.tiktoken`` file and how each token was merged."""

    def __init__(self, raw: bytes, pattern: str):
        import regex

        compiled = regex.compile(pattern)
        self.find, self.find_all = compiled.finditer, compiled.findall
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}
        self.token = {i: b for b, i in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self.halves: dict[int, tuple[int, int] | None] = {}
        for i in sorted(self.token):
            if len(b := self.token[i]) == 1:
                self.halves[i] = None
            elif len(parts := self._merged(b, i)) == 2:
                self.halves[i] = (self.rank[parts[0]], self.rank[parts[1]])
        #: Tokens that merging their own bytes makes; no other can be in an encoding.
        self.usable = {self.token[i]: i for i in self.halves}
        self.pairs: dict[tuple[int, int], bool] = {}
        #: The ids of a piece as decimals joined by spaces.
        self.piece_text = _Pieces(self)

    def _merged(self, b: bytes, below: int) -> list[bytes]:
        """Parts of ``b`` after all merges of a rank below ``below``."""
        parts = [b[k:k + 1] for k in range(len(b))]
        while True:
            best, at = below, -1
            for k in range(len(parts) - 1):
                r = self.rank.get(parts[k] + parts[k + 1], below)
                if r < best:
                    best, at = r, k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def stable(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay apart when their bytes are merged."""
        x, y = left, right
        x_ends = y_ends = len(self.token) + 1  # rank at which x and y are merged within their own side
        verdict = True
        while True:
            joint = self.rank.get(self.token[x] + self.token[y])
            # on equal ranks the pair further left merges first
            if joint is not None and joint < x_ends and joint <= y_ends:
                verdict = False
                break
            hx, hy = self.halves[x], self.halves[y]
            if hx is None and hy is None:
                break
            # undo the later merge of both sides
            if hy is None or (hx is not None and x > y):
                x_ends, x = x, hx[1]
            else:
                y_ends, y = y, hy[0]
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[left, right] = verdict
        return verdict

    def piece(self, b: bytes) -> list[int]:
        if (whole := self.rank.get(b)) is not None:
            return [whole]
        if len(b) > 64:
            return PrefixTable(self, b).ids()
        return self._short(b)

    def _short(self, b: bytes) -> list[int]:
        """The same table for a short piece, filled from its end: only the prefixes that are asked for."""
        usable, known, stable = self.usable.get, self.pairs.get, self.stable
        last: dict[int, int] = {}

        def of(end: int) -> int:
            for start in range(end):
                t = usable(b[start:end])
                if t is not None:
                    if start:
                        left = last.get(start)
                        if left is None:
                            left = of(start)
                        ok = known((left, t))
                        if not (stable(left, t) if ok is None else ok):
                            continue
                    last[end] = t
                    return t
            raise ValueError("the vocabulary lacks a byte")

        out, at = [], len(b)
        while at:
            t = last.get(at)
            if t is None:
                t = of(at)
            out.append(t)
            at -= len(self.token[t])
        return out[::-1]

    def blocks(self, text: str):
        """Blocks of pieces of ``text``."""
        if len(text) <= BLOCK_PIECES:
            if text:
                yield self.find_all(text)
            return
        found = (m.group() for m in self.find(text))
        while block := list(islice(found, BLOCK_PIECES)):
            yield block

    def encode(self, text: str) -> list[int]:
        return [int(i) for block in self.blocks(text) for p in block for i in self.piece_text[p].split(" ")]

    def decode(self, ids) -> bytes:
        """Bytes of ``ids``; an unknown id is an error."""
        return b"".join([self.token[i] for i in ids])


class _Pieces(dict):
    """Remembers the ids of pieces; starts anew when it is full."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary

    def __missing__(self, piece: str) -> str:
        if len(self) >= CACHE_PIECES:
            self.clear()
        ids = " ".join(map(str, self.v.piece(piece.encode())))
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class PrefixTable:
    """Last token of each byte prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary, b: bytes = b""):
        self.v, self.bytes, self.last = vocabulary, b"", [-1]
        self.append(b)

    def append(self, more: bytes) -> None:
        """Exact: entries of shorter prefixes stay as they are."""
        b = self.bytes = self.bytes + more
        usable, stable, known, last = self.v.usable.get, self.v.stable, self.v.pairs.get, self.last
        longest = self.v.longest
        for end in range(len(last), len(b) + 1):
            for start in range(end - longest if end > longest else 0, end):
                t = usable(b[start:end])
                if t is not None and (start == 0 or ((ok := known((last[start], t))) is None and stable(last[start], t)) or ok):
                    last.append(t)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Bytes ``start`` to ``stop`` become ``new``; only entries after ``start`` are computed."""
        tail = self.bytes[stop:]
        self.bytes, self.last = self.bytes[:start], self.last[:start + 1]
        self.append(new + tail)

    def ids(self, end: int | None = None) -> list[int]:
        """Encoding of the first ``end`` bytes."""
        out, at = [], len(self.bytes) if end is None else end
        while at:
            out.append(self.last[at])
            at -= len(self.v.token[self.last[at]])
        return out[::-1]


#: How many characters past its end a piece may depend on: ``'`` alone, where ``'re`` was possible.
_LOOK_AHEAD = 2


class EncodedText:
    """A text's pieces and ids that follow edits by local work.

    A piece depends on few characters past its end, so pieces that end so far before an edit stay; after the edit, matching is taken
    up until a piece starts where an old one did, from where all pieces stay.
    """

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.v, self.text = vocabulary, text
        self.starts, self.pieces, _ = self._cut(0)

    def _cut(self, at: int, until: frozenset | set = frozenset()):
        starts, pieces = [], []
        for m in self.v.find(self.text, at):
            if m.start() in until:
                return starts, pieces, m.start()
            starts.append(m.start())
            pieces.append(self.v.piece(m.group().encode()))
        return starts, pieces, None

    def replace(self, start: int, stop: int, new: str) -> None:
        from bisect import bisect_right

        shift = len(new) - (stop - start)
        old_starts, old_pieces, old_len = self.starts, self.pieces, len(self.text)
        self.text = self.text[:start] + new + self.text[stop:]
        ends = [*old_starts[1:], old_len]
        n_keep = bisect_right(ends, start - _LOOK_AHEAD)  # pieces that saw nothing of the edit
        tail = bisect_right(old_starts, stop)
        later = {s + shift: k for k, s in enumerate(old_starts[tail:], tail)}
        at = old_starts[n_keep] if n_keep < len(old_starts) else ends[n_keep - 1] if n_keep else 0
        starts, pieces, met = self._cut(at, later.keys())
        k = len(old_starts) if met is None else later[met]
        self.starts = old_starts[:n_keep] + starts + [s + shift for s in old_starts[k:]]
        self.pieces = old_pieces[:n_keep] + pieces + old_pieces[k:]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def ids(self) -> list[int]:
        return [i for p in self.pieces for i in p]


_BUILT: dict[tuple[int, str], Vocabulary] = {}


def _vocabulary(raw: bytes, pattern: str) -> Vocabulary:
    key = (hash(raw), pattern)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Vocabulary(raw, pattern)
    return _BUILT[key]


def _raw(spark, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _by_row(df: DataFrame, out: list[T.StructField], work):
    """Appends columns made by ``work(list of one column's values) -> rows``."""
    import pyarrow as pa

    clash = {c.lower() for c in df.columns} & {f.name.lower() for f in out}
    if clash:
        raise ValueError(f"the table already has {sorted(clash)}")
    schema = T.StructType([*df.schema.fields, *out])
    arrow = [(f.name, pa.list_(pa.int32()) if isinstance(f.dataType, T.ArrayType) else
              {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in out]

    def run(batches):
        step = 512
        for whole in batches:
            for k in range(0, whole.num_rows, step):
                rb = whole.slice(k, step)
                made = work(rb)
                cols = [pa.array(v, kind) for v, (_, kind) in zip(made, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*rb.columns, *cols], names=[*rb.schema.names, *(n for n, _ in arrow)])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, pattern: str, col: str = "text", out: str = "ids") -> DataFrame:
    """Adds the ids of ``col`` as an array."""
    raw, at = _raw(df.sparkSession, path), df.columns.index(col)

    def work(rb):
        v = _vocabulary(raw.value, pattern)
        return [[v.encode(t or "") for t in rb.column(at).to_pylist()]]

    return _by_row(df, [T.StructField(out, T.ArrayType(T.IntegerType()))], work)


def decode(df: DataFrame, path: str, pattern: str, col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids in ``col`` stand for (null: empty)."""
    raw, at = _raw(df.sparkSession, path), df.columns.index(col)

    def work(rb):
        v = _vocabulary(raw.value, pattern)
        return [[v.decode(x or ()) for x in rb.column(at).to_pylist()]]

    return _by_row(df, [T.StructField(out, T.BinaryType())], work)


def token_digests(df: DataFrame, path: str, pattern: str, col: str = "text", ids: str | None = None) -> DataFrame:
    """Adds ``n_tokens``, the digest of the ids and the digest of the bytes
    decoded from those ids, block by block; with ``ids``, also the ids in a column of that name."""
    raw, at = _raw(df.sparkSession, path), df.columns.index(col)

    def one(v: Vocabulary, back: dict[str, bytes], text: str):
        digest, decoded, n, all_ids = hashlib.sha256(), hashlib.sha256(), 0, []
        for block in v.blocks(text):
            s = " ".join(map(v.piece_text.__getitem__, block))
            digest.update((" " + s if n else s).encode())
            each = s.split(" ")
            n += len(each)
            decoded.update(b"".join(map(back.__getitem__, each)))
            if ids:
                all_ids.extend(map(int, each))
        return n, digest.hexdigest(), decoded.hexdigest(), *([all_ids] if ids else [])

    def work(rb):
        v = _vocabulary(raw.value, pattern)
        back = v.__dict__.setdefault("back", {str(i): b for i, b in v.token.items()})
        rows = [one(v, back, t or "") for t in rb.column(at).to_pylist()]
        return list(zip(*rows, strict=True)) if rows else [[]] * (3 + bool(ids))

    return _by_row(df, [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
                        *([T.StructField(ids, T.ArrayType(T.IntegerType()))] if ids else [])], work)
