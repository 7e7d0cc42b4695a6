"""Operator 5: a hidden Markov language model, trained by Baum-Welch over Spark.

Tokens are the words of a whole text in ASCII lower case, then one end.  Every word of the
training documents, however rare, has emissions of its own, as have the end and the class of all unknown words;
0.1 is added to each count: so the model is a distribution over all texts.

Texts are read once and written as blocks of about ``BLOCK`` tokens: the distinct words of the block (64-bit hashes), the commonest first,
and each text as places in them.  The emission table is a Spark table that grows with the vocabulary: one row
for each bucket, a range of hashes; where a block's words are in their buckets is looked up once.  In each round, blocks ask the buckets for the emissions of their words, tasks
run the scaled forward and backward recursions over a block's texts (windows of ``WINDOW`` tokens;
a document's later windows start from their own distribution), and the expected counts go back to the buckets
and are added there.  Only starts, moves, the end and sums by state come to the driver.

Scoring: the scaled forward recursion over the whole text, exactly, many texts side by side.  A common word is asked
for once by a block, so no key is hot.

Defined results: null and empty texts are one end token; a null id is the empty text in the hash;
repeated rows count and score each; without training documents every probability is that of the unknown;
extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartcast.llm.common import cleaned, kept, text_or_empty
from cartcast.llm.words import mix, word_hashes
from cartcast.session import checkpoint_dir

STATES = 8
FREQUENT = 32_768       # words in a bucket of the emission table, about; results don't depend on it
ROUNDS = 5
WINDOW = 512
BLOCK = 1 << 20         # tokens in a block
ASKED = 8               # blocks that ask for a word, about
PARTS = 16
PASSES = 3              # over parts of the blocks in a round: emissions of one part are under way at a time
PRIOR = 30.0            # tokens of the overall distribution that each state starts with
TOKENS_AT_ONCE = 400_000
EMISSIONS = 1 << 16     # tokens whose emissions are laid out at a time in scoring
END = 0                 # place of the end in every block; words follow


def held_out(col: str = "doc_id"):
    """Rows never learnt from: crc32 of the id as text, mod 10, is 0."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _planes(tokens) -> bytes:
    """All lowest bytes, then all second ones and so on: the high ones are mostly 0 and take no disk."""
    import numpy as np

    return tokens.view(np.uint8).reshape(-1, 4).T.tobytes()


def _tokens(planes):
    import numpy as np

    return np.ascontiguousarray(np.frombuffer(planes.as_buffer(), np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def _short(x):
    """The upper halves of single-precision numbers, rounded: training's messages need no more digits."""
    import numpy as np

    return ((np.ascontiguousarray(x, np.float32).view(np.uint32) + np.uint32(0x8000)) >> np.uint32(16)).astype(np.uint16)


def _long(raw):
    import numpy as np

    return (np.frombuffer(raw, np.uint16).astype(np.uint32) << np.uint32(16)).view(np.float32)


def _distinct(h):
    """Distinct values in order, the place of each entry's value and how often each occurs: numpy's ``unique``, but only the
    distinct values are sorted."""
    import numpy as np
    import pyarrow as pa

    coded = pa.array(h).dictionary_encode()
    places, values = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    order = np.argsort(values)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return values[order], rank[places], np.bincount(places, minlength=len(order))[order]


def _blocks(texts: DataFrame) -> DataFrame:
    """(turn, block, train, doc_id, held_out, tokens, words, counts, ranks): a row for each text with its tokens, places
    in the words of its block, the end last; and a row for each block (tokens null) with its
    distinct words, the commonest first, their counts, and the places of the words by their hashes.  All blocks of
    a file have the same ``turn``, the pass they are in, so that a pass leaves out the other files."""
    import pyarrow as pa

    names = ["turn", "block", "train", "doc_id", "held_out", "tokens", "words", "counts", "ranks"]

    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        first, made = TaskContext.get().partitionId() << 32, 0
        held: dict = {True: [], False: []}  # (ids, held out, hashes, lengths) of slices of texts
        size = {True: 0, False: 0}

        def rows(train):
            words, at, c = _distinct(np.concatenate([x[1] for x in held[train]]))
            order = np.argsort(-c, kind="stable")
            words, c, rank = words[order], c[order], np.argsort(order).astype(np.uint32)
            lengths = np.concatenate([x[2] for x in held[train]])
            ids = pa.concat_arrays([x[0] for x in held[train]])
            held[train].clear()
            size[train] = 0
            stops = np.cumsum(lengths)
            t = np.insert(rank[at] + np.uint32(1), stops, np.uint32(END))
            ends = stops + np.arange(1, len(stops) + 1)
            out = [_planes(t[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            n, none = len(out), [None] * len(out)
            return pa.RecordBatch.from_arrays([
                pa.array([(first >> 32) % PASSES] * (n + 1), pa.int32()), pa.array([first + made] * (n + 1), pa.int64()), pa.array([train] * (n + 1)), pa.concat_arrays([ids, pa.nulls(1, pa.int64())]),
                pa.array([not train] * (n + 1)), pa.array([*out, None], pa.binary()),
                pa.array([*none, words.tobytes()], pa.binary()), pa.array([*none, c.astype(np.int64).tobytes()], pa.binary()),
                pa.array([*none, np.argsort(words.view(np.uint64)).astype(np.uint32).tobytes()], pa.binary())], names=names)

        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                rb = whole.slice(at, 512)
                h, stops = word_hashes(rb.column(2).to_pylist())
                lengths = np.diff(stops, prepend=0)
                out = rb.column(1).to_numpy(zero_copy_only=False).astype(bool)
                of = np.repeat(out, lengths)
                for train in (True, False):
                    pick = out != train
                    if pick.any():
                        held[train].append((rb.column(0).filter(pa.array(pick)), h[of != train], lengths[pick]))
                        size[train] += int(lengths[pick].sum()) + int(pick.sum())
                        if size[train] >= BLOCK:
                            yield rows(train)
                            made += 1
        for train in (True, False):
            if held[train]:
                yield rows(train)
                made += 1

    return texts.mapInArrow(run, "turn int, block long, train boolean, doc_id long, held_out boolean, tokens binary, words binary, counts binary, ranks binary")


def word_counts(blocks: DataFrame) -> DataFrame:
    """(h, c): how often each word occurs in blocks of training texts."""
    import pyarrow as pa

    def run(batches):
        import numpy as np

        for rb in batches:
            for w, c in zip(rb.column(0), rb.column(1), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_buffer(), np.int64)) for x in (w, c)], names=["h", "c"])

    return blocks.where("words is not null").select("words", "counts").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _noise(h, states: int):
    """Normal draws of each word and state: a function of the word's hash only."""
    import numpy as np

    k = np.arange(1, states + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    u, v = (((mix((h[:, None] + k[None, :]) ^ np.uint64(seed)) >> np.uint64(11)).astype(float) + 0.5) / 2.0**53 for seed in (11, 0xA5A5))
    return np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)


def _by_bucket(counts: DataFrame, bits: int) -> DataFrame:
    """(bucket, words, counts): the vocabulary, one row a bucket, words in order."""
    import numpy as np
    import pyarrow as pa

    def run(group):
        h, c = (group.column(x).to_numpy() for x in ("h", "c"))
        order = np.argsort(h.view(np.uint64))
        return pa.table([group.column("bucket").slice(0, 1), *(pa.array([x[order].tobytes()], pa.binary()) for x in (h, c))], names=["bucket", "words", "counts"])

    return counts.select(F.shiftrightunsigned("h", 64 - bits).cast("int").alias("bucket"), "h", "c").groupBy("bucket").applyInArrow(run, "bucket int, words binary, counts binary")


BUCKET = "bucket int, counts binary, emit binary, sums array<double>"


def _bucket_row(bucket, counts, emit, sums):
    import numpy as np
    import pyarrow as pa

    raw = [pa.array([x.tobytes()], pa.binary()) for x in (counts, emit.astype(np.float32))]
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *raw, pa.array([np.asarray(sums, float).ravel().tolist()], pa.list_(pa.float64()))], names=["bucket", "counts", "emit", "sums"])


def _first_table(vocabulary: DataFrame, states: int) -> DataFrame:
    """The emission table before the first round, not divided by its ``sums``: one row a bucket."""
    import numpy as np

    def run(batches):
        for rb in batches:
            for bucket, w, c in zip(rb.column(0).to_pylist(), rb.column(1), rb.column(2), strict=True):
                c = np.frombuffer(c.as_buffer(), np.int64)
                emit = (c + 0.1)[:, None] * np.exp(_noise(np.frombuffer(w.as_buffer(), np.uint64), states))
                yield _bucket_row(bucket, c, emit, emit.sum(axis=0))

    return vocabulary.select("bucket", "words", "counts").mapInArrow(run, BUCKET)


def _places(blocks: DataFrame, vocabulary: DataFrame, bits: int) -> DataFrame:
    """(bucket, block, train, at): where a block's words, in order of their hashes, are in their buckets; -1 for unknown words."""
    import numpy as np
    import pyarrow as pa

    form = "bucket int, block long, train boolean, words binary"

    def cut(batches):
        for rb in batches:
            for block, train, w in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), rb.column(2), strict=True):
                h = np.sort(np.frombuffer(w.as_buffer(), np.uint64))
                own, first = np.unique(h >> np.uint64(64 - bits), return_index=True)
                stops = [*first.tolist(), len(h)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(own.astype(np.int32)), pa.array([block] * len(own), pa.int64()), pa.array([train] * len(own), pa.bool_()),
                    pa.array([h[a:b].tobytes() for a, b in zip(stops[:-1], stops[1:], strict=True)], pa.binary())], names=["bucket", "block", "train", "words"])

    def run(left, right):
        own = np.frombuffer(left.column("words")[0].as_buffer(), np.uint64) if left.num_rows else np.zeros(0, np.uint64)
        out = []
        for w in right.column("words"):
            h = np.frombuffer(w.as_buffer(), np.uint64)
            at = np.searchsorted(own, h)
            here = own[np.minimum(at, len(own) - 1)] == h if len(own) else np.zeros(len(h), bool)
            out.append(np.where(here, at, -1).astype(np.int32).tobytes())
        return right.drop_columns(["words"]).append_column("at", pa.array(out, pa.binary()))

    asked = blocks.where("words is not null").select("block", "train", "words").mapInArrow(cut, form)
    return vocabulary.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(run, "bucket int, block long, train boolean, at binary")


def _answers(table: DataFrame, places: DataFrame, states: int, with_counts: bool) -> DataFrame:
    """(block, bucket, at, emit, counts): the emissions of a block's words in a bucket; unknown words have 0.
    For scoring with the words' counts and all digits, for training in short."""
    import numpy as np
    import pyarrow as pa

    def run(left, right):
        c, emit = np.zeros(0, np.int64), np.zeros((0, states), np.float32)
        if left.num_rows:
            c = np.frombuffer(left.column("counts")[0].as_buffer(), np.int64)
            emit = np.frombuffer(left.column("emit")[0].as_buffer(), np.float32).reshape(-1, states)
        c, emit = np.append(c, 0), np.concatenate([emit, np.zeros((1, states), np.float32)])  # for -1
        ats = [np.frombuffer(x.as_buffer(), np.int32) for x in right.column("at")]
        return pa.table({
            "block": right.column("block"), "bucket": right.column("bucket"), "at": right.column("at"), "emit": pa.array([(emit[at] if with_counts else _short(emit[at])).tobytes() for at in ats], pa.binary()),
            "counts": pa.array([c[at].tobytes() if with_counts else None for at in ats], pa.binary())})

    form = "block long, bucket int, at binary, emit binary, counts binary"
    return table.where("bucket >= 0").groupBy("bucket").cogroup(places.groupBy("bucket")).applyInArrow(run, form)


def _block_model(model, ranks, answers, short: bool):
    """(parameters, order, answers in order): parameters over the places of a block, the end and then its words;
    ``order`` has the places of its words by their hashes, as the answers are."""
    import numpy as np

    start, move, end, unknown, sums = model
    order = next((np.frombuffer(r.as_buffer(), np.uint32) for r in ranks if r.is_valid), np.zeros(0, np.uint32)).astype(np.int64)
    answers = answers.take(np.argsort(answers.column("bucket").to_numpy()))
    at = np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(x.as_buffer(), np.int32) for x in answers.column("at"))])
    read = _long if short else lambda raw: np.frombuffer(raw, np.float32)
    e = np.concatenate([np.zeros((0, len(sums)), np.float32), *(read(x.as_buffer()).reshape(-1, len(sums)) for x in answers.column("emit"))])
    e = e / sums
    e[at < 0] = unknown / sums
    emit = np.empty((len(order) + 1, len(sums)), np.float32)
    emit[END], emit[1 + order] = end / sums, e
    return Parameters(start, move, emit).packed(), order, answers


@dataclass
class Parameters:
    """``start``: rows for a text's first window and for later ones."""

    start: object      # 2 x states
    move: object       # states x states
    emit: object       # classes x states

    def packed(self) -> Parameters:
        import numpy as np

        return Parameters(*(np.ascontiguousarray(x, np.float32) for x in (self.start, self.move, self.emit)))


def first_guess(states: int):
    """States that stay: (start, move)."""
    import numpy as np

    stay = 0.9 if states > 1 else 1.0
    move = np.full((states, states), (1 - stay) / max(states - 1, 1))
    np.fill_diagonal(move, stay)
    return np.full((2, states), 1 / states), move


def _side_by_side(sequences):
    """Sequences by falling length: their order, all first tokens, then all second ones and so on, how many sequences are
    still running at each step, and where the steps start.  Arrays have a row for each state, so that a step's work is on long rows."""
    import numpy as np

    order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
    lengths = np.array([len(sequences[k]) for k in order])
    running = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")
    starts = np.concatenate([[0], np.cumsum(running)])
    tokens = np.empty(starts[-1], np.uint32)
    step = np.arange(starts[-1]) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    tokens[starts[step] + np.repeat(np.arange(len(lengths)), lengths)] = np.concatenate([sequences[k] for k in order])
    return order, tokens, running.tolist(), starts.tolist()


def _steps(starts, size: int):
    """(first, last + 1) of runs of steps with about ``size`` tokens."""
    at = 0
    while at < len(starts) - 1:
        to = at + 1
        while to < len(starts) - 1 and starts[to + 1] - starts[at] <= size:
            to += 1
        yield at, to
        at = to


def _scale(a):
    """Sum over the states, in pairs as numpy adds a row of eight."""
    import numpy as np

    if len(a) != 8:
        return a.sum(axis=0)
    b = a[0::2] + a[1::2]
    c = b[0::2] + b[1::2]
    return np.add(c[0], c[1])


def log_likelihoods(sequences, p: Parameters):
    """Natural log of each sequence's probability, by the scaled forward recursion."""
    import numpy as np

    order, tokens, running, starts = _side_by_side(sequences)
    total = np.zeros(len(order))
    turn, of_state = np.ascontiguousarray(p.move.T), np.ascontiguousarray(p.emit.T)
    a = None
    for first, stop in _steps(starts, EMISSIONS):
        base = starts[first]
        emit = of_state.take(tokens[base:starts[stop]], axis=1)
        scale = np.empty(emit.shape[1], emit.dtype)
        for t in range(first, stop):
            n, low = running[t], starts[t] - base
            a = (p.start[0][:, None] if a is None else turn @ a[:, :n]) * emit[:, low:low + n]
            s = _scale(a)
            a /= s
            scale[low:low + n] = s
        np.log(scale, out=scale)
        for t in range(first, stop):
            low = starts[t] - base
            total[:running[t]] += scale[low:low + running[t]]
    out = np.empty(len(order))
    out[order] = total
    return out


def expected_counts(windows, later, p: Parameters):
    """Sums of expected starts, moves and emissions over ``windows``; ``later`` marks
    windows that don't begin a text."""
    import numpy as np

    order, tokens, running, starts = _side_by_side(windows)
    states, classes = p.move.shape[0], p.emit.shape[0]
    kind = np.asarray(later, int)[order]
    turn = np.ascontiguousarray(p.move.T)
    emit = np.ascontiguousarray(p.emit.T).take(tokens, axis=1)  # state by state: a state's emissions stay in the cache
    alpha = np.empty((states, len(tokens)), np.float32)
    scale = np.empty(len(tokens), np.float32)
    a = None
    for t, n in enumerate(running):
        at = slice(starts[t], starts[t] + n)
        a = (p.start[kind].T if a is None else turn @ a[:, :n]) * emit[:, at]
        s = _scale(a)
        a /= s
        alpha[:, at], scale[at] = a, s
    move = np.zeros((states, states))
    beta = np.ones((states, len(order)), np.float32)
    gamma = alpha  # becomes alpha * beta; the last step's beta is 1
    for t in range(len(running) - 1, 0, -1):
        n = running[t]
        at, before = slice(starts[t], starts[t] + n), slice(starts[t - 1], starts[t - 1] + n)
        after = emit[:, at] * beta[:, :n]
        after /= scale[at]
        move += (alpha[:, before] @ after.T) * p.move
        back = p.move @ after
        gamma[:, before] *= back
        beta[:, :n] = back
    start = np.zeros((2, states))
    for k in (0, 1):
        start[k] = gamma[:, :len(order)][:, kind == k].sum(axis=1, dtype=float)
    return start, move, np.array([np.bincount(tokens, gamma[z], classes) for z in range(states)]).T


def _round(blocks: DataFrame, table: DataFrame, places: DataFrame, model, total: float, so_far: DataFrame | None) -> DataFrame:
    """``so_far`` and what one round over these training blocks adds to it: the next emission table, and in rows of
    negative buckets the sums of starts, moves and ends."""
    import numpy as np
    import pyarrow as pa

    states = len(model[4])
    sent = blocks.sparkSession.sparkContext.broadcast(model)

    def learn(left, right):
        p, order, right = _block_model(sent.value, left.column("ranks"), right, True)
        start, move, emit = np.zeros((2, states)), np.zeros((states, states)), np.zeros(p.emit.shape[::-1]).T
        windows, later, n = [], [], 0

        def flush():
            for whole, part in zip((start, move, emit), expected_counts(windows, later, p), strict=True):
                whole += part
            windows.clear()
            later.clear()

        for x in left.column("tokens"):
            if x.is_valid:
                c = _tokens(x)
                for at in range(0, len(c), WINDOW):
                    windows.append(c[at:at + WINDOW])
                    later.append(at > 0)
                    n += len(windows[-1])
                if n >= TOKENS_AT_ONCE:
                    flush()
                    n = 0
        if windows:
            flush()
        stops = np.cumsum([0, *(len(x.as_buffer()) // 4 for x in right.column("at"))]).tolist()
        emit = np.ascontiguousarray(emit)
        own = _short(emit[1 + order])
        small = np.concatenate([start.ravel(), move.ravel(), emit[END]])
        return pa.table({
            "bucket": pa.array([*right.column("bucket").to_pylist(), -1 - left.column("block")[0].as_py() % PARTS], pa.int32()),
            "at": pa.array([*right.column("at").to_pylist(), b""], pa.binary()),
            "emit": pa.array([*(own[a:b].tobytes() for a, b in zip(stops[:-1], stops[1:], strict=True)), small.tobytes()], pa.binary())})

    def add(left, right):
        bucket = (left if left.num_rows else right).column("bucket")[0].as_py()
        if bucket < 0:
            none = np.zeros(0, np.int64)
            return pa.table([*_bucket_row(bucket, none, none, sum((np.frombuffer(x.as_buffer(), float) for x in right.column("emit")), np.array(left.column("sums")[0].as_py()) if left.num_rows else 0.0)).columns], names=names)
        c = np.frombuffer(left.column("counts")[0].as_buffer(), np.int64)
        before = left.column("emit")[0]
        emit = np.frombuffer(before.as_buffer(), np.float32).reshape(-1, states).astype(float) if before.is_valid else np.repeat((PRIOR * (c + 0.1) / total)[:, None], states, axis=1)
        for at, g in zip(right.column("at"), right.column("emit"), strict=True):  # a block's words are distinct
            emit[np.frombuffer(at.as_buffer(), np.int32)] += _long(g.as_buffer()).reshape(-1, states)
        return pa.table([*_bucket_row(bucket, c, emit, emit.sum(axis=0)).columns], names=names)

    names = ["bucket", "counts", "emit", "sums"]
    answers = _answers(table, places, states, False)
    learnt = blocks.select("block", "tokens", "ranks").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(learn, "bucket int, at binary, emit binary")
    old = table.where("bucket >= 0").select("bucket", "counts", F.lit(None).cast("binary").alias("emit"), F.lit(None).cast("array<double>").alias("sums")) if so_far is None else so_far
    return old.groupBy("bucket").cogroup(learnt.groupBy("bucket")).applyInArrow(add, BUCKET)


def scores(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.  ``frequent`` only sizes the buckets."""
    import numpy as np
    import pyarrow as pa

    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_or_empty().alias("text"))
    blocks = kept(_blocks(texts), "hmm-blocks")
    train = blocks.where("train")
    size = train.agg(F.count("tokens").alias("docs"), F.coalesce(F.sum(F.length("tokens") / 4), F.lit(0)).cast("long").alias("n"), F.coalesce(F.sum(F.length("words") / 8), F.lit(0)).cast("long").alias("asks")).first()
    n_docs, n = size["docs"], size["n"]
    bits = max(6, int(size["asks"] / (ASKED * frequent)).bit_length())
    vocabulary = kept(_by_bucket(word_counts(train), bits), "hmm-words")
    v_words = vocabulary.agg(F.coalesce(F.sum(F.length("words") / 8), F.lit(0)).cast("long")).first()[0]
    total = n + 0.1 * (v_words + 2)
    places = kept(_places(blocks, vocabulary, bits), "hmm-places")

    place = f"{checkpoint_dir(spark)}/hmm-emissions-{uuid.uuid4().hex}"

    def turned(df, k):
        """Three folders in turn hold the table and the next one as it grows, so that they take their disk thrice and not once a pass."""
        with cleaned(spark):
            df.write.mode("overwrite").parquet(f"{place}-{k}")
        return spark.read.schema(df.schema).parquet(f"{place}-{k}")

    def of_pass(df, g):
        return df.where(F.col("turn") == g) if "turn" in df.columns else df.where(F.shiftright("block", 32) % PASSES == g)

    def summed(df):
        rows = [r["sums"] for r in df.select(F.posexplode("sums").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).orderBy("k").agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias("sums")).collect()]
        return np.array([r["x"] for r in rows[0]]) if rows and rows[0] else None

    start, move = first_guess(states)
    end, unknown = np.array([n_docs + 0.1, 0.1])[:, None] * np.exp(_noise(np.array([1, 2], np.uint64), states))
    table = turned(_first_table(vocabulary, states), 0)
    words = summed(table)
    model = (start, move, end, unknown, end + unknown + (0 if words is None else words))
    asked = places.where("train")
    at = 0
    for _ in range(rounds if n_docs else 0):
        grown, free = None, [k for k in range(3) if k != at]
        for g in range(PASSES):
            grown = turned(_round(of_pass(train, g), table, of_pass(asked, g), model, total, grown), free[g % 2])
        table, at = grown, free[(PASSES - 1) % 2]
        small = summed(table.where("bucket < 0"))
        start, move, end = small[:2 * states].reshape(2, states) + 1.0 / states, small[2 * states:-states].reshape(states, states) + 1.0 / states, small[-states:]
        words = summed(table.where("bucket >= 0"))
        end, unknown = end + PRIOR * (n_docs + 0.1) / total, np.full(states, PRIOR * 0.1 / total)
        model = (start / start.sum(axis=1, keepdims=True), move / move.sum(axis=1, keepdims=True), end, unknown, end + unknown + (0 if words is None else words))
    sent = spark.sparkContext.broadcast(model)

    def forward(left, right):
        p, order, right = _block_model(sent.value, left.column("ranks"), right, False)
        c = np.full(len(p.emit), n_docs)
        c[1 + order] = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x.as_buffer(), np.int64) for x in right.column("counts"))])
        seen, logs = c > 0, np.log10(c + 0.1) - np.log10(total if n_docs else 0.1)
        rows = left.filter(left.column("tokens").is_valid())
        sequences = [_tokens(x) for x in rows.column("tokens")]
        got, at = [np.zeros(0)], 0
        while at < len(sequences):
            to, size = at, 0
            while to < len(sequences) and (to == at or size + len(sequences[to]) <= 4 * TOKENS_AT_ONCE):
                size += len(sequences[to])
                to += 1
            got.append(log_likelihoods(sequences[at:to], p) / np.log(10))
            at = to
        return pa.table({
            "doc_id": rows.column("doc_id"), "held_out": rows.column("held_out"), "n_tokens": pa.array([len(s) for s in sequences], pa.int64()),
            "n_known": pa.array([int(seen[s].sum()) for s in sequences], pa.int64()), "train_tokens": pa.array([n] * len(sequences), pa.int64()),
            "base_score": pa.array([float(logs[s].sum()) for s in sequences], pa.float64()), "score": pa.array(np.concatenate(got))})

    form = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = None
    for g in range(PASSES):
        answers = _answers(table, of_pass(places, g), states, True)
        scored = of_pass(blocks, g).select("block", "doc_id", "held_out", "tokens", "ranks").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(forward, form)
        scored = kept(scored, "hmm-scores")
        out = scored if out is None else out.unionByName(scored)
    return out
