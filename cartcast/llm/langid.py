"""Operator 12: language identification by a bidirectional gated recurrent network over bytes.

One network reads a window's bytes from the left, another from the right; at every position both states give probabilities of
the languages, and a document's probabilities are the mean over all positions of all its windows.  Windows of
``WINDOW`` bytes cover the whole text (the last one reaches back to be full; positions that it repeats don't count
again).  What lies before a window doesn't reach its states: that bounds memory and lets windows run side by side.
The units are gated recurrent ones whose gates and new states bend by ``x / (1 + |x|)``: a third of the time of exponentials.

Training is in numpy, by backpropagation through all steps of a window, with Adam, until the loss on a
held-back tenth of the sampled documents no longer falls.  The sample has about ``DOCUMENTS`` rows a language and
``WINDOWS`` windows a row, drawn by hashes; that is its only bound, and all languages weigh the same.  Only rows whose
``crc32(doc_id as text) mod 5`` isn't 0 are learned from, only by their text and language.

Defined results: ``und`` with score 0 if a text is null or has no letter, or if no row teaches a language; among equal
probabilities the smaller name wins; a null id is no training row, but is scored; repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartcast.llm.common import fresh

UNDETERMINED = "und"
STATES = 16
WINDOW = 96
DOCUMENTS = 500
WINDOWS = 3
AT_ONCE = 2048          # windows that run side by side
LEARN = 256             # windows of a training step
EPOCHS, PATIENCE = 60, 3
PAD = 256               # the symbol beside a text that is shorter than its window


def held_out(col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(5)) == 0


def _soft(x, room):
    """In place ``x / (1 + |x|)``, which saturates as the hyperbolic tangent does and needs no exponential; ``room`` is as large."""
    import numpy as np

    np.abs(x, out=room)
    room += 1
    np.divide(x, room, out=x)
    return x


@dataclass
class Network:
    """``table``: what each symbol adds to the gates (update, reset, new); ``turn``: what the state adds; ``bias`` of the
    new state's own part; all with a line a direction.  ``out`` and ``base`` give a position's language."""

    languages: list
    table: object
    turn: object
    bias: object
    out: object
    base: object

    NAMES = ("table", "turn", "bias", "out", "base")

    @staticmethod
    def start(languages: list, states: int, seed: int = 12) -> "Network":
        import numpy as np

        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
        return Network(languages, draw(2, PAD + 1, 3 * states, scale=0.3), draw(2, states, 3 * states, scale=states**-0.5),
                       np.zeros((2, 1, states), np.float32), draw(2 * states, len(languages), scale=states**-0.5), np.zeros(len(languages), np.float32))

    def run(self, symbols):
        """Probabilities of the languages at every position, (position, language, window).  All arrays have a line a
        feature and are made once: a step only fills them."""
        import numpy as np

        (n, steps), h = symbols.shape, self.turn.shape[1]
        table, turn = (np.ascontiguousarray(v.transpose(0, 2, 1)) for v in (self.table, self.turn))
        bias = self.bias.transpose(0, 2, 1)
        line = np.ascontiguousarray(symbols.T)
        out = np.empty((steps, 2 * h, n), table.dtype)
        state = np.zeros((2, h, n), table.dtype)
        x, g, room = (np.empty((2, 3 * h, n), table.dtype) for _ in range(3))
        gates, z, r, own, new, wide, part = g[:, :2 * h], g[:, :h], g[:, h:2 * h], g[:, 2 * h:], x[:, 2 * h:], room[:, :2 * h], room[:, 2 * h:]
        for t in range(steps):
            np.take(table[0], line[t], axis=1, out=x[0], mode="clip")
            np.take(table[1], line[steps - 1 - t], axis=1, out=x[1], mode="clip")
            np.matmul(turn, state, out=g)
            gates += x[:, :2 * h]
            _soft(gates, wide)
            gates *= 0.5
            gates += 0.5
            own += bias
            own *= r
            new += own
            _soft(new, part)
            state -= new
            state *= z
            state += new
            out[t, :h] = state[0]
            out[steps - 1 - t, h:] = state[1]
        p = np.matmul(self.out.T, out)
        p += self.base[:, None]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def _kept_run(self, symbols):
        """States at every position (position, window, both states), and what backpropagation needs."""
        import numpy as np

        (n, steps), h = symbols.shape, self.turn.shape[1]
        both = np.stack([symbols.T, symbols.T[::-1]])                # direction, step, window
        out = np.empty((steps, n, 2 * h), self.table.dtype)
        state = np.zeros((2, n, h), self.table.dtype)
        soft = lambda v: _soft(v, np.empty_like(v))
        kept = []
        for t in range(steps):
            x = np.stack([self.table[k][both[k, t]] for k in range(2)])
            g = state @ self.turn
            gates = 0.5 + 0.5 * soft(x[..., :2 * h] + g[..., :2 * h])
            z, r = gates[..., :h], gates[..., h:]
            own = g[..., 2 * h:] + self.bias
            new = soft(x[..., 2 * h:] + r * own)
            before, state = state, z * (state - new) + new
            out[t, :, :h] = state[0]
            out[steps - 1 - t, :, h:] = state[1]
            kept.append((before, z, r, own, new))
        return out, both, kept

    def gradients(self, symbols, label, count):
        """Mean loss over the counted positions (``count``: position, window) and its gradients, by backpropagation through time."""
        import numpy as np

        states, both, kept = self._kept_run(symbols)
        steps, n, h = len(states), len(symbols), self.turn.shape[1]
        p = states @ self.out + self.base
        p = np.exp(p - p.max(axis=-1, keepdims=True))
        p /= p.sum(axis=-1, keepdims=True)
        total = max(float(count.sum()), 1.0)
        loss = -float((np.log(np.maximum(p[:, np.arange(n), label], 1e-30)) * count).sum()) / total
        dp = p
        dp[:, np.arange(n), label] -= 1
        dp *= (count / total)[:, :, None].astype(p.dtype)
        flat = dp.reshape(-1, dp.shape[-1])
        out, base = states.reshape(-1, 2 * h).T @ flat, flat.sum(axis=0)
        above = dp @ self.out.T
        back = np.zeros((2, n, h), p.dtype)
        turn, bias = np.zeros_like(self.turn), np.zeros_like(self.bias)
        into = np.empty((2, steps, n, 3 * h), p.dtype)
        for t in range(steps - 1, -1, -1):
            before, z, r, own, new = kept[t]
            back[0] += above[t, :, :h]
            back[1] += above[steps - 1 - t, :, h:]
            slope = lambda v: (1 - np.abs(v)) ** 2
            d_new = back * (1 - z) * slope(new)
            d_own = d_new * r
            d = np.concatenate([back * (before - new) * 0.5 * slope(2 * z - 1), d_new * own * 0.5 * slope(2 * r - 1), d_own], axis=-1)
            into[:, t] = d
            into[:, t, :, 2 * h:] = d_new
            turn += before.transpose(0, 2, 1) @ d
            bias += d_own.sum(axis=1, keepdims=True)
            back = back * z + d @ self.turn.transpose(0, 2, 1)
        table = np.zeros_like(self.table)
        for k in range(2):
            symbol, rows = both[k].reshape(-1), into[k].reshape(-1, 3 * h)
            order = np.argsort(symbol, kind="stable")
            first = np.flatnonzero(np.diff(symbol[order], prepend=-1))
            table[k, symbol[order][first]] = np.add.reduceat(rows[order], first, axis=0)
        return loss, dict(zip(self.NAMES, (table, turn, bias, out, base)))


def windows(raw: list[bytes], width: int):
    """Windows of all texts: symbols, the text of each, and the first position that counts (those before were counted in the window before)."""
    import numpy as np

    sizes = np.array([len(t) for t in raw], np.int64)
    parts = -(-sizes // width)
    text = np.repeat(np.arange(len(raw)), parts)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    size = sizes[text]
    start = np.maximum(np.minimum(nth * width, size - width), 0)
    data = np.frombuffer(b"".join(raw) + bytes(width), np.uint8)
    begin = (np.cumsum(sizes) - sizes)[text] + start
    return data, begin, np.minimum(size, width), nth * width - start, text


def _symbols(data, begin, length, width: int):
    import numpy as np

    place = np.arange(width)
    out = data[begin[:, None] + place].astype(np.int64)
    out[place[None, :] >= length[:, None]] = PAD
    return out


def document_probabilities(net: Network, raw: list[bytes], width: int = WINDOW):
    """Mean probabilities over all positions of each (non-empty) text."""
    import numpy as np

    data, begin, length, skip, text = windows(raw, width)
    total = np.zeros((len(raw), len(net.languages)))
    steps = np.minimum(-(-length // 16) * 16, width)       # short texts need no full windows
    for size in np.unique(steps).tolist():
        of = np.flatnonzero(steps == size)
        for a in range(0, len(of), AT_ONCE):
            at = of[a:a + AT_ONCE]
            p = net.run(_symbols(data, begin[at], length[at], size))
            place = np.arange(size)[:, None]
            p *= ((place >= skip[at]) & (place < length[at]))[:, None, :]
            np.add.at(total, text[at], p.sum(axis=0).T)
    return total / np.array([max(len(t), 1) for t in raw])[:, None]


def train(examples: list[tuple[int, bytes, str]], states: int = STATES, seed: int = 12) -> Network:
    """A network for (document number, window, language) triples; every tenth document is held back to end the training."""
    import numpy as np

    languages = sorted({e[2] for e in examples})
    place = {name: k for k, name in enumerate(languages)}
    net = Network.start(languages, states, seed)
    if len(languages) < 2:
        return net
    data, begin, length, _, _ = windows([e[1][:WINDOW] for e in examples], WINDOW)
    symbols = _symbols(data, begin, length, WINDOW)
    label = np.array([place[e[2]] for e in examples])
    count = np.arange(WINDOW)[:, None] < length[None, :]
    back = np.array([e[0] % 10 == 0 for e in examples])
    if not back.any() or back.all():
        back = np.arange(len(examples)) % 10 == 0
    use, check = np.flatnonzero(~back), np.flatnonzero(back)
    share = np.bincount(label[use], minlength=len(languages)).astype(float)
    weight = (share.sum() / np.maximum(share, 1) / len(languages))[label]
    rng = np.random.default_rng(seed)
    slow = {k: np.zeros_like(getattr(net, k)) for k in net.NAMES}
    fast = {k: np.zeros_like(getattr(net, k)) for k in net.NAMES}
    best, waited, step = None, 0, 0
    for _ in range(EPOCHS):
        order = rng.permutation(use)
        for a in range(0, len(order), LEARN):
            at = order[a:a + LEARN]
            _, grads = net.gradients(symbols[at], label[at], count[:, at] * weight[at])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            for k, g in grads.items():
                g *= min(1.0, 1.0 / max(norm, 1e-12))
                slow[k] += 0.1 * (g - slow[k])
                fast[k] += 0.01 * (g * g - fast[k])
                change = 0.01 * (slow[k] / (1 - 0.9**step)) / (np.sqrt(fast[k] / (1 - 0.99**step)) + 1e-8)
                setattr(net, k, (getattr(net, k) - change).astype(np.float32))
        loss = 0.0
        for a in range(0, len(check), AT_ONCE):
            at = check[a:a + AT_ONCE]
            # what counts for a document: the pooled probability of its language
            pooled = (net.run(symbols[at]) * count[:, None, at]).sum(axis=0).T / length[at, None]
            loss -= float(np.log(np.maximum(pooled[np.arange(len(at)), label[at]], 1e-12)).sum())
        if best is None or loss < best[0] * 0.995:
            best, waited = (loss, {k: getattr(net, k) for k in net.NAMES}), 0
        else:
            waited += 1
            if waited == PATIENCE:
                break
    return Network(languages, **best[1])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network:
    """A network learned from a sample of the rows that aren't held out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("doc_id is not null and lang is not null").where(~held_out()).where(F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("draw", F.xxhash64("doc_id", "text"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return train([])
    most = 2**62
    part = F.create_map(*[v for name, n in sizes.items() for v in (F.lit(name), F.lit(int(min(1.0, DOCUMENTS / n) * most)))])
    width, at_most = WINDOW, WINDOWS

    def read(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            draws, pieces, names = [], [], []
            for draw, text, lang in zip(*(b.column(k).to_pylist() for k in range(3))):
                raw = text.encode()
                spots = max(1, -(-len(raw) // width))
                for k in np.random.default_rng(draw % 2**32).choice(spots, min(spots, at_most), replace=False).tolist():
                    start = max(0, min(k * width, len(raw) - width))
                    draws.append(draw)
                    pieces.append(raw[start:start + width])
                    names.append(lang)
            yield pa.RecordBatch.from_arrays([pa.array(draws, pa.int64()), pa.array(pieces, pa.binary()), pa.array(names, pa.string())], names=["draw", "piece", "lang"])

    sample = rows.where(F.pmod("draw", F.lit(most)) < part[F.col("lang")]).select("draw", "text", "lang")
    found = sample.mapInArrow(read, "draw long, piece binary, lang string").collect()
    examples = sorted((r.draw, bytes(r.piece), r.lang) for r in found)
    number = {d: k for k, d in enumerate(sorted({e[0] for e in examples}))}
    return train([(number[d], p, lang) for d, p, lang in examples])


def predictions(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the document's probability of that language."""
    from pyspark.sql.pandas.types import to_arrow_schema

    read_col, = fresh(docs, "read_")
    left = [c for c in docs.columns if c not in ("lang_pred", "score")]
    frame = docs.select(*left, F.when(F.col(text_col).cast("string").rlike(r"\p{L}"), F.col(text_col).cast("string")).alias(read_col))
    schema = frame.drop(read_col).withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0)}).schema
    arrow = to_arrow_schema(schema)

    def read(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            names, scores = [UNDETERMINED] * b.num_rows, np.zeros(b.num_rows)
            texts = b.column(b.num_columns - 1)
            has = [k for k in range(b.num_rows) if texts[k].is_valid] if net.languages else []
            if has:
                p = document_probabilities(net, [texts[k].as_buffer().to_pybytes() for k in has]).round(6)
                for k, i, s in zip(has, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                    names[k], scores[k] = net.languages[i], min(s, 1.0)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(b.num_columns - 1)), pa.array(names, pa.string()), pa.array(scores)], schema=arrow)

    return frame.mapInArrow(read, schema)
