"""Operator 8: toxicity by a subsequence string kernel, Nystroem landmarks and a
linear support vector machine over labelled sentences.

Units are white-space words in lower case without punctuation at their ends
(words of over 30 characters in overlapping parts; runs of single letters also
joined, so ``i d i o t`` is a unit).  The kernel compares two units by their
common subsequences of three characters that leave out at most ``GAP``
characters, each worth ``DECAY`` to the power of the length it spans, divided by
the units' norms; ``\x02`` and ``\x03`` mark both ends.  Gaps let ``id.iot`` or
``idxiot`` resemble ``idiot``.

Fitting: a bounded sample of labelled texts (about ``max_toxic`` and ``max_clean`` at most, by a
hash of the id) is what the machine learns from: every text of it is one row.  Landmarks are the
``LANDMARKS`` units that tell most about the label and a hash sample of others.  In Nystroem coordinates a text is the
sum of its ``TOP`` units of highest value, so that a phrase of words which are harmless alone counts as the sum of both; which
units these are follows from the machine itself, so selection and fit (squared hinge, Newton steps) take turns until the
selection no longer changes the decisions, ``ROUNDS`` times at most, from a start that tells the landmarks' words apart.  The round whose rows are
told apart best is kept.  A logistic curve fitted on the sample turns margin into a score.

Scoring: the fitted function is linear in the subsequences, so the landmarks
fold into one weight per subsequence, which gives exactly the same values.  Each
task scores the distinct units of its rows in numpy blocks; rows don't move.
Units below ``LEAST`` add nothing.

Defined results: null and empty texts have margin 0 and a score all the
same; a null id counts as the empty text in the hash; null labels and labels of
unknown documents are ignored, repeated labels of a document count by their
maximum; without a toxic and a clean training row, or without units that tell them apart, all
scores are 0; repeated rows get equal scores; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import compress

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartcast.llm.common import kept

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~–—…«»“”¿¡"
#: A unit tells about the label if its counts are e**EVIDENCE times likelier under its own rate than
#: under the rate of all documents: chance alone makes about one in a million.
EVIDENCE = 12.0
DECAY = 0.7
GAP = 3
WIDTH = 32          # characters of a unit with its marks
FLOOR = -0.5
LEAST = 0.3         # value from which a unit counts; one insult alone is worth about 2
TOP = 4             # units of a text that count
ROUNDS = 4
LANDMARKS, OTHER_LANDMARKS = 400, 100
RANK = 256          # coordinates kept, of the largest eigenvalues
STARTERS = 3000     # hash sample of clean units for the first guess
_SEEN = 150_000     # units that a task remembers
_OFFSETS = [(a, b) for a in range(GAP + 1) for b in range(GAP + 1 - a)]


def _words(text: str) -> set[str]:
    """The distinct words of a text as they stand, and its runs of single letters joined."""
    words = text.lower().split()
    single = bytes(map((1).__eq__, map(len, words)))
    out = set(words).difference(compress(words, single))
    at = single.find(b"\1\1\1")
    while at >= 0:
        end = single.find(b"\0", at)
        end = len(single) if end < 0 else end
        _add("".join(words[at:end]), out)
        at = single.find(b"\1\1\1", end)
    return out


def _units_of(words) -> set[str]:
    clean = {w.strip(PUNCTUATION) for w in words}
    clean.discard("")
    for w in [w for w in clean if len(w) > WIDTH - 2]:
        clean.remove(w)
        _add(w, clean)
    return clean


def units(text: str) -> set[str]:
    return _units_of(_words(text))


def _add(w: str, out: set[str]) -> None:
    most = WIDTH - 2
    if len(w) <= most:
        if w:
            out.add(w)
    else:
        out.update(w[k:k + most] for k in range(0, len(w) - most // 2, most // 2))


def _features(batch: list[str]):
    """Codes (0: none) and weights of the subsequences of each unit; rows are units."""
    import numpy as np

    marked = np.array(["\x02" + w + "\x03" for w in batch], dtype=f"U{WIDTH}")
    c = marked.view(np.uint32).reshape(len(batch), WIDTH).astype(np.uint64)
    codes, weights = [], []
    for a, b in _OFFSETS:
        span = 3 + a + b
        x, y, z = c[:, :WIDTH - span + 1], c[:, 1 + a:WIDTH - span + 2 + a], c[:, span - 1:]
        codes.append(np.where(z > 0, (x << np.uint64(42)) | (y << np.uint64(21)) | z, 0))
        weights.append(np.full(WIDTH - span + 1, DECAY ** span))
    return np.concatenate(codes, axis=1), np.concatenate(weights)


def _norms(codes, weights):
    """Lengths of the units' feature vectors: weights of equal codes add up first."""
    import numpy as np

    order = np.argsort(codes, axis=1, kind="stable")
    s = np.take_along_axis(codes, order, axis=1)
    w = np.where(s > 0, weights[order], 0.0)
    total = np.cumsum(w, axis=1)
    last = np.ones(s.shape, bool)
    last[:, :-1] = s[:, 1:] != s[:, :-1]
    rows, cols = np.nonzero(last)
    at = total[rows, cols]
    first = np.r_[True, rows[1:] != rows[:-1]]
    group = np.where(first, at, at - np.r_[0.0, at[:-1]])
    return np.sqrt(np.bincount(rows, group * group, minlength=len(codes)))


def _vectors(batch: list[str]) -> list[dict[int, float]]:
    """Normalised explicit feature vectors, for the landmarks."""
    codes, weights = _features(batch)
    norms = _norms(codes, weights)
    out = []
    for row, n in zip(codes, norms, strict=True):
        d: dict[int, float] = {}
        for code, w in zip(row.tolist(), weights.tolist(), strict=True):
            if code:
                d[code] = d.get(code, 0.0) + w
        out.append({k: v / n for k, v in d.items()} if n else {})
    return out


class Folded:
    """A linear function of subsequences: one weight per code, looked up densely."""

    def __init__(self, weights: dict[int, float], bias: float, floor: float = FLOOR):
        import numpy as np

        self.floor = floor
        letters = sorted({(k >> s) & 0x1FFFFF for k in weights for s in (42, 21, 0)})
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[letters] = np.arange(1, len(letters) + 1)
        self.n = len(letters) + 1
        self.sparse = self.n > 160
        self.bias = bias
        if self.sparse:  # a very large alphabet: sorted codes instead of a dense cube
            self.codes = np.array(sorted(weights), np.uint64)
            self.table = np.array([weights[k] for k in sorted(weights)])
            return
        self.table = np.zeros(self.n ** 3)
        for k, v in weights.items():
            a, b, c = (int(self.letter[(k >> s) & 0x1FFFFF]) for s in (42, 21, 0))
            self.table[(a * self.n + b) * self.n + c] = v

    def weight_of(self, codes):
        import numpy as np

        if self.sparse:
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            return np.where(self.codes[at] == codes, self.table[at], 0.0)
        mask = np.uint64(0x1FFFFF)
        a, b, c = (self.letter[((codes >> np.uint64(s)) & mask).astype(np.int32)] for s in (42, 21, 0))
        return self.table[(a * self.n + b) * self.n + c]

    def _near(self, batch: list[str]):
        """Places of the units whose value can be above the floor: their sums in columns as short as the units are, over a
        norm that is at most theirs."""
        import numpy as np

        sizes = np.fromiter(map(len, batch), np.int64, len(batch))
        if self.sparse or self.bias >= self.floor:
            return np.flatnonzero(sizes > 0)
        order, near = np.argsort(sizes, kind="stable"), []
        for k in range(0, len(batch), 4096):
            at = order[k:k + 4096]
            width = min(int(sizes[at[-1]]) + 2, WIDTH)
            c = np.array(["\x02" + batch[i] + "\x03" for i in at], dtype=f"U{width}").view(np.uint32).reshape(len(at), width)
            place = self.letter[c]
            first, second = place * (self.n * self.n), place * self.n
            total, square = np.zeros(len(at)), np.zeros(len(at))
            long = np.minimum(sizes[at] + 2, WIDTH)
            for a, b in _OFFSETS:
                span = 3 + a + b
                if span <= width:
                    end = width - span + 1
                    total += DECAY ** span * self.table[first[:, :end] + second[:, 1 + a:end + 1 + a] + place[:, span - 1:]].sum(axis=1)
                    square += DECAY ** (2 * span) * np.maximum(long - span + 1, 0)  # equal codes only make it longer
            near.append(at[total > (self.floor - self.bias) * np.sqrt(square) - 1e-6])
        return np.sort(np.concatenate(near)) if near else np.zeros(0, np.int64)

    def margins(self, batch: list[str]):
        """Value of each unit, not below the floor."""
        import numpy as np

        out = np.full(len(batch), self.floor)
        near = self._near(batch)
        for k in range(0, len(near), 2048):
            at = near[k:k + 2048]
            codes, weights = _features([batch[i] for i in at])
            total, norms = (self.weight_of(codes) * weights).sum(axis=1), _norms(codes, weights)
            out[at] = np.maximum(self.floor, total / np.where(norms > 0, norms, 1.0) + self.bias)
        return out


def _svm(z, y, cost, c: float = 10.0):
    """Squared hinge by Newton steps; the last coordinate of ``z`` is the bias.  Rows go in blocks: ``z`` is the only large array."""
    import numpy as np

    w = np.zeros(z.shape[1])
    active = np.ones(len(y), bool)
    for _ in range(50):
        square, right = np.eye(z.shape[1]), np.zeros(z.shape[1])
        for at in range(0, len(y), 2048):
            use = at + np.flatnonzero(active[at:at + 2048])
            part = z[use].astype(float)
            heavy = part * (2 * c * cost[use])[:, None]
            square += heavy.T @ part
            right += heavy.T @ y[use]
        w, was, active = np.linalg.solve(square, right), active, None
        active = y * (z @ w) < 1
        if (was == active).all():
            break
    return w


class Coordinates:
    """Nystroem coordinates: what the landmarks' kernel matrix makes of a unit's kernel values with them.  Each subsequence
    knows the few landmarks that have it; only the landmarks and the root of their matrix are sent to tasks."""

    def __init__(self, landmarks: list[str], root=None):
        import numpy as np

        self.landmarks, self.root = landmarks, root
        self.having: dict[int, tuple[list[int], list[float]]] = {}
        for j, d in enumerate(_vectors(landmarks)):
            for code, v in d.items():
                rows, values = self.having.setdefault(code, ([], []))
                rows.append(j)
                values.append(v)
        if root is None:
            gram = np.zeros((len(landmarks), len(landmarks)))
            for rows, values in self.having.values():
                gram[np.ix_(rows, rows)] += np.outer(values, values)
            value, vector = np.linalg.eigh(gram)
            good = np.flatnonzero(value > 1e-6 * value.max())[-RANK:]   # rising values
            self.root = vector[:, good] / np.sqrt(value[good])

    def __reduce__(self):
        return Coordinates, (self.landmarks, self.root)

    def of(self, batch: list[str]):
        import numpy as np

        kernel = np.zeros((len(batch), len(self.landmarks)))
        for i, d in enumerate(_vectors(batch) if batch else []):
            line = [0.0] * len(self.landmarks)
            for code, v in d.items():
                if (hit := self.having.get(code)) is not None:
                    for j, x in zip(*hit):
                        line[j] += v * x
            kernel[i] = line
        return kernel @ self.root

    def folded(self, w) -> Folded:
        """The function whose value at a unit is the product of its coordinates with ``w``."""
        part = (self.root @ w).tolist()
        g = {code: sum(part[j] * x for j, x in zip(rows, values)) for code, (rows, values) in self.having.items()}
        return Folded({k: v for k, v in g.items() if abs(v) > 1e-9}, 0.0, LEAST)


@dataclass
class Model:
    folded: Folded | None
    slope: float = 0.0
    shift: float = 0.0

    def score(self, margin: float) -> float:
        import math

        if self.folded is None:
            return 0.0
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, self.slope * margin + self.shift))))


class Memory:
    """What a task remembers of units: those that are far from toxic and the values of the others.  Units that
    can't stand as words, as marks would be taken off their ends, are apart."""

    def __init__(self):
        self.far: set[str] = set()
        self.near: dict[str, float] = {}
        self.cut: dict[str, float] = {}

    def learn(self, words: set[str], folded: Folded) -> None:
        new = list(_units_of(words - self.far - self.near.keys()) - self.far - self.near.keys() - self.cut.keys())
        for u, f in zip(new, folded.margins(new).tolist(), strict=True):
            if u.strip(PUNCTUATION) != u:
                self.cut[u] = f
            elif f > folded.floor:
                self.near[u] = f
            else:
                self.far.add(u)

    def hits(self, words: set[str], folded: Folded) -> set[tuple[float, str]]:
        """(value, unit) of the units above the floor."""
        own = self.near.keys() & words
        found = {(self.near[u], u) for u in own}
        for u in _units_of(words - self.far - own):
            f = self.near.get(u)
            if f is None:
                f = self.cut.get(u, folded.floor)
            if f > folded.floor:
                found.add((f, u))
        return found

    def bounded(self) -> None:
        if len(self.far) + len(self.near) + len(self.cut) > _SEEN:
            for some in (self.far, self.near, self.cut):
                some.clear()


def _top_units(texts, folded: Folded, memory: Memory):
    """The (value, unit) of each text's ``TOP`` units above the floor, highest first; ties by the unit."""
    import heapq

    each = [_words(t or "") for t in texts]
    memory.learn(set().union(*each), folded)
    out = [heapq.nlargest(TOP, memory.hits(ws, folded)) for ws in each]
    memory.bounded()
    return out


def _document_margins(texts, folded: Folded, memory: Memory):
    return [sum(f for f, _ in top) for top in _top_units(texts, folded, memory)]


def margins(df: DataFrame, folded: Folded, col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``margin`` of each row."""
    import pyarrow as pa

    if "margin" in {c.lower() for c in keep}:
        raise ValueError("the table already has a column margin")
    src = df.select(*[F.col(c) for c in keep], F.col(col).alias("unit_text"))
    sent = df.sparkSession.sparkContext.broadcast(folded)
    schema = src.drop("unit_text").withColumn("margin", F.lit(0.0)).schema

    def run(batches):
        memory = Memory()
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                rb = whole.slice(k, 256)
                got = _document_margins(rb.column(len(keep)).to_pylist(), sent.value, memory)
                yield pa.RecordBatch.from_arrays([*rb.columns[:-1], pa.array(got, pa.float64())], names=[*keep, "margin"])

    return src.mapInArrow(run, schema)


def _unit_counts(sample: DataFrame) -> DataFrame:
    import pyarrow as pa

    def run(batches):
        for rb in batches:
            toxic, texts = rb.column(0).to_pylist(), rb.column(1).to_pylist()
            for k in range(0, len(texts), 256):
                counts: dict[str, list[int]] = {}
                for y, t in zip(toxic[k:k + 256], texts[k:k + 256], strict=True):
                    for u in units(t or ""):
                        counts.setdefault(u, [0, 0])[y] += 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(list(counts), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()),
                    pa.array([c[0] for c in counts.values()], pa.int64())], names=["unit", "n_toxic", "n_clean"])

    rows = sample.select("toxic", "text").mapInArrow(run, "unit string, n_toxic long, n_clean long")
    return rows.groupBy("unit").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))


def training_rows(docs: DataFrame, labels: DataFrame, max_toxic: int, max_clean: int) -> DataFrame:
    """Texts and labels of the training part, about so many of each class at most."""
    marked = (labels.where("doc_id is not null and toxic is not null and toxic in (0, 1)")
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    marked = marked.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, max_toxic / max(sizes.get(1, 0), 1))).otherwise(min(1.0, max_clean / max(sizes.get(0, 0), 1)))
    picked = marked.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 11) < share * 2**53)
    # about max_toxic + max_clean ids
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("toxic", "text")


def _sentence_rows(sample: DataFrame, coordinates: Coordinates, folded: Folded):
    """Labels and coordinates of the sample's texts: the sums of their top units'.  As many as the sample has."""
    from zlib import crc32

    import numpy as np

    sent = sample.sparkSession.sparkContext.broadcast((coordinates, folded))

    def run(batches):
        import pyarrow as pa

        where, f = sent.value
        memory = Memory()
        for rb in batches:
            tops = _top_units(rb.column(1).to_pylist(), f, memory)
            used = sorted({u for top in tops for _, u in top})
            place = {u: k for k, u in enumerate(used)}
            z = where.of(used)
            rows = [z[[place[u] for _, u in top]].sum(axis=0).astype(np.float32).tobytes() if top else None for top in tops]
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(rows, pa.binary())], names=["toxic", "row"])

    rows = sample.select("toxic", "text").mapInArrow(run, "toxic int, row binary").toArrow()
    dims = coordinates.root.shape[1]
    z = np.zeros((rows.num_rows, dims + 1), np.float32)
    z[:, dims] = 1.0
    for k, r in enumerate(rows.column("row")):
        if r.is_valid:
            z[k, :dims] = np.frombuffer(r.as_buffer(), np.float32)
    y = np.where(np.asarray(rows.column("toxic")) == 1, 1.0, -1.0)
    order = np.argsort([crc32(r.tobytes()) for r in np.c_[z, y.astype(np.float32)]], kind="stable")  # rows come in any order
    return z[order], y[order]


def _told_apart(z, y, w) -> float:
    """Mean squared hinge loss, both classes alike."""
    import numpy as np

    loss = np.maximum(0, 1 - y * (z @ w)) ** 2
    return float(loss[y > 0].mean() + loss[y < 0].mean())


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = 4000, max_clean: int = 12000) -> Model:
    import numpy as np

    sample = kept(training_rows(docs, labels, max_toxic, max_clean), "toxic-sample")
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Model(None)
    counts = kept(_unit_counts(sample), "toxic-units")
    rate = (F.col("n_toxic") / n[1]) / ((F.col("n_clean") + 0.5) / n[0])
    both, share = F.col("n_toxic") + F.col("n_clean"), n[1] / (n[0] + n[1])
    evidence = F.col("n_toxic") * F.log(F.greatest(F.col("n_toxic"), F.lit(1)) / both / share) + F.col("n_clean") * F.log(
        F.greatest(F.col("n_clean"), F.lit(1)) / both / (1 - share))
    telling = counts.where((rate > 1.5) & (evidence >= EVIDENCE)).orderBy(evidence.desc(), "unit").limit(LANDMARKS)
    positive = telling.select("unit", F.log(rate).alias("pull")).collect()
    if not positive:
        return Model(None)
    # a unit counts as clean where toxic documents don't have it more often
    other = counts.where((F.col("n_clean") > 0) & (rate < 1.5))
    negative = [r["unit"] for r in other.orderBy(F.xxhash64("unit"), "unit").limit(STARTERS).collect()]
    coordinates = Coordinates([r["unit"] for r in positive] + negative[:OTHER_LANDMARKS])
    # the first guess: words by how much commoner they are in toxic texts
    z = np.hstack([coordinates.of([r["unit"] for r in positive] + negative), np.ones((len(positive) + len(negative), 1))])
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    pull = np.array([r["pull"] for r in positive])
    w = _svm(z, y, np.r_[pull / pull.max(), np.ones(len(negative))])[:-1]
    best, before = None, None
    z, y = _sentence_rows(sample, coordinates, coordinates.folded(w))
    for _ in range(ROUNDS):
        w = _svm(z, y, np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum())))
        # told apart as scoring will: with the units that the new function itself picks
        z, y = _sentence_rows(sample, coordinates, coordinates.folded(w[:-1]))
        loss = _told_apart(z, y, w)
        if best is None or loss < best[0]:
            best = (loss, w)
        decided = int((z @ w > 0).sum()), round(loss, 6)
        if decided == before:
            break
        before = decided
    folded = coordinates.folded(best[1][:-1])
    rows = margins(sample, folded, "text", ["toxic"]).select("toxic", "margin").toArrow()
    slope, shift = _logistic(np.asarray(rows.column("margin")), np.asarray(rows.column("toxic"), float))
    return Model(folded, slope, shift)


def _logistic(x, y):
    """Slope and shift by Newton steps that never raise the loss; the wanted probabilities stay off 0 and 1 as
    if each class had one more row of either kind, so that rows told apart fully have an optimum too."""
    import numpy as np

    z, w = np.c_[x, np.ones(len(x))], np.zeros(2)
    goal = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))

    def loss(w):
        f = z @ w
        return float((np.logaddexp(0, f) - goal * f).sum())

    now = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-9 * np.eye(2), z.T @ (goal - p))
        while (then := loss(w + step)) > now and abs(step).max() > 1e-12:
            step = step / 2
        w, gain, now = w + step, now - then, then
        if gain < 1e-9 * max(1.0, abs(now)):
            break
    return float(w[0]), float(w[1])


def scores(df: DataFrame, model: Model, col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all), ``score`` and ``predicted`` of each row."""
    keep = keep or df.columns
    if clash := {"score", "predicted"} & {c.lower() for c in keep}:
        raise ValueError(f"the table already has {sorted(clash)}")
    if model.folded is None:
        out = df.select(*keep).withColumn("score", F.lit(0.0))
    else:
        score = 1.0 / (1.0 + F.exp(-(F.col("margin") * model.slope + model.shift)))
        out = margins(df, model.folded, col, keep).withColumn("score", score).drop("margin")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(col: str = "doc_id"):
    """Rows whose label is never learnt: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % 5 == 0
