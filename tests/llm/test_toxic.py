import random

import numpy as np
from pyspark.sql import functions as F

from cartcast.llm import toxic


def brute_kernel(a, b):
    """Gap-weighted common subsequences of three characters, by all index triples."""
    def vec(w):
        w, out = "\x02" + w + "\x03", {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, len(w)):
                    if k - i - 2 <= toxic.GAP:
                        out[w[i] + w[j] + w[k]] = out.get(w[i] + w[j] + w[k], 0) + toxic.DECAY ** (k - i + 1)
        return out
    x, y = vec(a), vec(b)
    norm = lambda v: sum(t * t for t in v.values()) ** 0.5
    return sum(t * y.get(u, 0) for u, t in x.items()) / norm(x) / norm(y)


def test_kernel_and_folded_function():
    words = ["idiot", "idxiot", "aa", "a", "aaaa", "moron", "éèê", "x" * 30]
    v = toxic._vectors(words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert abs(sum(t * v[j].get(u, 0) for u, t in v[i].items()) - brute_kernel(a, b)) < 1e-9
    beta = [0.7, -0.2, 0.4]
    g = {}
    for w, d in zip(beta, v):
        for u, t in d.items():
            g[u] = g.get(u, 0) + w * t
    folded = toxic.Folded(g, -0.3)
    want = [max(toxic.FLOOR, sum(w * brute_kernel(words[j], x) for j, w in enumerate(beta)) - 0.3) for x in words]
    assert np.allclose(folded.margins(words), want)


def _folded(floor):
    g = {}
    for w, d in zip([3.0, 2.0, -1.0], toxic._vectors(["idiot", "moron", "lane"])):
        for u, t in d.items():
            g[u] = g.get(u, 0) + w * t
    return toxic.Folded(g, 0.0, floor)


def test_units_far_from_toxic_cost_short_columns_only(monkeypatch):
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefghimnorté", k=rnd.randint(1, 30))) for _ in range(300)] + ["idiot", "idi", "mor.on", "moron" * 6, "id", "lane"]
    exact = np.maximum(0.3, _folded(-1000.0).margins(words))  # no unit is that far
    full, features = [], toxic._features
    monkeypatch.setattr(toxic, "_features", lambda batch: full.extend(batch) or features(batch))
    assert np.array_equal(_folded(0.3).margins(words), exact) and (exact > 0.3).sum() >= 4
    assert len(full) < len(words) / 2 and {w for w, v in zip(words, exact) if v > 0.3} <= set(full)


def test_remembered_units_are_those_of_each_text():
    folded, memory = _folded(0.3), toxic.Memory()
    long = "idiot" + "x" * 24 + "-" + "moron" * 5  # its first part ends in a mark, which no word keeps
    texts = [long, long[:30], "idiot", "IDIOT! idiot", "«moron»,", "i d i o t", "lane a idi", "", None, "-", "idiot" * 9, long[:30] + " a!"]
    assert any(u.endswith("-") for u in toxic.units(long))
    for _ in range(2):
        for t in texts:
            us = sorted(toxic.units(t or ""))
            want = sorted(((f, u) for f, u in zip(folded.margins(us).tolist(), us) if f > 0.3), reverse=True)[:toxic.TOP]
            assert toxic._top_units([t], folded, memory) == [want]


def test_units():
    assert toxic.units("You, IDIOT! i d i o t a b") == {"you", "idiot", "idiotab"}
    assert toxic.units("i d i o t you") == {"idiot", "you"} and toxic.units(" \n") == set()
    long = toxic.units("ab" * 100)
    assert all(len(u) <= toxic.WIDTH - 2 for u in long) and len(long) >= 1


def _corpus(rnd, n=1500):
    clean = ["".join(rnd.choices("aeioulnrst", k=rnd.randint(2, 8))) for _ in range(400)]
    bad = ["vexgork", "plimzat", "droffquix"]
    rows, labels = [], []
    for i in range(n):
        w = rnd.choices(clean, k=rnd.randint(1, 60))
        y = i % 6 == 0
        if y:
            b = rnd.choice(bad)
            if rnd.random() < 0.2:
                k = rnd.randrange(1, len(b))
                b = b[:k] + rnd.choice("xz.") + b[k:]
            w.insert(rnd.randrange(len(w) + 1), b)
        rows.append((i, " ".join(w), "en"))
        labels.append((i, int(y)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark):
    rnd = random.Random(3)
    rows, labels = _corpus(rnd)
    odd = [(5001, None, "x"), (5002, "", "x"), (None, "vexgork", "x"), (5003, "v.exgork here", "x"), (5004, "p l i m z a t", "x"), (5005, "lane " * 30_000 + "droffquix", "x")]
    docs = spark.createDataFrame(rows + odd + [rows[1]], "doc_id long, text string, margin string")
    lab = spark.createDataFrame([*labels, (6, 1), (9999, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxic.fit(docs.select("doc_id", "text"), lab)
    out = {r.doc_id: r for r in toxic.scores(docs, model, keep=["doc_id"]).withColumn("held", toxic.held_out()).collect()}
    held = [(out[i].predicted, y) for i, y in labels if out[i].held]
    assert len(held) > 200 and sum(p == y for p, y in held) >= 0.98 * len(held)
    assert out[5001].predicted == 0 and out[5002].predicted == 0 and 0 <= out[5001].score <= 1
    assert [out[i].predicted for i in (None, 5003, 5004, 5005)] == [1, 1, 1, 1]


def test_labels_of_held_out_rows_are_not_read(spark):
    rows, labels = _corpus(random.Random(4), 600)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").drop("lang")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    other = lab.withColumn("toxic", F.when(toxic.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    got = [sorted((r.doc_id, r.score) for r in toxic.scores(docs, toxic.fit(docs, x), keep=["doc_id"]).collect()) for x in (lab, other)]
    assert np.allclose([s for _, s in got[0]], [s for _, s in got[1]])


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxic.scores(docs, toxic.fit(docs, none)).collect()] == [0.0, 0.0]
    assert toxic.scores(docs.limit(0), toxic.fit(docs, none)).count() == 0


def test_phrases_of_harmless_words(spark):
    """Toxic exactly when both words of a phrase occur; clean texts hold either alone."""
    rnd = random.Random(8)
    clean = ["".join(rnd.choices("aeioulnrst", k=rnd.randint(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(2000):
        w = rnd.choices(clean, k=rnd.randint(5, 60))
        y, other = i % 6 == 0, rnd.random()
        more = ["drop", "dead"] if y else ["drop"] if other < 0.3 else ["dead"] if other < 0.6 else []
        at = rnd.randrange(len(w) + 1)
        w[at:at] = more
        rows.append((i, " ".join(w)))
        labels.append((i, int(y)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxic.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    out = toxic.scores(docs, model, keep=["doc_id"]).where(toxic.held_out()).collect()
    y = dict(labels)
    caught = [r.predicted for r in out if y[r.doc_id]]
    left = [1 - r.predicted for r in out if not y[r.doc_id]]
    assert len(caught) > 40 and sum(caught) >= 0.9 * len(caught) and sum(left) >= 0.95 * len(left)
