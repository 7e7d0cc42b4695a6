import math
import random
import re
from collections import Counter

import numpy as np

from cartcast.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _truth(docs, items, best=10):
    """Every document scored for every item by the definition."""
    rows = [(i, Counter(t), len(t)) for i, t in ((i, _terms(t)) for i, t in docs) if t]
    n, words = len(rows), sum(r[2] for r in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for i, c, m in rows:
            m = 100 - 75 + (75 * m * n) // words
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in _terms(text) if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda r: (r[0], r[1], r[2] or 0))[:best])]
    return sorted(out, key=str)


def _corpus(n=600):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)] + ["Été", "naïve", "日本", "x́y"]
    weight = [1 / (k + 1) for k in range(len(words))]
    docs = [(k, rng.choice([" ", "\n", ". ", "_-"]).join(rng.choices(words, weight, k=rng.choice([1, 5, 30, 200])))) for k in range(n)]
    docs += [(n + k, docs[7][1]) for k in range(200)]          # a group of copies
    docs += [(5, "w399 w399 w399 again"), (5, "w399 w399 w399 again"), (None, "w399 W399 w399 again"), (None, None), (n + 300, ""), (n + 301, "...\x7f"), (n + 302, " ".join(["w1 w2 w390"] * 20000))]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 6, 20])))) for k in range(40)]
    items += [(90, docs[7][1]), (91, None), (92, ""), (93, "absent-from-all"), (94, "w399 again"), (94, "w399 again"), (94, "w1 W1 w1 w2"), (None, "W3 été ÉTÉ")]
    return docs, items


def _run(spark, docs, items, **kw):
    d = spark.createDataFrame([(t, i, "en", 7) for i, t in docs], "text string, doc_id long, item_id string, rank int").repartition(5)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return sorted(map(tuple, lexical.search(d, q, **kw).collect()), key=str)


def test_rankings_equal_a_full_scan(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 64)
    monkeypatch.setattr(lexical, "ITEMS", 16)                   # several blocks of items
    monkeypatch.setattr(lexical, "BROADCAST_ROWS", 20)          # the shuffled join
    docs, items = _corpus()
    got = _run(spark, docs, items)
    assert got == _truth(docs, [i for i in items if i[1] is not None])


def test_dense_signatures_give_the_same_rankings(spark, monkeypatch):
    monkeypatch.setattr(lexical, "KEY_BITS", 1)
    monkeypatch.setattr(lexical, "MOST_SLICES", 64)
    docs, items = _corpus(150)
    assert _run(spark, docs, items) == _truth(docs, [i for i in items if i[1] is not None])


def test_empty_tables(spark):
    docs, items = _corpus(20)
    assert _run(spark, [], items) == [] and _run(spark, docs, []) == []
    assert _run(spark, [(1, None), (2, "..")], items) == []


def test_bounds_hold_and_mostly_are_the_scores(spark):
    docs, items = _corpus(300)
    frame = spark.createDataFrame(docs, "doc_id long, text string").where("text is not null")
    blocks = lexical.index(frame).collect()
    n, words = sum(len(b.words) for b in blocks), sum(sum(b.words) for b in blocks)
    q = lexical.queries(frame, [t or "" for _, t in items], n, words)
    texts = {}
    for i, t in docs:
        texts.setdefault(i, []).append(t or "")
    close = total = 0
    for b in blocks:
        bound = q.bounds(b.asDict())
        for j, i in enumerate(b.ids):
            scores = [[q.score(Counter(lexical.terms(t)), len(lexical.terms(t)), k) for k in range(len(items))] for t in texts[i] if len(lexical.terms(t)) == b.words[j]]
            for k in range(len(items)):
                assert bound[k, j] >= min(s[k] for s in scores)
                close += any(s[k] >= 0.8 * bound[k, j] for s in scores)
                total += 1
    assert close > 0.95 * total


def test_terms_are_the_maximal_matches():
    rng = np.random.default_rng(1)
    for _ in range(200):
        text = "".join(chr(c) for c in rng.choice([*range(0, 0x180), 0x2028, 0x3000, 0x1F600], 60))
        assert [t.decode() for t in lexical.terms(text)] == _terms(text)
