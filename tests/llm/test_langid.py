import random
import zlib

import numpy as np
import pytest

from cartcast.llm import langid

#: invented languages that share letters and differ in what follows what
SYLLABLES = {"aa": ["ba", "ko", "mi", "tu"], "bb": ["ab", "ok", "im", "ut"], "cc": ["bra", "klo", "mé", "tü"]}


def _text(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


def _rows(n=700):
    rng = random.Random(1)
    rows = []
    for k in range(n):
        lang = rng.choices(list(SYLLABLES), [6, 2, 1])[0]
        rows.append((k, _text(rng, lang, rng.choice([3, 20, 20, 100])), lang))
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(t, lang, i, 0.5, "x") for i, t, lang in rows], "text string, lang string, doc_id long, score double, read_ string")


def test_gradients_equal_differences():
    """Backpropagation through time against central differences, in double precision."""
    rng = np.random.default_rng(0)
    net = langid.Network.start(["a", "b", "c"], 3)
    for name in net.NAMES:
        setattr(net, name, getattr(net, name).astype(float) + 0.1 * rng.normal(size=getattr(net, name).shape))
    symbols = rng.integers(0, 6, (4, 7))
    symbols[2, 5:] = langid.PAD
    label, count = np.array([0, 2, 1, 1]), (np.arange(7)[:, None] < np.array([7, 7, 5, 7])[None, :]) * rng.random((7, 4))
    _, grads = net.gradients(symbols, label, count)
    for name in net.NAMES:
        values = getattr(net, name)
        places = [tuple(p) for p in np.argwhere(np.abs(grads[name]) > 1e-6)][:: max(1, int((np.abs(grads[name]) > 1e-6).sum()) // 25)]
        assert places
        for at in places:
            had = values[at]
            values[at] = had + 1e-6
            up, _ = net.gradients(symbols, label, count)
            values[at] = had - 1e-6
            down, _ = net.gradients(symbols, label, count)
            values[at] = had
            assert abs((up - down) / 2e-6 - grads[name][at]) < 1e-6, name


def _by_steps(net, raw):
    """One text, one position and one direction at a time."""
    soft = lambda v: v / (1 + np.abs(v))
    sig = lambda v: 0.5 + 0.5 * soft(v)
    h = net.turn.shape[1]
    total = np.zeros(len(net.languages))
    spans = [(max(0, min(a, len(raw) - langid.WINDOW)), a) for a in range(0, len(raw), langid.WINDOW)]
    for start, first in spans:
        piece = list(raw[start:start + langid.WINDOW])
        width = min(-(-len(piece) // 16) * 16, langid.WINDOW)
        piece += [langid.PAD] * (width - len(piece))
        states = np.zeros((2, width, h))
        for k in range(2):
            s = np.zeros(h)
            for t in range(width) if k == 0 else range(width - 1, -1, -1):
                x, g = net.table[k, piece[t]].astype(float), s @ net.turn[k].astype(float)
                z, r = sig(x[:h] + g[:h]), sig(x[h:2 * h] + g[h:2 * h])
                new = soft(x[2 * h:] + r * (g[2 * h:] + net.bias[k, 0]))
                s = z * s + (1 - z) * new
                states[k, t] = s
        for t in range(first - start, min(width, len(raw) - start)):
            e = np.concatenate([states[0, t], states[1, t]]) @ net.out.astype(float) + net.base
            e = np.exp(e - e.max())
            total += e / e.sum()
    return total / len(raw)


def test_documents_are_the_mean_over_all_positions():
    net = langid.Network.start(["a", "b", "c", "d"], 5, seed=3)
    rng = np.random.default_rng(2)
    raw = [bytes(rng.integers(0, 256, n, np.uint8)) for n in (1, 15, 16, 17, 95, 96, 97, 192, 1000)]
    got = langid.document_probabilities(net, raw)
    for text, p in zip(raw, got):
        assert np.abs(_by_steps(net, text) - p).max() < 1e-5


@pytest.fixture(scope="module")
def learned(spark):
    rows = _rows()
    return rows, langid.fit(_frame(spark, rows))


def test_held_out_accuracy(spark, learned):
    rows, net = learned
    out = langid.predictions(_frame(spark, rows), net).where(langid.held_out()).collect()
    assert {r.doc_id for r in out} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == r.lang for r in out]) >= 0.97 and all(0 <= r.score <= 1 for r in out)


def test_odd_texts(spark, learned):
    _, net = learned
    long = _text(random.Random(2), "cc", 60000)
    rows = [(1, None, "aa"), (2, "", "aa"), (3, "12 + 3 = ½ ...", None), (4, long, None), (4, long, None), (None, "Ba ko mi tu", "aa"), (6, "é", None)]
    out = langid.predictions(_frame(spark, rows), net)
    assert out.columns == ["text", "lang", "doc_id", "read_", "lang_pred", "score"]
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in out.collect()}
    assert [got[i, t] for i, t, _ in rows[:3]] == [("und", 0.0)] * 3
    assert got[4, long][0] == "cc" and got[None, "Ba ko mi tu"][0] == "aa" and got[6, "é"][0] in SYLLABLES
    assert out.count() == len(rows)


def test_nothing_to_learn(spark):
    rows = [(k, "ba ko", None) for k in range(20)]
    net = langid.fit(_frame(spark, rows))
    assert {(r.lang_pred, r.score) for r in langid.predictions(_frame(spark, rows), net).collect()} == {("und", 0.0)}
    assert langid.predictions(_frame(spark, []), net).collect() == []
    one = langid.fit(_frame(spark, [(k, "ba ko", "aa") for k in range(20)]))
    assert {(r.lang_pred, r.score) for r in langid.predictions(_frame(spark, rows), one).collect()} == {("aa", 1.0)}


def test_held_out_rows_labels_and_sources_teach_nothing(spark):
    rows = _rows(250)
    net = langid.fit(_frame(spark, rows))
    other = [(i, t, lang) if zlib.crc32(str(i).encode()) % 5 else (i, "ut " * 50, "aa") for i, t, lang in rows]
    again = langid.fit(_frame(spark, other).repartition(3))
    assert all(np.array_equal(getattr(net, k), getattr(again, k)) for k in net.NAMES)
