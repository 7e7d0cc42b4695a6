import math
import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np

from cartcast.llm import hmm


def _paths(seq, p, kind=0):
    """Probability, and expected counts, by summing over all state paths."""
    k = p.move.shape[0]
    total, start, move, emit = 0.0, np.zeros((2, k)), np.zeros((k, k)), np.zeros(p.emit.shape)
    for z in product(range(k), repeat=len(seq)):
        w = p.start[kind][z[0]] * math.prod(p.emit[c, s] for c, s in zip(seq, z)) * math.prod(p.move[a, b] for a, b in zip(z, z[1:]))
        total += w
        start[kind, z[0]] += w
        for a, b in zip(z, z[1:]):
            move[a, b] += w
        for c, s in zip(seq, z):
            emit[c, s] += w
    return total, start / total, move / total, emit / total


def test_recursions_by_paths():
    rng = np.random.default_rng(0)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    p = hmm.Parameters(norm(rng.random((2, 3)), 1), norm(rng.random((3, 3)), 1), norm(rng.random((5, 3)), 0))
    seqs = [np.array(rng.integers(0, 5, n), np.uint16) for n in (1, 4, 6, 2, 1, 5)]
    later = [False, True, False, False, True, True]
    assert np.allclose(np.exp(hmm.log_likelihoods(seqs, p)), [_paths(s, p)[0] for s in seqs])
    got = hmm.expected_counts(seqs, later, p)
    want = [_paths(s, p, int(x)) for s, x in zip(seqs, later)]
    for k in range(3):
        assert np.allclose(got[k], sum(w[k + 1] for w in want), rtol=1e-4, atol=1e-5)


def _texts(rnd):
    a, b = [f"a{k}" for k in range(60)], [f"b{k}" for k in range(60)]
    out = []
    for k in range(400):
        out.append(" ".join(rnd.choice(a if k % 2 else b) if rnd.random() < 0.97 else f"r{rnd.randrange(500)}" for _ in range(rnd.randint(1, 60))))
    return out + [None, "", " \n", "A1 a1", "x " * 5000, "é\x1cé É"]


def test_scores(spark):
    rnd = random.Random(6)
    rows = [(k, t, 5) for k, t in enumerate(_texts(rnd))] + [(None, "a1 zz", 1), (3, "a1", 1)]
    rows += [(2000 + k, rows[0][1], 0) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score long")
    got = hmm.scores(df, states=4, frequent=100).collect()
    assert len(got) == len(rows)
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    c = Counter(w for i, t, _ in rows if not out(i) for w in [*words(t), "<end>"])
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), out(i), len(words(t)) + 1, sum(c[w] > 0 for w in words(t)) + 1, n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*words(t), "<end>"]), 6)) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    held = [r for r in got if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.97, "the states learn the two vocabularies"
    same = {round(r.score, 9) for r in got if (r.doc_id or 0) >= 2000}
    assert len(same) == 1


def test_probabilities_sum_to_one(spark):
    """Over all texts of up to two words of a closed vocabulary and one unknown word, what longer texts have is left."""
    df = spark.createDataFrame([(k, t) for k, t in enumerate(["a b", "a", "b c a", "d", "a d", "b"])], "doc_id long, text string")
    vocab = ["a", "b", "c", "d", "u"]
    texts = [""] + vocab + [f"{x} {y}" for x in vocab for y in vocab]
    probe = spark.createDataFrame([(k, t) for k, t in enumerate(["a b", "a", "b c a", "d", "a d", "b"])] + [(k, t) for k, t in zip([k for k in range(1000, 9000) if zlib.crc32(str(k).encode()) % 10 == 0], texts)], "doc_id long, text string")
    got = [r for r in hmm.scores(probe, states=2, frequent=2, rounds=2).collect() if r.doc_id >= 1000]
    short = sum(10 ** r.score for r in got)
    assert len(got) == 31 and 0.2 < short < 1.0
    base = sum(10 ** r.base_score for r in got)
    assert 0.2 < base < 1.0


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(k, "a") for k in range(3000) if zlib.crc32(str(k).encode()) % 10 == 0][:5], "doc_id long, text string")
    for r in hmm.scores(df).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (2, 0, 0) and r.base_score == 0 and math.isfinite(r.score)
    assert hmm.scores(df.limit(0)).collect() == []


def test_every_word_has_emissions(spark):
    """Words of a vocabulary far above ``frequent``, each seen three times, all help to tell the two kinds of text apart."""
    rnd = random.Random(9)
    kinds = [[f"{x}{k}" for k in range(400)] for x in "ab"]
    deal = [w for k in kinds for w in [k * 3]]
    rows, at = [], 0
    for words in deal:
        rnd.shuffle(words)
        for k in range(0, len(words), 20):
            while zlib.crc32(str(at).encode()) % 10 == 0:
                at += 1
            rows.append((at, " ".join(words[k:k + 20])))
            at += 1
    held = [k for k in range(10_000, 20_000) if zlib.crc32(str(k).encode()) % 10 == 0]
    pure = [(held[k], " ".join(rnd.sample(kinds[k % 2], 20))) for k in range(40)]
    mixed = [(held[100 + k], " ".join(w for pair in zip(rnd.sample(kinds[0], 10), rnd.sample(kinds[1], 10)) for w in pair)) for k in range(40)]
    got = {r.doc_id: r.score for r in hmm.scores(spark.createDataFrame(rows + pure + mixed, "doc_id long, text string"), states=2, frequent=10, rounds=20).collect()}
    assert min(got[k] for k, _ in pure) > max(got[k] for k, _ in mixed)


def test_steps_lie_side_by_side():
    # every step's tokens are one slice, and the slabs of emissions in scoring don't change a score
    seqs = [np.array(x, np.uint32) for x in ([1, 2, 3], [4], [5, 6, 7, 8], [9, 10])]
    order, tokens, running, starts = hmm._side_by_side(seqs)
    assert [tokens[a:a + n].tolist() for a, n in zip(starts, running)] == [[5, 1, 9, 4], [6, 2, 10], [7, 3], [8]]
    assert order == [2, 0, 3, 1] and list(hmm._steps(starts, 5)) == [(0, 1), (1, 3), (3, 4)]
    rng = np.random.default_rng(1)
    p = hmm.Parameters(rng.random((2, 8)), rng.random((8, 8)), rng.random((11, 8)))
    want = hmm.log_likelihoods(seqs, p)
    before, hmm.EMISSIONS = hmm.EMISSIONS, 2
    try:
        assert np.array_equal(hmm.log_likelihoods(seqs, p), want)
    finally:
        hmm.EMISSIONS = before


def test_distinct_words_without_sorting_all():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5000):
        h = rng.integers(0, 2**64, 700, dtype=np.uint64)[rng.integers(0, 700, n)]
        want = np.unique(h, return_inverse=True, return_counts=True)
        assert all(np.array_equal(a, b.ravel()) for a, b in zip(hmm._distinct(h), want, strict=True))


def test_files_of_blocks_hold_one_pass(spark):
    rows = [(k, k % 5 == 0, f"a{k} b c") for k in range(40)]
    texts = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string").repartition(6)
    turns = {(r.block >> 32, r.turn) for r in hmm._blocks(texts).collect()}
    assert turns == {(k, k % hmm.PASSES) for k in range(6)}
