import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartcast.llm import hostrules

WORD = r"[^\x20\x09-\x0D]+"


def brute(t):
    t = t or ""
    w = re.findall(WORD, t)
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    wins = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    inside = set()
    for k in range(len(w) - 7):
        if wins[tuple(w[k:k + 8])] > 1:
            inside |= set(range(k, k + 8))
    return len(w), len(lines), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside)


def test_counts_as_plain_python(spark):
    rnd = random.Random(1)
    texts = [None, "", " ", "\n\n", "a\na\n a\n", "é🙂 # <b> é🙂 # <b>", "x " * 30_000, "a b c d e f g h " * 2, "a b \x1cc d\x0be", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w2 w3 w4 w5 w6 w7 w8 w9"]
    for _ in range(200):
        texts.append("".join(rnd.choice(["a", "b", "#", " ", "\n", "\t", "é"]) for _ in range(rnd.randint(0, 200))))
        texts.append(" ".join(rnd.choices("abc", k=rnd.randint(0, 60))))
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, words_ long")
    for r in hostrules.counts(df).collect():
        assert (r.n_words, r.n_lines, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id]), texts[r.doc_id]


def test_verdicts(spark):
    good = " ".join(f"word{k}" for k in range(40))
    noisy = " ".join(f"w{k} ###" for k in range(40))
    rows = [(k, noisy, "bad") for k in range(50)] + [(50, good, "bad"), (51, noisy, "tiny")]
    rows += [(100 + k, good + f" v{k}", f"h{k % 5}") for k in range(400)] + [(600, noisy, "h0"), (601, "short", "h1"), (602, None, None), (603, good, None), (100, good + " v0", "h0")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n", F.lit(7))
    got = {r.doc_id: r for r in hostrules.verdicts(df).collect()}
    assert all(not got[k].kept and not got[k].base_failed for k in range(50))
    assert got[50].kept, "a clean document stays on a bad host"
    assert got[51].kept and got[600].kept, "one failure doesn't judge a host"
    assert got[601].base_failed and not got[601].kept and got[602].base_failed and got[603].kept
    assert hostrules.verdicts(df).count() == len(rows)
    assert hostrules.verdicts(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        hostrules.counts(df.withColumnRenamed("n", "N_Words"))
