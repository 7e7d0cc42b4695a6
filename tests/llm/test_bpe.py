import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cartcast.llm import bpe

RAW = open(P.path("byte_bpe_50k.tiktoken"), "rb").read()
V = bpe.Vocabulary(RAW, P.PATTERN)
TK = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=V.rank, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_tiktoken(text):
    assert V.encode(text) == TK.encode_ordinary(text)
    assert V.decode(V.encode(text)) == text.encode()


def test_runs_and_mixtures():
    rnd = random.Random(5)
    words = [t.decode("utf-8", "ignore") for t in rnd.sample(list(V.rank), 3000)]
    for _ in range(300):
        t = "".join(rnd.choices(words, k=rnd.randint(1, 40)))
        assert V.encode(t) == TK.encode_ordinary(t)
    for t in ("a" * 3000, " " * 2000 + "x", "=" * 999, "ab" * 1500, "\n\n \t" * 300, "é" * 777, "<|endoftext|>", "1" * 500):
        assert V.encode(t) == TK.encode_ordinary(t)


@settings(max_examples=150, deadline=None)
@given(st.text("abcdeghinorst", max_size=25), st.text("abcdeghinorst", max_size=25), st.integers(0, 25), st.integers(0, 25))
def test_prefix_table_append_and_replace(a, b, i, j):
    t = bpe.PrefixTable(V, a.encode())
    t.append(b.encode())
    assert t.ids() == bpe.PrefixTable(V, (a + b).encode()).ids()
    for end in range(len(a + b) + 1):
        assert t.ids(end) == bpe.PrefixTable(V, (a + b)[:end].encode()).ids()
    i, j = sorted((min(i, len(a + b)), min(j, len(a + b))))
    t.replace(i, j, b"est")
    assert t.ids() == bpe.PrefixTable(V, ((a + b)[:i] + "est" + (a + b)[j:]).encode()).ids()


@settings(max_examples=1500, deadline=None)
@given(st.text("ab '\n1s.tre", max_size=40), st.text("ab '\n1s.tre", max_size=8), st.integers(0, 40), st.integers(0, 40))
def test_edits_of_a_text(text, new, i, j):
    i, j = sorted((min(i, len(text)), min(j, len(text))))
    e = bpe.EncodedText(V, text)
    e.replace(i, j, new)
    assert e.ids() == TK.encode_ordinary(text[:i] + new + text[j:])
    e.append(new)
    assert e.ids() == TK.encode_ordinary(text[:i] + new + text[j:] + new)


def test_rows(spark):
    texts = [None, "", "Hello world", "Hello world", "x " * 200_000, "\x00é漢字🙂 end"]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, Extra string")
    path = P.path("byte_bpe_50k.tiktoken")
    enc = bpe.encode(df, path, P.PATTERN)
    back = bpe.decode(enc, path, P.PATTERN)
    for r in back.collect():
        assert r.ids == TK.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    for r in bpe.token_digests(df, path, P.PATTERN).collect():
        ids = TK.encode_ordinary(r.text or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    assert bpe.encode(df.limit(0), path, P.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(df.withColumnRenamed("Extra", "IDS"), path, P.PATTERN)
