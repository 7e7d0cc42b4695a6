import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cartcast.llm.words import word_hashes

ALPHABET = st.sampled_from(list("abAB.é漢🙂") + [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x00", " "])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=40), max_size=8))
def test_words_and_their_texts(texts):
    h, stops = word_hashes(texts)
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in texts]
    flat = [w for ws in words for w in ws]
    assert len(h) == len(flat) and stops.tolist() == np.cumsum([len(w) for w in words]).tolist()
    # equal words have equal hashes and others don't
    assert len(set(h.tolist())) == len(set(flat)) == len(set(zip(flat, h.tolist())))


def test_alone_and_in_a_block():
    texts = ["x" * 5000 + " y", "", "abcdefgh abcdefgh i abcdefghi", "  ", "abcdefghijklmnop abcdefghijklmnoq"]
    h, stops = word_hashes(texts)
    alone = [word_hashes([t])[0].tolist() for t in texts]
    starts = [0, *stops.tolist()[:-1]]
    assert [h[a:b].tolist() for a, b in zip(starts, stops.tolist())] == alone
    assert len(set(h.tolist())) == 7
    assert word_hashes([])[0].tolist() == []


def test_many_words_without_collisions():
    words = [f"{a}{b}{c}" for a in "abcdefghij" for b in range(500) for c in ("", "x", "yy", "longer-than-eight")]
    h, _ = word_hashes([" ".join(words)])
    assert len(set(h.tolist())) == len(words)
    assert abs(np.bitwise_count(h).mean() - 32) < 0.2
