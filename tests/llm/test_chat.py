import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartcast.llm import chat

T = chat.INSTRUCTION
PIECES = ["</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[:ROLE]", "\\", "\\\\", "<", "[", " ", "\n", "ok", "é", "[/", "INST]", "<\\/s>", "s>"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "", "tool", "[:ROLE] x"]), st.lists(st.sampled_from(PIECES), max_size=12).map("".join)), max_size=6))
def test_round_trip(turns):
    out = "".join(s for r, t in turns for _, s, _ in T.turn(r, t))
    assert T.read(out) == turns
    for _, t in turns:
        assert T.unescape(T.escape(t)) == t
        assert not any(c in T.escape(t) for c in ("</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[:ROLE]", "[/ROLE]", "<s>"))


def _want(turns):
    texts = [(r or "", t or "") for r, t in turns]
    said = "".join(t for r, t in texts if r == "assistant")
    return (len(texts), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in texts).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())


def test_conversations(spark):
    rnd = random.Random(8)
    convs = {k: [(rnd.choice(["user", "assistant", "system", "tool", None]), rnd.choice([None, "", "x" * 100_000, "".join(rnd.choices(PIECES, k=9))])) for _ in range(rnd.randint(1, 9))] for k in range(60)}
    convs[None] = [("user", "a"), ("assistant", "b")]
    convs[900] = [("system", "s"), ("user", "u"), ("assistant", "a"), ("user", "u"), ("assistant", "a")]
    convs[901] = [("user", "u"), ("user", "u")]
    convs[902] = [("user", "u"), ("assistant", "a"), ("user", "u")]
    convs[903] = [("assistant", str(k)) for k in range(5000)]
    rows = [(c, k, r, t, 1) for c, turns in convs.items() for k, (r, t) in enumerate(turns)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment int")
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == _want(turns)
        assert r.formatted_chars == sum(len(s) for x, t in turns for _, s, _ in T.turn(x or "", t or ""))
    assert got[900].problem is None and got[901].problem == "user > user" and got[902].problem == "user > <end>" and got[903].problem == "<start> > assistant"
    seg = chat.segments(df).where("conv_id = 900").orderBy("segment").collect()
    assert "".join(s.text for s in seg) == "<<SYS>>\ns\n<</SYS>>\n[INST] u [/INST] a </s>[INST] u [/INST] a </s>"
    assert [s.text for s in seg if s.loss] == ["a", "a"]


def test_ties_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "s")], "conv_id long, turn long, role string, text string")
    r, = chat.digests(df).collect()
    assert r.turns_sha256 == _want([("system", "s"), ("user", "a"), ("user", "a"), ("user", "b")])[1]
    assert chat.digests(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        chat.Template(marks={"a": ("x", "</a>")}, loss=frozenset(), follows={})
