import hashlib
import random
import re

import pytest

from cartcast.llm import pii


def luhn(s):
    d = [int(c) for c in s[::-1]]
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(d)) % 10 == 0


def brute(t):
    t, out = t or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for kind, p, ok in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ):
        out.append([f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(p, t) if ok(m.group())])
    return out


CASES = [
    None, "", "no data", "a@b.c", "a@b.c%d@e.f, x..y+z@q-1.co.uk. @x.y z@", "1.2.3.4.5.6.7.8 0001.02.255.256 1.2.3.256 300.1.1.1 12.13.14.15",
    "4663269261229448 4663 2692 6122 9448 4663-2692-6122-9448 46632692612294480 5 4663269261229448", "9" * 25 + " 0000000000000000", "4663--2692 4663269261229448-",
    "+1 (976) 555-9947 +12345678 +1234567 ++1 555 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "🙂é a.b@c.de 🙂 +49 (30) 1234567 ü 10.0.0.1", "mail john [at] example [dot] com now",
    "call 555 234 5678 or (312) 555-0000; version 1.2.3.4", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "pay 4663.2692.6122.9448", "a.b" * 5000, "1 " * 20000, "12" * 20000, "x@" * 2000 + "a@b.c" * 500, "+1 " * 3000, "1.1." * 3000,
]


def _random(rnd):
    alphabet = "ab1234567890" + "@.+- ()%_\n" * 2 + "é🙂"
    return "".join(rnd.choices(alphabet, k=rnd.randint(0, 120)))


def test_base_spans_as_plain_regex(spark):
    rnd = random.Random(9)
    texts = CASES + [_random(rnd) for _ in range(600)]
    texts += ["".join(rnd.choices("0123456789", k=15)) + str(d) for d in range(10)]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, kind int")
    got = {r.doc_id: r for r in pii.digests(df, pii.fit(df)).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        want = brute(t)
        r = got[k]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(w) for w in want], t
        flat = [s for w in want for s in w]
        assert r.base_sha256 == hashlib.sha256(",".join(flat).encode()).hexdigest()
        assert set(flat) <= set(r.spans.split(",")) | {""} and (r.spans == "") <= (not flat)


def test_loose_spans_and_redaction(spark):
    rows = [(k, f"please mail a{k}.b@mail{k % 7}.example.com or call +1 (9{k % 10}6) 555-99{k % 10}7 today") for k in range(60)]
    rows += [(100 + k, f"you can contact bob{k} [at] example [dot] com and call (312) 555-12{k % 10}4 ok") for k in range(30)]
    rows += [(200, "clean text, version 1.2 and 100 200 300"), (201, None), (202, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(df)
    got = {r.doc_id: r.text for r in pii.redact(df, model).collect()}
    assert got[0] == "please mail <EMAIL> or call <PHONE> today"
    assert got[100] == "you can contact <EMAIL> and call <PHONE> ok"
    assert got[200] == rows[-3][1] and got[201] is None and got[202] == ""
    share = model.rates[0][0][1]
    assert share[0] > 0.5


def test_names_and_empty(spark):
    df = spark.createDataFrame([(1, "a@b.c", "x")], "doc_id long, text string, m_email_1 string")
    assert pii.spans(df, pii.fit(df)).columns == ["doc_id", "text", "m_email_1", "pii"]
    none = df.limit(0)
    assert pii.digests(none, pii.fit(none)).count() == 0
    with pytest.raises(ValueError):
        pii.spans(df, pii.fit(df), out="M_email_1")
