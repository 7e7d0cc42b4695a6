import re
from collections import Counter

import public_tokenizers as P
import tiktoken

import corpus_pipeline as C
from cartcast.llm import bpe, mix, toxic
from test_jaccard import brute as components_of
from test_pii import brute as spans_of

SF = "/root/testdata/sf0.001"


def _redacted(text):
    if text is None:
        return None
    spans = sorted((int(a), int(b), k) for s in spans_of(text) for k, a, b in [x.split(":") for x in s])
    out, at = "", 0
    for a, b, k in spans:
        if a >= at:
            out += text[at:a] + f"<{k.upper()}>"
        at = max(at, b)
    return out + text[at:]


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "src0", 0), (9003, "same words here to repeat now", "en", None, 29), (9003, "same words here to repeat now", "en", None, 29), (None, "x y", "en", "a", 3)], docs.schema)
    docs = docs.unionByName(extra).cache()
    model = toxic.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = C.toxicity(spark, docs, SF)
    assert kept.columns == docs.columns
    score = lambda t: model.score(toxic._document_margins([t], model.folded, set(), {})[0]) if model.folded else 0.0
    key = lambda r: str(tuple(r))
    want = [r for r in docs.collect() if score(r.text) < 0.5]
    assert sorted(kept.collect(), key=key) == sorted(want, key=key)

    kept = kept.cache()
    unique = C.near_duplicates(spark, kept, SF).cache()
    assert unique.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    parts = components_of(rows)
    want = Counter(i for i, n, c in parts if i == c and (n == 0 or i is None)) + Counter({i: 1 for i, n, c in parts if i == c and n and i is not None})
    assert Counter(r.doc_id for r in unique.collect()) == want
    texts = dict(rows)
    assert all(texts[r.doc_id] == r.text for r in unique.collect())

    clean = C.private_data(spark, unique, SF).cache()
    by_id = {r.doc_id: r for r in clean.collect()}
    for r in unique.collect():
        assert by_id[r.doc_id].text == _redacted(r.text)
        assert by_id[r.doc_id].n_chars == (r.n_chars if r.text is None else len(by_id[r.doc_id].text))

    mixed = C.mixture(spark, clean, SF).cache()
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    name = "concat_ws(':', coalesce(cast(doc_id as string), 'null'), md5(cast(coalesce(text, '') as binary)))"
    for r in mix.mix(clean.selectExpr("*", f"{name} as name"), id_col="name")[1].collect():
        i = r.id.split(":")[0]
        assert times[None if i == "null" else int(i)] == (int(r.taken / r["size"] + 0.5) if r["size"] else 0)
    assert all(by_id[r.doc_id] == r for r in mixed.collect())

    raw = {r.doc_id: r.text for r in mixed.collect()}
    v = bpe.Vocabulary(open(P.path("byte_bpe_50k.tiktoken"), "rb").read(), P.PATTERN)
    tk = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=v.rank, special_tokens={})
    out = C.tokens(spark, mixed, SF).collect()
    assert Counter(r.doc_id for r in out) == times
    for r in out:
        assert r.ids == tk.encode_ordinary(raw[r.doc_id]) and r.n_tokens == len(r.ids)


def test_run_and_empty(spark):
    got = C.run(spark, SF)
    assert got.columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and got.count() > 50
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_five_stages():
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "private_data", "mixture", "tokens"]
    assert all(re.fullmatch(r"[a-z_]+", n) for n, _ in C.STAGES)


def test_repeated_ids_keep_their_words(spark):
    """Of several rows of an id, those without words stand alone and one text stays, in whatever order the rows come."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text, other = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, text, "en", "a", 1), (1, "", "en", "a", 0), (1, other, "en", "a", 2), (1, other, "en", "b", 3), (2, text + " seven", "en", "a", 1), (None, text, "en", "a", 1), (None, None, None, None, None)]
    results = set()
    for order in (rows, rows[::-1]):
        got = C.near_duplicates(spark, spark.createDataFrame(order, schema), SF).collect()
        assert Counter(r.doc_id for r in got) == {1: 2, 2: 1, None: 2} and "" in {r.text for r in got if r.doc_id == 1}
        results.add(tuple(sorted(map(str, got))))
    assert len(results) == 1
    mixed = C.mixture(spark, spark.createDataFrame(rows * 2 + [(7, "word " * 40, "en", "b", 9)], schema), SF)
    assert mixed.columns == ["doc_id", "text", "lang", "source", "n_chars"] and mixed.where("text is null or text = ''").count() == 0
