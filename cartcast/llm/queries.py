"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F

from cartcast.llm.common import table, text_batches

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(fn):
    @wraps(fn)
    def run(spark, sf):
        text_batches(spark)
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return run


@_query
def op1_byte_bpe(spark, sf):
    import public_tokenizers as P

    from cartcast.llm import bpe

    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.token_digests(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).drop("text")


@_query
def op8_string_kernel_toxicity(spark, sf):
    from cartcast.llm import toxic

    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxic.fit(docs, table(spark, sf, "labels"))
    out = toxic.scores(docs, model, keep=["doc_id"])
    return out.select("doc_id", toxic.held_out().alias("held_out"), "score", "predicted")


@_query
def op2_ngram_jaccard(spark, sf):
    from cartcast.llm import jaccard

    return jaccard.near_duplicates(table(spark, sf, "documents"))


@_query
def op7_weak_supervision_pii(spark, sf):
    from cartcast.llm import pii

    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pii.digests(docs, pii.fit(docs)).drop("text")


@_query
def op6_low_discrepancy_mix(spark, sf):
    from cartcast.llm import mix

    _, taken = mix.mix(table(spark, sf, "documents"))
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def _mix_sql() -> str:
    return """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) - 1 AS copy FROM d),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
s1 AS (SELECT *, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 3.0::DOUBLE * source_size AS cap FROM s0),
s2 AS (SELECT *, ((SELECT sum(source_size) FROM s1) - coalesce(sum(cap) OVER (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM s1),
s AS (SELECT *, least(cap, w * (SELECT max(lev) FROM s2)) AS target FROM s2),
e AS (SELECT r.*, s.place, s.source_size, s.target, CAST(floor(s.target + 0.5) AS BIGINT) AS used,
        sum(size) OVER (PARTITION BY place, pass ORDER BY md5(x.pass || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || copy), doc_id, size, copy
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + pass * s.source_size AS stop
      FROM r JOIN s ON r.source IS NOT DISTINCT FROM s.source, (SELECT unnest([0, 1, 2]) AS pass) x)
SELECT doc_id, size, any_value(source_size) AS source_size, any_value(target) AS target,
       CAST(sum(greatest(0, least(stop, used) - (stop - size))) AS BIGINT) AS taken
FROM e GROUP BY doc_id, source, size, copy"""


SQL["op6_low_discrepancy_mix"] = _mix_sql()


@_query
def op9_host_rules(spark, sf):
    from cartcast.llm import hostrules

    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return hostrules.verdicts(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _host_sql() -> str:
    from cartcast.llm.hostrules import BASE_RULES, LEAST_STRENGTH, LIMIT, RULES

    word = "[^\\x20\\x09-\\x0D]+"
    flags = ", ".join(f"({e}) AS f_{r}" for r, e in RULES.items())
    sums = ", ".join(f"count(*) FILTER (f_{r}) AS {r}" for r in RULES)
    rates = ", ".join(f"sum({r}) / sum(n) AS m_{r}" for r in RULES)
    spread = ", ".join(f"sum(n * pow({r} / n - m_{r}, 2)) / sum(n) AS v_{r}" for r in RULES)
    k = {r: f"least(greatest(m_{r} * (1 - m_{r}) / greatest(v_{r} - m_{r} * (1 - m_{r}) * hosts / docs, 1e-6) - 1, {LEAST_STRENGTH}), 1e6)" for r in RULES}
    on = ", ".join(f"CASE WHEN m_{r} IN (0, 1) OR hosts < 2 THEN m_{r} ELSE ({r} + m_{r} * {k[r]}) / (n + {k[r]}) END > {LIMIT} AS e_{r}" for r in RULES)
    base = " OR ".join(f"f_{r}" for r in BASE_RULES)
    host = " OR ".join(f"(f_{r} AND e_{r})" for r in RULES)
    return f"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}') AS w FROM documents),
w AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM t),
x AS (SELECT doc_id, i, array_to_string(list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING), ' ') AS win,
        count(*) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS len FROM w),
y AS (SELECT doc_id, i, CASE WHEN len = 8 AND count(*) OVER (PARTITION BY doc_id, win, len) > 1 THEN 1 ELSE 0 END AS twin FROM x),
z AS (SELECT doc_id, max(twin) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS inside FROM y),
r AS (SELECT doc_id, sum(inside) AS n_repeat_words FROM z GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda v : regexp_matches(v, '{word}')) AS lines FROM t),
c AS (SELECT t.doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM t JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
f AS (SELECT *, {flags} FROM c),
h AS (SELECT source, count(*) AS n, {sums} FROM f GROUP BY source),
m AS (SELECT count(*) AS hosts, sum(n) AS docs, {rates} FROM h),
v AS (SELECT {spread} FROM h, m),
e AS (SELECT source, {on} FROM h, m, v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({base}) AS base_failed, NOT (({base}) OR {host}) AS kept
FROM f JOIN e ON f.source IS NOT DISTINCT FROM e.source"""


SQL["op9_host_rules"] = _host_sql()


@_query
def op3_chat_format(spark, sf):
    from cartcast.llm import chat

    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(rows.unionByName(extra))


def _chat_sql() -> str:
    controls = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "</s>", "<s>", "[ROLE]", "[:ROLE]", "[/ROLE]")
    escaped = "replace(text, '\\', '\\\\')"
    for c in controls:
        escaped = f"replace({escaped}, '{c}', '{c[0]}\\{c[1:]}')"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, {escaped} AS esc,
  CASE role WHEN 'system' THEN 8 + 10 WHEN 'user' THEN 7 + 8 WHEN 'assistant' THEN 1 + 5 ELSE 6 + length(role) + 8 + 8 END AS around,
  lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS was, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n,
  count(*) OVER (PARTITION BY conv_id) AS of FROM c),
p AS (SELECT *, CASE WHEN role NOT IN ('system', 'user', 'assistant') THEN 'role ' || role
    WHEN n = 1 AND role IN ('system', 'user') THEN NULL WHEN n = 1 THEN '<start> > ' || role
    WHEN (was, role) IN (('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) THEN NULL ELSE was || ' > ' || role END AS bad FROM t)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(esc) + around) AS BIGINT) AS formatted_chars,
  coalesce(first(bad ORDER BY n) FILTER (bad IS NOT NULL), CASE WHEN first(role ORDER BY n DESC) <> 'assistant' THEN first(role ORDER BY n DESC) || ' > <end>' END) AS problem
FROM p GROUP BY conv_id"""


SQL["op3_chat_format"] = _chat_sql()


@_query
def op4_exact_shards(spark, sf):
    from cartcast.llm import shard

    return shard.text_shards(table(spark, sf, "documents"), 24)


@_query
def op5_hidden_markov_score(spark, sf):
    from cartcast.llm import hmm

    return hmm.scores(table(spark, sf, "documents"))


@_query
def op10_kmeans_tree_search(spark, sf):
    from cartcast.llm import ann

    return ann.search(table(spark, sf, "embeddings"), F.col("id") % 50 == 0)


@_query
def op11_secular_whitening(spark, sf):
    from cartcast.llm import whiten

    return whiten.whitened(table(spark, sf, "embeddings"))


@_query
def op13_sliced_bloom_search(spark, sf):
    from cartcast.llm import lexical

    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


SQL["op13_sliced_bloom_search"] = """
WITH d AS (SELECT doc_id, text, row_number() OVER () AS r FROM documents),
t AS (SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
f AS (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY r),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, c GROUP BY term),
i AS (SELECT DISTINCT item_id, text FROM benchmark),
q AS (SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM i),
k AS (SELECT item_id, text, term, count(*) AS times FROM q GROUP BY ALL),
s AS (SELECT k.item_id, k.text, f.r, f.doc_id,
        CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)))) AS BIGINT) AS score
      FROM k JOIN w USING (term) JOIN f USING (term) JOIN n USING (r), c GROUP BY k.item_id, k.text, f.r, f.doc_id),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10"""


@_query
def op12_byte_gru_language(spark, sf):
    from cartcast.llm import langid

    docs = table(spark, sf, "documents")
    out = langid.predictions(docs.select("doc_id", "text"), langid.fit(docs))
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")
