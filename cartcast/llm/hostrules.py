"""Operator 9: host-level quality rules, in DataFrame expressions only.

Each document gets counts over its whole text and fails or passes five rules:
``short`` and ``repeats`` (the base rules, which reject a document by themselves),
``symbols``, ``lines`` and ``length``.  For each host (the ``source`` of a document, or any column
given), failures are summed per rule; a host's rate of failure is shrunk towards the
rate of all hosts with a beta prior fitted to the hosts' rates by moments, so
that hosts with few documents aren't judged by chance.  Where a host's shrunk rate is above ``LIMIT``, the rule is
enforced on that host: its documents that fail the rule go; all others stay.
So a clean document is kept in any host.

Repeated windows are found within the row: windows of eight word hashes; only a
text that has fewer distinct windows than windows sorts them with their places.
Host sums are partial sums first, so a host with a third of all rows costs one row a
task; the verdicts are joined back by the host, where the planner broadcasts
them if small or splits a large host's rows otherwise.

Defined results: null and empty texts have no words and fail ``short``; a null
host is a host; repeated rows count each; extra columns are ignored; empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartcast.llm.common import WORD, fresh, kept, text_or_empty

WINDOW = 8
LIMIT = 0.5
#: The prior weighs as many documents at least, so that a single one never judges a host.
LEAST_STRENGTH = 4.0
#: Rules in terms of the counts; also SQL.
RULES = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "lines": "n_dup_lines >= 3 AND 10 * n_dup_lines > n_lines * 3",
    "length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}
BASE_RULES = ("short", "repeats")


def _covered(places: Column) -> Column:
    """Words in the windows that start at the sorted ``places``."""
    def step(acc, p):
        end = p + WINDOW
        return F.struct(end.alias("end"), (acc["n"] + end - F.greatest(p, acc["end"])).alias("n"))

    return F.aggregate(places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step, lambda a: a["n"])


def counts(df: DataFrame, col: str = "text") -> DataFrame:
    """Adds n_words, n_lines, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    made = ["n_words", "n_lines", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    if clash := {c.lower() for c in df.columns} & set(made):
        raise ValueError(f"the table already has {sorted(clash)}")
    text, words, lines, hashes, windows, order = fresh(df, "t_", "words_", "lines_", "hashes_", "windows_", "order_")
    c = F.col
    df = df.withColumn(text, text_or_empty(col))
    df = df.withColumns({
        words: F.regexp_extract_all(c(text), F.lit(WORD), F.lit(0)),
        lines: F.filter(F.split(c(text), "\n", -1), lambda x: x.rlike(WORD)),
        "n_symbols": F.char_length(F.regexp_replace(c(text), r"[^#*$%&|<>]++", "")).cast("long")})
    df = df.withColumns({
        "n_words": F.size(words).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "word_chars": F.char_length(F.array_join(c(words), "")).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(c(lines)))).cast("long"),
        hashes: F.transform(c(words), lambda w: F.xxhash64(w))}).drop(text, words, lines)
    last = F.size(hashes) - WINDOW
    df = df.withColumn(windows, F.when(last > 0, F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(c(hashes), i + k) for k in range(WINDOW)]))))
    # (hash, place) of the windows in the order of the hashes, where some are equal
    some = F.size(F.array_distinct(c(windows))) < F.size(windows)
    df = df.withColumn(order, F.when(some, F.array_sort(F.transform(c(windows), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twin = F.transform(F.sequence(F.lit(0), F.size(order) - 1), lambda j: F.when(
        (F.get(c(order), j)["h"] == F.get(c(order), j - 1)["h"]) | (F.get(c(order), j)["h"] == F.get(c(order), j + 1)["h"]), F.get(c(order), j)["i"]))
    places = F.array_sort(F.filter(twin, lambda p: p.isNotNull()))
    repeated = F.when(c(order).isNotNull(), _covered(places)).otherwise(0).cast("long")
    return df.withColumn("n_repeat_words", repeated).drop(hashes, windows, order)


def verdicts(df: DataFrame, host: str = "source", col: str = "text", limit: float = LIMIT) -> DataFrame:
    """The columns of ``df`` without ``col``, the counts, ``base_failed`` and ``kept``."""
    key = fresh(df, "host_key")[0]
    rows = kept(counts(df, col).drop(col), "host-counts")
    fails = {r: F.coalesce(F.expr(e), F.lit(False)) for r, e in RULES.items()}
    hosts = rows.groupBy(F.col(host).alias(key)).agg(F.count("*").alias("n"), *[F.count_if(e).alias(r) for r, e in fails.items()])
    hosts = kept(hosts, "host-sums")
    total = F.sum("n")
    rate = hosts.agg(total.alias("n"), F.count("*").alias("hosts"), *[(F.sum(r) / total).alias(r) for r in RULES]).first()
    spread = hosts.agg(*[(F.sum(F.col("n") * F.pow(F.col(r) / F.col("n") - F.lit(rate[r]), 2)) / total).alias(r) for r in RULES]).first()
    enforced = {r: _shrunk(F.col(r), rate[r], spread[r], rate["hosts"], rate["n"]) > limit for r in RULES}
    hosts = hosts.select(key, *[e.alias(f"enforced_{r}") for r, e in enforced.items()])
    out = rows.join(hosts, rows[host].eqNullSafe(hosts[key]))
    base = fails["short"] | fails["repeats"]
    by_host = F.lit(False)
    for r in RULES:
        by_host = by_host | (fails[r] & F.col(f"enforced_{r}"))
    return out.select(*[rows[x] for x in rows.columns], base.alias("base_failed"), (~base & ~by_host).alias("kept"))


def _shrunk(failed: Column, mean, spread, hosts, n) -> Column:
    """A host's rate under the beta prior: mean and variance between hosts fix its strength."""
    if not n or mean in (0, 1) or hosts < 2:
        return F.lit(float(mean or 0.0))
    between = max(spread - mean * (1 - mean) * hosts / n, 1e-6)
    strength = min(max(mean * (1 - mean) / between - 1, LEAST_STRENGTH), 1e6)
    return (failed + mean * strength) / (F.col("n") + strength)
