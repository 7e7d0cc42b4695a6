"""Operator 7: personal data by weak supervision, in DataFrame expressions only.

Candidates are *base* spans (four kinds with fixed rules: e-mail, ip, card,
phone) and *loose* ones (spelt-out e-mails, IPv6, cards with other separators,
phones without a plus).  Labelers vote yes, no or nothing on each candidate:

* ``rule``: the base rule of the kind; ``check``: structure (octets without leading zeros, area codes, card check digit, label lengths);
* ``gazetteer``: known ends of host names, card issuers' first digits, reserved networks, dialling codes;
* ``context``: words before the span that announce the kind, or speak against it
  (versions, prices, page numbers).

Votes are counted per pattern (kind and votes: at most a few hundred rows
whatever the input), and expectation-maximisation estimates, per kind, the share
of true candidates and each labeler's rates; the posteriors train the final
classifier, a logistic regression on votes and span features (again on the table of
patterns).  Loose candidates that the classifier accepts and that overlap no base
span of their kind are added; base spans always stay.

Positions come from cutting the text at the matches: a match starts after all pieces
and matches before it, counted in code points.  All patterns are possessive, or start only where a match can start,
so that long runs of digits or letters cost linear time; the classes are fixed by
the base rules.

Defined results: null and empty texts have no spans; repeated rows are treated alike;
spans of different kinds may overlap; overlapping spans are redacted as one,
under the first one's kind; extra columns pass through, a column with the name of a
result is an error; empty tables give empty results and a classifier that
accepts no loose candidate.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartcast.llm.common import fresh, text_or_empty

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("rule", "check", "gazetteer", "context")
FEATURES = (*LABELERS, "long", "separated", "digits")
ROUNDS = 30
CONTEXT_CHARS = 40

# The forms of the base kinds.
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a whole run of digits with single separators that has 16 to 19 of them; other runs would be dropped
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+ ?(?:\[at\]|\(at\)|\{at\}) ?[a-z0-9-]{1,63}+(?: ?(?:\.|\[dot\]|\(dot\)|\{dot\}) ?[a-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}+:){7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Za-z:.])",
    "card": r"(?<![0-9])(?<![0-9][./_])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?!\1?[0-9])",
    "phone": r"(?<![0-9+)(./-])(?<![0-9][ -])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![./-]?[0-9])",
}
#: A text without this can't have a match.
_MARK = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_LOOSE_MARK = {"email": "at", "ip": ":", "card": None, "phone": None}
# The gazetteers.
ENDS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info", "biz", "ch", "at", "it", "nl", "us", "ca", "jp")
CODES = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55",
         "56", "57", "60", "61", "62", "63", "64", "65", "66", "7", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98")
_FOR = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|reach|kontakt|courriel|correo|adresse)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|addr|from|client|login|adresse|dirección)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|payment|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|téléphone|teléfono|anruf)\b",
}
_AGAINST = r"(?i)\b(?:version|release|section|chapter|isbn|issn|doi|page|price|part|serial|order|build|kapitel|seite|prix|precio)\b"


def _matches(text: Column, pattern: str, mark: str | None) -> Column:
    hit = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return hit if mark is None else F.when(F.instr(text, mark) > 0, hit).otherwise(F.array().cast("array<string>"))


def _located(matches: Column, pieces: Column) -> Column:
    """array<struct<start, stop, span, before>> in code points."""
    empty = F.array().cast("array<struct<start:int,stop:int,span:string,before:string>>")

    def step(acc, x):
        start = acc["at"] + F.char_length(x["piece"])
        stop = start + F.char_length(x["span"])
        one = F.struct(start.alias("start"), stop.alias("stop"), x["span"].alias("span"), F.right(x["piece"], F.lit(CONTEXT_CHARS)).alias("before"))
        return F.struct(stop.alias("at"), F.concat(acc["found"], F.array(one)).alias("found"))

    pairs = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("piece"), matches.alias("span"))
    return F.when(F.size(matches) > 0, F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("found")), step, lambda a: a["found"])).otherwise(empty)


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(span: Column) -> Column:
    """Whether the digits of ``span`` pass the card check."""
    d = F.reverse(_digits(span))

    def step(total, k):
        x = F.substring(d, k, F.lit(1)).cast("int")
        twice = F.when(x > 4, x * 2 - 9).otherwise(x * 2)
        return total + F.when(k % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(d)), F.lit(0), step) % 10 == 0


def _base_rule(kind: str, span: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(span, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.char_length(_digits(span)).between(16, 19) & luhn(span)
    if kind == "phone":
        return F.char_length(_digits(span)).between(8, 15)
    return F.lit(True)


def _votes(kind: str, base: bool, x: Column) -> list[Column]:
    """Votes (1 yes, -1 no, 0 none) and span features of a candidate."""
    span, before = x["span"], x["before"]
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    digits = _digits(span)
    if kind == "email":
        host = F.lower(F.regexp_replace(F.regexp_extract(span, r"(?i)(?:@|\[at\]|\(at\)|\{at\})(.*)$", 1), r"(?i) ?[\[({]dot[\])}] ?", "."))
        check = vote(~host.rlike(r"(?:^|\.)-|-(?:\.|$)"), F.lit(True))
        known = vote(F.substring_index(F.trim(host), ".", -1).isin(*ENDS), F.substring_index(F.trim(host), ".", -1).rlike("^[0-9]+$"))
    elif kind == "ip":
        check = vote(~span.rlike(r"(?:^|[.:])0[0-9]"), F.lit(True))
        known = vote(span.rlike(r"^(?:10\.|127\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.)|^(?:2[0-9a-fA-F]{3}|f[cdCDeE])"), span.rlike(r"^0\.|^[0-9]\.[0-9]\.[0-9]\.[0-9]$"))
    elif kind == "card":
        check = vote(luhn(span), F.lit(True))
        known = vote(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"), digits.rlike("^0"))
    else:
        check = vote(F.lit(True) if base else digits.rlike("^[2-9][0-9]{2}[2-9]"), F.lit(True))
        known = vote(digits.rlike("^(?:" + "|".join(CODES) + ")") if base else span.rlike(r"^\([0-9]{3}\) "), digits.rlike("^0{2}"))
    context = vote(before.rlike(_FOR[kind]), before.rlike(_AGAINST))
    rule = F.lit(1 if base else 0)
    return [c.cast("int").alias(n) for n, c in zip(FEATURES, (
        rule, check, known, context,
        F.when(F.char_length(span) > 18, 1).otherwise(0), F.when(span.rlike(r"[ ().\[\]{}/_-]"), 1).otherwise(0),
        F.when(F.char_length(digits) * 2 > F.char_length(span), 1).otherwise(0)), strict=True)]


def _voted(found: Column, kind: str, base: bool) -> Column:
    if base:
        found = F.filter(found, lambda x: _base_rule(kind, x["span"]))
    return F.transform(found, lambda x: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"), F.lit(base).alias("base"), *_votes(kind, base, x)))


def _apart(loose: Column, base: Column) -> Column:
    return F.filter(loose, lambda x: ~F.exists(base, lambda y: (x["start"] < y["stop"]) & (y["start"] < x["stop"])))


def _count(found: Column, kind: int) -> Column:
    return F.size(F.filter(found, lambda x: x["base"] & (x["kind"] == kind))).cast("long")


def candidates(df: DataFrame, col: str, out: str) -> DataFrame:
    """Adds ``out``: array<struct<kind, start, stop, base, votes and features>>."""
    names = {(k, b): fresh(df, f"m_{k}_{int(b)}", f"p_{k}_{int(b)}") for k in KINDS for b in (True, False)}
    (text,) = fresh(df, "text_or_empty")
    df = df.withColumn(text, text_or_empty(col))
    forms = [(k, b, (BASE if b else LOOSE)[k], (_MARK if b else _LOOSE_MARK)[k]) for k in KINDS for b in (True, False)]
    df = df.withColumns({names[k, b][0]: _matches(F.col(text), p, mark) for k, b, p, mark in forms})
    none = F.array().cast("array<string>")
    df = df.withColumns({names[k, b][1]: F.when(F.size(names[k, b][0]) > 0, F.split(F.col(text), p, -1)).otherwise(none) for k, b, p, _ in forms})
    found = {}
    for k, b, _, _ in forms:
        found[names[k, b][0]] = _voted(_located(F.col(names[k, b][0]), F.col(names[k, b][1])), k, b)
    df = df.withColumns(found)
    # a loose candidate that touches a base span of its kind adds nothing
    parts = []
    for k in KINDS:
        base, loose = F.col(names[k, True][0]), F.col(names[k, False][0])
        parts += [base, _apart(loose, base)]
    return df.withColumn(out, F.concat(*parts)).drop(text, *(c for pair in names.values() for c in pair))


@dataclass
class Model:
    """Per kind: bias and one weight per feature; share and rates from the estimation."""

    weights: dict[int, list[float]]
    share: dict[int, float]
    rates: dict[int, list[dict[int, tuple[float, float]]]]

    def probability(self, x: Column) -> Column:
        def line(w):
            return F.lit(w[0]) + sum((F.lit(v) * x[f] for f, v in zip(FEATURES, w[1:], strict=True)), F.lit(0.0))

        z = F.lit(-30.0)
        for kind, w in self.weights.items():
            z = F.when(x["kind"] == kind, line(w)).otherwise(z)
        return 1.0 / (1.0 + F.exp(-z))


def fit(docs: DataFrame, col: str = "text") -> Model:
    (c,) = fresh(docs, "candidate")
    each = candidates(docs.select(F.col(col).alias("text")), "text", c).select(F.explode(c).alias("x")).select("x.*")
    # kinds, votes and features have few values: a bounded table, summed in each task first
    patterns = each.groupBy("kind", "base", *FEATURES).agg(F.count("*").alias("n")).collect()
    model = Model({}, {}, {})
    for kind in range(len(KINDS)):
        rows = sorted((tuple(r[f] for f in FEATURES), r["base"], r["n"]) for r in patterns if r["kind"] == kind)
        if not rows:
            continue
        share, rates, truth = _estimate(rows)
        model.share[kind], model.rates[kind] = share, rates
        model.weights[kind] = _logistic([x for x, _, _ in rows], truth, [n for _, _, n in rows])
    return model


def _estimate(rows) -> tuple[float, list, list[float]]:
    """Expectation-maximisation over vote patterns: share of true candidates,
    each labeler's rates of votes for true and false ones, posteriors of the rows.
    Priors stand for a few imagined candidates, so an unseen vote isn't impossible."""
    rates = [{1: (0.8, 0.2), -1: (0.1, 0.5), 0: (0.1, 0.3)} for _ in LABELERS]
    share, truth = 0.5, []
    for _ in range(ROUNDS):
        truth = []
        for x, _, _ in rows:
            t, f = math.log(share), math.log(1 - share)
            for j in range(len(LABELERS)):
                if x[j]:  # no vote tells nothing
                    t += math.log(rates[j][x[j]][0])
                    f += math.log(rates[j][x[j]][1])
            truth.append(1 / (1 + math.exp(min(500.0, f - t))))
        total = sum(n for _, _, n in rows)
        true = sum(p * n for p, (_, _, n) in zip(truth, rows, strict=True))
        share = (true + 2) / (total + 4)
        for j in range(len(LABELERS)):
            for side in (0, 1):
                w = [(p if side == 0 else 1 - p) * n for p, (_, _, n) in zip(truth, rows, strict=True)]
                yes = sum(v for v, (x, _, _) in zip(w, rows, strict=True) if x[j] == 1) + (8 if side == 0 else 2)
                no = sum(v for v, (x, _, _) in zip(w, rows, strict=True) if x[j] == -1) + (2 if side == 0 else 8)
                r = yes / (yes + no)
                for vote, value in ((1, r), (-1, 1 - r)):
                    old = rates[j][vote]
                    rates[j][vote] = (value, old[1]) if side == 0 else (old[0], value)
    return share, rates, truth


def _logistic(xs, truth, n) -> list[float]:
    """Weights (bias first) by gradient steps on the table of patterns, with a ridge."""
    total, w = sum(n), [0.0] * (len(FEATURES) + 1)
    for _ in range(400):
        grad = [0.02 * v for v in w]
        for x, t, c in zip(xs, truth, n, strict=True):
            z = w[0] + sum(a * b for a, b in zip(w[1:], x, strict=True))
            g = (1 / (1 + math.exp(-max(-50.0, min(50.0, z)))) - t) * c / total
            grad[0] += g
            for k, v in enumerate(x):
                grad[k + 1] += g * v
        w = [v - 0.8 * g for v, g in zip(w, grad, strict=True)]
    return w


def spans(df: DataFrame, model: Model, col: str = "text", out: str = "pii") -> DataFrame:
    """Adds ``out``: array<struct<kind, start, stop, base>> of base and accepted spans, by kind and start."""
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table already has {out}")
    df = candidates(df, col, out)
    kept = F.filter(out, lambda x: x["base"] | (model.probability(x) >= 0.5))
    return df.withColumn(out, F.array_sort(F.transform(kept, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"), x["base"].alias("base")))))


def listed(found: Column) -> Column:
    """kind:start:stop of spans, comma-joined in their order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def digests(df: DataFrame, model: Model, col: str = "text") -> DataFrame:
    """Adds the counts and digest of the base spans, and all spans as text."""
    (s,) = fresh(df, "pii_spans")
    df = spans(df, model, col, s)
    base = F.filter(s, lambda x: x["base"])
    return df.select(
        *[c for c in df.columns if c != s],
        *[_count(F.col(s), k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col(s)).alias("spans"))


def redact(df: DataFrame, model: Model, col: str = "text") -> DataFrame:
    """``col`` with every span replaced by its kind in angle brackets; null stays null."""
    (s,) = fresh(df, "pii_spans")
    df = spans(df, model, col, s)
    in_text = F.array_sort(F.transform(s, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    text = F.col(col)

    def step(acc, x):
        new = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.element_at(names, x["kind"] + 1))
        return F.struct(F.greatest(acc["at"], x["stop"]).alias("at"), F.when(x["start"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(in_text, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.char_length(text))))
    return df.withColumn(col, F.when(F.size(s) > 0, done).otherwise(text)).drop(s)
