"""Personal data: fixed patterns, plus spans found by weak supervision.  DataFrame functions only.

Labelers of three sorts (patterns, gazetteers, context) vote on loose candidates.  Expectation-maximisation
over the counts of vote patterns estimates how reliable each is; a logistic span classifier is trained on
the resulting probabilities and decides which candidates are added to the fixed patterns' spans.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

KINDS = ("email", "ip", "card", "phone")
#: Kinds of added spans that the fixed patterns do not know; they sort behind the others.
MORE_KINDS = ("number", "secret")
#: The fixed patterns, written so that a failed start is not tried again inside a run of characters.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_IP = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
_EMAIL = r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$"

#: Candidates: digit groups, strings around an @, long runs of letters and digits.  A group ends after 31 digits,
#: with all digits that follow without a gap: an open count of gaps would read long rows of numbers again and again.
CANDIDATES = (
    r"(?<![0-9A-Za-z.])\+?\(?[0-9](?:[\x20().-]{0,3}[0-9]){6,30}+[0-9]*+(?![0-9A-Za-z@])"
    r"|(?<![^\x20\x09-\x0D@])[^\x20\x09-\x0D@]++@[^\x20\x09-\x0D@]++"
    r"|(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}+(?![A-Za-z0-9+/_=-])"
)
CONTEXT = 32
#: Matches of a text that are taken together.
CHUNK = 64
#: Gazetteers: top-level domains, calling codes, card issuers.
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|ch|at|nl|be|pl|ru|us|ca|au|jp|cn|br|mx"
CALLING = "1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65"
FOR_IT = r"(?i)\b(?:e-?mail|mail|tel|phone|call|fax|mobile|contact|card|visa|account|iban|ip|host|token|key|secret|password|passwd|ssn|login|user)\b\W*$"
AGAINST_IT = r"(?i)\b(?:version|licen[cs]e|page|chapter|isbn|issn|doi|figure|fig|section|article|no|line|item|year|size|width|height)\b\W*$"

SHAPES = ("email", "plus", "quad", "digits", "mixed")
LENGTHS = (9, 12, 16, 24, 36)
TRAITS = 5 + 6 + 4 + 1 + 2 + 1 + 2
#: Candidates' worth of belief that half of a shape is personal data.
PSEUDO = 20.0
LABELERS = ("email_pattern", "phone_pattern", "card_pattern", "ip_pattern", "secret_pattern", "gazetteer", "context_for", "context_against", "few_digits")
SPAN = "array<struct<start:int,end:int,m:string,before:string>>"


def matches(text: Column, pattern: str, guard: Column) -> Column:
    """Struct of the gaps between matches of a pattern and the matches; null where ``guard`` fails."""
    return F.when(guard, F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")))


def _chunks(n: Column) -> Column:
    """Numbers of the chunks of ``CHUNK`` that n > 0 items fall into."""
    return F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int"))


def _inside(chunk: Column, n: Column) -> Column:
    """Places of the items of a chunk."""
    return F.sequence(chunk * CHUNK, F.least(chunk * CHUNK + (CHUNK - 1), n - 1))


def _before(values: Column, zero: Column, merge) -> Column:
    """For each value, what ``merge`` makes of those before it."""
    start = F.struct(zero.alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda a, x: F.struct(merge(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
    return F.aggregate(values, start, step)["out"]


def placed(pair: Column) -> Column:
    """Spans (start, end in code points, the match, what stands before it) from :func:`matches`; ``pair`` must be a column.

    Matches are taken in chunks, each from the sum of the lengths before it, so a text with many is not copied
    over and over.
    """
    n = F.size(pair["found"])
    size = lambda i: F.length(F.get(pair["gaps"], i)) + F.length(F.get(pair["found"], i))
    sizes = F.transform(_chunks(n), lambda c: F.aggregate(_inside(c, n), F.lit(0), lambda a, i: a + size(i)))
    begins = F.array(_before(sizes, F.lit(0), lambda a, x: a + x))

    def step(acc: Column, i: Column) -> Column:
        gap, m = F.get(pair["gaps"], i), F.get(pair["found"], i)
        start = acc["at"] + F.length(gap)
        end = start + F.length(m)
        span = F.struct(start.alias("start"), end.alias("end"), m.alias("m"), F.right(gap, F.lit(CONTEXT)).alias("before"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def spans(at: Column) -> Column:
        one = lambda begin, c: F.aggregate(_inside(c, n), F.struct(begin.alias("at"), F.array().cast(SPAN).alias("out")), step)["out"]
        return F.flatten(F.transform(at, one))

    return F.when(pair.isNotNull() & (n > 0), F.get(F.transform(begins, spans), F.lit(0))).otherwise(F.array().cast(SPAN))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    return {"email": F.lit(True), "ip": m.rlike(_IP), "card": F.call_function("luhn_check", _digits(m)), "phone": n.between(9, 15)}[kind]


def shape(m: Column) -> Column:
    return (
        F.when(m.contains("@"), "email").when(m.startswith("+"), "plus").when(m.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), "quad")
        .when(m.rlike(r"^[\x20().0-9-]+$"), "digits").otherwise("mixed")
    )


def votes(m: Column, before: Column) -> list[Column]:
    """One vote of each labeler: 1 for personal data, 0 against it, -1 to abstain."""
    kind, digits = shape(m), _digits(m)
    n = F.length(digits)
    return [
        F.when(kind == "email", F.when(m.rlike(_EMAIL), 1).otherwise(0)).otherwise(-1),
        F.when(kind == "plus", F.when(n.between(9, 15), 1).otherwise(0)).otherwise(-1),
        F.when((kind == "digits") & n.between(12, 19), F.when(F.call_function("luhn_check", digits), 1).otherwise(0)).otherwise(-1),
        F.when(kind == "quad", F.when(m.rlike(_IP), 1).otherwise(0)).otherwise(-1),
        F.when(kind == "mixed", F.when((F.length(m) >= 32) & m.rlike("[0-9]") & m.rlike("[A-Za-z]"), 1).otherwise(0)).otherwise(-1),
        F.when(kind == "email", F.when(m.rlike(rf"(?i)\.(?:{DOMAINS})\W*$"), 1).otherwise(0))
        .when(kind == "plus", F.when(digits.rlike(f"^(?:{CALLING})"), 1).otherwise(0))
        .when((kind == "digits") & n.between(13, 19) & digits.rlike(f"^(?:{ISSUERS})"), 1).otherwise(-1),
        F.when(before.rlike(FOR_IT), 1).otherwise(-1),
        F.when(before.rlike(AGAINST_IT), 0).otherwise(-1),
        F.when((kind == "digits") & (n < 12), 0).otherwise(-1),
    ]


def traits(m: Column, before: Column) -> Column:
    """Features of the span classifier as one code: shape, length, share of digits, Luhn, mixed case, words and mark before it."""
    size, digits = F.length(m), _digits(m)
    length = F.lit(0)
    for limit in LENGTHS:
        length = length + F.when(size >= limit, 1).otherwise(0)
    share = F.least(F.lit(3), F.floor(4 * F.length(digits) / size).cast("int"))
    context = F.when(before.rlike(FOR_IT), 1).when(before.rlike(AGAINST_IT), 2).otherwise(0)
    code = F.array_position(F.array(*(F.lit(s) for s in SHAPES)), shape(m)).cast("int") - 1
    luhn = F.when(F.call_function("luhn_check", digits), 1).otherwise(0)
    case = F.when(m.rlike("[a-z]") & m.rlike("[A-Z]"), 1).otherwise(0)
    mark = F.when(before.rlike(r"[:=]\W*$"), 1).when(before.rlike(r"[A-Za-z]{2}[\x20\x09-\x0D]*$"), 2).otherwise(0)
    return (((((code * 6 + length) * 4 + share) * 2 + luhn) * 3 + context) * 2 + case) * 3 + mark


def vector(code: int) -> np.ndarray:
    """One-hot features of a traits code."""
    code, mark = divmod(code, 3)
    code, case = divmod(code, 2)
    code, context = divmod(code, 3)
    code, luhn = divmod(code, 2)
    code, share = divmod(code, 4)
    kind, length = divmod(code, 6)
    x = np.zeros(TRAITS)
    x[kind] = x[5 + length] = x[11 + share] = 1
    x[15], x[18] = luhn, case
    if context:
        x[15 + context] = 1
    if mark:
        x[18 + mark] = 1
    return x


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], shapes: list[int] | None = None, rounds: int = 100) -> tuple[np.ndarray, list[float]]:
    """EM over vote patterns and their counts: accuracy of each labeler, P(personal | pattern).

    Labelers are taken as independent given the class.  The share of personal data is estimated for each shape of
    candidates, drawn to a half by PSEUDO candidates and kept between 0.1 and 0.5; an accuracy stays between 0.55
    and 0.99.  So a labeler that never meets another cannot be turned round, and a common class cannot swallow the
    votes against it (where one labeler speaks alone, its accuracy and the share cannot both be told).
    """
    if not patterns:
        return np.full(len(LABELERS), 0.8), []
    v = np.array([p for p, _ in patterns])
    n = np.array([c for _, c in patterns], np.float64)
    of = np.array(shapes if shapes is not None else [0] * len(patterns))
    told = v >= 0
    accuracy = np.full(v.shape[1], 0.8)
    prior = np.full(of.max() + 1, 0.5)
    q = np.full(len(v), 0.5)
    for _ in range(rounds):
        odds = np.log(accuracy / (1 - accuracy))
        logit = np.log(prior / (1 - prior))[of] + np.where(told, np.where(v == 1, odds, -odds), 0.0).sum(1)
        q = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        right = np.where(v == 1, q[:, None], 1 - q[:, None])
        pseudo = 5.0
        accuracy = np.clip(((n[:, None] * told * right).sum(0) + 0.8 * pseudo) / ((n[:, None] * told).sum(0) + pseudo), 0.55, 0.99)
        prior = np.clip((np.bincount(of, n * q) + PSEUDO / 2) / (np.bincount(of, n) + PSEUDO), 0.1, 0.5)
    return accuracy, list(q)


def fit_classifier(groups: list[tuple[int, float, float]], rounds: int = 400, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on (traits code, spans, expected personal spans), a bounded table."""
    if not groups:
        return np.zeros(TRAITS), -10.0
    x = np.array([vector(c) for c, _, _ in groups])
    n = np.array([g[1] for g in groups], np.float64)
    y = np.array([g[2] for g in groups], np.float64) / n
    n = n / n.sum()
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        g = n * (p - y)
        h = np.maximum(n * p * (1 - p), 1e-9)
        a = np.hstack([x, np.ones((len(x), 1))])
        full = a.T @ (a * h[:, None]) + penalty * np.eye(a.shape[1])
        move = np.linalg.solve(full, a.T @ g + penalty * np.append(w, 0))
        w, b = w - 0.5 * move[:-1], b - 0.5 * move[-1]
        if np.abs(move).max() < 1e-9:
            break
    return w, float(b)


def annotated(docs: DataFrame, text_col: str, taken: str = "_pii") -> DataFrame:
    """``docs`` with columns base and candidates (arrays of structs) under the prefix ``taken``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digit = text.rlike("[0-9]")
    guards = {"email": text.contains("@"), "ip": digit, "card": digit, "phone": text.contains("+")}
    pairs = docs.withColumns({f"{taken}_{k}": matches(text, PATTERNS[k], guards[k]) for k in KINDS} | {f"{taken}_any": matches(text, CANDIDATES, digit | guards["email"])})
    spans = pairs.withColumns({f"{taken}_{k}": placed(F.col(f"{taken}_{k}")) for k in (*KINDS, "any")})

    def of(kind: str) -> Column:
        good = F.filter(F.col(f"{taken}_{kind}"), lambda s: _valid(kind, s["m"]))
        return F.transform(good, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))

    base = F.array_sort(F.concat(*(of(k) for k in KINDS)))
    loose = F.transform(
        F.col(f"{taken}_any"),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), shape(s["m"]).alias("shape"), F.array(*votes(s["m"], s["before"])).alias("votes"), traits(s["m"], s["before"]).alias("traits")),
    )
    return spans.withColumns({f"{taken}_base": base, f"{taken}_loose": loose}).drop(*(f"{taken}_{k}" for k in (*KINDS, "any")))


def fit(table: DataFrame, loose: str) -> dict[int, float]:
    """Probability of each traits code seen, from the candidates of all documents.

    Two aggregations gather at most 5 * 3 ** 9 vote patterns (each shape allows few) and 4,320 traits codes.
    """
    spans = table.select(F.explode(loose).alias("s")).select("s.shape", "s.votes", "s.traits")
    found = sorted((SHAPES.index(r["shape"]), tuple(r["votes"]), r["n"]) for r in spans.groupBy("shape", "votes").agg(F.count("*").alias("n")).collect())
    if not found:
        return {}
    _, q = reliabilities([(p, n) for _, p, n in found], [k for k, _, _ in found])
    key = F.concat_ws(",", "shape", F.transform(F.col("votes"), lambda v: v.cast("string")))
    known = table.sparkSession.createDataFrame([(",".join([SHAPES[k], *map(str, p)]), float(x)) for (k, p, _), x in zip(found, q, strict=True)], "key string, q double")
    joined = spans.withColumn("key", key).join(F.broadcast(known), "key")  # at most 5 * 3 ** 9 patterns
    groups = sorted((r["traits"], r["n"], r["q"]) for r in joined.groupBy("traits").agg(F.count("*").alias("n"), F.sum("q").alias("q")).collect())
    w, b = fit_classifier(groups)
    return {c: float(1 / (1 + math.exp(-float(vector(c) @ w + b)))) for c, _, _ in groups}


def all_spans(base: Column, loose: Column, model: dict[int, float], threshold: float = 0.5) -> Column:
    """Base spans and the candidates that the classifier takes and no base span overlaps, sorted."""
    taken = [c for c, p in sorted(model.items()) if p >= threshold]
    rank = lambda s: F.when(s == "email", 0).when(s == "quad", 1).when(s == "plus", 3).when(s == "digits", 4).otherwise(5)
    wanted = F.filter(loose, lambda s: s["traits"].isin(taken) if taken else F.lit(False))
    free = F.filter(wanted, lambda s: ~F.exists(base, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"])))
    return F.array_sort(F.concat(base, F.transform(free, lambda s: F.struct(s["start"].alias("start"), rank(s["shape"]).alias("kind"), s["end"].alias("end")))))


def joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in (*KINDS, *MORE_KINDS)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans) for every row; no shuffle of rows.

    Counts and digest are of the fixed patterns.  ``spans`` also has what the classifier adds, kinds number
    and secret behind the others; ``n_spans`` counts them all.  Null texts are empty.  Texts are read whole, once; repeated rows each get
    their row; an empty table gives none.  Columns of other names are not read.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    table = stored(annotated(narrow, "text", "p").select("id", "p_base", "p_loose"), "spans")
    model = fit(table, "p_loose")
    count = lambda k: F.size(F.filter("p_base", lambda s: s["kind"] == k)).cast("long")
    return table.withColumn("p_all", all_spans(F.col("p_base"), F.col("p_loose"), model, threshold)).select(
        F.col("id").alias(id_col),
        *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(joined(F.col("p_base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("p_all")).alias("spans"),
        F.size("p_all").cast("long").alias("n_spans"),
    )


def redact(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars", threshold: float = 0.5) -> DataFrame:
    """``docs`` with each span of :func:`find` replaced by its kind in brackets; overlapping spans as one.

    ``size_col`` (if present) becomes the new number of characters where the text changed.  Columns and their
    order stay; null texts stay null.
    """
    prefix = "pii"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    # Rows without candidates are left out later: a filter here would be pushed below and search the text again.
    table = stored(annotated(docs.select(text_col), text_col, prefix).select(f"{prefix}_loose"), "spans")
    model = fit(table, f"{prefix}_loose")
    names = F.array(*(F.lit(f"[{k}]") for k in (*KINDS, *MORE_KINDS)))
    out, spans = annotated(docs, text_col, prefix), f"{prefix}_spans"
    out = out.withColumn(spans, all_spans(F.col(f"{prefix}_base"), F.col(f"{prefix}_loose"), model, threshold))
    text = F.col(text_col)

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        more = F.when(apart, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"]))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("out"))

    # In chunks of spans, each from the end of all spans before it.
    n = F.size(spans)
    parts = F.transform(_chunks(n), lambda c: F.slice(F.col(spans), c * CHUNK + 1, F.lit(CHUNK)))
    ends = F.transform(parts, lambda x: F.array_max(F.transform(x, lambda s: s["end"])))
    starts = _before(ends, F.lit(0), lambda a, x: F.greatest(a, x))
    pieces = F.zip_with(parts, starts, lambda x, at: F.aggregate(x, F.struct(at.alias("at"), F.lit("").alias("out")), step)["out"])
    last = F.array_max(F.transform(F.col(spans), lambda s: s["end"]))
    done = F.concat(F.array_join(pieces, ""), F.substring(text, last + 1, F.length(text)))
    # Computed once, as a column of its own.
    fresh_text = f"{prefix}_text"
    out = out.withColumn(fresh_text, F.when(F.size(spans) > 0, done).otherwise(text))
    changed = {text_col: F.col(fresh_text)}
    if size_col and size_col in docs.columns:
        changed[size_col] = F.when(F.size(spans) > 0, F.length(fresh_text).cast(docs.schema[size_col].dataType)).otherwise(F.col(size_col))
    return out.withColumns(changed).select(*docs.columns)
