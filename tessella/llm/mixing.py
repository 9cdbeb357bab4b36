"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.  Native."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, fresh, stored, words

MARGINS = ("source", "lang", "topic")
#: Targets by default: each margin's token share to this power (below 1 lifts small groups), normalised.
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.9}
#: Share of all tokens that a sample is expected to hold.
FRACTION = 0.8
ROUNDS = 400
#: Rounds end when no share is farther from its target than this (as a table, a round costs three joins, than
#: TABLE_TOLERANCE); targets count as met within MET.
TOLERANCE = 1e-12
TABLE_TOLERANCE = 1e-8
MET = 1e-6
#: Default targets that cannot be met together are moved towards the actual shares in these steps.
STRENGTHS = (1.0, 0.75, 0.5, 0.25, 0.0)
#: Up to this many (source, lang, topic) cells, 8 doubles each, are raked by the driver; more are raked as a table.
MAX_CELLS = 100_000
SEED = 20


def topic(text: Column) -> Column:
    """A coarse topic by surface form of the whole text: one of 'none', 'upper', 'table', 'symbols', 'numeric', 'prose'."""
    size = F.length(text)

    def by_marks(marks: Column) -> Column:
        count = lambda pattern: F.length(marks) - F.length(F.regexp_replace(marks, pattern, ""))
        return (
            F.when(2 * count("[A-Z]") > size, "upper")
            .when(20 * count(r"\|") > size, "table")
            .when(20 * count("[#*$%&<>]") > size, "symbols")
            .when(10 * count("[0-9]") > size, "numeric")
            .otherwise("prose")
        )

    # One pass over the text drops what is none of these and common; what it leaves is short.
    marks = F.array(F.translate(text, "abcdefghijklmnopqrstuvwxyz .,\n", ""))
    return F.when(text.isNull() | (F.trim(text) == ""), "none").otherwise(F.get(F.transform(marks, by_marks), F.lit(0)))


def _group(column: Column) -> Column:
    """Group name in which null is a group of its own."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def _shown(name: str) -> str:
    return "null" if name == "null" else name[1:]


@dataclass
class Fit:
    """Outcome of raking.

    ``cells``: (source, lang, topic, weight, probability), weight as fitted over actual share of tokens.
    ``strength``: how far from the actual shares to the targets the fit went (1: all the way).  ``margins``:
    farthest share from its target in each margin.
    """

    cells: DataFrame
    strength: float
    rounds: int
    margins: dict[str, float] = field(default_factory=dict)


def _goals(sums: dict[str, float], given: dict[str | None, float] | None, power: float, strength: float) -> dict[str, float]:
    """Target share of each group that has tokens; given ones are normalised, and 0 for groups not named."""
    total = sum(sums.values())
    if given is None:
        raw = {k: v**power for k, v in sums.items()}
    else:
        raw = {k: float(given.get(None if k == "null" else k[1:], 0.0)) for k in sums}
    whole = sum(raw.values())
    return {k: strength * raw[k] / whole + (1 - strength) * v / total for k, v in sums.items()}


def _check_given(margin: str, sums: dict[str, float], given: dict[str | None, float] | None) -> None:
    if given is None:
        return
    asked = {"null" if k is None else f"={k}": v for k, v in given.items()}
    if any(v < 0 for v in asked.values()) or sum(asked.values()) <= 0:
        raise ValueError(f"{margin} targets must not be negative, and some must be above 0")
    missing = sorted(_shown(k) for k, v in asked.items() if v > 0 and k not in sums)
    if missing:
        raise ValueError(f"{margin} targets for groups without tokens: {', '.join(missing[:10])}")


class _Held:
    """Cells in the driver's memory (at most MAX_CELLS)."""

    def __init__(self, cells: DataFrame):
        rows = sorted(tuple(r) for r in cells.select(*MARGINS, F.col("tokens").cast("double")).collect())
        self.spark, self.schema, self.rows = cells.sparkSession, "source string, lang string, topic string, weight double, probability double", rows
        self.tokens = np.array([r[3] for r in rows])
        self.names = [sorted({r[k] for r in rows}) for k in range(3)]
        place = [{g: i for i, g in enumerate(n)} for n in self.names]
        self.at = [np.array([place[k][r[k]] for r in rows], int) for k in range(3)]
        self.w = self.tokens / self.tokens.sum()

    def sums(self, k: int) -> dict[str, float]:
        return dict(zip(self.names[k], np.bincount(self.at[k], self.tokens, len(self.names[k])), strict=True))

    def rake(self, goals: list[dict[str, float]], rounds: int) -> tuple[int, list[float]]:
        want = [np.array([g[n] for n in names]) for g, names in zip(goals, self.names, strict=True)]
        w, done, off = self.tokens / self.tokens.sum(), 0, [0.0] * 3
        for done in range(1, rounds + 1):
            for k in range(3):
                now = np.bincount(self.at[k], w, len(want[k]))
                w = w * np.divide(want[k], now, out=np.zeros(len(now)), where=now > 0)[self.at[k]]
            off = [float(np.abs(np.bincount(self.at[k], w, len(want[k])) - want[k]).max()) for k in range(3)]
            if max(off) < TOLERANCE:
                break
        self.w = w
        return done, off

    def result(self, fraction: float) -> DataFrame:
        weight = self.w * self.tokens.sum() / self.tokens
        order = np.argsort(-weight, kind="stable")
        t, w = self.tokens[order], weight[order]
        # The k heaviest cells are kept whole; the rest share what is left in proportion to their weights.
        full = np.concatenate([[0.0], np.cumsum(t)])[:-1]
        rest = np.cumsum((t * w)[::-1])[::-1]
        scale = np.divide(fraction * t.sum() - full, rest, out=np.zeros(len(t)), where=rest > 0)
        fits = np.flatnonzero(scale * w <= 1 + 1e-12)
        scale = max(0.0, scale[fits[0]]) if len(fits) else np.inf
        p = np.where(weight > 0, np.minimum(1.0, scale * np.maximum(weight, 1e-300)), 0.0)
        return self.spark.createDataFrame([(*r[:3], float(a), float(b)) for r, a, b in zip(self.rows, weight, p, strict=True)], self.schema)


class _Table:
    """Cells as a table: one aggregation and join for each margin and round, written after every round."""

    def __init__(self, cells: DataFrame):
        self.start = cells.withColumn("tokens", F.col("tokens").cast("double"))
        self.total = float(self.start.agg(F.sum("tokens")).first()[0])
        self.own = [stored(self.start.groupBy(m).agg(F.sum("tokens").alias("tokens")), "margin") for m in MARGINS]
        self.now = None

    def sums(self, k: int) -> dict[str, float]:
        return _MarginTable(self.own[k])

    def rake(self, goals: list, rounds: int) -> tuple[int, list[float]]:
        now = stored(self.start.withColumn("w", F.col("tokens") / F.lit(self.total)), "cells")
        done, off = 0, [0.0] * 3
        for done in range(1, rounds + 1):
            new = now
            for m, goal in zip(MARGINS, goals, strict=True):
                sums = new.groupBy(m).agg(F.sum("w").alias("sum")).join(goal, m, "left")
                factor = F.when(F.col("sum") > 0, F.coalesce("goal", F.lit(0.0)) / F.col("sum")).otherwise(0.0)
                new = new.join(sums.select(m, factor.alias("factor")), m).withColumn("w", F.col("w") * F.col("factor")).select(*MARGINS, "tokens", "w")
            new = stored(new, "cells")
            discard(now)
            now = new
            off = [now.groupBy(m).agg(F.sum("w").alias("sum")).join(g, m, "full").agg(F.max(F.abs(F.coalesce("sum", F.lit(0.0)) - F.coalesce("goal", F.lit(0.0))))).first()[0] for m, g in zip(MARGINS, goals, strict=True)]
            if max(off) < TABLE_TOLERANCE:
                break
        if self.now is not None:
            discard(self.now)
        self.now = now
        return done, off

    def result(self, fraction: float) -> DataFrame:
        weights = self.now.withColumn("weight", F.col("w") * F.lit(self.total) / F.col("tokens"))
        scale, want = 0.0, fraction * self.total
        for _ in range(100):
            over = F.col("weight") * F.lit(scale) >= 1
            r = weights.agg(F.sum(F.when(over, F.col("tokens"))).alias("full"), F.sum(F.when(~over, F.col("weight") * F.col("tokens"))).alias("open")).first()
            new = max(0.0, want - (r["full"] or 0.0)) / r["open"] if r["open"] else scale
            if abs(new - scale) <= 1e-12 * scale:
                break
            scale = max(new, scale)
        return weights.select(*MARGINS, "weight", F.least(F.lit(1.0), F.col("weight") * F.lit(scale)).alias("probability"))


class _MarginTable:
    """Sums of one margin as a table, and the goals that follow from them."""

    def __init__(self, table: DataFrame):
        self.table = table

    def goals(self, given: dict[str | None, float] | None, power: float, strength: float) -> DataFrame:
        name, total = self.table.columns[0], self.table.agg(F.sum("tokens")).first()[0]
        if given is None:
            raw = F.pow("tokens", F.lit(power))
            with_raw = self.table.withColumn("raw", raw)
        else:
            asked = self.table.sparkSession.createDataFrame([("null" if k is None else f"={k}", float(v)) for k, v in given.items()], f"{name} string, raw double")
            with_raw = self.table.join(asked, name, "left").fillna(0.0, ["raw"])
        whole = with_raw.agg(F.sum("raw")).first()[0]
        return with_raw.select(name, (F.lit(strength) * F.col("raw") / F.lit(whole) + F.lit(1 - strength) * F.col("tokens") / F.lit(total)).alias("goal"))

    def names(self, given: dict[str | None, float]) -> dict[str, float]:
        """Sums of the groups that ``given`` names."""
        wanted = ["null" if k is None else f"={k}" for k in given]
        name = self.table.columns[0]
        return {r[0]: r[1] for r in self.table.where(F.col(name).isin(wanted)).collect()}


def fit(
    cells: DataFrame,
    targets: dict[str, dict[str | None, float]] | None = None,
    temper: dict[str, float] = TEMPER,
    fraction: float = FRACTION,
    rounds: int = ROUNDS,
    max_cells: int = MAX_CELLS,
) -> Fit:
    """Rake (source, lang, topic, tokens) cells, group names as by :func:`mix`, to the three margins.

    ``targets`` may give shares for 'source', 'lang' or 'topic' (normalised; groups not named: 0); other margins
    have their tempered shares as targets.  Given targets that cannot be met together raise a ValueError that names
    the groups; if the tempered ones cannot, they are moved towards the actual shares, which always can, and
    ``strength`` tells how far.  Probabilities are proportional to weights, cut at 1 with the rest raised for it, so
    that the expected tokens of a sample are ``fraction`` of all (or all tokens of positive weight, if fewer).
    """
    given = targets or {}
    if set(given) - set(MARGINS):
        raise ValueError(f"targets are for {', '.join(MARGINS)}")
    cells = cells.where("tokens > 0")
    n = cells.count()
    if not n:
        empty = "source string, lang string, topic string, weight double, probability double"
        return Fit(cells.sparkSession.createDataFrame([], empty), 1.0, 0, dict.fromkeys(MARGINS, 0.0))
    table = _Held(cells) if n <= max_cells else _Table(cells)
    sums = [table.sums(k) for k in range(3)]
    for k, m in enumerate(MARGINS):
        _check_given(m, sums[k].names(given[m]) if m in given and isinstance(sums[k], _MarginTable) else sums[k], given.get(m))
    for strength in STRENGTHS:
        # Given targets are kept as they are; only tempered ones may be moved.
        power = lambda m: 1.0 if m in given else strength  # noqa: B023, E731
        goals = [s.goals(given.get(m), temper[m], power(m)) if isinstance(s, _MarginTable) else _goals(s, given.get(m), temper[m], power(m)) for m, s in zip(MARGINS, sums, strict=True)]
        done, off = table.rake(goals, rounds)
        if max(off) <= MET:
            return Fit(table.result(fraction), strength, done, dict(zip(MARGINS, off, strict=True)))
        if len(given) == 3:
            break
    worst = ", ".join(f"{m}: off by {x:.4f}" for m, x in zip(MARGINS, off, strict=True))
    raise ValueError(f"targets for {', '.join(sorted(given))} cannot be met together ({worst}); groups: {_far(table, goals)}")


def _far(table: _Held | _Table, goals: list) -> str:
    """The groups farthest from their targets, for an error message."""
    out = []
    for k, m in enumerate(MARGINS):
        if isinstance(table, _Held):
            now = np.bincount(table.at[k], table.w, len(table.names[k]))
            out += [(abs(x - goals[k][g]), f"{m}={_shown(g)} {x:.4f} of {goals[k][g]:.4f}") for g, x in zip(table.names[k], now, strict=True)]
        else:
            both = table.now.groupBy(m).agg(F.sum("w").alias("sum")).join(goals[k], m).withColumn("far", F.abs(F.col("sum") - F.col("goal")))
            out += [(r["far"], f"{m}={_shown(r[m])} {r['sum']:.4f} of {r['goal']:.4f}") for r in both.orderBy(F.desc("far")).limit(3).collect()]
    return "; ".join(x for _, x in sorted(out, reverse=True)[:5])


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic_of: Column | None = None,
    tokens_of: Column | None = None,
    seed: int = SEED,
    **options,
) -> DataFrame:
    """``docs`` with topic, weight, probability and selected columns.

    ``weight`` is the fitted weight of a token of the row (fitted share over actual share), ``probability``
    the chance to be kept, ``selected`` whether a hash of the id (of the text, without an id) falls below it, so
    copies of an id share their fate and a rerun gives the same sample.  Null sources, languages and topics are groups of their
    own.  Texts without words hold no tokens and have no say in the fit; those of a cell without any tokens get
    weight and probability 0.  Names that ``docs`` already has get an underscore.  An empty table stays empty.
    """
    names = {x: fresh(docs, x) for x in ("topic", "weight", "probability", "selected")}
    kind = topic(F.col(text_col)) if topic_of is None else topic_of
    tokens = F.size(words(F.col(text_col))) if tokens_of is None else tokens_of
    cells = stored(
        docs.select(_group(F.col(source_col)).alias("source"), _group(F.col(lang_col)).alias("lang"), _group(kind).alias("topic"), tokens.cast("long").alias("tokens"))
        .groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")),
        "cells",
    )
    options = {"max_cells": MAX_CELLS, **options}
    found = stored(fit(cells, **options).cells, "fitted")
    small = cells.count() <= options["max_cells"]
    discard(cells)
    keys = [fresh(docs, f"{m}_key") for m in MARGINS]
    fitted = found.toDF(*keys, names["weight"], names["probability"])
    out = docs.withColumns({keys[0]: _group(F.col(source_col)), keys[1]: _group(F.col(lang_col)), names["topic"]: kind})
    # At most max_cells rows are broadcast; more are joined as a table (skewed keys are split by adaptive execution).
    out = out.withColumn(keys[2], _group(F.col(names["topic"]))).join(F.broadcast(fitted) if small else fitted, keys, "left")
    out = out.fillna(0.0, [names["weight"], names["probability"]])
    # 52 bits of the id's md5 (of the text's, without an id) as a fraction.
    who = F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.md5(text_col)), F.lit(str(seed)))
    draw = F.conv(F.substring(F.md5(who), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    return out.withColumn(names["selected"], draw < F.col(names["probability"])).select(*docs.columns, *names.values())
