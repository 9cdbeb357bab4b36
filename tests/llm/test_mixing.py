import random
import re
from collections import defaultdict

import pytest

from tessella.llm import mixing


def brute_fit(cells, goals, fraction):
    """Plain raking of {(source, lang, topic): tokens} to three margins, then the scale."""
    w = {c: t / sum(cells.values()) for c, t in cells.items()}
    for _ in range(4000):
        for k in range(3):
            now = defaultdict(float)
            for c, v in w.items():
                now[c[k]] += v
            w = {c: v * goals[k][c[k]] / now[c[k]] if now[c[k]] else 0.0 for c, v in w.items()}
    total = sum(cells.values())
    rate = {c: w[c] / t for c, t in cells.items() if t}
    lo, hi = 0.0, 1e12
    for _ in range(300):
        mid = (lo + hi) / 2
        if sum(min(1, mid * r) * cells[c] for c, r in rate.items()) < fraction * total:
            lo = mid
        else:
            hi = mid
    return {c: r * total for c, r in rate.items()}, {c: min(1, hi * r) for c, r in rate.items()}


def goals_of(cells):
    out = []
    for k, power in enumerate((mixing.TEMPER["source"], mixing.TEMPER["lang"], mixing.TEMPER["topic"])):
        sums = defaultdict(float)
        for c, t in cells.items():
            sums[c[k]] += t
        raw = {g: v**power for g, v in sums.items()}
        out.append({g: v / sum(raw.values()) for g, v in raw.items()})
    return out


def test_equal_to_plain_raking(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    cells = defaultdict(float)
    for r in rows:
        cells[r.source, r.lang, r.topic] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    weight, probability = brute_fit(cells, goals_of(cells), mixing.FRACTION)
    for r in rows:
        c = (r.source, r.lang, r.topic)
        assert r.weight == pytest.approx(weight[c], rel=1e-3)
        assert r.probability == pytest.approx(probability[c], rel=1e-3)
    again = {(r.doc_id, r.selected) for r in mixing.mix(docs.repartition(3)).collect()}
    assert again == {(r.doc_id, r.selected) for r in rows}


def test_sample_meets_its_probabilities(spark):
    rng = random.Random(7)
    rows = [(i, "w " * rng.randint(1, 30), rng.choice("ab"), rng.choice("xyz")) for i in range(6000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), fraction=0.5, targets={"lang": {"a": 0.8, "b": 0.2}}).collect()
    tokens = lambda r: len(r.text.split())
    total, kept = sum(map(tokens, got)), sum(tokens(r) for r in got if r.selected)
    assert abs(kept / total - 0.5) < 0.03
    share = sum(r.weight * tokens(r) for r in got if r.lang == "a") / sum(r.weight * tokens(r) for r in got)
    assert share == pytest.approx(0.8, abs=1e-5)


def test_nulls_and_odd_tables(spark, odd_docs, no_docs):
    got = mixing.mix(odd_docs)
    assert got.count() == odd_docs.count() and got.columns[: len(odd_docs.columns)] == odd_docs.columns
    assert all(0 <= r.probability <= 1 for r in got.collect())
    assert mixing.mix(no_docs).count() == 0


def cells_of(spark, rows):
    return spark.createDataFrame([(f"={a}", f"={b}", f"={c}", t) for a, b, c, t in rows], "source string, lang string, topic string, tokens long")


@pytest.mark.parametrize("targets", [None, {"lang": {"x": 0.5, "y": 0.3, "z": 0.2}}])
def test_beyond_the_drivers_cells_the_result_is_the_same(spark, targets):
    rng = random.Random(3)
    cells = cells_of(spark, [(a, b, c, rng.randint(0, 90)) for a in "abcde" for b in "xyz" for c in "pq"])
    both = []
    for most in (1000, 0):
        found = mixing.fit(cells, targets, max_cells=most)
        assert found.strength == 1 and max(found.margins.values()) <= mixing.MET
        both.append({(r.source, r.lang, r.topic): (r.weight, r.probability) for r in found.cells.collect()})
    assert both[0].keys() == both[1].keys()
    assert all(both[0][k] == pytest.approx(both[1][k], abs=1e-6) for k in both[0])


@pytest.mark.parametrize("most", [1000, 0])
def test_targets_that_cannot_be_met(spark, most):
    """Only x is in source a and only y in b: given margins that conflict are an error, tempered ones are softened."""
    cells = cells_of(spark, [("a", "x", "p", 90), ("b", "y", "p", 10)])
    with pytest.raises(ValueError, match="cannot be met together.*source=b"):
        mixing.fit(cells, {"source": {"a": 0.2, "b": 0.8}, "lang": {"x": 0.5, "y": 0.5}}, rounds=4, max_cells=most)
    with pytest.raises(ValueError, match="without tokens: z"):
        mixing.fit(cells, {"lang": {"z": 1.0}}, max_cells=most)
    with pytest.raises(ValueError, match="above 0"):
        mixing.fit(cells, {"lang": {"x": 0.0}}, max_cells=most)
    soft = mixing.fit(cells, temper={"source": 0.2, "lang": 1.0, "topic": 1.0}, rounds=4, max_cells=most)
    assert soft.strength == 0 and max(soft.margins.values()) <= mixing.MET
    assert all(r.weight == pytest.approx(1) and r.probability == pytest.approx(mixing.FRACTION) for r in soft.cells.collect())


def test_topics(spark):
    texts = ["", "  ", None, "ABC DEF g", "a|b|c d e f", "# # a b c d e f", "call 12345 now ok", "plain words É only"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    from pyspark.sql import functions as F

    def plain(t):
        if not (t or "").strip(" "):
            return "none"
        count = lambda chars: len(re.findall(f"[{chars}]", t))
        return next((k for k, m, c in (("upper", 2, "A-Z"), ("table", 20, "|"), ("symbols", 20, "#*$%&<>"), ("numeric", 10, "0-9")) if m * count(c) > len(t)), "prose")

    got = [r.k for r in df.select("i", mixing.topic(F.col("text")).alias("k")).orderBy("i").collect()]
    assert got == [plain(t) for t in texts] and set(got) == {"none", "upper", "table", "symbols", "numeric", "prose"}
