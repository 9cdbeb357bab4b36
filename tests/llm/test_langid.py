import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from tessella.llm import langid
from tessella.llm.common import bucket


def run(docs, train=None):
    held = bucket(F.col("doc_id"), 5) == 0
    train = docs if train is None else train
    rows = langid.training_rows(train, "doc_id", "text", "lang", ~held, langid.MAX_TRAIN_ROWS)
    return langid.identify(docs, langid.fit(rows), carry=(("held_out", held),))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = run(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 150 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_texts(spark, sf, odd_docs, no_docs):
    train = spark.read.parquet(f"{sf}/documents.parquet")
    got = {}
    for r in run(odd_docs, train).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert len(got[4]) == 2 and got[4][0] == got[4][1] and got[4][0][0] != "und"
    assert all(got[i] == [("und", 0.0)] for i in (1, 2, 3, 7))
    assert run(no_docs, train).count() == 0
    assert {r.lang_pred for r in run(train.where("doc_id < 5"), no_docs).collect()} == {"und"}


def test_profile_in_pieces_equals_whole(monkeypatch):
    rng = random.Random(14)
    text = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(400)).encode()
    whole = langid.profile(text)
    monkeypatch.setattr(langid.pieces, "__defaults__", (64,))
    assert np.allclose(whole, langid.profile(text), atol=1e-6)


def test_levels():
    rng = np.random.default_rng(15)
    langs = ["en", "de", "fr", "es", "xx"]
    centre = {c: rng.normal(size=langid.DIM) for c in langs}
    x = np.array([centre[c] + 0.5 * rng.normal(size=langid.DIM) for c in langs for _ in range(30)], np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    model = langid.Model(x, [c for c in langs for _ in range(30)])
    assert model.families == [["de", "en"], ["es", "fr"], ["xx"]]
    assert [len(p) for p in model.lang_pairs] == [1, 1, 0] and len(model.family_pairs) == 3
    got, score = model.predict(x)
    assert got == [c for c in langs for _ in range(30)] and (score > 0.5).all()


def brute_profile(text, dim):
    """Square roots of the counts of hashed n-grams within words and over one edge, as a unit vector."""
    data = [32, *text.encode(), 32]
    code = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in data]
    counts = [0.0] * dim
    for n in (1, 2, 3, 4):
        for i in range(len(code) - n + 1):
            gram = code[i : i + n]
            if any(c == 0 for c in gram[1:-1]) or not any((gram[0], gram[-1])):
                continue
            value = 0
            for c in gram:
                value = (value * 257 + c) % 2**32
            counts[(value + n * 0x9E3779B1) * 2654435761 % 2**32 >> (32 - dim.bit_length() + 1)] += 1
    norm = math.sqrt(sum(counts))
    return [math.sqrt(c) / norm for c in counts]


def brute_predict(model, x):
    """Family by all pairs of families, then language by all pairs within it; a pair's share is a logistic of its margin."""

    def shares(names, first):
        if len(names) == 1:
            return [1.0]
        won = [1e-12] * len(names)
        for k, (i, j) in enumerate(itertools.combinations(range(len(names)), 2)):
            s = model.svm
            margin = sum(a * float(b) for a, b in zip(x, s.weights[:, first + k], strict=True) if a) + s.bias[first + k]
            p = 1 / (1 + math.exp(-max(-30, min(30, margin * s.scale[first + k]))))
            won[i] += p
            won[j] += 1 - p
        total = sum(w * w for w in won)
        return [w * w / total for w in won]

    family = shares(model.families, 0)
    best = family.index(max(family))
    first = len(model.family_pairs) + sum(len(p) for p in model.lang_pairs[:best])
    own = shares(model.families[best], first)
    return model.families[best][own.index(max(own))], family[best] * max(own)


def test_whole_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = bucket(F.col("doc_id"), 5) == 0
    model = langid.fit(langid.training_rows(docs, "doc_id", "text", "lang", ~held, langid.MAX_TRAIN_ROWS))
    text = {r.doc_id: r.text for r in docs.collect()}
    got = langid.identify(docs, model, carry=(("held_out", held),)).collect()
    assert len(got) == len(text)
    for r in got[:40]:
        if not any(c.isalpha() for c in text[r.doc_id] or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        lang, score = brute_predict(model, brute_profile(text[r.doc_id], langid.DIM))
        assert r.lang_pred == lang and abs(r.score - score) < 1e-4


def test_training_rows_are_shared_equally(spark):
    rows = [(i, f"text {i}", "en" if i % 10 else "de") for i in range(3000)] + [(7, "text 7 again", "en")] * 500 + [(None, "x", "en"), (1, None, "en"), (2, "1 2", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.training_rows(docs, "doc_id", "text", "lang", F.lit(True), 100).collect()
    assert sorted(r.lang for r in got) == ["de"] * 50 + ["en"] * 50
