import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessella.llm import toxicity
from tessella.llm.common import bucket

BAD = ("grobar", "grobarin", "slunt", "mivvo")


def corpus(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ta", "re", "no", "li", "se", "um"]) for _ in range(rng.randint(1, 3)))
    out = []
    for i in range(n):
        sentences = [[word() for _ in range(rng.randint(3, 9))] for _ in range(rng.randint(2, 8))]
        toxic = rng.random() < 0.4
        if toxic:
            rng.choice(sentences).insert(1, rng.choice(BAD))
        out.append((i, ". ".join(" ".join(s) for s in sentences) + ".", int(toxic)))
    return out


def run(spark, docs, labels):
    held = bucket(F.col("doc_id"), 4) == 2
    rows = toxicity.training_docs(docs, labels, "doc_id", "text", "toxic", ~held, toxicity.MAX_TRAIN_DOCS)
    return toxicity.assess(docs, toxicity.fit(rows), carry=(("held_out", held),))


def test_held_out_documents_and_sentences(spark):
    rows = corpus(900, 16)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    text = {i: t for i, t, _ in rows}
    truth = {i: y for i, _, y in rows}
    got = [r for r in run(spark, df.select("doc_id", "text"), df.select("doc_id", "toxic")).collect() if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.95
    for r in got:
        if r.predicted and truth[r.doc_id]:
            assert any(b in text[r.doc_id][r.worst_start : r.worst_end] for b in BAD)


def test_real_tables_beat_chance(spark):
    path = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    got = run(spark, docs.join(labels, "doc_id", "left_semi"), labels).join(labels, "doc_id").where("held_out").collect()
    hit = [r.predicted for r in got if r.toxic]
    false = [r.predicted for r in got if not r.toxic]
    assert np.mean(hit) > 0.7 and np.mean(false) < 0.03


def test_odd_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(10)] + [(None, 1, "x"), (3, None, "x"), (4, 1, "y")], "doc_id long, toxic int, text string")
    rows = run(spark, odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 and r.worst_start is None for r in rows if r.doc_id in (1, 2, 3))
    assert run(spark, no_docs, labels).count() == 0
    assert run(spark, odd_docs, labels.limit(0)).count() == odd_docs.count()


def test_noisy_or():
    model = toxicity.Model(np.zeros(toxicity.DIM), 0.0)
    got = model.scores(toxicity.Bags.of(pa.array(["a b. c d", "", " \n ", None, "a\nb\n\nc"])))
    assert np.allclose(got, [0.75, 0, 0, 0, 0.875])


def brute_score(text, model):
    """1 - prod(1 - p) over the sentences, each a set of lower-cased words with hashed stems."""
    rest = 1.0
    for sentence in re.split(rb"(?<=[.!?])[\x20\x09-\x0D]+|\n+", (text or "").encode().lower()):
        words = set(sentence.split())
        if words:
            z = model.bias
            for w in words:
                bare = w.strip(b"!?.,;:\"'()[]{}<>|*#$%&-_/\\=+~`^@")
                codes = [b"=" + bare, *(bare[:k] for k in (4, 5, 6, 7, 8) if k <= len(bare))] if bare else []
                z += sum(float(model.weights[zlib.crc32(c) % toxicity.DIM]) for c in codes)
            rest *= 1 - 1 / (1 + math.exp(-z))
    return 1 - rest


def test_whole_query_equals_brute_force(spark, sf, odd_docs):
    held = bucket(F.col("doc_id"), 4) == 2
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(toxicity.training_docs(docs, labels, "doc_id", "text", "toxic", ~held, toxicity.MAX_TRAIN_DOCS))
    for table in (docs, odd_docs):
        text = {(r.doc_id, r.text) for r in table.collect()}
        got = toxicity.assess(table.withColumn("given", F.col("text")), model, carry=(("held_out", held), ("given", F.col("text")))).collect()
        assert {(r.doc_id, r.given) for r in got} == text and len(got) == table.count()
        for r in got:
            want = brute_score(r.given, model)
            assert abs(r.score - want) < 1e-5 and r.predicted == int(r.score >= 0.3)


def test_training_sample_is_bounded_in_rows_and_bytes(spark):
    rows = [(i, "word " * (i % 50 + 1), i % 3 == 0) for i in range(4000)] + [(5, "again", False)] * 300
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    pick = lambda **bounds: toxicity.training_docs(docs, labels, "doc_id", "text", "toxic", F.lit(True), **bounds)
    got = pick(max_docs=200)
    assert [sum(y == k for y, _ in got) for k in (0, 1)] == [100, 100] and sorted(got) == sorted(pick(max_docs=200))
    small = pick(max_docs=200, max_bytes=6000)
    assert 20 < len(small) < 200 and all(sum(len(t) for y, t in small if y == k) <= 3000 for k in (0, 1))


def test_feature_table_equals_features():
    words = ["", "!!", "abc", "(word).", "é" * 5, "x" * 63, "y" * 200 + "!", "-a-b-", "\x01", "12345678"]
    table = toxicity.feature_table(pa.array(["skip", *words]).slice(1))
    for w, row in zip(words, table.tolist(), strict=True):
        assert sorted(i for i in row if i < toxicity.DIM) == sorted(toxicity.features(w.encode()))
    assert toxicity.feature_table(pa.array([], pa.string())).shape == (0, 6)
