import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank int, id string"


def brute(rows, every=100, k=10):
    good = []
    for r in rows:
        v = r.embedding
        if r.vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((r.vec_id, [math.floor(1024 * float(x)) for x in v]))
    out = []
    for q, v in {(i, tuple(v)) for i, v in good if i % every == 0}:
        found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v) and len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run(df, **options):
    got = topk.top_k(df, df.where("vec_id % 100 = 0"), **options)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())


def test_equal_to_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert run(df) == brute(df.collect())
    assert run(df, query_block=2) == brute(df.collect())


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_ties_bad_vectors_repeats_and_large_values(spark, scale):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) * scale for _ in range(6)], "x", 1, "y") for i in range(700)]
    rows += [rows[3], rows[100], (200, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x", 1, "y"), (701, None, "x", 1, "y"), (702, [float("nan")] * 6, "x", 1, "y")]
    rows += [(703, [float("inf")] * 6, "x", 1, "y"), (None, [1.0] * 6, "x", 1, "y"), (704, [1.0, 2.0], "x", 1, "y"), (800, [3.0, 2.0], "x", 1, "y"), (900, [], "x", 1, "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert run(df) == brute(df.collect())


def test_bounds_stop_before_the_lists_end():
    rng = np.random.default_rng(5)
    x = np.floor(1024 * rng.dirichlet(np.full(8, 0.2), 4000)).astype(np.float64)
    q = np.zeros((1, 8))
    q[0, 2] = 1000
    lists, depths = topk.Lists(x), []
    real = topk.DEPTHS
    got = list(lists.search(q, 10, np.full(1, -np.inf), [np.zeros(0, int)]))
    assert len(got) == 1 and len(got[0][1]) < 200 and real[-1] == 1.0
    best = np.sort(x @ q[0])[-10:]
    assert set(best) <= set(x[got[0][1]] @ q[0]) and not depths


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert run(df) == []
    one = spark.createDataFrame([(100, [1.0], "x", 1, "y")], SCHEMA)
    assert run(one) == [] and one.where(F.col("vec_id") == 100).count() == 1
