import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tessella.llm import simhash
from tessella.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fp(text):
    tokens = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + 3]) for i in range(len(tokens) - 2)] or [" ".join(tokens)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """fps: list of (id, fp); the smallest id reachable over links of three or fewer bits."""
    head = {i: i for i in range(len(fps))}

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 3:
                head[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(fps):
        if key is not None:
            r = root(i)
            least[r] = min(least.get(r, key), key)
    return [least.get(root(i)) for i in range(len(fps))]


def test_equal_to_brute_force(spark, sf, odd_docs):
    for table in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        rows = [(r.doc_id, brute_fp(r.text)) for r in table.collect()]
        want = sorted((str(i), f"{fp:016x}", str(c)) for (i, fp), c in zip(rows, brute_components(rows), strict=True))
        got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(table).collect())
        assert got == want


def test_no_link_is_lost_in_dense_groups(spark):
    rng = random.Random(3)
    fps = set()
    for _ in range(3):
        x = rng.getrandbits(64)
        for _ in range(60):
            y = x
            for b in rng.sample(range(64), rng.randint(0, 5)):
                y ^= 1 << b
            fps.add(y)
    fps |= {rng.getrandbits(64) for _ in range(40)}
    fps = sorted(fps)
    signed = [(int(np.uint64(x).astype(np.int64)),) for x in fps]
    want = brute_components(list(enumerate(fps)))
    for part in (20_000, 7):
        found = {r.node: r.component for r in components(simhash.links(spark.createDataFrame(signed, "fp long"), part=part)).collect()}
        groups = {}
        for k, (x,) in enumerate(signed):
            groups.setdefault(found.get(x, x), set()).add(want[k])
        assert all(len(g) == 1 for g in groups.values())
        assert len(groups) == len(set(want))


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame([*path, *star, (7, 7), (None, 3)], "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0}
    assert {got[100 + i] for i in range(300)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_deduplicate_keeps_one_of_each_group(spark, sf, odd_docs, no_docs):
    for table in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        heads = {r.component_id for r in simhash.near_duplicates(table).where(F.col("doc_id").isNotNull()).collect()}
        kept = simhash.deduplicate(table)
        assert kept.columns == table.columns
        ids = [r.doc_id for r in kept.collect()]
        assert sorted(i for i in ids if i is not None) == sorted(heads)
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.deduplicate(no_docs).count() == 0
