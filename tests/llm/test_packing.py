import random
import re
from collections import defaultdict
from itertools import combinations

from tessella.llm import packing


def padding(lengths, ends):
    return sum(min(e for e in ends if e >= x) - x for x in lengths)


def test_boundaries_are_optimal():
    rng = random.Random(6)
    for _ in range(30):
        lengths = [rng.randint(0, 14) for _ in range(rng.randint(1, 40))]
        hist = [(x, lengths.count(x)) for x in sorted(set(lengths))]
        for k in (1, 2, 3):
            ends = packing.boundaries(hist, k)
            tops = sorted(set(lengths))
            best = min(padding(lengths, [*c, tops[-1]]) for m in range(k) for c in combinations(tops[:-1], min(m, len(tops) - 1)))
            assert padding(lengths, ends) == best and len(ends) <= k and ends[-1] == tops[-1]


def plain_boundaries(lengths, buckets):
    """Least padding by trying every previous end, for every number of buckets."""
    tops = sorted(set(lengths))
    best = {(0, 0): 0}
    for k in range(1, buckets + 1):
        for j in range(1, len(tops) + 1):
            own = [best[k - 1, i] + sum(tops[j - 1] - x for x in lengths if (tops[i - 1] if i else -1) < x <= tops[j - 1]) for i in range(j) if (k - 1, i) in best]
            if own:
                best[k, j] = min(own)
    return min(v for (k, j), v in best.items() if j == len(tops))


def test_boundaries_are_optimal_for_long_lengths():
    rng = random.Random(8)
    for _ in range(12):
        lengths = [int(rng.lognormvariate(5, 1.5)) for _ in range(rng.randint(1, 60))]
        hist = [(x, lengths.count(x)) for x in sorted(set(lengths))]
        for k in (1, 4, 9):
            assert padding(lengths, packing.boundaries(hist, k)) == plain_boundaries(lengths, k)
    many = [(x, rng.randint(1, 9)) for x in range(0, 200_000, 7)]
    assert len(packing.boundaries(many, 12)) == 12


def check(rows, budget=packing.TOKEN_BUDGET):
    batches = defaultdict(list)
    for r in rows:
        assert r["n_tokens"] <= r["bucket_len"]
        batches[r["batch_id"]].append(r)
    partial = defaultdict(int)
    for b in batches.values():
        size = max(1, budget // max(1, b[0]["bucket_len"]))
        assert len({(r["bucket"], r["bucket_len"], r["shard"]) for r in b}) == 1 and len(b) <= size
        partial[b[0]["bucket"], b[0]["shard"]] += len(b) < size
    assert all(v <= 1 for v in partial.values())


def numbered(rows):
    """Batches by counting the rows of each shard in order of length and id."""
    shards = defaultdict(list)
    for r in rows:
        shards[r.bucket, r.shard].append(r)
    return {r.doc_id: i // max(1, packing.TOKEN_BUDGET // max(1, r.bucket_len)) for s in shards.values() for i, r in enumerate(sorted(s, key=lambda r: (r.n_tokens, r.doc_id)))}


def test_rows_without_id_are_dealt_out(spark):
    docs = spark.createDataFrame([(None, "a b c")] * 900, "doc_id long, text string")
    rows = packing.pack(docs, shard_rows=100).collect()
    assert len(rows) == 900 and len({r.shard for r in rows}) == 9
    check(rows)


def test_every_row_is_packed(spark, sf, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for options in ({}, {"shard_rows": 30, "buckets": 4}):
        rows = packing.pack(docs, **options).collect()
        want = sorted((r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text))) for r in docs.collect())
        assert sorted((r.doc_id, r.n_tokens) for r in rows) == want
        check(rows)
        lengths = [n for _, n in want]
        ends = sorted({r.bucket_len for r in rows})
        assert padding(lengths, ends) == plain_boundaries(lengths, options.get("buckets", packing.BUCKETS))
        assert numbered(rows) == {r.doc_id: r.batch for r in rows}
    odd = packing.pack(odd_docs.drop("bucket"))
    assert odd.count() == odd_docs.count()
    check([r.asDict() for r in odd.collect()])
    clash = packing.pack(odd_docs)
    assert {r.bucket for r in clash.collect()} == {"clash"} and "bucket_" in clash.columns
    assert packing.pack(no_docs).count() == 0
