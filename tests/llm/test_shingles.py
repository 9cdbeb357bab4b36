import random
import re
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

from tessella.llm import shingles  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(text):
    tokens = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4)} or {tuple(tokens)}


def brute_heads(rows):
    """The smallest id of each component over links of Jaccard similarity 0.8 or more."""
    found = [(i, brute_sets(text)) for i, text in rows]
    head = list(range(len(found)))

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    for i, (_, x) in enumerate(found):
        for j in range(i):
            y = found[j][1]
            if 4 * max(len(x), len(y)) <= 5 * min(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
                head[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(found):
        least[root(i)] = min(least.get(root(i), key), key)
    return set(least.values())


def edited(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = "".join(rng.choices("abcdefghij", k=9))
    return out


def test_stage_takes_near_copies_at_similarity_08(spark):
    rng = random.Random(5)
    rows = []
    for k in range(60):
        words = ["".join(rng.choices("klmnopqrst", k=6)) for _ in range(300)]
        rows.append((2 * k, " ".join(words)))
        # n spread edits change about 5 n of 296 shingles: similarities of about 0.97 down to 0.7
        rows.append((2 * k + 1, " ".join(edited(rng, words, 1 + k % 9))))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    want = brute_heads(rows)
    assert sorted(got) == sorted(want) and 60 < len(want) < 120


def test_equal_to_brute_force(spark, sf, odd_docs, no_docs):
    for table in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        rows = [(r.doc_id, r.text) for r in table.collect() if r.doc_id is not None]
        got = shingles.near_duplicates(table).collect()
        assert {r.component_id for r in got} == brute_heads(rows) and len(got) == len(rows)
    assert shingles.near_duplicates(no_docs).count() == 0


def test_parts_lose_no_link(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("klmnopqrst", k=6)) for _ in range(200)]
    docs = spark.createDataFrame([(k, " ".join(edited(rng, words, 2))) for k in range(80)], "doc_id long, text string")
    table = shingles.signatures(docs, "doc_id", "text", 5, 5, 30)
    for part_bytes in (1 << 20, 20_000):
        found = shingles.components(shingles.links(table, docs, "doc_id", "text", 5, 0.8, part_bytes)).collect()
        assert len({r.component for r in found}) == len(brute_heads([(r.doc_id, r.text) for r in docs.collect()])) == 1
        assert len(found) == 80


def test_links_span_and_are_similar():
    x = np.arange(100, dtype=np.uint64)
    a, b = shingles.similar_links([1, 2, 3, 4], [x, x[10:], x[20:], x[50:]])
    assert sorted(zip(a, b, strict=True)) in ([(1, 2), (1, 3)], [(1, 2), (2, 3)])


def test_simhash_alone_finds_copies_within_its_bits(spark):
    """Without a band, what SimHash blocks bring together and the exact similarity confirms."""
    words = [f"w{i}" for i in range(2000)]
    texts = [" ".join(words), " ".join([*words[:-1], "x"]), " ".join(words[1000:] + [f"v{i}" for i in range(1000)]), None]
    prints = [shingles.simhash(shingles.shingle_set((x or "").encode())) for x in texts]
    assert (prints[0] ^ prints[1]).bit_count() <= 3 < (prints[0] ^ prints[2]).bit_count()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = shingles.near_duplicates(docs, bands=0).collect()
    assert {r.doc_id: r.component_id for r in found} == {0: 0, 1: 0, 2: 2, 3: 3}


def test_fingerprints_limit_what_is_compared():
    x = np.arange(100, dtype=np.uint64)  # small numbers: all high bits agree
    assert shingles.similar_links([1, 2], [x, x[10:]], max_bits=64) == ([1], [2])
    far = (x[10:] ^ np.uint64(0)).copy()
    bits = (shingles.simhash(x) ^ shingles.simhash(far)).bit_count()
    assert shingles.similar_links([1, 2], [x, far], max_bits=bits - 1) == ([], [])
