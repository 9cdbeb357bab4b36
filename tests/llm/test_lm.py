import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import common, lm
from tessella.llm.common import bucket

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [" "]


def held(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2


def brute(rows):
    c = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    return [(str(i), held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t))) for i, t in rows]


def run(docs):
    return lm.score(docs, bucket(F.col("doc_id"), 7) == 2).collect()


@pytest.mark.parametrize("per_root", [24, 0.001])
def test_base_equals_brute_force(spark, sf, odd_docs, monkeypatch, per_root):
    monkeypatch.setattr(lm.frequent, "__defaults__", (per_root,))
    tables = [spark.read.parquet(f"{sf}/documents.parquet")] + ([odd_docs] if per_root < 1 else [])
    for table in tables:
        rows = [(r.doc_id, r.text) for r in table.collect()]
        want = sorted(brute(rows))
        got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in run(table))
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert all(g[5] == pytest.approx(w[5], rel=1e-9) for g, w in zip(got, want, strict=True))


def paths(n_words):
    """rank -> [(node, child)], by the classes' definition, one word at a time."""
    tree, w = lm.Tree(n_words), lm.WIDTH
    out = {n_words: [(0, w - 1)]}
    for r in range(n_words):
        start, _, first, levels, begin = next(b for b in tree.bands if b[0] <= r < b[1])
        q = r - start
        out[r] = [(0, first + q // w**levels)] + [(begin[k - 1] + q // w ** (levels - k + 1), q // w ** (levels - k) % w) for k in range(1, levels + 1)]
    return out


def brute_log10(model, path, code):
    """Sum over the path of log10 softmax, from the weights and the feature hash alone."""
    total = 0.0
    for level, (node, child) in enumerate(path):
        salt = (node + 11) * 668265263 % 2**32
        rows = [((c ^ salt) * 3266489917 % 2**32) >> (32 - model.bits) for c in (code[k] for k in lm.FEATURES[min(level, len(lm.FEATURES) - 1)])]
        z = model.table[[*rows, (1 << model.bits) + node]].astype(np.float64).sum(0)
        total += (z[child] - math.log(np.exp(z).sum())) / math.log(10)
    return total


def brute_codes(ids, n_words):
    begin, a, b, m = n_words + 1, 2654435761, 2246822519, 2**32
    out = []
    for i in range(len(ids)):
        one, two = ids[i - 1] if i else begin, ids[i - 2] if i > 1 else begin
        pair = ((one + 1) * a % m ^ (two + 3) * b % m) * a % m
        out.append(((one + 1) * a % m, pair if max(one, two) < lm.PAIRED else 0, (two + 7) * b % m ^ 0x5BD1E995))
    return out


@pytest.mark.parametrize("n_words", [0, 3, 600, 9000])
def test_probabilities_add_up_to_one(n_words):
    rng = np.random.default_rng(9)
    m = lm.Model(lm.Tree(n_words), 10)
    m.table = rng.normal(size=m.table.shape).astype(np.float32)
    m.table[1 << 10 :] = -50  # outcomes without a word have no mass
    for p in paths(n_words).values():
        for node, child in p:
            m.table[(1 << 10) + node, child] = rng.normal()
    codes = lm.histories(np.array([5, 9, 2]), np.array([0]), n_words)[:, [2]]
    p = m.log10(np.repeat(codes, n_words + 1, axis=1), np.arange(n_words + 1))
    assert (10**p).sum() == pytest.approx(1, abs=1e-4)
    known = paths(n_words)
    code = brute_codes([5, 9, 2], n_words)[2]
    for r in (0, n_words // 2, n_words):
        assert p[r] == pytest.approx(brute_log10(m, known[r], code), abs=1e-4)


def test_score_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = bucket(F.col("doc_id"), 7) == 2
    counts = lm.frequent(lm.word_counts(docs, "text", ~out))
    model = lm.train(lm.encode(docs, counts, "doc_id", "text", out), counts)
    model.table = model.table.astype(np.float16).astype(np.float32)
    rank, known = {w.decode(): i for i, w in enumerate(counts.words)}, paths(len(counts.words))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    c = Counter(w for i, t in rows if not held(i) for w in words(t))
    rare = sum(c.values()) - int(counts.n.sum()) + len(c) - len(counts.n) + 1
    got = {r.doc_id: r.score for r in lm.score(docs, out).collect()}
    for i, t in rows[:25]:
        ids = [rank.get(w, len(rank)) for w in words(t)]
        want = sum(brute_log10(model, known[j], k) for j, k in zip(ids, brute_codes(ids, len(rank)), strict=True))
        want += sum(math.log10((c[w] + 1) / rare) for w in words(t) if w not in rank)
        assert got[i] == pytest.approx(want, rel=1e-4)
    assert len(rank) > 512  # more than the words directly below the root


def test_gain_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    gains = []
    for n in (1, 8, 64):
        got = [r for r in run(docs.repartition(n)) if r.held_out]
        gains.append((sum(r.score for r in got) - sum(r.base_score for r in got)) / sum(r.n_tokens for r in got))
        assert all(r.score < 0 for r in got)
    assert min(gains) > 0.08 and max(gains) < 1.1 * min(gains), gains


def test_steps_lower_the_loss():
    ids = np.tile(np.array([1, 40, 3, 700, 2, 5]), 3000)
    codes = lm.histories(ids, np.array([0]), 1000)
    m = lm.Model(lm.Tree(1000), 12)
    before = m.log10(codes, ids).mean()
    for at in range(0, len(ids), 1000):
        m.learn(codes[:, at : at + 1000], ids[at : at + 1000])
    assert m.log10(codes, ids).mean() > before + 0.5


def test_words_are_split_as_python_does(monkeypatch):
    texts = ["  aa Bb\tcc\x0b\n" * 50, None, "", " \n", "É x\x85y \x1c"]
    import pyarrow as pa

    for size in (1 << 20, 7):
        monkeypatch.setattr(common, "PIECE", size)
        monkeypatch.setattr(common.pieces, "__defaults__", (size,))
        ids, distinct, lengths = common.split_words(pa.array(texts))
        want = [(t or "").encode().lower().split() for t in texts]
        assert [distinct[i] for i in ids] == [w for x in want for w in x] and lengths.tolist() == [len(x) for x in want]


def test_long_words_keep_their_own_counts(spark):
    long = ["x" * 300 + str(k) for k in range(3)]
    docs = spark.createDataFrame([(i, " ".join([long[i % 3], "a"])) for i in range(60)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_known, round(r.base_score, 9)) for r in run(docs))
    assert got == sorted((int(i), k, round(s, 9)) for i, _, _, k, _, s in brute([(r.doc_id, r.text) for r in docs.collect()]))


def test_empty_and_untrained(spark, no_docs):
    assert run(no_docs) == []
    only_held = [i for i in range(60) if held(i)][:3]
    got = run(spark.createDataFrame([(i, "a b") for i in only_held], "doc_id long, text string"))
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0)] * 3
