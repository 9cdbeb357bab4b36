import re
from collections import Counter

import zstandard

from tessella.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    tokens = WORD.findall(text)
    windows = Counter(tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4))
    hit = set()
    for i in range(len(tokens) - 4):
        if windows[tuple(tokens[i : i + 5])] > 1:
            hit |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(tokens)
    return n, sum(map(len, tokens)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), n < 10 or 100 * len(hit) > 20 * n


def test_counts_equal_brute_force(spark, sf, odd_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for table in (docs, odd_docs):
        want = sorted((str(r.doc_id), *brute(r.text)) for r in table.collect())
        got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(table).collect())
        assert got == want


def test_ratio_is_of_the_whole_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    for r in docs.collect():
        if r.text:
            b = r.text.encode()
            assert got[r.doc_id].ratio == len(b) / len(zstandard.ZstdCompressor(level=3).compress(b))


def test_bands_reject_repetition_and_noise(spark):
    import base64
    import random

    rng = random.Random(1)
    noise = " ".join(base64.b85encode(rng.randbytes(12)).decode() for _ in range(2000))
    lines = "\n".join(f"item {i % 7} of the list has colour {'red' if i % 2 else 'blue'} number {i}" for i in range(900))
    prose = " ".join("".join(rng.choice(["the", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]) for _ in range(rng.randint(1, 4))) for _ in range(900))
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame([(1, noise), (2, lines), (3, prose)], "doc_id long, text string")).collect()}
    assert got[1].reason == "incompressible" and not got[1].base_failed
    assert got[2].reason in ("repetitive", "repeated_windows")
    assert got[3].kept


def test_half_of_a_text_in_bad_chunks(spark):
    import random

    rng = random.Random(2)
    prose = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(1500))
    pack = zstandard.ZstdCompressor(level=3)
    _, _, _, share = quality.compression((prose + " ab" * 6000).encode(), pack)
    assert 0.5 < share < 0.8


def test_keep_and_judge_agree(spark, sf, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for table in (docs, odd_docs, no_docs):
        kept = quality.keep(table)
        assert kept.columns == table.columns
        want = sorted(str(r.doc_id) for r in quality.judge(table).where("kept").collect())
        assert sorted(str(r.doc_id) for r in kept.collect()) == want
    assert quality.judge(no_docs).count() == 0


def test_bands_reject_base64_and_hex_at_every_length(spark, sf):
    import base64
    import random

    rng = random.Random(4)

    def wrapped(size, width):
        line = base64.b64encode(rng.randbytes(size)).decode()
        return "\n".join(line[i : i + width] for i in range(0, len(line), width))[:size]

    def hexadecimal(size, width):
        return " ".join(rng.randbytes(width // 2).hex() for _ in range(size // width + 1))[:size]

    ends = [b.from_bytes for b in quality.DOCUMENT_BANDS[2:]] + [120_000]
    noise = [wrapped(size, width) for a, b in zip(ends, ends[1:], strict=False) for size in (a, (a + b) // 2, b - 1) for width in (16, 76)]
    noise += [hexadecimal(size, width) for size in (4096, 6000, 8191, 8192, 12_000, 16_383, 16_384, 40_000, 80_000) for width in (8, 32, 64)]
    long = [t for (t,) in spark.read.parquet(f"{sf}/documents.parquet").where("length(text) > 2000").select("text").collect() if quality.MIN_WORDS < len(t.split())]
    prose = "\n".join(long).encode()[:18_000].decode("utf-8", "ignore")
    noise += [prose + "\n" + wrapped(22_000, 76), wrapped(22_000, 76) + "\n" + prose]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(noise)], "doc_id long, text string")
    for r in quality.judge(docs).collect():
        few = len(noise[r.doc_id].split()) < quality.MIN_WORDS
        assert r.reason == ("few_words" if few else r.reason) and r.reason in ("few_words", "incompressible", "chunks"), (r, noise[r.doc_id][:80])
    assert sum(len(t.split()) >= quality.MIN_WORDS for t in noise) > 60
    whole = spark.createDataFrame([(1, prose)], "doc_id long, text string")
    assert quality.judge(whole).first().reason not in ("incompressible", "chunks")


def brute_verdict(text):
    """Base rules, then the ratio of the whole text and of each piece of 4,096 bytes against the limits for its length."""
    data = (text or "").encode()
    if brute(text)[-1]:
        return False
    ratio = lambda b: len(b) / len(zstandard.ZstdCompressor(level=3).compress(b))

    def inside(bands, b):
        low, high = [(x.low, x.high) for x in bands if x.from_bytes <= len(b)][-1]
        return low <= ratio(b) <= high

    pieces = [data[i : i + 4096] for i in range(0, len(data), 4096)]
    bad = sum(len(p) for p in pieces if not inside(quality.CHUNK_BANDS, p))
    return inside(quality.DOCUMENT_BANDS, data) and 4 * bad <= len(data)


def test_verdict_equals_brute_force(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for table in (docs, odd_docs):
        want = sorted((str(r.doc_id), brute_verdict(r.text)) for r in table.collect())
        assert sorted((str(r.doc_id), r.kept) for r in quality.judge(table).collect()) == want
