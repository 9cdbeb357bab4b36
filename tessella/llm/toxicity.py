"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, from document labels."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, flat_words, gathered, hash_sample, slices, stored

#: Hashed features: a word and its beginnings, so that forms of one stem share weights.
DIM = 1 << 18
STEMS = (4, 5, 6, 7, 8)
#: Labelled documents that a fit reads at most, half of them for each label where there are enough.
MAX_TRAIN_DOCS = 3000
#: Bytes of their texts at most, half of them for each label.
MAX_TRAIN_BYTES = 16 << 20
THRESHOLD = 0.3
#: Sentences end at these marks or at a line's end.
SENTENCE = re.compile(rb"(?<=[.!?])[\x20\x09-\x0D]+|\n+")
#: Dropped before words are hashed, so that "WORD!!" and "word" are one feature.
_EDGE = b"!?.,;:\"'()[]{}<>|*#$%&-_/\\=+~`^@"
_CACHE = 200_000
#: Bytes of a word that are hashed side by side with other words'; longer words are hashed one by one.
_STEPS = 64


def features(word: bytes) -> list[int]:
    """Hashed ids of a lower-case word and of its beginnings (lengths in bytes); none for bare marks."""
    bare = word.strip(_EDGE)
    if not bare:
        return []
    return [zlib.crc32(b"=" + bare) % DIM, *(zlib.crc32(bare[:k]) % DIM for k in STEMS if k <= len(bare))]


def _crc_table() -> np.ndarray:
    """The steps of zlib's CRC-32 by byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def feature_table(words: pa.Array) -> np.ndarray:
    """:func:`features` of each word, in columns; DIM where a word has no such feature."""
    bare = pc.ascii_trim(words, characters=_EDGE.decode())
    offsets = np.frombuffer(bare.buffers()[1], np.int32)[bare.offset : bare.offset + len(bare) + 1] if len(bare) else np.zeros(1, np.int32)
    data = np.frombuffer(bare.buffers()[2] or b"", np.uint8) if len(bare) else np.zeros(0, np.uint8)
    start, size = offsets[:-1].astype(np.int64), np.diff(offsets)
    out = np.full((len(words), 1 + len(STEMS)), DIM, np.int64)
    order = np.argsort(-size, kind="stable")
    step = lambda c, byte: _CRC[(c ^ byte) & 255] ^ c >> 8
    stem = np.full(len(words), 0xFFFFFFFF, np.uint32)
    whole = np.full(len(words), step(np.uint32(0xFFFFFFFF), np.uint32(ord("="))), np.uint32)
    for j in range(min(_STEPS, int(size.max(initial=0)))):
        own = order[: np.searchsorted(-size[order], -j, "left")]  # words longer than j
        byte = data[start[own] + j].astype(np.uint32)
        whole[own] = step(whole[own], byte)
        if j < max(STEMS):
            stem[own] = step(stem[own], byte)
            if j + 1 in STEMS:
                out[own, 1 + STEMS.index(j + 1)] = (stem[own] ^ np.uint32(0xFFFFFFFF)) % DIM
    out[size > 0, 0] = (whole[size > 0] ^ np.uint32(0xFFFFFFFF)) % DIM
    for i in np.flatnonzero(size > _STEPS):
        out[i, 0] = zlib.crc32(b"=" + data[start[i] : start[i] + size[i]].tobytes()) % DIM
    return out


@dataclass
class Bags:
    """Sentences of several texts as sets of words: (sentence, word) pairs, each sentence's text, the words' features."""

    sentence: np.ndarray
    word: np.ndarray
    text_of: np.ndarray
    features: np.ndarray
    texts: int

    @staticmethod
    def of(texts: pa.Array) -> Bags:
        """Sentences end after a word that ends with . ! or ?, and at a line's end (or a lone U+0001); those without words are left out."""
        flat, lengths = flat_words(pc.replace_substring(texts.fill_null(""), "\n", " \x01 "))
        coded = flat.dictionary_encode()
        ids, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        flags = lambda x: x.to_numpy(zero_copy_only=False).astype(bool)
        mark = flags(pc.equal(distinct, "\x01"))
        stop = mark | flags(pc.match_substring_regex(distinct, "[.!?]$"))
        text_of = np.repeat(np.arange(len(lengths)), lengths)
        begins = np.ones(len(ids), bool)
        begins[1:] = stop[ids[:-1]] | (text_of[1:] != text_of[:-1])
        sentence = np.cumsum(begins)
        words, n = ~mark[ids], max(1, len(distinct))
        pairs = sentence[words] * n + ids[words]
        pairs.sort()
        pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])] if len(pairs) else pairs
        of = pairs // n
        first = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.zeros(0, bool)
        return Bags(np.cumsum(first) - 1, pairs % n, text_of[begins][of[first] - 1], feature_table(distinct), len(lengths))


class Model:
    """Weights of the features and the bias of a sentence."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), bias

    def words(self) -> _Weights:
        return _Weights(self.weights)

    def totals(self, bags: Bags, shift: float = 0.0) -> np.ndarray:
        """-log P(label 0) of each text: the sum over its sentences."""
        own = np.append(self.weights, np.float32(0))[bags.features].sum(1, dtype=np.float64)
        z = np.bincount(bags.sentence, own[bags.word], len(bags.text_of)) + self.bias + shift
        return np.bincount(bags.text_of, np.logaddexp(0, z), bags.texts)

    def scores(self, bags: Bags) -> np.ndarray:
        """Noisy-or of each text's sentences, 1 - prod(1 - p); 0 without sentences."""
        return -np.expm1(-self.totals(bags))


class _Weights(dict):
    """word -> sum of the weights of its features; emptied when it holds too many words."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= _CACHE:
            self.clear()
        got = self[word] = float(self.weights[features(word)].sum())
        return got


def fit_noisy_or(bags: Bags, labels: np.ndarray, rounds: int = 100, rate: float = 0.05, penalty: float = 1e-5, sparse: float = 3e-4, min_docs: int = 3) -> Model:
    """Maximum likelihood of document labels under the noisy-or of sentence scores (Adam, full batches).

    An L1 term keeps to the few features that explain the labels.  Both labels weigh the same.  Features of fewer than
    ``min_docs`` documents keep weight 0.  One label alone (or no documents) gives a model without weights.
    """
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(DIM), 20.0 if len(labels) and labels.max() else -20.0)
    word, sent_of, doc_of, n = bags.word, bags.sentence, bags.text_of, bags.texts
    ids = bags.features
    owner, flat = np.nonzero(ids < DIM)[0], ids[ids < DIM]
    # Document frequency of the features, from the distinct words of each document.
    pairs = np.unique(doc_of[sent_of] * len(ids) + word)
    by_word = np.bincount(owner, minlength=len(ids))
    begin = np.concatenate([[0], np.cumsum(by_word)[:-1]])
    w_of = pairs % len(ids)
    spread = np.repeat(begin[w_of], by_word[w_of]) + np.arange(by_word[w_of].sum()) - np.repeat(np.cumsum(by_word[w_of]) - by_word[w_of], by_word[w_of])
    seen = np.unique(np.repeat(pairs // len(ids), by_word[w_of]) * DIM + flat[spread]) % DIM
    common = np.bincount(seen, minlength=DIM) >= min_docs
    w, bias = np.zeros(DIM), -4.0
    cost = np.where(labels > 0, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    m, v = np.zeros(DIM + 1), np.zeros(DIM + 1)
    for t in range(1, rounds + 1):
        of_word = np.bincount(owner, w[flat], len(ids))
        z = np.bincount(sent_of, of_word[word], len(doc_of)) + bias
        total = np.bincount(doc_of, np.logaddexp(0, z), n)  # -log P(label 0)
        outer = cost * np.where(labels > 0, -1 / np.expm1(np.clip(total, 1e-6, 50)), 1.0)
        g_sent = outer[doc_of] / (1 + np.exp(-np.clip(z, -30, 30)))
        g_word = np.bincount(word, g_sent[sent_of], len(ids))
        grad = np.append((np.bincount(flat, g_word[owner], DIM) + penalty * w) * common, g_sent.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        move = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w -= move[:-1]
        w = np.sign(w) * np.maximum(0, np.abs(w) - rate * sparse / (np.sqrt(v[:-1] / (1 - 0.99**t)) + 1e-4))
        bias -= move[-1]
    return Model(w, float(bias))


def calibrated(model: Model, bags: Bags, labels: np.ndarray, threshold: float = THRESHOLD, cost: float = 8.0) -> Model:
    """Shift the bias so that missed label-1 documents plus ``cost`` times false alarms are fewest at ``threshold``."""
    if not len(labels) or labels.min() == labels.max():
        return model
    best = (np.inf, 0.0)
    for shift in sorted(np.arange(-4, 2.01, 0.1), key=abs):
        p = -np.expm1(-model.totals(bags, shift)) >= threshold
        loss = (~p[labels > 0]).mean() + cost * p[labels == 0].mean()
        if loss < best[0] - 1e-12:
            best = (loss, shift)
    return Model(model.weights, model.bias + best[1])


def training_docs(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, usable: Column, max_docs: int, max_bytes: int = MAX_TRAIN_BYTES
) -> list[tuple[int, str]]:
    """(label, text) of up to ``max_docs`` usable labelled documents with ``max_bytes`` of text; a hash of the id decides which.

    Contradicting labels of one id count as 1, repeated documents of an id once.  Null labels, ids and texts teach
    nothing.  No window and no task holds all documents of a label; the driver gets sizes first, then the texts
    that the bounds allow.
    """
    marked = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable).groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
    ids = hash_sample(marked, "id", "label", max_docs // 2, 2)
    small = docs.sparkSession.createDataFrame(ids, f"id {marked.schema['id'].dataType.simpleString()}, label int")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null and id is not null")
    found = stored(texts.join(F.broadcast(small), "id").groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "labelled")  # at most max_docs ids
    place, sizes = {x: i for i, x in enumerate(ids)}, found.select("id", "label", F.octet_length("text").alias("size")).collect()
    used, chosen = {0: 0, 1: 0}, []
    for r in sorted(sizes, key=lambda r: place[(r["id"], r["label"])]):
        if used[r["label"]] + r["size"] <= max_bytes // 2:
            used[r["label"]] += r["size"]
            chosen.append((r["id"],))
    kept = found.join(F.broadcast(docs.sparkSession.createDataFrame(chosen, f"id {marked.schema['id'].dataType.simpleString()}")), "id")
    rows = [(r["label"], r["text"]) for r in kept.select("label", "text").collect()]
    discard(found)
    return rows


def fit(rows: list[tuple[int, str]]) -> Model:
    """Fit on the rows of :func:`training_docs`, a bounded sample; a fifth of them, by hash, sets the bias."""
    found = sorted((y, t) for y, t in rows if t.split())
    later = np.array([zlib.crc32(t.encode()) % 5 == 0 for _, t in found], bool)
    part = lambda mask: (Bags.of(pa.array([t for (_, t), k in zip(found, mask, strict=True) if k], pa.string())), np.array([float(y > 0) for (y, _), k in zip(found, mask, strict=True) if k]))
    tune = part(later)
    if min((tune[1] == k).sum() for k in (0, 1)) < 20:
        return fit_noisy_or(*part(np.ones(len(found), bool)))
    return calibrated(fit_noisy_or(*part(~later)), *tune)


def assess(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    carry: tuple[tuple[str, Column], ...] = (),
) -> DataFrame:
    """(id, score, predicted, worst_start, worst_end, worst_score) for every row; no shuffle.

    ``score`` is the noisy-or of all sentences of the whole text.  ``worst_*`` locate the sentence that
    offends most, as character offsets (end exclusive), where the text is predicted toxic; else they are
    null.  Null, empty and wordless texts score 0.  Repeated rows each get their row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = model.words()

        def rows() -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                texts = part.column(part.num_columns - 1)
                score = model.scores(Bags.of(texts))
                found = score >= threshold
                worst = [locate(texts[i].as_py().encode(), model, words) if x else (None, None, None) for i, x in enumerate(found.tolist())]
                arrays = [
                    *part.columns[:-1],
                    pa.array(score, pa.float64()),
                    pa.array(found.astype(np.int32), pa.int32()),
                    pa.array([x[0] for x in worst], pa.int64()),
                    pa.array([x[1] for x in worst], pa.int64()),
                    pa.array([x[2] for x in worst], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names[:-1], "score", "predicted", "worst_start", "worst_end", "worst_score"])

        yield from gathered(rows())

    narrow = docs.select(F.col(id_col).cast("long").alias(id_col), *(c.alias(n) for n, c in carry), F.col(text_col).alias("_text"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(run, f"{head}, score double, predicted int, worst_start long, worst_end long, worst_score double")


def locate(text: bytes, model: Model, words: _Weights) -> tuple[int, int, float]:
    """Character offsets and score of the sentence that scores highest (the first, if several do)."""
    spans, at = [], 0
    for m in SENTENCE.finditer(text):
        spans.append((at, m.start()))
        at = m.end()
    spans.append((at, len(text)))
    best = (0, 0, -np.inf)
    for lo, hi in spans:
        own = dict.fromkeys(text[lo:hi].lower().split())
        z = sum(map(words.__getitem__, own)) + model.bias
        if own and z > best[2]:
            best = (lo, hi, z)
    size = lambda b: len(b.decode("utf-8", "replace"))
    lo = size(text[: best[0]])
    return lo, lo + size(text[best[0] : best[1]]), float(1 / (1 + np.exp(-best[2])))
