"""Language identification in two levels: the family first, then pairwise linear SVMs within it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import gathered, hash_sample, slices

#: Families of common language codes.  A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "indic": ("hi", "bn", "mr", "gu", "pa", "ne", "ur", "si"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "ky", "uz", "tk"),
    "semitic": ("ar", "he", "am", "mt"),
}
#: Hashed n-gram features.
DIM = 1 << 13
ORDERS = (1, 2, 3, 4)
#: Labelled rows that a fit reads at most, shared equally among the languages.
MAX_TRAIN_ROWS = 2000
#: Languages that a fit tells apart at most, the most frequent ones.
MAX_LANGS = 200
UNKNOWN = "und"
#: Bytes whose n-grams are in memory at once; longer texts are summed piece by piece.
PIECE = 1 << 19


def _byte_classes() -> np.ndarray:
    """ASCII letters lower-cased; bytes of other scripts as they are; all else a word boundary (0)."""
    table = np.zeros(256, np.uint32)
    for b in range(256):
        if 0x41 <= b <= 0x5A:
            table[b] = b + 32
        elif 0x61 <= b <= 0x7A or b >= 0x80:
            table[b] = b
    return table


_CLASSES = _byte_classes()


def ngram_ids(piece: np.ndarray, dim: int = DIM) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order: positions and hashed ids of the n-grams of bytes, word boundaries included once."""
    c = _CLASSES[piece]
    out = []
    code = c.copy()
    for n in ORDERS:
        if n > 1:
            if len(c) < n:
                break
            code = code[:-1] * np.uint32(257) + c[n - 1 :]
        # An n-gram may start or end at a boundary but not lie across one.
        inside = np.ones(len(code), bool)
        if n == 1:
            inside = c > 0
        else:
            for k in range(1, n - 1):
                inside &= c[k : len(c) - n + 1 + k] > 0
            inside &= (c[: len(code)] > 0) | (c[n - 1 :] > 0)
        at = np.flatnonzero(inside)
        h = (code[at] + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(2654435761)
        out.append((at, (h >> np.uint32(32 - dim.bit_length() + 1)).astype(np.int64)))
    return out


def pieces(data: np.ndarray, size: int = PIECE) -> Iterator[np.ndarray]:
    """Cut bytes at word boundaries near every ``size`` bytes (anywhere, if a word is longer)."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        if end < len(data):
            gaps = np.flatnonzero(_CLASSES[data[at:end]] == 0)
            if len(gaps):
                end = at + int(gaps[-1]) + 1
        yield data[at:end]
        at = end


def profile(text: bytes, dim: int = DIM) -> np.ndarray:
    """Unit vector of hashed n-gram counts (square roots) of a whole text."""
    total = np.zeros(dim, np.float64)
    for piece in pieces(np.frombuffer(text, np.uint8)):
        for _, ids in ngram_ids(np.concatenate([[np.uint8(32)], piece, [np.uint8(32)]]), dim):
            total += np.bincount(ids, minlength=dim)
    total = np.sqrt(total)
    norm = np.sqrt((total**2).sum())
    return (total / norm if norm else total).astype(np.float32)


@dataclass
class Svm:
    """Linear separators, one column of ``weights`` each, with logistic scales for their margins."""

    weights: np.ndarray
    bias: np.ndarray
    scale: np.ndarray


def fit_svm(x: np.ndarray, y: np.ndarray, rounds: int = 150, penalty: float = 1e-4) -> tuple[np.ndarray, float, float]:
    """Squared-hinge linear SVM by accelerated gradient descent; classes weigh the same."""
    n, d = x.shape
    cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, b = np.zeros(d), 0.0
    vw, vb, t = w.copy(), b, 1.0
    step = 1.0 / (2 * 2 + penalty)
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ vw + vb)) * y * cost
        w2, b2 = vw + step * (2 * (x.T @ slack) - penalty * vw), vb + step * 2 * slack.sum()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    # Logistic scale of the margin, so that scores read as probabilities.
    m, a = y * (x @ w + b), 1.0
    for _ in range(50):
        a += 2.0 * (cost * m / (1 + np.exp(np.clip(a * m, -30, 30)))).sum()
    return w, float(b), float(np.clip(a, 1.0, 20.0))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def pair_shares(margins: np.ndarray, pairs: list[tuple[int, int]], n: int) -> np.ndarray:
    """One-versus-one votes, each weighted by its probability, as shares of n classes."""
    if n == 1:
        return np.ones((len(margins), 1))
    share = np.full((len(margins), n), 1e-12)
    for k, (i, j) in enumerate(pairs):
        share[:, i] += margins[:, k]
        share[:, j] += 1 - margins[:, k]
    share *= share  # sharpened: a class that wins all its pairs stands out
    return share / share.sum(1, keepdims=True)


class Model:
    """Family separators (one versus one) and, for each family, separators of its languages."""

    def __init__(self, x: np.ndarray, langs: list[str], families: dict[str, tuple[str, ...]] = FAMILIES):
        known = {code: name for name, codes in families.items() for code in codes}
        self.langs = sorted(set(langs))
        names = sorted({known.get(c, c) for c in self.langs})
        self.families = [[c for c in self.langs if known.get(c, c) == f] for f in names]
        label = np.array([names.index(known.get(c, c)) for c in langs], int)
        lang = np.array(langs, object)
        columns, bias, scale = [], [], []

        def separate(rows: np.ndarray, positive: np.ndarray) -> None:
            w, b, a = fit_svm(x[rows].astype(np.float64), np.where(positive, 1.0, -1.0))
            columns.append(w)
            bias.append(b)
            scale.append(a)

        self.family_pairs = list(combinations(range(len(names)), 2))
        for i, j in self.family_pairs:
            rows = (label == i) | (label == j)
            separate(rows, label[rows] == i)
        self.lang_pairs = []
        for codes in self.families:
            own = list(combinations(range(len(codes)), 2))
            self.lang_pairs.append(own)
            for i, j in own:
                rows = (lang == codes[i]) | (lang == codes[j])
                separate(rows, lang[rows] == codes[i])
        d = x.shape[1] if len(x) else DIM
        self.svm = Svm(np.array(columns).reshape(-1, d).T.astype(np.float32), np.array(bias), np.array(scale))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score (family share times language share) of each profile."""
        if not self.langs:
            return [UNKNOWN] * len(x), np.zeros(len(x))
        p = _sigmoid((x @ self.svm.weights + self.svm.bias) * self.svm.scale)
        family = pair_shares(p[:, : len(self.family_pairs)], self.family_pairs, len(self.families))
        best = family.argmax(1)
        out, score = np.empty(len(x), object), np.zeros(len(x))
        at = len(self.family_pairs)
        for f, codes in enumerate(self.families):
            own = self.lang_pairs[f]
            share = pair_shares(p[:, at : at + len(own)], own, len(codes))
            at += len(own)
            mine = best == f
            pick = share.argmax(1)
            out[mine] = np.array(codes, object)[pick[mine]]
            score[mine] = (family[:, f] * share[np.arange(len(x)), pick])[mine]
        return list(out), score


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, usable: Column, max_rows: int) -> DataFrame:
    """(text, lang) of up to ``max_rows`` usable labelled rows, as many for each language; a hash of the id decides which.

    The MAX_LANGS most frequent languages take part.  Rows without id teach nothing, repeated rows of an id and
    language once.  No window and no task holds all rows of a language.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), usable.alias("usable"))
    named = named.where("usable and id is not null and lang is not null and text is not null and text rlike '\\\\p{L}'")
    langs = max(1, min(MAX_LANGS, named.select("lang").distinct().count()))
    chosen = hash_sample(named, "id", "lang", max(1, max_rows // langs), langs)
    small = docs.sparkSession.createDataFrame(chosen, f"id {named.schema['id'].dataType.simpleString()}, lang string")
    rows = named.join(F.broadcast(small), ["id", "lang"])  # at most max_rows ids
    return rows.groupBy("id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "lang")


def fit(rows: DataFrame, families: dict[str, tuple[str, ...]] = FAMILIES) -> Model:
    """Fit on the rows of :func:`training_rows`; profiles (32 kB each) are made by the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            vectors = [profile(x).tobytes() for x in part.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(vectors, pa.binary()), part.column(1)], names=["vector", "lang"])

    found = sorted((r.lang, bytes(r.vector)) for r in rows.select("text", "lang").mapInArrow(run, "vector binary, lang string").collect())
    x = np.array([np.frombuffer(v, np.float32) for _, v in found], np.float32).reshape(len(found), DIM)
    return Model(x, [c for c, _ in found], families)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[tuple[str, Column], ...] = ()) -> DataFrame:
    """(id, lang_pred, score) for every row; no shuffle.  ``score``: share of the family times that of the language in it.

    A null text or one without letters gives ``und`` with score 0.  Whole texts are read, long ones
    piece by piece.  Repeated rows each get their row; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                texts = part.column(part.num_columns - 1).cast(pa.binary()).to_pylist()
                x = np.array([profile(t or b"") for t in texts], np.float32)
                langs, score = model.predict(x)
                lang = [c if t is not None else UNKNOWN for c, t in zip(langs, texts, strict=True)]
                score = np.where([t is not None for t in texts], score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    names=[*part.schema.names[:-1], "lang_pred", "score"],
                )

        yield from gathered(rows())

    has_letter = F.col(text_col).rlike(r"\p{L}")
    narrow = docs.select(F.col(id_col).cast("long").alias(id_col), *(c.alias(n) for n, c in carry), F.when(has_letter, F.col(text_col)).alias("_text"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(run, f"{head}, lang_pred string, score double")
