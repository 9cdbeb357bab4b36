"""Quality rules: base counts, and compression bands with limits that depend on length."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, raw, slices

#: Bytes that count as symbols (fixed value).
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Limits for texts of at least ``from_bytes`` UTF-8 bytes: low <= bytes / compressed bytes <= high."""

    from_bytes: int
    low: float
    high: float


#: Short texts hardly compress whatever they hold, so the band moves with the length.  Running prose
#: gains with length as the window fills: about 1.5 at 300 bytes, 2 at 2 kB, 2.5 at 30 kB.  Random base64
#: reaches 1.13 below 384 bytes and 1.33 at any length, random hexadecimal words 1.92 at 4 kB and 1.96 at
#: any length; the lower limits lie between these and prose.  Hexadecimal below 4 kB compresses as prose does.
DOCUMENT_BANDS = (
    Band(0, 0.0, 1e9),
    Band(128, 1.0, 2.6),
    Band(192, 1.12, 2.6),
    Band(256, 1.17, 2.6),
    Band(384, 1.22, 2.6),
    Band(512, 1.28, 2.8),
    Band(768, 1.31, 2.8),
    Band(1024, 1.38, 3.0),
    Band(2048, 1.5, 3.0),
    Band(4096, 1.94, 3.4),
    Band(8192, 1.95, 3.4),
    Band(16384, 1.98, 4.0),
    Band(65536, 1.98, 4.6),
)
#: The same for each fixed chunk (``CHUNK`` bytes; the last may be shorter).  Words of random letters (1.6 to 1.7)
#: pass here, so chunks tell base64 from text, not hexadecimal.
CHUNK_BANDS = (
    Band(0, 0.0, 1e9),
    Band(256, 1.17, 3.2),
    Band(384, 1.22, 3.2),
    Band(512, 1.28, 3.2),
    Band(768, 1.31, 3.2),
    Band(1024, 1.38, 4.0),
    Band(2048, 1.5, 4.0),
    Band(4096, 1.5, 5.0),
)
CHUNK = 4096
#: A document goes when more than this share of its chunks' bytes lies outside the chunk bands.
MAX_BAD_CHUNKS = 0.25
LEVEL = 3
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

SCHEMA = (
    "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, ratio double, low double, high double, bad_chunk_share double, reason string"
)


def repeated_words(tokens: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words which the text holds twice or more."""
    n = len(tokens)
    if n <= width:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in tokens), np.int64, n)
    size = max(len(seen), 1)
    if size == n:
        return 0
    keys, span = ids, size
    for k in range(1, width):
        if span * size >= 2**62:
            _, keys = np.unique(keys, return_inverse=True)
            span = n
        keys = keys[: n - k] * size + ids[k:]
        span *= size
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(len(keys) + 1, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    mark = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + width, -1)
    return int((np.cumsum(mark[:n]) > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    tokens = text.split()
    joined = b"".join(tokens)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
    symbols = sum(joined.count(bytes([c])) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(tokens), chars, symbols, len(lines) - len(set(lines)), repeated_words(tokens)


def band_of(bands: tuple[Band, ...], size: int) -> Band:
    return next(b for b in reversed(bands) if size >= b.from_bytes)


def compression(
    text: bytes,
    pack: zstandard.ZstdCompressor,
    documents: tuple[Band, ...] = DOCUMENT_BANDS,
    chunks: tuple[Band, ...] = CHUNK_BANDS,
    chunk: int = CHUNK,
) -> tuple[float | None, float, float, float]:
    """Whole-document ratio, its band, and the share of bytes in chunks outside theirs."""
    n = len(text)
    band = band_of(documents, n)
    if not n:
        return None, band.low, band.high, 0.0
    ratio = n / len(pack.compress(text))
    bad = 0
    for at in range(0, n, chunk):
        piece = text[at : at + chunk]
        limit = band_of(chunks, len(piece))
        part = ratio if len(piece) == n else len(piece) / len(pack.compress(piece))
        if not limit.low <= part <= limit.high:
            bad += len(piece)
    return ratio, band.low, band.high, bad / n


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    documents: tuple[Band, ...] = DOCUMENT_BANDS,
    chunks: tuple[Band, ...] = CHUNK_BANDS,
    chunk: int = CHUNK,
    max_bad_chunks: float = MAX_BAD_CHUNKS,
    level: int = LEVEL,
) -> DataFrame:
    """One row per input row with base counts, compression figures and verdict; no shuffle.

    Null and empty texts have no words: all counts 0, ``ratio`` null, base_failed.  Repeated rows each
    get their row, an empty table gives none, and columns other than the two named are not read.  A
    very long text is taken whole; chunks are compressed one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=level)

        def rows() -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                out: list[list] = [[] for _ in range(12)]
                for text in raw(part.column(1)):
                    text = text or b""
                    n, chars, symbols, dup, repeat = base_counts(text)
                    ratio, low, high, bad = compression(text, pack, documents, chunks, chunk)
                    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
                    reason = (
                        "few_words" if n < MIN_WORDS
                        else "repeated_windows" if failed
                        else "incompressible" if ratio < low
                        else "repetitive" if ratio > high
                        else "chunks" if bad > max_bad_chunks
                        else None
                    )
                    for column, x in zip(out, (n, chars, symbols, dup, repeat, failed, reason is None, ratio, low, high, bad, reason), strict=True):
                        column.append(x)
                types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 4 + [pa.string()]
                names = [x.split()[0] for x in SCHEMA.split(",")]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(out, types, strict=True))], names=names)

        yield from gathered(rows())

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, SCHEMA).withColumnRenamed("id", id_col)


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns; no shuffle.

    The verdict is computed beside the row it belongs to, so repeated ids need no join.
    """
    width = len(docs.columns)
    schema = docs.schema
    at = docs.columns.index(text_col)
    documents, chunks = limits.get("documents", DOCUMENT_BANDS), limits.get("chunks", CHUNK_BANDS)
    chunk, most, level = limits.get("chunk", CHUNK), limits.get("max_bad_chunks", MAX_BAD_CHUNKS), limits.get("level", LEVEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=level)
        for part in slices(batches):
            mask = []
            for text in raw(part.column(at)):
                text = text or b""
                n, _, _, _, repeat = base_counts(text)
                good = n >= MIN_WORDS and 100 * repeat <= MAX_REPEAT_PERCENT * n
                if good:
                    ratio, low, high, bad = compression(text, pack, documents, chunks, chunk)
                    good = low <= ratio <= high and bad <= most
                mask.append(good)
            yield part.filter(pa.array(mask, pa.bool_()))

    assert width == len(set(docs.columns)), "column names must be distinct"
    return docs.mapInArrow(run, schema)
