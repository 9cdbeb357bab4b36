"""Helpers shared by the corpus operators: shared scratch space, narrow inputs, Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import discard, passing, scratch_dir, shared_dir, stored

__all__ = ["discard", "passing", "scratch_dir", "shared_dir", "stored"]

#: ASCII white space, the only separators of words (fixed value).
SPACE = r"[\x20\x09-\x0D]+"

#: Rows of an Arrow batch that are turned into Python objects at once, and bytes (but one row at least).
SLICE_ROWS = 256
SLICE_BYTES = 16 << 20
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


#: Rows of a table of keys that go to every task at most (two or three longs each, 48 MB); more are joined.
BROADCAST_ROWS = 2_000_000


def few(rows: DataFrame) -> DataFrame:
    """A written table of narrow rows, with a hint to send it to every task if it has at most BROADCAST_ROWS."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def shared(rows: DataFrame, keys: list[str], name: str = "counts") -> DataFrame:
    """The rows of ``rows`` whose ``keys`` come up again, with their number as ``members``.

    Keys are counted with sums before the shuffle, so a common key gathers nowhere.  Those that repeat are written;
    if they are few they are sent to the rows, so the rows are not shuffled for it, else joined.
    """
    return rows.join(few(stored(rows.groupBy(*keys).agg(F.count("*").alias("members")).where("members > 1"), name)), keys)


def bucket(id_col: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null ids count as '')."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus


def words(text: Column) -> Column:
    """Array of the words of a text: runs of characters other than ASCII white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into small zero-copy slices, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield from _halved(batch.slice(at, rows), size)


def _halved(part: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    if part.num_rows > 1 and part.nbytes > size:
        half = part.num_rows // 2
        yield from _halved(part.slice(0, half), size)
        yield from _halved(part.slice(half), size)
    else:
        yield part


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """A text cut at white space about every ``size`` bytes, so no word is cut."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + size) if at + size < len(text) else None
        end = gap.end() if gap else len(text)
        yield text[at:end]
        at = end


def flat_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (A-Z lower-cased) of a column of texts one after the other, and the words of each text.

    Words are runs of characters other than ASCII white space; nulls and empty texts have none.
    """
    n = len(texts)
    if n and int(pc.max(pc.binary_length(texts)).as_py() or 0) > PIECE:
        cut = [list(pieces(x or b"")) for x in raw(texts)]
        owner = np.repeat(np.arange(n), [len(x) for x in cut])
        texts = pa.array([p for x in cut for p in x], pa.binary()).cast(pa.string())
    else:
        owner = np.arange(n)
    if not len(texts):
        return pa.array([], pa.string()), np.zeros(n, np.int64)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    starts = lists.offsets.to_numpy()
    flat = lists.values.slice(starts[0], starts[-1] - starts[0])
    # The splitter gives an empty string before leading and after trailing white space.
    full = pc.greater(pc.binary_length(flat), 0)
    sums = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))]).astype(np.int64)[starts - starts[0]]
    return flat.filter(full), np.bincount(owner, np.diff(sums), n).astype(np.int64)


def split_words(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Places of a column's words in the list of distinct words, that list, words of each text (see :func:`flat_words`)."""
    flat, lengths = flat_words(texts)
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), raw(coded.dictionary), lengths


def raw(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Join small result batches, so that few messages go back to the JVM."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def hash_sample(rows: DataFrame, key: str, group: str, most: int, groups: int) -> list[tuple]:
    """(key, group) of up to ``most`` distinct keys of each group: those whose hashes are smallest.

    The ``groups`` most frequent groups take part.  A hash limit that about twice as many keys meet goes first, so
    no task and no window holds a group; then what is left (about ``2 * most * groups`` rows) is collected.
    Null keys and groups take no part.
    """
    rows = rows.select(F.col(key).alias("key"), F.col(group).alias("group")).where("key is not null and group is not null")
    sizes = rows.groupBy("group").agg(F.approx_count_distinct("key", 0.02).alias("n"), F.count("*").alias("rows")).orderBy(F.desc("rows"), "group").limit(groups).collect()
    if not sizes:
        return []
    limits = [(r["group"], int(min(1.0, 2.2 * most / max(1, r["n"])) * 2**52)) for r in sizes]
    schema = f"group {rows.schema['group'].dataType.simpleString()}, top long"
    small = F.broadcast(rows.sparkSession.createDataFrame(limits, schema))  # at most ``groups`` rows
    hashed = rows.withColumn("u", F.shiftrightunsigned(F.xxhash64("key"), 12)).join(small, "group").where("u < top")
    found: dict = {}
    for r in sorted(hashed.select("key", "group", "u").distinct().collect(), key=lambda r: (r["u"], str(r["key"]))):
        found.setdefault(r["group"], []).append((r["key"], r["group"]))
    return [x for rows_ in found.values() for x in rows_[:most]]
