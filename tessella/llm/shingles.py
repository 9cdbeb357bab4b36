"""Near-duplicates by the exact Jaccard similarity of word shingles, candidates by SimHash fingerprints and MinHash bands."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, gathered, raw, shared, slices, stored
from .components import components
from .simhash import MAX_BITS, block_masks

SHINGLE = 5
SIMILARITY = 0.8
SEED = 42
#: A pair at similarity s shares a band with probability 1 - (1 - s^ROWS)^BANDS: all but 7 in a million at 0.8.
ROWS = 5
BANDS = 30
#: Shingles whose hashes are taken at once.
BLOCK = 2048
#: Bytes of shingles of one band key that one task compares; more are split into pairs of parts.
PART_BYTES = 8 << 20


def shingle_set(text: bytes | None, width: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text's UTF-8 bytes (A-Z lower-cased).

    A text of up to ``width`` words, also of none, is one shingle.
    """
    tokens = (text or b"").lower().split()
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= width:
        return np.array([digest(b" ".join(tokens), seed)], np.uint64)
    found = map(b" ".join, zip(*(tokens[k:] for k in range(width)), strict=False))
    return np.unique(np.fromiter((digest(x, seed) for x in found), np.uint64, len(tokens) - width + 1))


def _factors(n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 2**64, (2, n, 1), np.uint64)
    return a | np.uint64(1), b


def band_keys(found: np.ndarray, a: np.ndarray, b: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One signed long for each band of MinHash values."""
    least = np.full(len(a), 2**64 - 1, np.uint64)
    for at in range(0, len(found), BLOCK):
        np.minimum(least, (a * found[at : at + BLOCK] + b).min(1), out=least)
    keys = [xxhash.xxh64_intdigest(x.tobytes(), k) for k, x in enumerate(least.reshape(-1, rows))]
    return np.array(keys, np.uint64).view(np.int64)


def simhash(found: np.ndarray) -> int:
    """64-bit SimHash of a set of shingles."""
    ones = np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(found)).astype(np.uint8), bitorder="little").view(np.uint64)[0])


def block_keys(fp: int, masks: np.ndarray) -> np.ndarray:
    """One signed long for each choice of blocks of a fingerprint."""
    return np.array([xxhash.xxh64_intdigest(x.tobytes(), k) for k, x in enumerate(np.uint64(fp) & masks)], np.uint64).view(np.int64)


def set_name(found: np.ndarray) -> int:
    """A signed long that names a set of shingles."""
    name = xxhash.xxh64_intdigest(found.tobytes())
    return name - (1 << 64) if name >= 1 << 63 else name


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int, rows: int, bands: int) -> DataFrame:
    """(id, fp, n, keys) for every row: name and size of its set of shingles, band keys (odd), SimHash block keys (even).  No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _factors(rows * bands)
        masks = np.array(block_masks(), np.int64).view(np.uint64)
        each = bands + len(masks)

        def out() -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                sets = [shingle_set(x, width) for x in raw(part.column(1))]
                keys = np.concatenate([y for x in sets for y in (band_keys(x, a, b, rows) | 1, block_keys(simhash(x), masks) & ~1)])
                offsets = pa.array(np.arange(0, len(keys) + 1, each, dtype=np.int32))
                columns = [part.column(0), pa.array(map(set_name, sets), pa.int64()), pa.array(map(len, sets), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(keys))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "fp", "n", "keys"])

        yield from gathered(out())

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "id long, fp long, n long, keys array<long>")


def similar_links(names: list[int], sets: list[np.ndarray], similarity: float = SIMILARITY, max_bits: int | None = None) -> tuple[list[int], list[int]]:
    """Links that connect what has a Jaccard similarity of ``similarity`` or more, as few as a spanning forest has.

    With ``max_bits`` only what has SimHash fingerprints within so many bits is compared.

    Breadth-first search, each step comparing one set with all not yet reached: no pair is left out, and a
    dense group is used up in a few steps.
    """
    size = np.array([len(x) for x in sets])
    starts = np.cumsum(size) - size
    kinds, flat = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(kinds), bool)
    rest = np.ones(len(sets), bool)
    prints = np.array([simhash(x) for x in sets], np.uint64) if max_bits is not None else None
    a: list[int] = []
    b: list[int] = []
    for first in range(len(sets)):
        if not rest[first]:
            continue
        rest[first] = False
        queue = [first]
        while queue and rest.any():
            x = queue.pop()
            close = rest if prints is None else rest & (np.bitwise_count(prints ^ prints[x]) <= max_bits)
            if not close.any():
                continue
            own = flat[starts[x] : starts[x] + size[x]]
            mark[own] = True
            both = np.add.reduceat(mark[flat], starts, dtype=np.int64)
            mark[own] = False
            near = np.flatnonzero(close & (both >= similarity * (size + size[x] - both) - 1e-9))
            a += [names[x]] * len(near)
            b += [names[y] for y in near]
            rest[near] = False
            queue += near.tolist()
    return a, b


def links(table: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, similarity: float, part_bytes: int = PART_BYTES) -> DataFrame:
    """(a, b): links between distinct sets whose components are those of all similar pairs that share a key.

    Members of a band key are compared all with all, those of a SimHash block key where their fingerprints are within
    MAX_BITS bits.  Keys with the same members are compared once, by the band key if there is one.  A key with more than ``part_bytes`` of shingles is
    split into parts that meet pairwise, so no task holds more than two parts and no pair is left out.
    """
    heads = stored(table.groupBy("fp").agg(F.min_by(F.struct("id", "n", "keys"), "id").alias("h")).select("fp", "h.*"), "heads")
    keyed = heads.select("fp", "id", "n", F.explode("keys").alias("key"))
    again = stored(shared(keyed, ["key"]), "shared")
    groups = again.groupBy("key").agg(F.first("members").alias("members"), F.bit_xor(F.xxhash64("fp")).alias("x"), F.min("fp").alias("least"), F.sum("n").alias("n"))
    once = groups.groupBy("members", "x", "least").agg(F.max(F.struct(F.col("key").bitwiseAND(1).alias("band"), "key"))["key"].alias("key"), F.first("n").alias("all"))
    parts = F.ceil(8 * F.col("all") / part_bytes).cast("int")
    met = stored(again.join(once.select("key", parts.alias("parts")), "key").select("key", "fp", "id", "parts"), "met")
    dealt = met.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    pairs = dealt.select("key", "fp", "mine", F.explode(other).alias("other")).select("key", "fp", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"))
    pairs = few(stored(pairs, "pairs"))

    def run_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch])):
                # A repeated id can have another text.
                rows = [(fp, x) for fp, x in zip(part.column(0).to_pylist(), (shingle_set(x, width) for x in raw(part.column(1))), strict=True) if set_name(x) == fp]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].tobytes() for r in rows], pa.binary())], names=["fp", "shingles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, {}

        def found() -> pa.RecordBatch:
            a, b = similar_links(list(held), list(held.values()), similarity, None if at[0] & 1 else MAX_BITS) if len(held) > 1 else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for part in slices(iter([batch])):
                keys = zip(*(part.column(k).to_pylist() for k in range(3)), strict=True)
                for key, fp, x in zip(keys, part.column(3).to_pylist(), part.column(4).to_pylist(), strict=True):
                    if key != at:
                        yield found()
                        at, held = key, {}
                    held[fp] = np.frombuffer(x, np.uint64)
        yield found()

    wanted = few(stored(met.select("fp", F.col("id").alias("wanted")).distinct(), "wanted"))
    texts = docs.select(F.col(id_col).cast("long").alias("wanted"), F.col(text_col).alias("text")).join(wanted, "wanted").select("fp", "text")
    sets = stored(texts.mapInArrow(run_sets, "fp long, shingles binary"), "sets")
    members = sets.join(pairs, "fp").repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    return members.select("key", "p", "q", "fp", "shingles").mapInArrow(lambda batches: gathered(run(batches)), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    similarity: float = SIMILARITY,
    rows: int = ROWS,
    bands: int = BANDS,
) -> DataFrame:
    """(id, component_id) for every row of ``docs`` with an id.

    Texts with the same set of shingles meet as one before any comparison.  Candidates are those of SimHash (a choice of
    3 of 6 blocks in common, fingerprints within 3 bits) and those that share a band of MinHash values; only pairs whose exact similarity is ``similarity`` or more are linked.
    """
    docs = docs.where(F.col(id_col).isNotNull())
    table = stored(signatures(docs, id_col, text_col, width, rows, bands), "signatures")
    found = components(links(table, docs, id_col, text_col, width, similarity))
    named = table.groupBy("fp").agg(F.min("id").alias("head")).join(found, F.col("fp") == F.col("node"), "left").select("fp", "head", F.coalesce("component", "fp").alias("c"))
    least = named.groupBy("c").agg(F.min("head").alias("component_id"))
    return table.select("id", "fp").join(named.join(least, "c").select("fp", "component_id"), "fp").select(F.col("id").alias(id_col), "component_id")
