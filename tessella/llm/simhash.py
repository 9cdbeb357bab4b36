"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few, fresh, gathered, passing, raw, shared, slices, stored
from .components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
#: Fingerprints are cut into this many blocks; two within MAX_BITS bits share BLOCKS - MAX_BITS of them.
BLOCKS = 6
#: Members of a block key that one task compares; more are split into pairs of parts.
PART = 20_000


def fingerprint(text: bytes | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the shingles of a text's UTF-8 bytes (A-Z lower-cased); 0 if it has no words."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    if len(tokens) <= width:
        shingles: Iterator[bytes] = iter([b" ".join(tokens)])
    else:
        shingles = map(b" ".join, zip(*(tokens[k:] for k in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    n = max(1, len(tokens) - width + 1)
    h = np.fromiter((digest(x, seed) for x in shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        ones += np.unpackbits(h[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, fp) for every row; ``fp`` is the fingerprint as a signed long.  No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                fp = np.array([fingerprint(x, width, seed) for x in raw(part.column(1))], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp)], names=["id", "fp"])

        yield from gathered(rows())

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "id long, fp long")


def block_masks(blocks: int = BLOCKS, max_bits: int = MAX_BITS) -> list[int]:
    """Bit masks (as signed longs) of all choices of blocks - max_bits blocks."""
    cuts = [round(64 * k / blocks) for k in range(blocks + 1)]
    part = [((1 << cuts[k + 1]) - (1 << cuts[k])) for k in range(blocks)]
    masks = [sum(part[k] for k in c) for c in combinations(range(blocks), blocks - max_bits)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def spanning_links(left: np.ndarray, right: np.ndarray | None, max_bits: int) -> tuple[list[int], list[int]]:
    """Links that connect what lies within ``max_bits`` bits, as few as a spanning forest has.

    One array: breadth-first search over its values, each step comparing one value with those not yet
    reached.  Two arrays: the same on their union, so links inside one part may come as well, which are
    true links too.  A dense cluster is used up in a few steps; memory is one array.
    """
    rest = np.unique(left if right is None else np.concatenate([left, right]))
    a: list[int] = []
    b: list[int] = []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count((rest ^ x).view(np.uint64)) <= max_bits
            if near.any():
                found = rest[near]
                a += [int(x)] * len(found)
                b += found.tolist()
                queue += list(found)
                rest = rest[~near]
    return a, b


def links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, part: int = PART) -> DataFrame:
    """(a, b): links between distinct fingerprints whose components are those of all close pairs.

    Each fingerprint goes to every choice of ``blocks - max_bits`` of its blocks: close pairs meet in at
    least one.  A key's members are counted before they meet (with map-side sums, so a common key gathers
    nowhere), keys with one member end there, and a key with more than ``part`` members is split into parts
    that meet pairwise, so no task or row holds more than two parts and no pair is left out.
    """
    masks = block_masks(blocks, max_bits)
    keyed = fps.select(
        F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks))).alias("mask", "key"),
        "fp",
    )
    met = shared(keyed, ["mask", "key"]).withColumnRenamed("members", "n")
    parts = F.ceil(F.col("n") / part).cast("int")
    mine: Column = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = met.withColumn("parts", parts).withColumn("mine", mine)
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    pairs = dealt.select("mask", "key", "fp", "mine", F.explode(other).alias("other"))
    grouped = pairs.groupBy("mask", "key", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q")).agg(F.collect_list("fp").alias("members"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            values = column.values.to_numpy(zero_copy_only=False)
            offsets = column.offsets.to_numpy()
            a: list[int] = []
            b: list[int] = []
            for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
                x, y = spanning_links(values[lo:hi], None, max_bits)
                a += x
                b += y
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return grouped.select("members").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    seed: int = SEED,
    max_bits: int = MAX_BITS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``.

    Exact copies meet as one fingerprint before any comparison, so a group of copies of any size costs
    the comparison one row; the rows of a group get their component by a join that adaptive execution splits
    where one fingerprint is common.  Null, empty and white-space texts have fingerprint 0 and are linked like any
    other.  Repeated rows each get their row; rows with a null id get a component by the other rows of
    their group (null if there are none).  An empty table gives an empty result.
    """
    table = stored(fingerprints(docs, id_col, text_col, width, seed), "fingerprints")
    heads = stored(table.groupBy("fp").agg(F.min("id").alias("head")), "heads")
    found = components(links(heads, max_bits, blocks))
    # A component of fingerprints is named by its smallest fingerprint; its id is the smallest of all heads.
    named = heads.join(found, heads.fp == found.node, "left").select("fp", "head", F.coalesce("component", "fp").alias("c"))
    least = named.groupBy("c").agg(F.min("head").alias("component_id"))
    labels = named.join(least, "c").select("fp", "component_id")
    return table.join(labels, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: Callable[..., DataFrame] = near_duplicates, **options) -> DataFrame:
    """One document of each group that ``by`` finds stays: that with the smallest id, all columns kept.

    Only ids are joined with the documents: those that go, and those that repeat.  If they are few
    (see :func:`common.few`) they are sent to all tasks, so no text is shuffled; else they are joined.  Rows that repeat the id of the document that stays
    are reduced to one of them (by a hash of the text).  Rows without an id cannot be told apart and stay.
    """
    with passing(docs.sparkSession) as keep:
        found = by(docs, id_col, text_col, **options).where(F.col(id_col).isNotNull())
        each = found.groupBy(F.col(id_col).alias("id")).agg(F.max("component_id").alias("head"), F.count("*").alias("rows"))
        marked = keep(stored(each.where("head < id or rows > 1"), "marked"))
    key = fresh(docs, "marked_id")
    ids = lambda condition: few(marked.where(condition).select(F.col("id").alias(key)))
    match = F.col(id_col).cast("long") == F.col(key)
    once = docs.join(ids("true"), match, "left_anti")
    again = docs.join(ids("head = id"), match, "left_semi")
    # The rows of one id are reduced by a running minimum, not gathered.
    row, place = fresh(docs, "row"), F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    kept = again.groupBy(id_col).agg(F.min_by(F.struct(*docs.columns), place).alias(row)).select(f"{row}.*")
    return once.unionByName(kept)
