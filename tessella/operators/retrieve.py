"""Top-k cosine retrieval within blocks, adaptive pruning, retrieval context."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config, Prune
from ..sources.scratch import passing, stored
from .blocking import raw_weights, term_counts

#: Queries, and records, of one part that a task compares.
PART = 32_768
#: Queries whose results are one Arrow batch.
BATCH = 1024


def best_first(score: str = "score") -> Window:
    return Window.partitionBy("s1_id").orderBy(F.desc(score), "cand_id")


def packed(weights: DataFrame) -> DataFrame:
    """(country, entity_id, fids, ws): one row for each record of a long table of weights."""
    items = F.collect_list(F.struct("fid", "w"))
    return weights.groupBy("country", "entity_id").agg(items.alias("x")).select("country", "entity_id", F.col("x.fid").alias("fids"), F.col("x.w").alias("ws"))


def of_unit_length(rows: DataFrame) -> DataFrame:
    """Packed rows over their norms."""
    norm = F.sqrt(F.aggregate("ws", F.lit(0.0), lambda s, w: s + w * w))
    return rows.withColumn("norm", norm).withColumn("ws", F.transform("ws", lambda w: w / F.when(F.col("norm") > 0, F.col("norm")).otherwise(1.0))).drop("norm")


def may_be_kept(scores: np.ndarray, rules: tuple[Prune, ...]) -> np.ndarray:
    """Which of a part's scores, best first, one of the rules can still keep when all parts are known.

    The best of all parts is this part's or more and ranks only grow, so the bounds are the loosest that can come.
    What a rule keeps stands above all that it drops: pruning the rest gives what pruning all gives, with the same ranks.
    """
    best, rank = scores[0], np.arange(1, len(scores) + 1)
    may = rank == 1
    for p in rules:
        may |= (scores >= p.floor_confident * max(best, p.confident)) & (rank <= p.cap_confident)
        if best <= p.confident:
            may |= (scores >= p.floor * max(best, p.usable)) & (rank <= p.cap)
        if best < p.usable:
            may |= rank <= p.fallback
    return may


class Postings:
    """Posting lists of the records of one part, in the order of their ids."""

    def __init__(self, records: list[pa.RecordBatch]):
        table = pa.Table.from_batches(records).combine_chunks()
        self.ids = table.column("entity_id").combine_chunks()
        lists, w = (table.column(c).combine_chunks() for c in ("fids", "ws"))
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        self.features = coded.dictionary
        self.owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))[order]
        self.w = w.flatten().to_numpy()[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(self.features)))])

    def best(self, codes: np.ndarray, q: np.ndarray, k: int, digits: int | None, within: tuple[Prune, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k records most similar to one query: score > 0, best first, ties by id; see :func:`may_be_kept`."""
        cuts = [slice(self.starts[c], self.starts[c + 1]) for c in codes]
        if not cuts:
            return np.zeros(0, np.int64), np.zeros(0)
        owner = np.concatenate([self.owner[c] for c in cuts])
        products = np.concatenate([self.w[c] * x for c, x in zip(cuts, q, strict=True)])
        if 8 * len(owner) < len(self.ids):
            places, inverse = np.unique(owner, return_inverse=True)
            sums = np.bincount(inverse, products)
        else:
            sums = np.bincount(owner, products, len(self.ids))
            places = np.flatnonzero(sums)
            sums = sums[places]
        if digits is not None:
            sums = np.floor(sums * 10**digits + 0.5) / 10**digits
        keep = sums > 0
        if len(sums) > k:
            keep &= sums >= np.partition(sums, len(sums) - k)[len(sums) - k]
        places, sums = places[keep], sums[keep]
        order = np.argsort(-sums, kind="stable")[:k]
        if within and len(order):
            order = order[may_be_kept(sums[order], within)]
        return places[order], sums[order]

    def search(self, queries: pa.RecordBatch, k: int, digits: int | None, within: tuple[Prune, ...] = ()) -> pa.RecordBatch:
        """(s1_id, country, cand_ids, scores) of a batch of packed queries."""
        lists, w = queries.column("fids"), queries.column("ws").flatten().to_numpy()
        codes = pc.index_in(lists.flatten(), value_set=self.features).fill_null(-1).to_numpy()
        cuts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        found = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            known = codes[a:b] >= 0
            found.append(self.best(codes[a:b][known], w[a:b][known], k, digits, within))
        offsets = pa.array(np.cumsum([0, *(len(x) for x, _ in found)]), pa.int32())
        ids = self.ids.take(pa.array(np.concatenate([x for x, _ in found])))
        scores = pa.array(np.concatenate([x for _, x in found]))
        lists = [pa.ListArray.from_arrays(offsets, x) for x in (ids, scores)]
        return pa.RecordBatch.from_arrays([queries.column("entity_id"), queries.column("country"), *lists], names=["s1_id", "country", "cand_ids", "scores"])


def _meet(batches: Iterator[pa.RecordBatch], k: int, digits: int | None, within: tuple[Prune, ...] = ()) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (country, p, r, side, entity_id): a part of the records (side 0) before the queries that meet it."""
    at, held, index = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = [batch.column("country").dictionary_encode().indices.to_numpy(), *(batch.column(c).to_numpy() for c in ("p", "r", "side"))]
        turns = np.flatnonzero(np.any([np.diff(m) != 0 for m in marks], axis=0)) + 1
        for lo, hi in zip([0, *turns], [*turns, batch.num_rows], strict=True):
            part = batch.slice(lo, hi - lo)
            key = tuple(part.column(c)[0].as_py() for c in ("country", "p", "r"))
            if key != at:
                at, held, index = key, [], None
            if part.column("side")[0].as_py() == 0:
                held.append(part)
            elif held:
                index = index or Postings(held)
                for x in range(0, part.num_rows, BATCH):
                    yield index.search(part.slice(x, BATCH), k, digits, within)


def top_k(queries: DataFrame, weights: DataFrame, idf: DataFrame, cfg: Config, part: int = PART, within: tuple[Prune, ...] = ()) -> DataFrame:
    """(s1_id, country, cand_id, score, rank): each query's k most similar indexed records, score > 0.

    Queries and records of a block are dealt into parts of about ``part`` rows that meet pairwise.  A task sums the
    products of one query at a time over the posting lists of one part of the records, so no product leaves it: the
    shuffles hold each record once for each part of the queries (and the other way round), and each query's k best of
    each part.  Ties go by cand_id; with ``score_digits`` scores are rounded before they are ranked.  A caller that
    prunes next names its rules (``within``): what none of them can keep is not shuffled, and ranks count without it.
    The parts' lists are a stored table (see :func:`scratch.passing`); ranking them is left to the result.
    """
    parts = lambda df, name: df.groupBy("country").agg(F.ceil(F.count("*") / part).cast("int").alias(name))
    mine = lambda n: F.pmod(F.xxhash64("entity_id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["country", "p", "r", "side", "entity_id", "fids", "ws"]
    k, digits = cfg.k, cfg.score_digits
    with passing(queries.sparkSession) as keep:
        asked = stored(of_unit_length(packed(raw_weights(term_counts(queries, cfg), idf))), "asked")
        held = stored(packed(weights), "held")
        deal = F.broadcast(parts(asked, "ps").join(parts(held, "rs"), "country"))  # one row for each country
        records = held.join(deal, "country").withColumns({"p": every("ps"), "r": mine("rs"), "side": F.lit(0)}).select(*columns)
        asking = asked.join(deal, "country").withColumns({"p": mine("ps"), "side": F.lit(1)}).withColumn("r", every("rs")).select(*columns)
        met = records.unionByName(asking).repartition("country", "p", "r").sortWithinPartitions(*columns[:5])
        best = met.mapInArrow(lambda batches: _meet(batches, k, digits, within), "s1_id string, country string, cand_ids array<string>, scores array<double>")
        best = keep(stored(best, "best"))  # weights and their shuffles go before the lists are ranked
    rows = best.repartition("s1_id").select("s1_id", "country", F.explode(F.arrays_zip("cand_ids", "scores")).alias("x"))
    ranked = rows.select("s1_id", "country", F.col("x.cand_ids").alias("cand_id"), F.col("x.scores").alias("score")).withColumn("rank", F.row_number().over(best_first()))
    return ranked.where(F.col("rank") <= cfg.k).select("s1_id", "country", "cand_id", "score", "rank")


def keep_adaptively(score: Column, rank: Column, best: Column, p: Prune) -> Column:
    confident = (score >= p.floor_confident * best) & (rank <= p.cap_confident)
    usable = (score >= p.floor * best) & (rank <= p.cap)
    return (best > 0) & F.when(best >= p.usable, F.when(best > p.confident, confident).otherwise(usable)).otherwise(rank <= p.fallback)


def prune(candidates: DataFrame, p: Prune = Prune()) -> DataFrame:
    """Candidates kept by the adaptive rule, with their new 1-based rank."""
    best = F.max("score").over(Window.partitionBy("s1_id"))
    place = F.row_number().over(best_first())
    kept = candidates.drop("rank").withColumns({"best": best, "rank": place}).where(keep_adaptively(F.col("score"), F.col("rank"), F.col("best"), p))
    return kept.drop("best")


def context(candidates: DataFrame) -> DataFrame:
    """Adds score_over_best, gap_best and gap_next (the last one's next score is 0)."""
    best = F.max("score").over(Window.partitionBy("s1_id"))
    after = F.lead("score", 1, 0.0).over(best_first())
    return candidates.withColumns({
        "score_over_best": F.when(best > 0, F.col("score") / best).otherwise(0.0), "gap_best": best - F.col("score"), "gap_next": F.col("score") - after,
    })


def candidate_lists(s1: DataFrame, candidates: DataFrame) -> DataFrame:
    """(entity_id, candidate_ids): best first, an empty list for records without candidates."""
    lists = candidates.groupBy("s1_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "cand_id"))), lambda x: x["cand_id"]).alias("candidate_ids"))
    return s1.select("entity_id").join(lists, F.col("entity_id") == F.col("s1_id"), "left").select(
        "entity_id", F.coalesce("candidate_ids", F.array().cast("array<string>")).alias("candidate_ids")
    )
