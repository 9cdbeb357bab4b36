"""Exact top-k inner products by no-random-access aggregation of sorted lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Components are read as floor(SCALE * x).
SCALE = 1024
#: Queries that one pass over the vectors answers; their vectors are sent to all tasks (the size is bounded
#: by this count times the dimension, 4 MB at 64 dimensions).
QUERY_BLOCK = 8192
#: Vectors whose sorted lists are in memory at once, and queries that read them together.
LIST_BLOCK = 4096
QUERY_GROUP = 256
#: Depths, as shares of a list, at which bounds may be looked at, and the first of them where no score is known yet.
DEPTHS = (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.8, 1.0)
FIRST = 2


def usable(vector: Column) -> Column:
    """True for vectors that are neither null nor hold null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, with x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


class Lists:
    """Sorted lists of one block of vectors, one list for each component, read from either end.

    A query reads list d downwards if its weight there is positive, upwards if negative: contributions then
    never grow with depth.  ``top[d]`` and ``low[d]`` give each vector's place from either end.
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        n = len(x)
        order = np.argsort(x, axis=0, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(n)[:, None], axis=0)
        self.low, self.top = place, n - 1 - place
        self.sorted = np.take_along_axis(x, order, axis=0)
        #: What is read down to a depth, and what is not: made once for all queries that look there.
        self.parts: dict[int, np.ndarray] = {}

    def read(self, depth: int) -> np.ndarray:
        """Rows: read components by list from the top, from the bottom; then 1 for each unread one, likewise."""
        if depth not in self.parts:
            top, low = self.top < depth, self.low < depth
            kind = self.x.dtype
            self.parts[depth] = np.concatenate([self.x * top, self.x * low, (~top).astype(kind), (~low).astype(kind)], axis=1).T
        return self.parts[depth]

    def search(self, q: np.ndarray, k: int, floor: np.ndarray, own: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each query, the vectors that may be among its k best, given k-th best scores so far.

        ``floor``: scores that an answer must reach; ``own[i]``: places of vectors that query i may not
        return (its own rows).  A query's lists are read down to the depth at which a vector seen in none of them
        could not reach its floor any more (outsiders cannot qualify before); the depth follows from the lists'
        frontiers alone.  There a vector's upper bound counts its unread parts at the frontier, its lower bound at
        the end of their lists (only needed where no floor is known).  A query stops when few vectors have an upper
        bound that reaches the floor (equal ones stay, as ties go to the smaller id), else its lists are read on;
        the scores of what remains are resolved by the caller.
        """
        n = len(self.x)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        depths = np.unique([min(n, max(2 * k, int(np.ceil(n * share)))) for share in DEPTHS])
        fronts = up @ self.sorted[n - depths].T + down @ self.sorted[depths - 1].T
        ready = fronts < floor[:, None]
        at = np.where(np.isinf(floor), min(FIRST, len(depths) - 1), np.where(ready.any(1), ready.argmax(1), len(depths) - 1))
        for g, depth in enumerate(depths):
            waiting = np.flatnonzero(at == g)
            if not len(waiting):
                continue
            p, m = up[waiting], down[waiting]
            if depth >= n:
                lower = upper = q[waiting] @ self.x.T
            else:
                parts = self.read(int(depth))
                weigh = lambda a, b, rows: np.concatenate([p[rows], m[rows], p[rows] * a, m[rows] * b], axis=1) @ parts  # noqa: B023, E731
                upper = weigh(self.sorted[n - depth], self.sorted[depth - 1], slice(None))
                new = np.flatnonzero(np.isinf(floor[waiting]))
                lower = np.full(upper.shape if len(new) else (len(upper), 0), -np.inf)
                if len(new):
                    lower[new] = weigh(self.sorted[0], self.sorted[-1], new)
            for row, query in enumerate(waiting):
                hi, bar = upper[row].astype(np.float64), floor[query]
                lo = lower[row].astype(np.float64) if np.isinf(bar) else np.zeros(0)
                if self.x.dtype.kind == "i":  # too large for exact doubles: widen the bounds by their rounding
                    slack = 1.0 + 2.0**-50 * max(np.abs(lo).max(initial=0), np.abs(hi).max())
                    lo, hi, bar = lo - slack, hi + slack, bar - slack
                if len(own[query]):
                    hi[own[query]] = -np.inf
                    if len(lo):
                        lo[own[query]] = -np.inf
                if len(lo) > k:
                    bar = max(bar, np.partition(lo, n - k)[n - k])
                inside = np.flatnonzero((hi >= bar) & (hi > -np.inf))
                if depth >= n or len(inside) <= max(4 * k, n // 16):
                    yield query, inside
                else:
                    at[query] = len(depths) - 1


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = [np.zeros(0, np.int64)] * queries
        self.ids = [np.zeros(0, np.int64)] * queries
        self.floor = np.full(queries, -np.inf)

    def add(self, query: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[query], score]), np.concatenate([self.ids[query], ids])
        order = np.lexsort((ids, -score))[: self.k]
        self.score[query], self.ids[query] = score[order], ids[order]
        if len(order) == self.k:
            self.floor[query] = score[order[-1]]


def _exact(q: np.ndarray, x: np.ndarray) -> bool:
    """Whether products and sums stay within the integers that doubles hold."""
    if not q.size or not x.size:
        return True
    return float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] * 4 < 2.0**53


def search_block(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, best: Best) -> None:
    """Update ``best`` with one block of vectors."""
    fits = _exact(q, x)
    lists = Lists(x.astype(np.float64) if fits else x)
    kind = np.float64 if fits else np.int64
    order = np.argsort(ids, kind="stable")
    lo, hi = np.searchsorted(ids[order], query_ids, "left"), np.searchsorted(ids[order], query_ids, "right")
    for at in range(0, len(q), QUERY_GROUP):
        end = min(len(q), at + QUERY_GROUP)
        own = [order[lo[i] : hi[i]] for i in range(at, end)]
        for i, inside in lists.search(q[at:end].astype(kind), best.k, best.floor[at:end], own):
            if len(inside):
                best.add(at + i, (x[inside] @ q[at + i]).astype(np.int64), ids[inside])


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products over all vectors.

    Ties go to the smaller id; a query with fewer candidates returns them all.  Rows with the query's own id
    are not candidates.  Vectors that are null or hold null or non-finite components, and rows without an
    id, take no part; vectors of another length than the query's are not comparable with it.  A repeated
    row counts as a candidate each time; a repeated query is answered once.  Scores must fit 64 bits.  Queries go through in blocks
    of bounded size, each against all rows; a task keeps k answers of each query and passes them on once.
    """
    spark = vectors.sparkSession
    narrow = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    narrow = narrow.select("id", quantised(F.col("v"), scale).alias("v"), F.size("v").alias("dim"))
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    asked = asked.select("id", quantised(F.col("v"), scale).alias("v"), F.size("v").alias("dim")).distinct()
    n = asked.count()
    blocks = max(1, -(-n * 5 // (query_block * 4)))
    if blocks > 1:
        asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))), "queries")
    parts = []
    for block in range(blocks):
        own = asked.where(F.col("block") == block) if blocks > 1 else asked
        rows = sorted((r.dim, r.id, r.v) for r in own.select("dim", "id", "v").collect())
        by_dim = {d: (np.array([r[1] for r in rows if r[0] == d]), np.array([r[2] for r in rows if r[0] == d], np.int64)) for d in {r[0] for r in rows}}
        parts.append(narrow.mapInArrow(_pass(by_dim, k), "query_id long, vec_id long, score long"))
    found = parts[0]
    for other in parts[1:]:
        found = found.union(other)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pass(by_dim: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {d: Best(len(q), k) for d, (_, q) in by_dim.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, LIST_BLOCK):
                part = batch.slice(at, LIST_BLOCK)
                ids, dims = part.column(0).to_numpy(), part.column(2).to_numpy()
                values = part.column(1).flatten().to_numpy()
                offsets = np.concatenate([[0], np.cumsum(dims)])
                for d, (query_ids, q) in by_dim.items():
                    mine = np.flatnonzero(dims == d)
                    if len(mine) and d:
                        x = values.reshape(-1, d) if len(mine) == len(dims) else values[offsets[mine][:, None] + np.arange(d)]
                        search_block(query_ids, q, ids[mine], x, best[d])
        for d, (query_ids, _) in by_dim.items():
            b = best[d]
            sizes = [len(s) for s in b.score]
            for at in range(0, len(sizes), 1000):
                s = slice(at, at + 1000)
                if sum(sizes[s]):
                    arrays = [np.repeat(query_ids[s], sizes[s]), np.concatenate(b.ids[s]), np.concatenate(b.score[s])]
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["query_id", "vec_id", "score"])

    return run
