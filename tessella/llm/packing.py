"""Packing: optimal length buckets from the global histogram, token-budget batches inside each."""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, words

#: Tokens of a padded batch.
TOKEN_BUDGET = 16_384
BUCKETS = 12
#: Documents that are numbered together; a bucket is cut into as many shards as it needs.
SHARD_ROWS = 50_000


def histogram(lengths: DataFrame, length_col: str) -> list[tuple[int, int]]:
    """(length, documents) for each length, in order.

    k distinct lengths need more than k * k / 2 tokens, so the driver gets at most sqrt(2 * tokens) rows.
    """
    return sorted((r[0], r[1]) for r in lengths.groupBy(length_col).agg(F.count("*")).collect())


def boundaries(hist: list[tuple[int, int]], buckets: int = BUCKETS) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least padding (dynamic programming, exact integers).

    The padding of a bucket is its end times its documents, less their tokens, so a bucket after the first i lengths
    that ends at the j-th adds end * (n_j - n_i) to what the first i cost: a line in ``end`` for each i.  The least of
    these lines is kept as their lower envelope, so a bucket more costs time in proportion to the lengths.  Among equal
    solutions the one with fewest buckets, then smallest ends, is taken.
    """
    if not hist:
        return []
    top, m = [h[0] for h in hist], len(hist)
    n = [0]
    for _, count in hist:
        n.append(n[-1] + count)
    cost: list[int | None] = [0] + [None] * m
    back, totals = [], []
    for _ in range(min(buckets, m)):
        new: list[int | None] = [None] * (m + 1)
        choice = [0] * (m + 1)
        lines: list[int] = []  # of lengths i: cost[i] - n[i] * end
        first = 0
        for j in range(1, m + 1):
            i = j - 1
            if cost[i] is not None:
                while len(lines) - first > 1:
                    a, b = lines[-2], lines[-1]
                    # b is nowhere below both a and i.
                    if (cost[i] - cost[a]) * (n[b] - n[a]) <= (cost[b] - cost[a]) * (n[i] - n[a]):
                        lines.pop()
                    else:
                        break
                lines.append(i)
            x = top[j - 1]
            while len(lines) - first > 1 and cost[lines[first + 1]] - n[lines[first + 1]] * x < cost[lines[first]] - n[lines[first]] * x:
                first += 1
            if len(lines) > first:
                choice[j] = lines[first]
                new[j] = cost[lines[first]] + (n[j] - n[lines[first]]) * x
        cost = new
        back.append(choice)
        totals.append(new[m])
    k = min(range(len(totals)), key=lambda b: (totals[b] is None, totals[b] or 0))
    j, ends = m, []
    for level in range(k, -1, -1):
        ends.append(top[j - 1])
        j = back[level][j]
    return ends[::-1]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: Column | None = None,
    budget: int = TOKEN_BUDGET,
    buckets: int = BUCKETS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``docs`` with n_tokens, bucket, bucket_len, shard, batch and batch_id columns; every row is packed.

    ``length``: the tokens of a row, by default the words of its whole text (null and empty texts have 0
    tokens and go to the first bucket).  A batch holds up to max(1, budget // bucket_len) rows of one bucket,
    padded to bucket_len; a document longer than the budget is a batch of its own.  Rows of a bucket are
    dealt to shards by the md5 of id and length (without an id, of the row's place), and numbered within the shard, so
    a window holds about ``shard_rows`` rows, and more only where one id repeats; all batches of a shard but the last
    are full.  Columns of ``docs`` that have
    one of the names used here keep it, and the new column gets an underscore.  Repeated rows are packed
    each; ties in length go by id; an empty table stays empty.
    """
    names = {x: fresh(docs, x) for x in ("n_tokens", "bucket", "bucket_len", "shard", "batch", "batch_id")}
    tokens = (F.size(words(F.col(text_col))) if length is None else F.coalesce(length, F.lit(0))).cast("long")
    measured = docs.withColumn(names["n_tokens"], tokens)
    hist = histogram(docs.select(tokens.alias("n_tokens")), "n_tokens")
    ends = boundaries(hist, buckets) or [0]
    counts = [0] * len(ends)
    for length_, n in hist:
        counts[bisect_left(ends, length_)] += n
    shards = [max(1, -(-c // shard_rows)) for c in counts]

    def by_bucket(values: list[int]) -> Column:
        out = F.lit(values[-1])
        for end, value in list(zip(ends, values, strict=True))[-2::-1]:
            out = F.when(F.col(names["n_tokens"]) <= end, value).otherwise(out)
        return out.cast("long")

    row = F.coalesce(F.col(id_col).cast("long"), F.monotonically_increasing_id())
    spread = F.conv(F.substring(F.md5(F.concat_ws("|", row, names["n_tokens"])), 1, 8), 16, 10).cast("long")
    dealt = measured.withColumns({
        names["bucket"]: by_bucket(list(range(len(ends)))).cast("int"),
        names["bucket_len"]: by_bucket(ends),
        names["shard"]: (spread % by_bucket(shards)).cast("int"),
    })
    place = fresh(docs, "place")
    size = by_bucket([max(1, budget // max(1, e)) for e in ends])
    order = Window.partitionBy(names["bucket"], names["shard"]).orderBy(names["n_tokens"], id_col)
    numbered = dealt.withColumn(place, F.row_number().over(order))
    batch = F.floor((F.col(place) - 1) / size).cast("long")
    return numbered.withColumn(names["batch"], batch).withColumn(
        names["batch_id"], F.concat_ws("-", names["bucket"], names["shard"], names["batch"])
    ).drop(place)
