"""F0.5 and its variants, recall at K, sweeps, percentiles, grids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Prune, Rule
from .retrieve import best_first, keep_adaptively

#: The depths at which recall is reported, and the percentiles of scores.
KS = (1, 3, 5, 10, 20, 30, 50, 75, 100, 150, 200, 300, 500)
PERCENTILES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
#: The pruning settings of the sweep (floors of confident and other queries, caps of both).
SWEEP = tuple(
    Prune(floor_confident=a, floor=b, cap_confident=c, cap=d)
    for a, b, c, d in ((0.30, 0.20, 20, 40), (0.25, 0.15, 25, 50), (0.30, 0.18, 30, 45), (0.28, 0.17, 30, 45), (0.32, 0.20, 28, 40), (0.28, 0.16, 28, 45), (0.27, 0.16, 27, 45), (0.30, 0.18, 50, 50))
)
#: The grid of selection rules (single, match, share).
GRID = ((0.55, 0.60, 0.65, 0.68, 0.70, 0.75), (0.45, 0.50, 0.55, 0.60, 0.65), (0.60, 0.70, 0.80, 0.90))


def f05(predicted: Column, hit: Column, truth: Column) -> Column:
    """F0.5 from counts: 1 if both sets are empty, 0 if one is or nothing hits."""
    p, r = hit / predicted, hit / truth
    return F.when((predicted == 0) & (truth == 0), 1.0).when((predicted == 0) | (truth == 0) | (hit == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def entity_f05(entities: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, n_pred, n_hit, n_true, f05) for every entity, also those without pairs on either side."""
    p = predicted.select("s1_id", "cand_id").distinct().withColumn("p", F.lit(1))
    t = truth.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1))
    n = p.join(t, ["s1_id", "cand_id"], "full").groupBy("s1_id").agg(F.sum("p").alias("n_pred"), F.sum(F.when(F.col("p").isNotNull() & F.col("t").isNotNull(), 1)).alias("n_hit"), F.sum("t").alias("n_true"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    every = entities.select("s1_id").distinct().join(n, "s1_id", "left").select("s1_id", zero("n_pred"), zero("n_hit"), zero("n_true"))
    return every.withColumn("f05", f05(F.col("n_pred"), F.col("n_hit"), F.col("n_true")))


def macro_f05(entities: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    return entity_f05(entities, predicted, truth).agg(F.avg("f05").alias("macro_f05"), F.count("*").alias("n_entities"))


def recall_curve(candidates: DataFrame, truth: DataFrame, ks: tuple[int, ...] = KS) -> DataFrame:
    """(k, hits, truths, recall): share of true pairs among the first k candidates."""
    found = truth.select("s1_id", "cand_id").join(candidates.select("s1_id", "cand_id", "rank"), ["s1_id", "cand_id"], "left")
    sums = found.agg(F.count("*").alias("truths"), *(F.count(F.when(F.col("rank") <= k, 1)).alias(f"k{k}") for k in ks))
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("hits")) for k in ks)))
    return sums.select("truths", rows.alias("x")).select("x.k", "x.hits", "truths", (F.col("x.hits") / F.col("truths")).alias("recall"))


def prune_sweep(candidates: DataFrame, truth: DataFrame, n_queries: int, settings: Sequence[Prune], depths: Sequence[int] = ()) -> DataFrame:
    """(setting, kept, hits, recall, mean_candidates[, k]) of several pruning rules in one pass (settings are few).

    With ``depths`` each rule is applied to the first k candidates for each k of them.  Only candidates that a rule keeps meet the truth.
    """
    best = F.max("score").over(Window.partitionBy("s1_id"))
    t = truth.select("s1_id", "cand_id").withColumn("true", F.lit(1))
    each = [(i, k) for k in depths or (None,) for i in range(len(settings))]
    rule = [keep_adaptively(F.col("score"), F.col("rank"), F.col("best"), p) for p in settings]
    kept = [rule[i] if k is None else rule[i] & (F.col("rank") <= k) for i, k in each]
    ranked = candidates.drop("rank").withColumns({"best": best, "rank": F.row_number().over(best_first())})
    base = ranked.where(reduce(or_, rule)).join(t, ["s1_id", "cand_id"], "left")
    sums = base.agg(*(F.count(F.when(c, 1)).alias(f"n{i}") for i, c in enumerate(kept)), *(F.count(F.when(c & F.col("true").isNotNull(), 1)).alias(f"h{i}") for i, c in enumerate(kept)))
    truths = truth.agg(F.count("*").alias("truths"))
    rows = F.explode(F.array(*(F.struct(F.lit(s).alias("setting"), F.col(f"n{i}").alias("kept"), F.col(f"h{i}").alias("hits"), F.lit(k).alias("k")) for i, (s, k) in enumerate(each))))
    out = sums.join(truths).select("truths", rows.alias("x"))  # one row each
    return out.select("x.setting", "x.kept", "x.hits", (F.col("x.hits") / F.col("truths")).alias("recall"), (F.col("x.kept") / n_queries).alias("mean_candidates"), *(["x.k"] if depths else []))


def score_percentiles(scored: DataFrame, by: str = "kind", digits: int = 4) -> DataFrame:
    """(kind, n, p1 .. p99) of scores, interpolated linearly."""
    p = F.percentile("score", F.array(*(F.lit(x) for x in PERCENTILES)))
    got = scored.groupBy(by).agg(F.count("*").alias("n"), p.alias("p"))
    return got.select(by, "n", *(F.round(F.get("p", F.lit(i)), digits).alias(f"p{round(100 * x)}") for i, x in enumerate(PERCENTILES)))


def rank_histogram(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """(worst_rank, entities): the rank of each entity's last true candidate; 0 where one is missed."""
    found = truth.select("s1_id", "cand_id").join(candidates.select("s1_id", "cand_id", "rank"), ["s1_id", "cand_id"], "left")
    worst = found.groupBy("s1_id").agg(F.when(F.count("*") == F.count("rank"), F.max("rank")).otherwise(0).alias("worst_rank"))
    return worst.groupBy("worst_rank").agg(F.count("*").alias("entities"))


def missed_by_country(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """(country, truths, missed): true pairs (with a country) that were not retrieved."""
    found = truth.join(candidates.select("s1_id", "cand_id", F.lit(1).alias("got")), ["s1_id", "cand_id"], "left")
    return found.groupBy("country").agg(F.count("*").alias("truths"), F.count(F.when(F.col("got").isNull(), 1)).alias("missed"))


def missed_examples(candidates: DataFrame, truth: DataFrame, n: int = 20) -> DataFrame:
    """(s1_id, cand_id, country): the first ``n`` true pairs, by their ids, that were not retrieved."""
    found = truth.join(candidates.select("s1_id", "cand_id"), ["s1_id", "cand_id"], "left_anti")
    return found.select("s1_id", "cand_id", "country").orderBy("s1_id", "cand_id").limit(n)


def top_scores(entities: DataFrame, candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, kind, score): the best score of each entity (0 without candidates), kind 'singleton' if it has no true pair."""
    best = candidates.groupBy("s1_id").agg(F.max("score").alias("score"))
    matched = truth.select("s1_id").distinct().withColumn("m", F.lit(1))
    every = entities.select("s1_id").distinct().join(best, "s1_id", "left").join(matched, "s1_id", "left")
    return every.select("s1_id", F.when(F.col("m").isNull(), "singleton").otherwise("matched").alias("kind"), F.coalesce("score", F.lit(0.0)).alias("score"))


def resolver_report(entities: DataFrame, claims: DataFrame, kept: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: macro F0.5 of the resolved claims, claims made and claims kept."""
    score = macro_f05(entities, kept, truth)
    return score.join(claims.agg(F.count("*").alias("n_claims"))).join(kept.agg(F.count("*").alias("n_kept")))  # one row each


def grid_scores(entities: DataFrame, scored: DataFrame, truth: DataFrame, grid=GRID, cap: int = 12, by: list[str] | None = None) -> DataFrame:
    """(rule, single, match, share[, by], macro_f05, n_entities) of every rule; ``entities`` has s1_id (and ``by``).

    A rule keeps a head of the candidates, so each entity is one row of sorted probabilities and truth flags
    (retrieval bounds their number by k) and the rules are applied to it without a further shuffle.
    """
    by = by or []
    t = truth.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1))
    n_true = t.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    flagged = scored.join(t, ["s1_id", "cand_id"], "left")
    item = F.struct((-F.col("prob")).alias("neg"), "cand_id", F.coalesce("t", F.lit(0)).alias("t"))
    lists = flagged.groupBy("s1_id").agg(F.slice(F.sort_array(F.collect_list(item)), 1, cap).alias("items"))
    every = entities.select("s1_id", *by).distinct().join(lists, "s1_id", "left").join(n_true, "s1_id", "left").withColumn("items", F.coalesce("items", F.array().cast(lists.schema["items"].dataType))).withColumn("n_true", F.coalesce("n_true", F.lit(0)))
    rules = F.array(*(F.struct(F.lit(i).alias("rule"), F.lit(a).alias("single"), F.lit(b).alias("match"), F.lit(c).alias("share")) for i, (a, b, c) in enumerate(product(*grid))))
    each = every.select("*", F.explode(rules).alias("r"))
    best = F.when(F.size("items") > 0, -F.element_at("items", 1)["neg"]).otherwise(0.0)
    each = each.withColumn("bar", F.when((F.size("items") > 0) & (best >= F.col("r.single")), F.greatest(F.col("r.match"), F.col("r.share") * best)))
    kept = F.filter("items", lambda x: F.coalesce(-x["neg"] >= F.col("bar"), F.lit(False)))
    counted = each.withColumn("kept", kept).select("r", *by, F.size("kept").alias("n"), F.aggregate("kept", F.lit(0), lambda s, x: s + x["t"]).alias("h"), "n_true")
    return counted.groupBy("r.rule", "r.single", "r.match", "r.share", *by).agg(F.avg(f05(F.col("n"), F.col("h"), F.col("n_true"))).alias("macro_f05"), F.count("*").alias("n_entities"))


def best_rule(scores: DataFrame, by: list[str] | None = None, least: int = 0) -> DataFrame:
    """The rule with the highest macro F0.5 (the first, if several), for each ``by`` group of ``least`` entities or more."""
    order = Window.partitionBy(*(by or [F.lit(1)])).orderBy(F.desc("macro_f05"), "rule")
    return scores.where(F.col("n_entities") >= least).withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")


def baselines(entities: DataFrame, scored: DataFrame, truth: DataFrame, least: float = 0.5) -> DataFrame:
    """One row: macro F0.5 of a perfect classifier on the candidates, of no matches, and of the top candidate."""
    t = truth.select("s1_id", "cand_id").distinct()
    perfect = scored.join(t, ["s1_id", "cand_id"], "left_semi")
    first = scored.withColumn("place", F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc("prob"), "cand_id"))).where((F.col("place") == 1) & (F.col("prob") >= least))
    a = entity_f05(entities, perfect, truth).agg(F.avg("f05").alias("oracle_f05"), F.avg((F.col("n_true") == 0).cast("double")).alias("all_empty_f05"))
    return a.join(entity_f05(entities, first, truth).agg(F.avg("f05").alias("top1_f05")))  # one row each


def weighted_f05(scores: DataFrame, mix: DataFrame) -> DataFrame:
    """Macro F0.5 weighted to a mix of countries; a country that the mix lacks counts as its smallest share.

    ``scores``: s1_id, country, f05.  ``mix``: country, share (one row a country).
    """
    n = scores.groupBy("country").agg(F.count("*").alias("n"), F.sum("f05").alias("s"))
    low = mix.agg(F.min("share").alias("low"))
    w = n.join(F.broadcast(mix), "country", "left").join(F.broadcast(low)).withColumn("w", F.coalesce("share", "low"))
    return w.agg((F.sum(F.col("w") * F.col("s") / F.col("n")) / F.sum("w")).alias("weighted_f05"))
