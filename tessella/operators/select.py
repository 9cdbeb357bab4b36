"""Set selection and the one-to-one resolver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Rule


RULES = "country string, single double, match double, share double"


def rules_by_country(best: DataFrame) -> DataFrame:
    """(country, single, match, share) from the best rules of :func:`metrics.best_rule`, one row a country."""
    return best.select("country", "single", "match", "share")


def select_matches(scored: DataFrame, rule: Rule = Rule(), by_country: DataFrame | None = None) -> DataFrame:
    """Pairs (s1_id, cand_id, prob) that the rule keeps.

    No match if the best probability is below ``single``; else those of at least max(match, share * best),
    ``cap`` at most, best first, ties by cand_id.  ``by_country`` (see :func:`rules_by_country`) holds own limits of
    some countries; all others follow ``rule``.
    """
    by = Window.partitionBy("s1_id")
    ranked = scored.withColumns({"best": F.max("prob").over(by), "place": F.row_number().over(by.orderBy(F.desc("prob"), "cand_id"))})
    limits = {x: F.lit(getattr(rule, x)) for x in ("single", "match", "share")}
    if by_country is not None:
        own = by_country.select("country", *(F.col(x).alias(f"own_{x}") for x in limits))
        ranked = ranked.join(F.broadcast(own), "country", "left")  # one row a country
        limits = {x: F.coalesce(f"own_{x}", v) for x, v in limits.items()}
    bar = F.greatest(limits["match"], limits["share"] * F.col("best"))
    kept = ranked.where((F.col("best") >= limits["single"]) & (F.col("prob") >= bar) & (F.col("place") <= rule.cap))
    return kept.select(*scored.columns)


def resolve_one_to_one(claims: DataFrame) -> DataFrame:
    """Claims (s1_id, cand_id, prob) such that no candidate is claimed twice.

    A candidate goes to the highest probability among records whose best claim it is; if it is nobody's
    best, to the highest of all; ties go to the smaller s1_id.  One window over the candidates.
    """
    first = F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc("prob"), "cand_id")) == 1
    own = Window.partitionBy("cand_id").orderBy(F.desc("is_best"), F.desc("prob"), "s1_id")
    return claims.withColumn("is_best", first).withColumn("place", F.row_number().over(own)).where("place = 1").drop("is_best", "place")


def pseudo_labels(scored: DataFrame, trained_countries: DataFrame, least: float = 0.85, digits: int = 6) -> DataFrame:
    """Confident pairs (s1_id, cand_id, prob) of countries that no training pair had; once each, the highest probability."""
    new = scored.join(F.broadcast(trained_countries.select("country").distinct()), "country", "left_anti")  # one row a country
    return new.where(F.col("prob") >= least).groupBy("s1_id", "cand_id").agg(F.round(F.max("prob"), digits).alias("prob"))
