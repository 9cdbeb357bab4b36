"""The pair classifier: gradient-boosted trees, seeds averaged."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Rule
from ..sources.tables import in_split
from . import boost
from .pairs import FEATURES
from .select import RULES


@dataclass(frozen=True)
class Trees:
    """Boosting settings; rounds end early when the validation loss stops falling."""

    rounds: int = 2500
    depth: int = 7
    step: float = 0.05
    least_per_node: int = 50
    rows: float = 0.85
    features: str = "0.85"
    seeds: tuple[int, ...] = (42,)
    least_rounds: int = 50


def assemble(df: DataFrame, names: tuple[str, ...] = FEATURES) -> DataFrame:
    """Adds a vector of the named features; more columns are ignored, missing ones are an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"features missing: {missing}")
    return VectorAssembler(inputCols=list(names), outputCol="vector", handleInvalid="keep").transform(df)


def label_pairs(features: DataFrame, truth: DataFrame) -> DataFrame:
    """Features with label 1 for true pairs and 0 for others."""
    t = truth.select("s1_id", "cand_id").distinct().withColumn("label", F.lit(1.0))
    return features.join(t, ["s1_id", "cand_id"], "left").fillna(0.0, ["label"])


def training_set(features: DataFrame, truth: DataFrame, pseudo_features: DataFrame | None = None, pseudo: DataFrame | None = None) -> DataFrame:
    """Labelled pairs with a ``pseudo`` flag; pairs of pseudo-labelled entities are labelled by the confident pairs.

    Only entities that have a confident pair are taken from ``pseudo_features``.
    """
    rows = label_pairs(features, truth).withColumn("pseudo", F.lit(False))
    if pseudo is None:
        return rows
    own = pseudo_features.join(pseudo.select("s1_id").distinct(), "s1_id", "left_semi")
    return rows.unionByName(label_pairs(own, pseudo).withColumn("pseudo", F.lit(True)), allowMissingColumns=True)


def save_training_set(rows: DataFrame, path: str, names: tuple[str, ...] = FEATURES) -> None:
    """The pairs, and one JSON line about them."""
    rows.write.mode("overwrite").parquet(f"{path}/pairs")
    n = rows.sparkSession.read.parquet(f"{path}/pairs").agg(
        F.count("*").alias("pairs"), F.sum("label").cast("long").alias("positives"), F.countDistinct(F.when(F.col("pseudo"), F.col("s1_id"))).alias("pseudo_entities")
    )
    about = n.withColumn("features", F.lit(json.dumps(list(names))))
    about.coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_training_set(spark: SparkSession, path: str, names: tuple[str, ...] = FEATURES) -> DataFrame:
    """The pairs of :func:`save_training_set`; other features than ``names`` are an error."""
    stored = json.loads(spark.read.json(f"{path}/meta").first()["features"])
    if tuple(stored) != tuple(names):
        raise ValueError(f"training set has {len(stored)} features, expected {len(names)}: build it again")
    return spark.read.parquet(f"{path}/pairs")


def validation(s1_id: Column, percent: int = 20) -> Column:
    return in_split(s1_id, percent)


def _models(labelled: DataFrame, held: Column | None, trees: Trees, names: tuple[str, ...], rounds: list[int]) -> list[GBTClassificationModel]:
    missing = [n for n in names if n not in labelled.columns]
    if missing:
        raise ValueError(f"features missing: {missing}")
    if not boost.at_once(labelled.sparkSession):
        data = assemble(labelled, names).withColumn("validation", F.lit(False) if held is None else held).select("vector", "label", "validation")
        make = lambda seed, n: GBTClassifier(
            featuresCol="vector", labelCol="label", maxIter=n, maxDepth=trees.depth, stepSize=trees.step, minInstancesPerNode=trees.least_per_node,
            subsamplingRate=trees.rows, featureSubsetStrategy=trees.features, seed=seed, cacheNodeIds=True, **({} if held is None else {"validationIndicatorCol": "validation"}),
        )
        return [make(seed, n).fit(data) for seed, n in zip(trees.seeds, rounds, strict=True)]
    rows = labelled.select(*names, F.xxhash64("s1_id", "cand_id").alias("key"), "label", (F.lit(False) if held is None else held).alias("held"))
    return boost.train(rows, names, [boost.Settings(n, trees.depth, trees.step, trees.least_per_node, trees.rows, float(trees.features), seed) for seed, n in zip(trees.seeds, rounds, strict=True)])


def fit(labelled: DataFrame, trees: Trees = Trees(), names: tuple[str, ...] = FEATURES, percent: int = 20) -> list[GBTClassificationModel]:
    """One model for each seed; a fifth of the entities (never single pairs) stops the boosting early.

    Pseudo-labelled entities (``pseudo`` true, if there is such a column) teach but do not validate.
    """
    held = validation(F.col("s1_id"), percent)
    if "pseudo" in labelled.columns:
        held = held & ~F.col("pseudo")
    return _models(labelled, held, trees, names, [trees.rounds] * len(trees.seeds))


def refit(labelled: DataFrame, models: list[GBTClassificationModel], trees: Trees = Trees(), names: tuple[str, ...] = FEATURES) -> list[GBTClassificationModel]:
    """Models on all entities, with a tenth more rounds than the stopped ones had (``least_rounds`` at least)."""
    return _models(labelled, None, trees, names, [max(trees.least_rounds, int(1.1 * m.getNumTrees)) for m in models])


def predict(features: DataFrame, models: list[GBTClassificationModel], names: tuple[str, ...] = FEATURES, digits: int = 6) -> DataFrame:
    """(s1_id, cand_id[, country], prob): mean probability over the models, rounded."""
    df = assemble(features, names)
    for i, m in enumerate(models):
        df = m.copy().setProbabilityCol(f"p{i}").setRawPredictionCol(f"r{i}").setPredictionCol(f"c{i}").transform(df)
    mean = sum((F.get(vector_to_array(f"p{i}"), F.lit(1)) for i in range(len(models))), F.lit(0.0)) / len(models)
    keep = ["s1_id", "cand_id", *(["country"] if "country" in features.columns else [])]
    return df.select(*keep, F.round(mean, digits).alias("prob"))


def save(
    models: list[GBTClassificationModel], path: str, rule: Rule, names: tuple[str, ...] = FEATURES, by_country: dict[str, Rule] | None = None,
    scores: dict[str, float] | None = None, validation_ids: DataFrame | None = None,
) -> None:
    """Models, and their metadata: features, rules, baselines and other scores; the entities that validated beside them."""
    spark = SparkSession.active()
    for i, m in enumerate(models):
        PipelineModel([m]).write().overwrite().save(f"{path}/model{i}")
    meta = {
        "features": list(names), "models": len(models), "trees": [m.getNumTrees for m in models], "rule": asdict(rule),
        "by_country": {c: asdict(r) for c, r in (by_country or {}).items()}, "scores": scores or {},
    }
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
    if validation_ids is not None:
        validation_ids.select("s1_id").distinct().write.mode("overwrite").parquet(f"{path}/validation_ids")


def load(path: str) -> tuple[list[GBTClassificationModel], dict]:
    """Models and metadata; the rules are :class:`Rule` objects."""
    meta = json.loads(SparkSession.active().read.text(f"{path}/meta").first()[0])
    meta["rule"] = Rule(**meta["rule"])
    meta["by_country"] = {c: Rule(**r) for c, r in meta["by_country"].items()}
    return [PipelineModel.load(f"{path}/model{i}").stages[0] for i in range(meta["models"])], meta


def rule_table(spark: SparkSession, by_country: dict[str, Rule]) -> DataFrame:
    """Rules by country as a table for :func:`select.select_matches`."""
    return spark.createDataFrame([(c, r.single, r.match, r.share) for c, r in by_country.items()], RULES)
