import uuid

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from tessella.operators import boost, model

NAMES = ("a", "b", "c")


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(5)
    a, b, c = rng.integers(0, 25, 3000), rng.integers(0, 9, 3000), rng.integers(0, 30, 3000)
    label = (a + 3 * b + c // 2 + rng.normal(0, 3, 3000) > 35).astype(float)
    rows = [(f"s{i // 3}", f"c{i}", float(x), float(y), float(z), float(t)) for i, (x, y, z, t) in enumerate(zip(a, b, c, label, strict=True))]
    return spark.createDataFrame(rows, "s1_id string, cand_id string, a float, b float, c double, label double").cache()


def test_training_is_a_few_jobs_and_not_some_for_each_round(spark, labelled):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "fit")
    try:
        fitted = model.fit(labelled, model.Trees(rounds=30, depth=4, least_per_node=5), NAMES)
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert fitted[0].getNumTrees > 10
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 25


def test_trees_are_those_of_spark_and_do_not_depend_on_the_deal(spark, labelled):
    """Without samples of rows and features, Spark's own trees give the same probabilities."""
    trees = model.Trees(rounds=40, depth=3, step=0.1, least_per_node=20, rows=1.0, features="1.0", seeds=(7,))
    ours = model.fit(labelled, trees, NAMES)
    data = model.assemble(labelled, NAMES).withColumn("validation", model.validation(F.col("s1_id")))
    theirs = GBTClassifier(featuresCol="vector", labelCol="label", validationIndicatorCol="validation", maxIter=40, maxDepth=3, stepSize=0.1, minInstancesPerNode=20, seed=7).fit(data)
    assert ours[0].getNumTrees == theirs.getNumTrees > 5
    x, y = (np.array([r.prob for r in model.predict(labelled, m, NAMES).orderBy("cand_id").collect()]) for m in (ours, [theirs]))
    assert np.abs(x - y).max() < 2e-3 and (x > 0.5).sum() > 500
    some = model.Trees(rounds=12, depth=4, least_per_node=5)
    one, other = (model.fit(labelled.repartition(n), some, NAMES)[0].toDebugString.split("\n", 1)[1] for n in (1, 9))
    assert one == other
    with pytest.raises(ValueError, match="features missing"):
        model.fit(labelled.drop("b"), some, NAMES)


def test_missing_values_go_with_the_largest_as_in_the_model(spark):
    rows = [(f"s{i}", f"c{i}", None if i % 4 == 0 else float(i % 4), float(i % 4 in (0, 3))) for i in range(400)]
    df = spark.createDataFrame(rows, "s1_id string, cand_id string, a double, label double")
    fitted = model.fit(df, model.Trees(rounds=5, depth=2, least_per_node=5), ("a",))
    prob = {r.a: r.prob for r in model.predict(df, fitted, ("a",)).join(df.select("cand_id", "a"), "cand_id").collect()}
    assert prob[None] == prob[3.0] > 0.8 > 0.2 > prob[2.0] == prob[1.0]


def test_a_common_value_takes_one_bin():
    assert boost.cuts_of(np.array([3.0, 1.0, np.nan, 1.0])).tolist() == [2.0]
    assert not len(boost.cuts_of(np.full(5, 2.0))) and not len(boost.cuts_of(np.full(5, np.nan)))
    values = np.concatenate([np.zeros(9000), np.arange(1, 1001) / 1000])
    cuts = boost.cuts_of(values, 32)
    assert len(cuts) == 31 and 0 < cuts[0] < 0.001
    sizes = np.bincount(np.searchsorted(cuts, values))
    assert sizes[0] == 9000 and sizes[1:].max() < 40


def test_pairs_of_features_are_told_apart():
    rng = np.random.default_rng(3)
    bins, target = rng.integers(0, boost.BINS, (5, 200)), rng.integers(-8, 8, 200) / 4
    padded = np.vstack([bins, np.zeros((1, 200), int)])
    pairs = (padded[::2] * boost.BINS + padded[1::2]).astype(np.uint16)
    rows, slot = np.arange(0, 200, 2), rng.integers(0, 3, 100)
    got = boost.histograms(pairs, rows, slot, target, 3)
    want = np.zeros_like(got)
    for r, k in zip(rows, slot, strict=True):
        for f in range(6):
            want[k, f, padded[f, r]] += (1, target[r])
    assert (got == want).all()


def test_where_barriers_are_refused_spark_trains(spark, labelled, monkeypatch):
    assert boost.at_once(spark)
    monkeypatch.setattr(boost, "at_once", lambda spark: False)
    trees = model.Trees(rounds=3, depth=2, least_per_node=5, least_rounds=2)
    fitted = model.fit(labelled, trees, NAMES)
    assert model.refit(labelled, fitted, trees, NAMES)[0].getNumTrees >= 2
