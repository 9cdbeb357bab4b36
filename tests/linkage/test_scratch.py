import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessella.plans import queries
from tessella.sources import scratch


def tables_of(spark):
    return {p.name for p in Path(scratch.scratch_dir(spark).removeprefix("file:")).iterdir()}


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    df = scratch.stored(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and df.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_kept_tables_belong_to_the_surrounding_step(spark):
    with scratch.passing(spark) as keep:
        with scratch.passing(spark) as inner:
            a, b = inner(scratch.stored(spark.range(3), "a")), scratch.stored(spark.range(4), "b")
        assert a.count() == 3 and Path(b._scratch).name not in tables_of(spark)
        c = keep(scratch.stored(spark.range(5), "c"))
    assert Path(a._scratch).name not in tables_of(spark) and c.count() == 5


@pytest.mark.parametrize("name", ["resolver_report", "weighted_f05", "macro_f05", "baselines", "country_rules", "retrieval_context", "missed_examples", "resolve_one_to_one", "pseudo_labels", "missed_by_country", "rank_histogram", "country_thresholds", "hashed_topk", "pair_features", "assembled_files"])
def test_what_retrieval_stores_goes_before_its_results_are_read(spark, sf, name):
    before = tables_of(spark)
    df = queries.QUERIES[name](spark, sf)
    left = sorted(x.rpartition("-")[0] for x in tables_of(spark) - before)
    assert set(left) <= {"records", "views", "scored", "best", "context", "run"} and len(left) <= 4
    df.count()
