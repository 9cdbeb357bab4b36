"""A corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; stages are written as Parquet and read
again in between.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import mixing, packing, pii, quality, shingles, simhash
from tessella.llm.common import discard, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more) stays."""
    return simhash.deduplicate(docs, by=shingles.near_duplicates)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by the probabilities that meet the source, language and topic targets."""
    mixed = mixing.mix(docs)
    return mixed.where(F.col("selected")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches beside the documents' columns."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("packed", packed),
]

#: Fingerprints, compression and fitted models have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage kept is deleted when the next one has read it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        kept = stored(stage(spark, docs, sf_dir), "stage")
        if i:
            discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
