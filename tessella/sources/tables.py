"""Readers.  Every field is a string; a missing field is '', never null."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RECORD = ("entity_id", "business_name", "business_address", "country")
TRUTH = ("source1_entity_id", "matched_entity_ids")
ID = r"^S([123])-([0-9]{1,9})$"


@dataclass(frozen=True)
class Paths:
    """Where tables are; by default from ER_DATA_DIR, ER_WORK_DIR and ER_OUTPUT_DIR."""

    data: str = "data"
    work: str = "work"
    output: str = "output"

    @staticmethod
    def from_environment() -> Paths:
        return Paths(*(os.environ.get(k, d) for k, d in (("ER_DATA_DIR", "data"), ("ER_WORK_DIR", "work"), ("ER_OUTPUT_DIR", "output"))))


def read_tsv(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """A tab-separated table with a header; doubled quotes, line breaks in quotes, short rows."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    df = spark.read.schema(schema).csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=True, mode="PERMISSIVE", enforceSchema=True)
    return df.select(*(F.coalesce(c, F.lit("")).alias(c) for c in columns))


def read_records(spark: SparkSession, path: str, country: str | None = None, limit: int | None = None) -> DataFrame:
    df = read_tsv(spark, path, RECORD)
    df = df if country is None else df.where(F.col("country") == country)
    return df if limit is None else df.limit(limit)


def read_corpus(spark: SparkSession, paths: Paths, corpus: str) -> tuple[DataFrame, DataFrame]:
    """(queries: source 1, indexed records: sources 2 and 3)."""
    one, two, three = (read_records(spark, f"{paths.data}/{corpus}_source{n}.tsv") for n in (1, 2, 3))
    return one, two.unionByName(three)


def matched_lists(df: DataFrame, list_col: str = "matched_entity_ids") -> DataFrame:
    """(s1_id, ids): comma lists as arrays without empty items."""
    ids = F.filter(F.split(F.coalesce(list_col, F.lit("")), ","), lambda x: x != "")
    return df.select(F.col("source1_entity_id").alias("s1_id"), ids.alias("ids"))


def truth_pairs(lists: DataFrame) -> DataFrame:
    """(s1_id, cand_id) rows of matched lists, each once."""
    return lists.select("s1_id", F.explode("ids").alias("cand_id")).distinct()


def read_truth(spark: SparkSession, path: str, subset: DataFrame | None = None) -> DataFrame:
    lists = matched_lists(read_tsv(spark, path, TRUTH))
    return lists if subset is None else lists.join(subset.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")


def read_pseudo_labels(spark: SparkSession, path: str) -> DataFrame:
    df = read_tsv(spark, path, ("source1_entity_id", "candidate_id", "prob"))
    return df.select(F.col("source1_entity_id").alias("s1_id"), F.col("candidate_id").alias("cand_id"), F.expr("try_cast(prob as double)").alias("prob"))


def only(df: DataFrame, ids: DataFrame, key: str = "entity_id") -> DataFrame:
    """Rows whose id is wanted; the planner decides whether the ids are small enough to broadcast."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(key)), key, "left_semi")


def source_of(entity_id):
    """The source part of an id: S1, S2 or S3."""
    return F.substring(entity_id, 1, 2)


def encoded_id(entity_id):
    """source * 10^13 + number as long; null for ids of another form."""
    part = F.regexp_extract(entity_id, ID, 1), F.regexp_extract(entity_id, ID, 2)
    return F.when(entity_id.rlike(ID), part[0].cast("long") * F.lit(10**13) + part[1].cast("long"))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, the same for every run and partitioning."""
    return df.orderBy(F.md5(F.concat_ws("|", F.col(key), F.lit(str(seed)))), key).limit(n)


def in_split(key, percent: int = 20, seed: int = 42):
    """True for about ``percent`` % of the keys, by their md5; all rows of a key fall on one side."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", key, F.lit(str(seed)))), 1, 8), 16, 10).cast("long")
    return h % 100 < percent
