"""Writers of pair lists, checkpoints and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import without_shuffle_files


def pair_list(s1: DataFrame, pairs: DataFrame, list_col: str, order: str = "prob") -> DataFrame:
    """(source1_entity_id, list_col): one row for each record of source 1, ids comma-joined best first, each once."""
    item = F.struct((-F.col(order)).alias("neg"), "cand_id")
    lists = pairs.groupBy("s1_id").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["cand_id"])).alias("ids"))
    joined = s1.select(F.col("entity_id").alias("s1_id")).distinct().join(lists, "s1_id", "left")
    return joined.select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(F.array_join("ids", ","), F.lit("")).alias(list_col))


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated with a header; empty fields print as nothing.  Files appear when the job commits."""
    with without_shuffle_files(df.sparkSession):
        df.write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="", quote='"', escape='"')


def write_empty(s1: DataFrame, matches: str, candidates: str) -> None:
    """The baseline without any match, in both files."""
    for path, name in ((matches, "matched_entity_ids"), (candidates, "candidate_entity_ids")):
        write_tsv(s1.select(F.col("entity_id").alias("source1_entity_id"), F.lit("").alias(name)), path)


def write_checkpoint(scored: DataFrame, path: str) -> None:
    """Scored pairs by country; only the countries written are replaced, so a run can resume."""
    with without_shuffle_files(scored.sparkSession):
        scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("country").parquet(path)


def mark_done(countries: DataFrame, path: str) -> None:
    """Note countries as finished, also those without any pair."""
    countries.select("country").write.mode("append").parquet(f"{path}_done")


def pending(countries: DataFrame, path: str) -> DataFrame:
    """Countries that a checkpoint does not hold yet (all, if there is no checkpoint)."""
    from pyspark.errors import AnalysisException

    spark = countries.sparkSession
    for place in (f"{path}_done", path):
        try:
            countries = countries.join(spark.read.parquet(place).select(F.col("country").cast("string").alias("country")).distinct(), "country", "left_anti")
        except AnalysisException:
            continue
    return countries


def write_pseudo_labels(labels: DataFrame, path: str) -> None:
    """Tab-separated (source1_entity_id, candidate_id, prob), probabilities with six digits."""
    write_tsv(labels.select(F.col("s1_id").alias("source1_entity_id"), F.col("cand_id").alias("candidate_id"), F.format_string("%.6f", "prob").alias("prob")), path)


def report(df: DataFrame) -> list[dict]:
    """Rows of a small report table as dictionaries."""
    return [r.asDict(recursive=True) for r in df.collect()]


def write_report(tables: dict[str, DataFrame], path: str) -> None:
    """One JSON line (name, rows) for each of several small report tables, written by the cluster."""
    lines = [t.agg(F.collect_list(F.struct(*(F.col(f"`{c}`") for c in t.columns))).alias("rows")).select(F.to_json(F.struct(F.lit(n).alias("name"), "rows")).alias("value")) for n, t in tables.items()]
    whole = lines[0]
    for line in lines[1:]:
        whole = whole.unionByName(line)
    whole.coalesce(1).write.mode("overwrite").text(path)
