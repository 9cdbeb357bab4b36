"""Profiles of sources and truth, and the rules that output files must keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize
from ..functions.translit import to_ascii
from ..sources.tables import ID, read_tsv

NON_ASCII = r"[^\x00-\x7f]"


def _count(condition):
    return F.count(F.when(condition, 1))


def profile_source(records: DataFrame) -> DataFrame:
    """One row for each source: counts of rows, bad and repeated ids, id digits, missing and non-ASCII fields, countries."""
    c = F.col
    rows = records.select(
        F.substring("entity_id", 1, 2).alias("source"), "entity_id", "country", c("entity_id").rlike(ID).alias("good"), F.length(F.regexp_extract("entity_id", ID, 2)).alias("digits"),
        *(F.coalesce(x, F.lit("")).alias(x) for x in ("business_name", "business_address")),
    )
    counts = rows.groupBy("source").agg(
        F.count("*").alias("n_rows"), _count(~c("good")).alias("bad_id"), (_count(c("good")) - F.countDistinct(F.when(c("good"), c("entity_id")))).alias("dup_id"),
        F.min(F.when(c("good"), c("digits"))).alias("min_digits"), F.max(F.when(c("good"), c("digits"))).alias("max_digits"),
        _count(F.trim("business_name") == "").alias("missing_name"), _count(F.trim("business_address") == "").alias("missing_address"),
        _count(c("business_name").rlike(NON_ASCII)).alias("nonlatin_name"), _count(c("business_address").rlike(NON_ASCII)).alias("nonlatin_address"),
        _count(c("business_name").rlike(NON_ASCII) & (F.trim(F.regexp_replace("business_name", NON_ASCII, "")) == "")).alias("nonlatin_only_name"),
        F.countDistinct("country").alias("countries"),
    )
    return counts


def country_histogram(records: DataFrame) -> DataFrame:
    return records.groupBy("country").agg(F.count("*").alias("n_rows"))


def profile_truth(lists: DataFrame) -> DataFrame:
    """One row: records, singletons, pairs, longest and mean list, repeats and self matches in lists, sources, ids claimed twice."""
    sized = lists.select("s1_id", "ids", F.size("ids").alias("n"), F.size(F.array_distinct("ids")).alias("d"))
    a = sized.agg(
        F.count("*").alias("n_entities"), _count(F.col("n") == 0).alias("singletons"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_pairs"), F.max("n").cast("long").alias("longest"),
        F.avg("n").alias("mean_size"), F.coalesce(F.sum(F.col("n") - F.col("d")), F.lit(0)).cast("long").alias("repeats"), _count(F.array_contains("ids", F.col("s1_id"))).alias("self_matches"),
    )
    long = lists.select("s1_id", F.explode("ids").alias("cand_id"))
    b = long.agg(_count(F.col("cand_id").startswith("S2-")).alias("from_s2"), _count(F.col("cand_id").startswith("S3-")).alias("from_s3"))
    twice = long.groupBy("cand_id").agg(F.countDistinct("s1_id").alias("n")).where("n > 1").agg(F.count("*").alias("claimed_twice"))
    return a.join(b).join(twice)  # one row each


def list_sizes(lists: DataFrame) -> DataFrame:
    return lists.groupBy(F.size("ids").alias("size")).agg(F.count("*").alias("entities"))


def same_country(truth: DataFrame, queries: DataFrame, records: DataFrame) -> DataFrame:
    """One row: true pairs within one country, across countries, and with an unknown side."""
    q = queries.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("c1"))
    r = records.select(F.col("entity_id").alias("cand_id"), F.col("country").alias("c2"))
    both = truth.join(q, "s1_id", "left").join(r, "cand_id", "left")
    known = F.col("c1").isNotNull() & F.col("c2").isNotNull()
    return both.agg(_count(known & (F.col("c1") == F.col("c2"))).alias("same"), _count(known & (F.col("c1") != F.col("c2"))).alias("cross"), _count(~known).alias("unknown"))


def cross_country_examples(truth: DataFrame, queries: DataFrame, records: DataFrame, n: int = 5) -> DataFrame:
    """(s1_id, cand_id, country_1, country_2): the first ``n`` true pairs, by their ids, whose countries differ."""
    q = queries.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("country_1"))
    r = records.select(F.col("entity_id").alias("cand_id"), F.col("country").alias("country_2"))
    return truth.select("s1_id", "cand_id").join(q, "s1_id").join(r, "cand_id").where("country_1 <> country_2").select("s1_id", "cand_id", "country_1", "country_2").orderBy("s1_id", "cand_id").limit(n)


def profile_matched(records: DataFrame, truth: DataFrame) -> DataFrame:
    """(source, country, n_rows, missing_name, missing_address, nonlatin_name) of the records that a true pair names."""
    rows = records.join(truth.select(F.col("cand_id").alias("entity_id")).distinct(), "entity_id", "left_semi")
    name, address = (F.coalesce(x, F.lit("")) for x in ("business_name", "business_address"))
    return rows.groupBy(F.substring("entity_id", 1, 2).alias("source"), "country").agg(
        F.count("*").alias("n_rows"), _count(F.trim(name) == "").alias("missing_name"), _count(F.trim(address) == "").alias("missing_address"), _count(name.rlike(NON_ASCII)).alias("nonlatin_name")
    )


def name_vanishes(records: DataFrame) -> DataFrame:
    """Records with a name of which nothing is left after normalisation (other scripts romanised first)."""
    plain = to_ascii(records.withColumn("plain", F.col("business_name")), "plain")
    return plain.where((F.trim("business_name") != "") & (normalize(F.col("plain")) == "")).select("entity_id", "business_name")


def check_header(df: DataFrame, list_col: str) -> list[str]:
    want = ["source1_entity_id", list_col]
    return [] if df.columns == want else [f"bad header {df.columns}, expected {want}"]


def read_result(spark: SparkSession, path: str, list_col: str) -> DataFrame:
    """An output file as (source1_entity_id, list); a header other than that is an error."""
    given = spark.read.csv(path, sep="\t", header=True, quote='"', escape='"')
    if found := check_header(given, list_col):
        raise ValueError(f"{path}: {found[0]}")
    return read_tsv(spark, path, ("source1_entity_id", list_col))


def validate_files(spark: SparkSession, matches: str, candidates: str, s1: DataFrame, known: DataFrame) -> DataFrame:
    """:func:`violations` of two output files."""
    return violations(read_result(spark, matches, "matched_entity_ids"), read_result(spark, candidates, "candidate_entity_ids"), s1, known)


def violations(matches: DataFrame, candidates: DataFrame, s1: DataFrame, known: DataFrame) -> DataFrame:
    """(file, rule, s1_id, detail) of every broken output rule; valid files give no row.

    ``matches``/``candidates``: s1_id and a comma list; ``s1``/``known``: entity_id.
    """
    out = []

    def found(df: DataFrame, file: str, rule: str, detail="") -> None:
        out.append(df.select(F.lit(file).alias("file"), F.lit(rule).alias("rule"), "s1_id", (F.col(detail) if detail else F.lit("")).alias("detail")))

    ids = s1.select(F.col("entity_id").alias("s1_id")).distinct()
    every = known.select(F.col("entity_id").alias("cand_id")).distinct()
    longs = {}
    for file, df in (("matches", matches), ("candidates", candidates)):
        df = df.toDF("s1_id", "list")
        rows = df.select("s1_id", F.filter(F.split(F.coalesce("list", F.lit("")), ","), lambda x: x != "").alias("ids"))
        found(rows.groupBy("s1_id").count().where("count > 1"), file, "repeated_row")
        found(ids.join(rows, "s1_id", "left_anti"), file, "missing_row")
        found(rows.join(ids, "s1_id", "left_anti"), file, "unknown_row")
        long = rows.select("s1_id", F.explode("ids").alias("cand_id"))
        longs[file] = long.distinct()
        found(long.groupBy("s1_id", "cand_id").count().where("count > 1"), file, "repeated_id", "cand_id")
        found(longs[file].where("cand_id like 'S1-%'"), file, "self_match", "cand_id")
        found(longs[file].where("cand_id not like 'S1-%'").join(every, "cand_id", "left_anti"), file, "unknown_id", "cand_id")
    found(longs["matches"].join(longs["candidates"], ["s1_id", "cand_id"], "left_anti"), "matches", "not_a_candidate", "cand_id")
    total = out[0]
    for df in out[1:]:
        total = total.unionByName(df)
    return total
