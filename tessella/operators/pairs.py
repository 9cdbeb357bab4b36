"""The 42 features of a candidate pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, StructField, StructType

from ..functions import similarity

#: The features in the order in which models take them.
FEATURES = (
    "ret_score", "ret_rank", "ret_score_over_best", "ret_gap_best", "ret_gap_next",
    "name_ratio", "name_token_sort", "name_token_set", "name_partial", "name_wratio", "name_jaro",
    "core_ratio", "core_token_sort", "core_token_set", "core_partial", "core_wratio", "core_jaro",
    "core_token_jaccard", "core_concat_ratio", "core_len_diff",
    "skel_ratio", "skel_token_sort", "skel_token_set", "skel_partial",
    "addr_ratio", "addr_token_set", "addr_partial", "addr_token_jaccard", "addr_word_jaccard",
    "num_jaccard", "num_shared", "num_conflict", "num_longest_shared_len", "postcode_delta",
    "addr_empty_s1", "addr_empty_cand", "name_nonlatin_cand", "is_s3", "skel_concat_ratio",
    "long_num_exact", "addr_housenum_exact", "name_idf_soft_jaccard",
)


def jaccard(a: Column, b: Column) -> Column:
    """Set Jaccard of two arrays: 1 if both are empty, 0 if one is."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def words_of(s: Column) -> Column:
    return F.filter(F.split(s, r"\s+"), lambda t: t != "")


def name_idf(viewed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(token, df, idf) of core-name tokens of two records or more, and one row (n_records, default_idf)."""
    total = viewed.agg(F.count("*").alias("n_records")).withColumn("default_idf", F.log((F.col("n_records") + 1.0) / 2.0) + 1.0)
    df = viewed.select(F.explode(F.array_distinct(words_of(F.col("name_core")))).alias("token")).groupBy("token").agg(F.count("*").alias("df")).where("df >= 2")
    return df.join(F.broadcast(total)).select("token", "df", (F.log((F.col("n_records") + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf")), total


def save_name_idf(idf: DataFrame, total: DataFrame, path: str) -> None:
    """The weights and the default, as two Parquet tables."""
    idf.write.mode("overwrite").parquet(f"{path}/tokens")
    total.coalesce(1).write.mode("overwrite").parquet(f"{path}/default")


def load_name_idf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/tokens"), spark.read.parquet(f"{path}/default")


def token_weights(names: DataFrame, idf: DataFrame, total: DataFrame, core: str = "name_core") -> DataFrame:
    """(core, weights): a map of token to idf for each distinct core name; tokens without a weight get the default.

    Weights are joined once for each name, not for each pair.  Their number grows with the corpus, so they are not
    broadcast.
    """
    named = names.select(F.col(core).alias("core")).distinct()
    tokens = named.select("core", F.explode_outer(F.array_distinct(words_of(F.col("core")))).alias("token"))
    weighed = tokens.join(idf.select("token", "idf"), "token", "left").join(F.broadcast(total.select("default_idf")))  # one row
    item = F.when(F.col("token").isNotNull(), F.struct("token", F.coalesce("idf", "default_idf").alias("w")))
    return weighed.groupBy("core").agg(F.map_from_entries(F.collect_list(item)).alias("weights"))


def soft_jaccard_of(a: Column, b: Column) -> Column:
    """Weight of the shared tokens of two weight maps over that of all; 1 if both are empty."""
    sum_of = lambda entries: F.aggregate(entries, F.lit(0.0), lambda s, e: s + e["value"])
    shared = sum_of(F.filter(F.map_entries(a), lambda e: F.array_contains(F.map_keys(b), e["key"])))
    union = sum_of(F.map_entries(a)) + sum_of(F.map_entries(b)) - shared
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(shared / union)


def soft_jaccard(pairs: DataFrame, idf: DataFrame, total: DataFrame) -> DataFrame:
    """(s1_id, cand_id, name_idf_soft_jaccard) of pairs with core names core_1 and core_2, or with their weights (:func:`weighted`)."""
    if "weights_1" not in pairs.columns:
        weights = token_weights(pairs.select("core_1").union(pairs.select("core_2")), idf, total, "core_1")
        side = lambda n: weights.select(F.col("core").alias(f"core_{n}"), F.col("weights").alias(f"weights_{n}"))
        pairs = pairs.select("s1_id", "cand_id", "core_1", "core_2").join(side(1), "core_1").join(side(2), "core_2")
    return pairs.select("s1_id", "cand_id", soft_jaccard_of(F.col("weights_1"), F.col("weights_2")).alias("name_idf_soft_jaccard"))


def weighted(queries: DataFrame, records: DataFrame, idf: DataFrame, total: DataFrame) -> list[DataFrame]:
    """Views of both sides with the token weights of their core names, joined once for each record and not for each pair."""
    weights = token_weights(queries.select("name_core").union(records.select("name_core")), idf, total).withColumnRenamed("core", "name_core")
    return [df.join(weights, "name_core") for df in (queries, records)]


def attach(candidates: DataFrame, queries: DataFrame, records: DataFrame) -> DataFrame:
    """Candidates with the views of both sides under the suffixes _1 and _2 (late lookup: ids first, texts after top-k).

    Records come first: each is in many more pairs than a query is, and a join leaves the rows of one record side by
    side, so the shuffle that brings them to the queries compresses the repeated text.
    """

    def side(df: DataFrame, key: str, n: int) -> DataFrame:
        return df.select(
            F.col("entity_id").alias(key), F.col("name_raw").alias(f"name_{n}"), F.col("name_core").alias(f"core_{n}"), F.col("name_skeleton").alias(f"skel_{n}"),
            F.col("business_address").alias(f"addr_{n}"), F.col("address_tokens").alias(f"words_{n}"), F.col("address_numbers").alias(f"nums_{n}"), F.col("business_name").alias(f"given_{n}"),
            *([F.col("weights").alias(f"weights_{n}")] if "weights" in df.columns else []),
        )

    return candidates.join(side(records, "cand_id", 2), "cand_id").join(side(queries, "s1_id", 1), "s1_id")


def set_columns() -> dict[str, Column]:
    """Token-set, number and flag features of attached pairs, all built in."""
    c = F.col
    shared = F.array_intersect("nums_1", "nums_2")
    long_ = lambda a: F.transform(F.filter(a, lambda x: F.length(x) >= 4), lambda x: x.cast("decimal(38,0)"))
    raw_long = lambda s: long_(F.regexp_extract_all(s, F.lit(r"\d+"), F.lit(0)))
    near = F.exists(raw_long(c("addr_1")), lambda x: F.exists(raw_long(c("addr_2")), lambda y: F.abs(x - y) <= 1))
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("int").cast("double")
    return {
        "core_token_jaccard": jaccard(F.array_distinct(words_of(c("core_1"))), F.array_distinct(words_of(c("core_2")))),
        "core_len_diff": F.abs(F.length("core_1") - F.length("core_2")).cast("double"),
        "addr_token_jaccard": jaccard(F.array_distinct(words_of(c("addr_1"))), F.array_distinct(words_of(c("addr_2")))),
        "addr_word_jaccard": jaccard(F.array_distinct("words_1"), F.array_distinct("words_2")),
        "num_jaccard": jaccard(F.array_distinct("nums_1"), F.array_distinct("nums_2")),
        "num_shared": F.size(shared).cast("double"),
        "num_conflict": flag((F.size("nums_1") > 0) & (F.size("nums_2") > 0) & (F.size(shared) == 0)),
        "num_longest_shared_len": F.coalesce(F.array_max(F.transform(shared, F.length)), F.lit(0)).cast("double"),
        "postcode_delta": flag(near),
        "addr_empty_s1": flag(F.trim("addr_1") == ""),
        "addr_empty_cand": flag(F.trim("addr_2") == ""),
        "name_nonlatin_cand": flag(c("given_2").rlike(r"[^\x00-\x7f]")),
        "is_s3": flag(c("cand_id").startswith("S3-")),
        "long_num_exact": flag(F.exists(shared, lambda x: F.length(x) >= 4)),
        "addr_housenum_exact": flag(F.get("nums_1", F.lit(0)) == F.get("nums_2", F.lit(0))),
    }


def set_features(pairs: DataFrame) -> DataFrame:
    """(s1_id, cand_id, ...) with the columns of :func:`set_columns`."""
    return pairs.select("s1_id", "cand_id", *(c.alias(n) for n, c in set_columns().items()))


_edits = F.pandas_udf(similarity.similarities, StructType([StructField(c, FloatType()) for c in similarity.COLUMNS]))


def string_columns() -> Column:
    """Struct of the 21 edit similarities of attached pairs: one Arrow UDF over the eight strings."""
    return _edits(*(f"{x}_{n}" for x in ("name", "core", "skel", "addr") for n in (1, 2)))


def string_features(pairs: DataFrame) -> DataFrame:
    """(s1_id, cand_id, ...) with the edit similarities."""
    return pairs.select("s1_id", "cand_id", string_columns().alias("s")).select("s1_id", "cand_id", "s.*")


def features(candidates: DataFrame, queries: DataFrame, records: DataFrame, idf: DataFrame, total: DataFrame) -> DataFrame:
    """All 42 features (float) of pruned candidates with :func:`retrieve.context`; one row for each pair.

    Both sides' views, with the token weights of their names, are joined to the candidates once; everything else is
    columns of that row, so pairs are not joined with each other.  A country or label of the candidates stays.
    """
    sides = weighted(queries, records, idf, total)
    keep = ["s1_id", "cand_id", *(c for c in ("country", "label") if c in candidates.columns)]
    given = {"ret_score": "score", "ret_rank": "rank", "ret_score_over_best": "score_over_best", "ret_gap_best": "gap_best", "ret_gap_next": "gap_next"}
    columns = {n: F.col(c) for n, c in given.items()} | set_columns() | {"name_idf_soft_jaccard": soft_jaccard_of(F.col("weights_1"), F.col("weights_2"))}
    wide = attach(candidates, *sides).select(*keep, *(c.alias(n) for n, c in columns.items()), string_columns().alias("s"))
    return wide.select(*keep, *(F.col(f if f in columns else f"s.{f}").cast("float").alias(f) for f in FEATURES))
