"""Blocking index: feature bags, document frequencies, weights.  One block for each country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import text as T
from ..functions.translit import to_ascii


def views(records: DataFrame) -> DataFrame:
    """Records with normalised views, made once for each record: raw and core name, skeletons, address words, numbers.

    ``records``: entity_id, business_name, business_address, country (nulls count as empty).  Names and addresses in
    other scripts are romanised before they are normalised; the given ones stay beside the views.
    """
    base = records.select(
        "entity_id", F.coalesce("country", F.lit("")).alias("country"), F.coalesce("business_name", F.lit("")).alias("business_name"),
        F.coalesce("business_address", F.lit("")).alias("business_address"),
    )
    plain = to_ascii(base.withColumns({"plain_name": F.col("business_name"), "plain_address": F.col("business_address")}), "plain_name", "plain_address")
    with_tokens = plain.withColumns({"name_tokens": T.tokens(F.col("plain_name")), "address_tokens": T.address_words(F.col("plain_address"))}).drop("plain_name", "plain_address")
    named = with_tokens.withColumn("name_raw", F.array_join("name_tokens", " "))
    return named.withColumns({
        "name_core": T.core_name(F.col("name_raw")), "name_skeleton": T.skeleton_text(F.col("name_raw")),
        "address_numbers": T.numbers_of(F.col("address_tokens")),
    })


def _prefixed(prefix: str, parts: Column) -> Column:
    return F.transform(parts, lambda t: F.concat(F.lit(prefix), t))


def _skeletons(parts: Column) -> Column:
    return F.filter(F.transform(parts, T.skeleton), lambda s: s != "")


def bag(name_tokens: Column, address_tokens: Column) -> Column:
    """Multiset of a record's features, as an array."""
    n = F.greatest(F.size(name_tokens) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(name_tokens, F.lit(1), n), F.slice(name_tokens, F.lit(2), n), lambda a, b: F.concat_ws("_", F.lit("b"), a, b))
    return F.concat(
        _prefixed("n_", name_tokens), pairs, _prefixed("k_", _skeletons(name_tokens)), _prefixed("a_", address_tokens),
        _prefixed("d_", T.numbers_of(address_tokens)), _prefixed("ak_", _skeletons(address_tokens)), _prefixed("dw_", T.number_pairs_of(address_tokens)),
    )


def term_counts(viewed: DataFrame, cfg: Config) -> DataFrame:
    """(country, entity_id, fid, tf): each feature of a record once; hashed features that collide are added.

    Records are dealt before their features become rows, so that counting moves records and not features.
    """
    dealt = viewed.select("country", "entity_id", "name_tokens", "address_tokens").repartition("country", "entity_id")
    features = dealt.select("country", "entity_id", F.explode(bag(F.col("name_tokens"), F.col("address_tokens"))).alias("feature"))
    fid = (F.crc32(F.col("feature").cast("binary")) % cfg.buckets).cast("int") if cfg.hashed else F.col("feature")
    return features.groupBy("country", "entity_id", fid.alias("fid")).agg(F.count("*").alias("tf"))


def frequencies(counts: DataFrame, sizes: DataFrame, cfg: Config) -> DataFrame:
    """(country, fid, df, idf) of the features kept: df <= df_frac * N, idf = ln((N + 1) / (df + 1)) + 1."""
    df = counts.groupBy("country", "fid").agg(F.count("*").alias("df"))
    return df.join(F.broadcast(sizes), "country").where(F.col("df") <= cfg.df_frac * F.col("n_records")).select(
        "country", "fid", "df", (F.log((F.col("n_records") + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf")
    )  # one row for each country


def block_sizes(viewed: DataFrame) -> DataFrame:
    """(country, n_records); as many rows as there are countries."""
    return viewed.groupBy("country").agg(F.count("*").alias("n_records"))


def raw_weights(counts: DataFrame, idf: DataFrame) -> DataFrame:
    """(country, entity_id, fid, w): tf * idf; dropped features do not count."""
    return counts.join(idf.select("country", "fid", "idf"), ["country", "fid"]).select("country", "entity_id", "fid", (F.col("tf") * F.col("idf")).alias("w"))


def weigh(counts: DataFrame, idf: DataFrame) -> DataFrame:
    """(country, entity_id, fid, w): tf * idf over the record's norm; dropped features do not count."""
    raw = raw_weights(counts, idf)
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("country", "entity_id")))
    return raw.select("country", "entity_id", "fid", (F.col("w") / F.when(norm > 0, norm).otherwise(1.0)).alias("w"))


def build_index(viewed: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """(weights of the records, frequencies) of the indexed corpus."""
    counts = term_counts(viewed, cfg)
    idf = frequencies(counts, block_sizes(viewed), cfg)
    return weigh(counts, idf), idf


def index_metadata(viewed: DataFrame, idf: DataFrame, cfg: Config) -> DataFrame:
    """(country, n_records, features_kept, df_frac, buckets): one row for each block of an index."""
    kept = idf.groupBy("country").agg(F.count("*").alias("features_kept"))
    return block_sizes(viewed).join(kept, "country", "left").select(
        "country", "n_records", F.coalesce("features_kept", F.lit(0)).cast("long").alias("features_kept"), F.lit(cfg.df_frac).cast("double").alias("df_frac"), F.lit(cfg.buckets if cfg.hashed else 0).alias("buckets")
    )


def save_index(weights: DataFrame, idf: DataFrame, path: str, overwrite: bool = False, metadata: DataFrame | None = None) -> None:
    """Write an index as Parquet by country, and its metadata; an existing one stays unless ``overwrite``."""
    mode = "overwrite" if overwrite else "ignore"
    weights.write.mode(mode).partitionBy("country").option("maxRecordsPerFile", 2_000_000).parquet(f"{path}/weights")
    idf.write.mode(mode).partitionBy("country").parquet(f"{path}/idf")
    if metadata is not None:
        metadata.coalesce(1).write.mode(mode).json(f"{path}/metadata")


def load_index(spark, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/weights"), spark.read.parquet(f"{path}/idf")


def load_metadata(spark, path: str) -> DataFrame:
    return spark.read.schema("country string, n_records long, features_kept long, df_frac double, buckets int").json(f"{path}/metadata")
