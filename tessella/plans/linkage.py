"""The linkage plan from records to matches, and the linkage view of the standard tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, Prune
from ..operators import blocking, model, pairs, retrieve, select
from ..sources import sinks
from ..sources.scratch import discard, passing, stored

#: Texts that are Python objects at once.
SLICE = 256
#: Words of a record's name, and of its address.
NAME_WORDS, ADDRESS_WORDS = 4, 8


def longest_words(text: bytes | None, n: int = NAME_WORDS + ADDRESS_WORDS) -> list[str]:
    """The n longest distinct words of UTF-8 text, ties in order of the alphabet; words end at ASCII white space."""
    words = b" ".join(set((text or b"").split())).decode().split(" ") if text else []
    sizes = sorted(map(len, words), reverse=True)
    least = sizes[n - 1] if len(sizes) > n else 1
    return sorted((w for w in words if len(w) >= least), key=lambda w: (-len(w), w))[:n]


def _short_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, addresses = [], []
        for at in range(0, batch.num_rows, SLICE):
            for text in batch.column(2).slice(at, SLICE).cast(pa.binary()).to_pylist():
                w = longest_words(text)
                names.append(" ".join(w[:NAME_WORDS]))
                addresses.append(" ".join(w[NAME_WORDS:]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(addresses, pa.string())], names=["doc_id", "country", "business_name", "business_address"])


def document_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as noisy records: name = the 4 longest words of the whole text, address = the next 8, country = lang.

    Words count once, longest first, ties in order of the alphabet; near copies of a text thus have nearly the same
    record wherever they differ.  The first record of each (country, name) is of source 1, the others of source 2
    (even doc_id) or 3.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("lang", F.lit("")).alias("country"), "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, country string, business_name string, business_address string"
    rows = docs.mapInArrow(_short_records, schema)
    rows = stored(rows, "records")  # all readers of the view start from the short records, not from the texts
    first = rows.groupBy("country", "business_name").agg(F.min("doc_id").alias("head"))
    source = F.when(F.col("doc_id") == F.col("head"), "S1-").when(F.col("doc_id") % 2 == 0, "S2-").otherwise("S3-")
    joined = rows.join(first, ["country", "business_name"])
    return joined.select(F.concat(source, F.col("doc_id").cast("string")).alias("entity_id"), "business_name", "business_address", "country", "head")


def split_view(view: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(queries, indexed records, truth with country) of :func:`document_view`."""
    columns = ["entity_id", "business_name", "business_address", "country"]
    one = view.where("entity_id like 'S1-%'")
    rest = view.where("entity_id not like 'S1-%'")
    truth = rest.select(F.concat(F.lit("S1-"), F.col("head").cast("string")).alias("s1_id"), F.col("entity_id").alias("cand_id"), "country")
    return one.select(*columns), rest.select(*columns), truth


def candidates(queries: DataFrame, records: DataFrame, cfg: Config, pruned: bool = True, within: tuple[Prune, ...] = ()) -> DataFrame:
    """(s1_id, country, cand_id, score, rank) from viewed queries and records; ``within``: see :func:`retrieve.top_k`."""
    counts = blocking.term_counts(records, cfg)
    idf = stored(blocking.frequencies(counts, blocking.block_sizes(records), cfg), "idf")  # both sides' weights read it, the result does not
    found = retrieve.top_k(queries, blocking.weigh(counts, idf), idf, cfg, within=(cfg.prune,) if pruned else within)
    discard(idf)
    return retrieve.prune(found, cfg.prune) if pruned else found


def pair_features(queries: DataFrame, records: DataFrame, cfg: Config, truth: DataFrame | None = None) -> DataFrame:
    """The 42 features of all pruned candidates, with labels by ``truth`` if it is given: they meet the ids, not the features."""
    with passing(queries.sparkSession) as keep:
        found = retrieve.context(candidates(queries, records, cfg))
        found = keep(stored(found if truth is None else model.label_pairs(found, truth), "context"))  # what retrieval wrote goes before texts are shuffled
    idf, total = pairs.name_idf(queries.unionByName(records))
    return pairs.features(found, queries, records, idf, total)


def link(queries: DataFrame, records: DataFrame, models, cfg: Config, names=pairs.FEATURES, by_country: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(scored pairs, resolved matches) of viewed queries and records: candidates, features, probabilities, selection, one-to-one.

    Records whose country is not in the index, or without candidates, have no pair; writers add their
    empty lists from source 1.  Views are read by the index, by retrieval and by both sides of the features: callers
    store or persist them (see :func:`link_corpus`).
    """
    scored = model.predict(pair_features(queries, records, cfg), models, names)
    return scored, select.resolve_one_to_one(select.select_matches(scored, cfg.rule, by_country))


def link_corpus(queries: DataFrame, records: DataFrame, score, cfg: Config, path: str, by_country: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(candidates with probabilities, resolved matches) of given records, country by country, with checkpoints under ``path``.

    ``score(queries, records)`` gives (s1_id, cand_id, country, prob) of viewed records.  A country that a checkpoint
    holds is not scored again, so a run that broke off goes on with the next one.  The resolver sees the claims of all
    countries.
    """
    spark, place = queries.sparkSession, f"{path}/pairs"
    todo = sinks.pending(records.select(F.coalesce("country", F.lit("")).alias("country")).distinct(), place)
    for country in sorted(r["country"] for r in todo.collect()):
        with passing(spark):  # what a country stores goes before the next one begins
            q, r = (stored(blocking.views(df.where(F.coalesce("country", F.lit("")) == country)), "views") for df in (queries, records))
            sinks.write_checkpoint(score(q, r).select("s1_id", "cand_id", "prob", "country"), place)
        sinks.mark_done(spark.createDataFrame([(country,)], "country string"), place)
    schema = "s1_id string, cand_id string, prob double, country string"
    scored = spark.read.schema(schema).parquet(place)
    return scored, select.resolve_one_to_one(select.select_matches(scored, cfg.rule, by_country))


def assemble(s1: DataFrame, scored: DataFrame, matches: DataFrame, path: str) -> tuple[str, str]:
    """Write both output files of a run, one row for each record of source 1; returns (matches, candidates) paths."""
    out = f"{path}/matching_results", f"{path}/candidate_pairs"
    sinks.write_tsv(sinks.pair_list(s1, matches, "matched_entity_ids"), out[0])
    sinks.write_tsv(sinks.pair_list(s1, scored, "candidate_entity_ids"), out[1])
    return out


def score_as_probability(found: DataFrame) -> DataFrame:
    """Candidates with their cosine as a stand-in for the model's probability."""
    return found.withColumn("prob", F.round(F.least("score", F.lit(1.0)), 6))
