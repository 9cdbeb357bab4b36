"""Queries of the linkage engine over the standard tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, Prune, Rule
from ..functions import similarity
from ..functions import text as T
from ..functions.translit import to_ascii
from ..operators import blocking, metrics, model, pairs, profile, retrieve, select
from ..sources import sinks, tables
from ..sources.scratch import discard, passing, scratch_dir, stored
from . import linkage

#: Blocks of the standard tables are small, so the df cut is wide; features stay strings so that SQL can follow.
CFG = Config(df_frac=0.5, hashed=False, score_digits=6)
#: A rule for cosines instead of probabilities.
RULE = Rule(single=0.30, match=0.25, share=0.60, cap=12)
#: Entities that a country needs for a rule of its own.
LEAST = 300
#: The most candidates that recall and the sweeps look at.
DEEP = replace(CFG, k=max(metrics.KS))


class View:
    """The linkage view of one data folder, with normalised queries and records.

    Most plans read the normalised records several times, and scored candidates are both claims and their measure:
    both are written once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.all = linkage.document_view(spark, sf_dir)
        self.one, self.rest, self.truth = linkage.split_view(self.all)
        self.viewed = stored(blocking.views(self.all), "views")
        self.q, self.r = (self.viewed.where(c) for c in ("entity_id like 'S1-%'", "entity_id not like 'S1-%'"))
        self._scored: DataFrame | None = None

    @property
    def entities(self) -> DataFrame:
        return self.one.select(F.col("entity_id").alias("s1_id"), "country")

    def found(self, cfg: Config = CFG, within: tuple[Prune, ...] = ()) -> DataFrame:
        return linkage.candidates(self.q, self.r, cfg, pruned=False, within=within)

    def pruned(self) -> DataFrame:
        return linkage.candidates(self.q, self.r, CFG)

    def scored(self) -> DataFrame:
        if self._scored is None:
            with passing(self.all.sparkSession) as keep:  # retrieval's own tables go
                self._scored = keep(stored(linkage.score_as_probability(self.pruned()), "scored"))
        return self._scored

    def chosen(self) -> DataFrame:
        return select.select_matches(self.scored(), RULE)


def _round(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir).viewed
    return v.select(
        "entity_id", "name_raw", "name_core", "name_skeleton", F.array_join("address_tokens", " ").alias("address_words"),
        F.array_join("address_numbers", " ").alias("numbers"), F.array_join(T.number_pairs_of(F.col("address_tokens")), " ").alias("number_pairs"),
    )


def feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.term_counts(View(spark, sf_dir).r, CFG)


def document_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return _round(blocking.frequencies(blocking.term_counts(v.r, CFG), blocking.block_sizes(v.r), CFG), "idf")


def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(blocking.build_index(View(spark, sf_dir).r, CFG)[0], "w")


def hashed_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return View(spark, sf_dir).found(Config(df_frac=0.5))


def topk_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return View(spark, sf_dir).found()


def adaptive_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    return View(spark, sf_dir).pruned()


def retrieval_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(retrieve.context(View(spark, sf_dir).pruned()), "score_over_best", "gap_best", "gap_next")


def candidate_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return retrieve.candidate_lists(v.one, v.pruned()).select("entity_id", F.array_join("candidate_ids", ",").alias("candidate_ids"))


def name_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return _round(pairs.name_idf(v.viewed)[0], "idf")


def set_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    out = pairs.set_features(pairs.attach(v.pruned().select("s1_id", "cand_id"), v.q, v.r))
    return _round(out, "core_token_jaccard", "addr_token_jaccard", "addr_word_jaccard", "num_jaccard")


def soft_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    idf, total = pairs.name_idf(v.viewed)
    found = pairs.attach(v.pruned().select("s1_id", "cand_id"), *pairs.weighted(v.q, v.r, idf, total))
    return _round(pairs.soft_jaccard(found, idf, total), "name_idf_soft_jaccard")


def jaro_winkler(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batches):
        for df in batches:
            df["name_jaro"] = similarity.jaro_winkler_many(list(df.name_1), list(df.name_2))
            yield df[["s1_id", "cand_id", "name_jaro"]]

    v = View(spark, sf_dir)
    named = pairs.attach(v.pruned().select("s1_id", "cand_id"), v.q, v.r).select("s1_id", "cand_id", "name_1", "name_2")
    return _round(named.mapInPandas(run, "s1_id string, cand_id string, name_jaro double"), "name_jaro")


def string_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return pairs.string_features(pairs.attach(v.pruned().select("s1_id", "cand_id"), v.q, v.r))


def pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return linkage.pair_features(v.q, v.r, CFG)


def select_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return View(spark, sf_dir).chosen().select("s1_id", "cand_id", "prob")


def resolve_one_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.resolve_one_to_one(View(spark, sf_dir).chosen()).select("s1_id", "cand_id", "prob")


def entity_f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return _round(metrics.entity_f05(v.entities, v.chosen(), v.truth), "f05")


def macro_f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before and after the resolver."""
    v = View(spark, sf_dir)
    chosen = v.chosen()
    before = metrics.macro_f05(v.entities, chosen, v.truth).withColumn("stage", F.lit("selected"))
    after = metrics.macro_f05(v.entities, select.resolve_one_to_one(chosen), v.truth).withColumn("stage", F.lit("resolved"))
    return _round(before.unionByName(after), "macro_f05")


def recall_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieves as many candidates as the largest k that is reported."""
    v = View(spark, sf_dir)
    return _round(metrics.recall_curve(v.found(DEEP), v.truth), "recall")


def prune_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All settings, on the first 50 and on the first 100 candidates."""
    v = View(spark, sf_dir)
    found = v.found(replace(CFG, k=100), metrics.SWEEP)
    return _round(metrics.prune_sweep(found, v.truth, v.one.count(), metrics.SWEEP, (50, 100)), "recall", "mean_candidates")


def score_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    t = v.truth.select("s1_id", "cand_id", F.lit("true").alias("kind"))
    return metrics.score_percentiles(v.found().join(t, ["s1_id", "cand_id"], "left").fillna("other", ["kind"]))


def rank_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return metrics.rank_histogram(v.found(), v.truth)


def missed_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return metrics.missed_by_country(v.found(), v.truth)


def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return _round(metrics.grid_scores(v.entities, v.scored(), v.truth), "macro_f05")


def country_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best rule of each country with LEAST entities or more."""
    return _country_rules(View(spark, sf_dir))


def _country_rules(v: View) -> DataFrame:
    scores = _round(metrics.grid_scores(v.entities, v.scored(), v.truth, by=["country"]), "macro_f05")
    return metrics.best_rule(scores, ["country"], least=LEAST)


def country_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches by the rules of their countries; countries that have none follow the common rule."""
    v = View(spark, sf_dir)
    return select.select_matches(v.scored(), RULE, select.rules_by_country(_country_rules(v))).select("s1_id", "cand_id", "country", "prob")


def baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return _round(metrics.baselines(v.entities, v.scored(), v.truth), "oracle_f05", "all_empty_f05", "top1_f05")


def weighted_f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights: each country's share of the indexed records."""
    v = View(spark, sf_dir)
    n = v.rest.count()
    mix = v.rest.groupBy("country").agg((F.count("*") / F.lit(n or 1)).alias("share"))
    scores = metrics.entity_f05(v.entities, v.chosen(), v.truth).join(v.entities, "s1_id")
    return _round(metrics.weighted_f05(scores, mix), "weighted_f05")


def profile_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_source(View(spark, sf_dir).all)


def country_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.country_histogram(View(spark, sf_dir).all)


def _lists(v: View) -> DataFrame:
    return v.entities.select("s1_id").join(v.truth.groupBy("s1_id").agg(F.sort_array(F.collect_list("cand_id")).alias("ids")), "s1_id", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))


def profile_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(profile.profile_truth(_lists(View(spark, sf_dir))), "mean_size")


def list_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.list_sizes(_lists(View(spark, sf_dir)))


def same_country_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return profile.same_country(v.truth.select("s1_id", "cand_id"), v.one, v.rest)


def validate_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The truth as matches against the retrieved candidates: pairs that were not retrieved break a rule."""
    v = View(spark, sf_dir)
    matches = sinks.pair_list(v.one, v.truth.withColumn("prob", F.lit(1.0)), "matched_entity_ids")
    found = sinks.pair_list(v.one, v.pruned(), "candidate_entity_ids", order="score")
    return profile.violations(matches, found, v.one, v.rest)


def pseudo_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confident pairs outside one country."""
    v = View(spark, sf_dir)
    return select.pseudo_labels(v.scored(), spark.createDataFrame([("en",)], "country string"), least=0.5)


def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.hash_sample(View(spark, sf_dir).one, "entity_id", 50).select("entity_id")


def linked_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees trained on the truth's pairs, then matches of all records: the whole plan."""
    v = View(spark, sf_dir)
    features = stored(linkage.pair_features(v.q, v.r, CFG, v.truth), "features")  # each boosting job starts from these rows, not from their plan
    scored = stored(model.predict(features, model.fit(features)), "scored")
    discard(features)
    return select.resolve_one_to_one(select.select_matches(scored, CFG.rule))


def transliterate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and addresses in ASCII, before normalisation."""
    v = View(spark, sf_dir).all
    return to_ascii(v.select("entity_id", "business_name", "business_address"), "business_name", "business_address")


def index_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return blocking.index_metadata(v.r, blocking.frequencies(blocking.term_counts(v.r, CFG), blocking.block_sizes(v.r), CFG), CFG)


def record_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as a tab-separated file and read again, those of source 1 that have a true pair."""
    v = View(spark, sf_dir)
    path = f"{scratch_dir(spark)}/records-{uuid.uuid4().hex}"
    sinks.write_tsv(v.all.select(*tables.RECORD), path)
    return tables.only(tables.read_records(spark, path), v.truth.select("s1_id").distinct())


def truth_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of true pairs written and read again, as pairs."""
    v = View(spark, sf_dir)
    path = f"{scratch_dir(spark)}/truth-{uuid.uuid4().hex}"
    sinks.write_tsv(sinks.pair_list(v.one, v.truth.withColumn("prob", F.lit(1.0)), "matched_entity_ids"), path)
    return tables.truth_pairs(tables.read_truth(spark, path))


def entity_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which entities validate."""
    return View(spark, sf_dir).entities.select("s1_id", model.validation(F.col("s1_id")).alias("validation"))


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and labels of a stored training set: English pairs by the truth, confident pairs of other countries as pseudo labels."""
    v = View(spark, sf_dir)
    scored = v.scored()
    own = scored.where("country = 'en'").select("s1_id", "cand_id")
    pseudo = select.pseudo_labels(scored, spark.createDataFrame([("en",)], "country string"), least=0.5)
    path = f"{scratch_dir(spark)}/training-{uuid.uuid4().hex}"
    model.save_training_set(model.training_set(own, v.truth, scored.where("country <> 'en'").select("s1_id", "cand_id"), pseudo), path, ())
    return model.load_training_set(spark, path, ()).select("s1_id", "cand_id", F.col("label").cast("int").alias("label"), "pseudo")


def assembled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both output files of a run by countries with checkpoints, read again: (file, source1_entity_id, ids)."""
    v = View(spark, sf_dir)
    path = f"{scratch_dir(spark)}/run-{uuid.uuid4().hex}"
    score = lambda q, r: linkage.score_as_probability(linkage.candidates(q, r, CFG))
    scored, matches = linkage.link_corpus(v.one, v.rest, score, replace(CFG, rule=RULE), path)
    names = linkage.assemble(v.one, scored, matches, path)
    columns = ("matched_entity_ids", "candidate_entity_ids")
    files = [profile.read_result(spark, p, c).select(F.lit(f).alias("file"), "source1_entity_id", F.col(c).alias("ids")) for f, p, c in zip(("matches", "candidates"), names, columns, strict=True)]
    return files[0].unionByName(files[1])


def resolver_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro F0.5 after the resolver, claims and claims kept."""
    v = View(spark, sf_dir)
    claims = v.chosen()
    return _round(metrics.resolver_report(v.entities, claims, select.resolve_one_to_one(claims), v.truth), "macro_f05")


def top_score_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best scores of entities without and with true pairs."""
    v = View(spark, sf_dir)
    return metrics.score_percentiles(metrics.top_scores(v.entities, v.found(), v.truth))


def missed_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return metrics.missed_examples(v.pruned(), v.truth)


def oracle_by_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro F0.5 of a perfect choice among the first 10, 50 and 100 candidates."""
    v = View(spark, sf_dir)
    found = stored(v.found(replace(CFG, k=100)).select("s1_id", "cand_id", "rank").join(v.truth.select("s1_id", "cand_id"), ["s1_id", "cand_id"], "left_semi"), "found")  # true pairs only, read for each depth
    each = [metrics.macro_f05(v.entities, found.where(F.col("rank") <= k), v.truth).select(F.lit(k).alias("k"), "macro_f05") for k in (10, 50, 100)]
    return _round(each[0].unionByName(each[1]).unionByName(each[2]), "macro_f05")


def profile_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = View(spark, sf_dir)
    return profile.profile_matched(v.rest, v.truth)


def cross_country_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records with one text in two countries, by the heads of their texts."""
    v = View(spark, sf_dir)
    pairs_ = v.one.select(F.col("entity_id").alias("s1_id"), "business_name").join(v.rest.select(F.col("entity_id").alias("cand_id"), "business_name"), "business_name")
    return profile.cross_country_examples(pairs_, v.one, v.rest)


def name_vanishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.name_vanishes(View(spark, sf_dir).all)


NAMES = (
    normalize_text, transliterate_names, feature_counts, document_frequencies, index_metadata, tfidf_weights, topk_cosine, hashed_topk, adaptive_prune, retrieval_context, candidate_lists,
    name_idf, set_features, soft_jaccard, jaro_winkler, string_features, pair_features, select_matches, country_thresholds, resolve_one_to_one, resolver_report, entity_f05, macro_f05,
    recall_curve, oracle_by_depth, prune_sweep, score_percentiles, top_score_percentiles, rank_histogram, missed_by_country, missed_examples, grid_search, country_rules, baselines,
    weighted_f05, profile_source, profile_matched, country_histogram, profile_truth, list_sizes, same_country_rate, cross_country_examples, name_vanishes, validate_output, pseudo_labels,
    hash_sample, entity_split, record_scan, truth_scan, training_set, assembled_files, linked_records,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in NAMES}
