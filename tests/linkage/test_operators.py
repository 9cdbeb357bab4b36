import json
import random

import pytest
from pyspark.sql import functions as F

from tessella.config import Config, Prune, Rule
from tessella.operators import blocking, metrics, model, pairs, profile, retrieve, select
from tessella.plans import linkage
from tessella.sources import sinks, tables
from tessella.streaming import link

CLAIM = "s1_id string, cand_id string, prob double"
RECORD = "entity_id string, business_name string, business_address string, country string"


def resolved(spark, *claims):
    return sorted((r.s1_id, r.cand_id) for r in select.resolve_one_to_one(spark.createDataFrame(list(claims), CLAIM)).collect())


def test_resolver_literals(spark):
    assert resolved(spark, ("a", "x", 0.9), ("b", "x", 0.85), ("b", "y", 0.8), ("c", "z", 0.7)) == [("a", "x"), ("b", "y"), ("c", "z")]
    assert resolved(spark, ("a", "x", 0.9), ("b", "x", 0.9)) == [("a", "x")]
    assert resolved(spark, ("a", "x", 0.9), ("b", "x", 0.85), ("b", "y", 0.6)) == [("a", "x"), ("b", "y")]


def greedy(claims):
    best = {}
    for s, c, p in sorted(claims, key=lambda x: (-x[2], x[1])):
        best.setdefault(s, (s, c, p))
    taken = {}
    for s, c, _ in sorted(best.values(), key=lambda x: (-x[2], x[0])):
        taken.setdefault(c, s)
    for s, c, _ in sorted(claims, key=lambda x: (-x[2], x[0], x[1])):
        if best[s][1] != c:
            taken.setdefault(c, s)
    return sorted((s, c) for c, s in taken.items())


def test_resolver_is_the_greedy_one(spark):
    rng = random.Random(12)
    for _ in range(8):
        claims = [(s, c, rng.choice([0.5, 0.6, 0.7, 0.8])) for s in "abcdef" for c in "uvwxyz" if rng.random() < 0.6]
        assert resolved(spark, *claims) == greedy(claims)


def test_selection(spark):
    df = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.65), ("a", "z", 0.62), ("b", "x", 0.67), ("c", "x", 0.68)] + [("d", f"{i:02}", 0.9) for i in range(20)], CLAIM)
    got = sorted((r.s1_id, r.cand_id) for r in select.select_matches(df, Rule(single=0.68, match=0.60, share=0.70)).collect())
    assert got == [("a", "x"), ("a", "y"), ("c", "x")] + [("d", f"{i:02}") for i in range(12)]


def test_prune_boundaries(spark):
    rows = [("hi", f"{i:03}", 0.9) for i in range(40)] + [("mid", f"{i:03}", 0.85) for i in range(60)] + [("lo", f"{i}", 0.149 - i / 1000) for i in range(6)] + [("edge", "a", 0.15), ("edge", "b", 0.17 * 0.15), ("edge", "c", 0.02)]
    df = spark.createDataFrame(rows, "s1_id string, cand_id string, score double")
    got = {r.s1_id: r.n for r in retrieve.prune(df, Prune()).groupBy("s1_id").agg(F.count("*").alias("n")).collect()}
    assert got == {"hi": 30, "mid": 45, "lo": 3, "edge": 2}


def test_f05(spark):
    cases = [(3, 2, 2, 5 / 7), (0, 0, 0, 1), (0, 0, 1, 0), (1, 0, 0, 0), (2, 1, 1, 0.5556), (2, 0, 2, 0)]
    df = spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(cases)], "i int, p double, h double, t double, want double")
    for r in df.select("want", metrics.f05(F.col("p"), F.col("h"), F.col("t")).alias("got")).collect():
        assert r.got == pytest.approx(r.want, abs=1e-4)


def records(spark, *rows):
    return blocking.views(spark.createDataFrame(list(rows), RECORD))


def test_features_of_an_identical_pair(spark):
    # Long enough a shared name for the third record to stay above the share of the best score that pruning asks for.
    q = records(spark, ("S1-1", "Alpha Zylker Medical Supplies Ltd", "12 Main St 94016", "US"))
    r = records(spark, ("S3-1", "Alpha Zylker Medical Supplies Ltd", "12 Main St 94016", "US"), ("S2-9", "Alpha Zylker Medical Supplies Group", "", "US"))
    cfg = Config(df_frac=1.0)
    found = retrieve.context(linkage.candidates(q, r, cfg))
    idf, total = pairs.name_idf(q.unionByName(r))
    rows = {x.cand_id: x for x in pairs.features(found, q, r, idf, total).collect()}
    same = rows["S3-1"]
    assert len(pairs.FEATURES) == 42 and all(f in same for f in pairs.FEATURES)
    assert all(same[f] == 1 for f in ("name_ratio", "core_jaro", "addr_ratio", "long_num_exact", "addr_housenum_exact", "name_idf_soft_jaccard", "is_s3", "postcode_delta"))
    assert same.ret_score == pytest.approx(1) and same.ret_rank == 1
    assert rows["S2-9"].addr_empty_cand == 1 and 0 < rows["S2-9"].name_idf_soft_jaccard < 1


def test_soft_jaccard_literal(spark):
    pair = spark.createDataFrame([("a", "b", "alpha zylker", "alpha group"), ("c", "d", "", "")], "s1_id string, cand_id string, core_1 string, core_2 string")
    idf = spark.createDataFrame([("alpha", 15.0), ("group", 2.0)], "token string, idf double")
    total = spark.createDataFrame([(1, 15.0)], "n_records long, default_idf double")
    got = {r.s1_id: r.name_idf_soft_jaccard for r in pairs.soft_jaccard(pair, idf, total).collect()}
    assert got == {"a": pytest.approx(15 / 32), "c": 1.0}


def test_edge_records(spark):
    q = records(spark, ("S1-1", "", "", "US"), ("S1-2", "only here", "x", "XX"), ("S1-3", None, None, None), ("S1-4", "!!!", "???", "US"))
    r = records(spark, ("S2-1", "", "", "US"), ("S2-2", "one row", "1 st", "FR"))
    assert linkage.candidates(q, r, Config(df_frac=1.0)).count() == 0
    lists = retrieve.candidate_lists(q, linkage.candidates(q, r, Config(df_frac=1.0)))
    assert {x.entity_id: x.candidate_ids for x in lists.collect()} == {f"S1-{i}": [] for i in range(1, 5)}
    assert linkage.candidates(q.limit(0), r, Config()).count() == 0


def test_hashed_and_plain_features_agree(spark, sf):
    one, rest, _ = linkage.split_view(linkage.document_view(spark, sf))
    q, r = blocking.views(one), blocking.views(rest)
    plain = {(x.s1_id, x.cand_id) for x in linkage.candidates(q, r, Config(df_frac=1.0, hashed=False, k=5, score_digits=6)).collect()}
    hashed = {(x.s1_id, x.cand_id) for x in linkage.candidates(q, r, Config(df_frac=1.0, k=5, score_digits=6)).collect()}
    assert len(plain & hashed) >= 0.98 * len(plain)


def test_index_round_trip_and_stream(spark, sf, tmp_path):
    one, rest, _ = linkage.split_view(linkage.document_view(spark, sf))
    cfg = Config(df_frac=1.0, score_digits=6)
    weights, idf = blocking.build_index(blocking.views(rest), cfg)
    blocking.save_index(weights, idf, str(tmp_path / "index"))
    weights, idf = blocking.load_index(spark, str(tmp_path / "index"))
    one.select(*tables.RECORD).repartition(3).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    sink = lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}")
    query = link.retrieve_stream(link.arriving(spark, str(tmp_path / "in"), 1), weights, idf, cfg, sink, str(tmp_path / "ck"))
    assert query.awaitTermination(200) and query.exception() is None
    got = {(r.s1_id, r.cand_id, r.score) for r in spark.read.parquet(out).collect()}
    want = {(r.s1_id, r.cand_id, r.score) for r in linkage.candidates(blocking.views(one), blocking.views(rest), cfg).collect()}
    assert got == want


def test_validation_rules(spark):
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "entity_id string")
    known = spark.createDataFrame([("S2-1",), ("S3-1",)], "entity_id string")
    lists = "source1_entity_id string, ids string"
    good = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", ""), ("S1-3", "S3-1,S2-1")], lists)
    assert profile.violations(good, good, s1, known).count() == 0
    bad = spark.createDataFrame([("S1-1", "S2-1,S2-1,S1-2,S2-7"), ("S1-1", ""), ("S1-2", "S3-1"), ("S1-9", "")], lists)
    rules = {r.rule for r in profile.violations(bad, good, s1, known).where("file = 'matches'").collect()}
    assert rules == {"repeated_row", "missing_row", "unknown_row", "repeated_id", "self_match", "unknown_id", "not_a_candidate"}
    assert profile.check_header(good, "matched_entity_ids") and not profile.check_header(good.toDF("source1_entity_id", "x"), "x")


def test_writers(spark, tmp_path):
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    p = spark.createDataFrame([("S1-1", "S2-1", 0.5), ("S1-1", "S2-2", 0.9)], CLAIM)
    sinks.write_tsv(sinks.pair_list(s1, p, "matched_entity_ids").coalesce(1), str(tmp_path / "m"))
    text = next((tmp_path / "m").glob("*.csv")).read_text().splitlines()
    assert text[0] == "source1_entity_id\tmatched_entity_ids" and sorted(text[1:]) == ["S1-1\tS2-2,S2-1", "S1-2\t"]
    lists = tables.read_truth(spark, str(tmp_path / "m"))
    assert {r.s1_id: r.ids for r in lists.collect()} == {"S1-1": ["S2-2", "S2-1"], "S1-2": []}
    sinks.write_empty(s1, str(tmp_path / "a"), str(tmp_path / "b"))
    path = str(tmp_path / "ck")
    countries = spark.createDataFrame([("FR",), ("US",)], "country string")
    assert sinks.pending(countries, path).count() == 2
    sinks.write_checkpoint(p.withColumn("country", F.lit("FR")), path)
    assert [r.country for r in sinks.pending(countries, path).collect()] == ["US"]


def test_model_finds_perturbed_names(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))
    ones, rest, truth = [], [], []
    for i in range(150):
        name, address = " ".join(word() for _ in range(3)), f"{rng.randint(1, 999)} {word()} street {rng.randint(10000, 99999)}"
        ones.append((f"S1-{i}", name, address, "US"))
        for k in range(rng.randint(0, 2)):
            j = rng.randrange(len(name))
            rest.append((f"S{2 + k}-{i}", name[:j] + rng.choice("xyz") + name[j + 1 :], address if rng.random() < 0.7 else "", "US"))
            truth.append((f"S1-{i}", f"S{2 + k}-{i}"))
    q, r = records(spark, *ones), records(spark, *rest)
    t = spark.createDataFrame(truth, "s1_id string, cand_id string")
    cfg = Config(df_frac=1.0)
    labelled = model.label_pairs(linkage.pair_features(q, r, cfg), t).cache()
    trees = model.Trees(rounds=6, depth=3, least_per_node=2)
    models = model.fit(labelled, trees)
    scored = model.predict(labelled, models)
    matched = select.resolve_one_to_one(select.select_matches(scored, cfg.rule))
    score = metrics.macro_f05(q.select(F.col("entity_id").alias("s1_id")), matched, t).first()
    assert score.macro_f05 > 0.9
    with pytest.raises(ValueError, match="features missing"):
        model.assemble(labelled.drop("ret_rank"))


def test_country_thresholds(spark):
    rows = [("a", "x", "US", 0.5), ("b", "y", "IN", 0.5), ("c", "z", None, 0.5), ("d", "w", "IN", 0.9), ("d", "v", "IN", 0.46)]
    df = spark.createDataFrame(rows, "s1_id string, cand_id string, country string, prob double")
    own = model.rule_table(spark, {"IN": Rule(single=0.45, match=0.45, share=0.5)})
    got = sorted((r.s1_id, r.cand_id) for r in select.select_matches(df, Rule(single=0.7, match=0.6, share=0.7), own).collect())
    assert got == [("b", "y"), ("d", "v"), ("d", "w")]
    assert [r.s1_id for r in select.select_matches(df, Rule(single=0.7, match=0.6, share=0.7)).collect()] == ["d"]


def test_names_in_other_scripts_are_found(spark):
    """The Latin spelling of a name retrieves the same name in another script, and the other way round."""
    twins = [("तिरुपति फाइनेंस", "Tirupati Finance"), ("శ్రీనివాస ట్రేడర్స్", "Srinivasa Tredars"), ("Москва Пекарня", "Moskva Pekarnya"), ("かべ ハナ", "kabe hana"), ("서울 바다", "Seoul Bada")]
    latin = records(spark, *((f"S1-{i}", b, "", "XX") for i, (_, b) in enumerate(twins)))
    other = records(spark, *((f"S2-{i}", a, "", "XX") for i, (a, _) in enumerate(twins)))
    for q, r in ((latin, other), (other, latin)):
        found = linkage.candidates(q, r, Config(df_frac=1.0)).where("rank = 1").collect()
        assert sorted((x.s1_id[3:], x.cand_id[3:]) for x in found) == [(str(i), str(i)) for i in range(len(twins))]


def test_run_by_country_goes_on_where_it_broke_off(spark, tmp_path):
    q = spark.createDataFrame([("S1-1", "alpha beta", "1 st", "US"), ("S1-2", "gamma delta", "2 st", "IN"), ("S1-3", "solo", "", "FR"), ("S1-4", "no name", "x", None)], RECORD)
    r = spark.createDataFrame([("S2-1", "alpha beta", "1 st", "US"), ("S2-2", "gamma delta", "2 st", "IN"), ("S3-2", "gamma delta", "", "IN"), ("S2-9", "other", "", "ZZ"), ("S3-4", "no name", "x", None)], RECORD)
    cfg = Config(df_frac=1.0, rule=Rule(single=0.3, match=0.2, share=0.3))
    seen = []

    def score(a, b):
        country = b.first().country
        seen.append(country)
        if country == "US" and seen.count("US") == 1:
            raise RuntimeError("broke off")
        return linkage.score_as_probability(linkage.candidates(a, b, cfg))

    with pytest.raises(RuntimeError):
        linkage.link_corpus(q, r, score, cfg, str(tmp_path))
    scored, matches = linkage.link_corpus(q, r, score, cfg, str(tmp_path))
    assert seen == ["", "IN", "US", "US", "ZZ"]
    assert sorted((x.s1_id, x.cand_id) for x in matches.collect()) == [("S1-1", "S2-1"), ("S1-2", "S2-2"), ("S1-2", "S3-2"), ("S1-4", "S3-4")]
    out = linkage.assemble(q, scored, matches, str(tmp_path / "out"))
    lists = {x.source1_entity_id: x.matched_entity_ids for x in profile.read_result(spark, out[0], "matched_entity_ids").collect()}
    assert lists == {"S1-1": "S2-1", "S1-2": "S2-2,S3-2", "S1-3": "", "S1-4": "S3-4"}
    assert profile.validate_files(spark, *out, q, r).count() == 0
    with pytest.raises(ValueError, match="bad header"):
        profile.read_result(spark, out[0], "candidate_entity_ids")
    assert linkage.link_corpus(q, r, score, cfg, str(tmp_path))[0].count() == scored.count() and len(seen) == 5


def test_training_set_with_pseudo_labels(spark, tmp_path):
    names = ("a", "b")
    rows = [(f"s{i}", f"c{j}", float(i % 3), float(j)) for i in range(40) for j in range(4)]
    features = spark.createDataFrame(rows, "s1_id string, cand_id string, a double, b double")
    truth = spark.createDataFrame([(f"s{i}", "c0") for i in range(40)], "s1_id string, cand_id string")
    more = spark.createDataFrame([(f"p{i}", f"c{j}", float(i % 3), float(j)) for i in range(60) for j in range(4)], features.schema)
    pseudo = spark.createDataFrame([(f"p{i}", "c0", 0.9) for i in range(50)], CLAIM)
    model.save_training_set(model.training_set(features, truth, more, pseudo), str(tmp_path / "set"), names)
    got = model.load_training_set(spark, str(tmp_path / "set"), names)
    assert got.count() == 160 + 200 and got.where("pseudo").agg(F.sum("label")).first()[0] == 50
    with pytest.raises(ValueError, match="2 features, expected 1"):
        model.load_training_set(spark, str(tmp_path / "set"), ("a",))
    trees = model.Trees(rounds=4, depth=2, least_per_node=1, seeds=(1, 2), least_rounds=3)
    held = model.validation(F.col("s1_id"))
    own = got.where(held & ~F.col("pseudo")).select("s1_id").distinct()
    assert 0 < own.count() < 40
    models = model.fit(got, trees, names)
    # Validation by pseudo entities alone would leave nothing to stop by; they only teach.
    assert model.assemble(got, names).where(held).where("pseudo").count() > 0 and len(models) == 2
    again = model.refit(got, models, trees, names)
    assert [m.getNumTrees for m in again] == [max(3, int(1.1 * m.getNumTrees)) for m in models]
    rule = Rule(single=0.61)
    model.save(again, str(tmp_path / "model"), rule, names, {"IN": Rule(match=0.5)}, {"oracle_f05": 0.9}, own)
    loaded, meta = model.load(str(tmp_path / "model"))
    assert meta["rule"] == rule and meta["by_country"]["IN"].match == 0.5 and meta["scores"] == {"oracle_f05": 0.9} and meta["features"] == list(names)
    assert spark.read.parquet(str(tmp_path / "model/validation_ids")).count() == own.count()
    a, b = (sorted(tuple(r) for r in model.predict(got, m, names).collect()) for m in (again, loaded))
    assert a == b and len({round(r[2], 3) for r in a}) > 1
    first = sorted(tuple(r) for r in model.predict(got, again[:1], names).collect())
    second = sorted(tuple(r) for r in model.predict(got, again[1:], names).collect())
    assert all(x[2] == pytest.approx((y[2] + z[2]) / 2, abs=2e-6) for x, y, z in zip(a, first, second, strict=True))


def test_stored_weights_metadata_and_reports(spark, tmp_path):
    r = records(spark, ("S2-1", "alpha beta", "1 st", "US"), ("S2-2", "alpha", "2 st", "IN"), ("S3-3", "", "", ""))
    idf, total = pairs.name_idf(r)
    pairs.save_name_idf(idf, total, str(tmp_path / "idf"))
    again = pairs.load_name_idf(spark, str(tmp_path / "idf"))
    assert [sorted(map(tuple, t.collect())) for t in again] == [sorted(map(tuple, t.collect())) for t in (idf, total)]
    cfg = Config(df_frac=1.0)
    weights, kept = blocking.build_index(r, cfg)
    blocking.save_index(weights, kept, str(tmp_path / "index"), metadata=blocking.index_metadata(r, kept, cfg))
    about = {x.country or "": (x.n_records, x.features_kept > 0, x.buckets) for x in blocking.load_metadata(spark, str(tmp_path / "index")).collect()}
    assert about == {"US": (1, True, 1 << 22), "IN": (1, True, 1 << 22), "": (1, False, 1 << 22)}
    labels = spark.createDataFrame([("S1-1", "S2-1", 0.123456789)], CLAIM)
    sinks.write_pseudo_labels(labels, str(tmp_path / "pseudo"))
    assert [tuple(x) for x in tables.read_pseudo_labels(spark, str(tmp_path / "pseudo")).collect()] == [("S1-1", "S2-1", 0.123457)]
    sinks.write_report({"totals": total, "labels": labels}, str(tmp_path / "report"))
    lines = [json.loads(x.value) for x in spark.read.text(str(tmp_path / "report")).collect()]
    assert {x["name"]: len(x["rows"]) for x in lines} == {"totals": 1, "labels": 1}
    assert sinks.report(total)[0]["n_records"] == 3


def test_profiles_of_matched_and_vanishing_records(spark):
    rows = spark.createDataFrame([("S2-1", "東京", "x", "JP"), ("S2-2", "Москва", "", "RU"), ("S3-3", " ", "y", "RU"), ("S3-4", "!!!", "y", "FR")], RECORD)
    assert sorted(r.entity_id for r in profile.name_vanishes(rows).collect()) == ["S2-1", "S3-4"]
    truth = spark.createDataFrame([("S1-1", "S2-2"), ("S1-2", "S2-2"), ("S1-1", "S3-3")], "s1_id string, cand_id string")
    got = {(r.source, r.country): (r.n_rows, r.missing_name, r.missing_address, r.nonlatin_name) for r in profile.profile_matched(rows, truth).collect()}
    assert got == {("S2", "RU"): (1, 0, 1, 1), ("S3", "RU"): (1, 1, 0, 0)}
    ones = spark.createDataFrame([("S1-1", "a", "", "RU"), ("S1-2", "b", "", "FR")], RECORD)
    assert [tuple(r) for r in profile.cross_country_examples(truth, ones, rows).collect()] == [("S1-2", "S2-2", "FR", "RU")]


def test_paths_and_samples(spark, monkeypatch):
    monkeypatch.setenv("ER_DATA_DIR", "/d")
    assert tables.Paths.from_environment() == tables.Paths("/d", "work", "output")
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    split = df.select("k", tables.in_split(F.col("k")).alias("v"))
    assert 300 < split.where("v").count() < 500
    assert sorted(split.repartition(7).collect()) == sorted(split.collect())
    assert tables.hash_sample(df, "k", 5).collect() == tables.hash_sample(df.repartition(9), "k", 5).collect()
