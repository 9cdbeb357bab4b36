import random

import numpy as np
from pyspark.sql import functions as F

from tessella.config import Config, Prune
from tessella.operators import blocking, metrics, model, retrieve
from tessella.operators import pairs as pair_ops
from tessella.plans import linkage, queries


def records(spark, n, prefix, seed, common="alpha"):
    rng = random.Random(seed)
    rows = [(f"{prefix}{i}", f"{common} {rng.choice('bcdfgjkl')}{rng.choice('mnprstvz')} {i % 40}", f"{rng.randrange(30)} main", "xy"[i % 2]) for i in range(n)]
    return blocking.views(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))


def written(spark):
    """Records that all stages so far have written for shuffles."""
    sc, jvm = spark.sparkContext, spark._jvm
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def pairs(weights):
    by = {}
    for r in weights.collect():
        by.setdefault((r.country, r.fid), []).append((r.entity_id, r.w))
    return by


def test_parts_give_what_brute_force_gives(spark):
    cfg = Config(k=7, df_frac=1.0, hashed=False, score_digits=6)
    q, r = records(spark, 60, "S1-", 1), records(spark, 90, "S2-", 2)
    weights, idf = blocking.build_index(r, cfg)
    asked, held = pairs(blocking.weigh(blocking.term_counts(q, cfg), idf)), pairs(weights)
    sums = {}
    for key, a in asked.items():
        for s1, x in a:
            for cand, y in held.get(key, []):
                sums[s1, cand] = sums.get((s1, cand), 0.0) + x * y
    want = {}
    for (s1, cand), s in sums.items():
        want.setdefault(s1, []).append((-round(s, 6), cand))
    want = {(s1, cand, i) for s1, found in want.items() for i, (_, cand) in enumerate(sorted(found)[:7], 1)}
    for part in (4, 1000):
        assert {(x.s1_id, x.cand_id, x["rank"]) for x in retrieve.top_k(q, weights, idf, cfg, part).collect()} == want


def test_products_of_a_common_feature_are_not_shuffled(spark):
    cfg = Config(k=3, df_frac=1.0, hashed=False, score_digits=6)
    q, r = records(spark, 1000, "S1-", 1).persist(), records(spark, 1000, "S2-", 2).persist()
    weights, idf = blocking.build_index(r, cfg)
    before = written(spark)
    assert retrieve.top_k(q, weights, idf, cfg).count() == 3000
    assert written(spark) - before < 200_000  # 500,000 pairs share the common word
    q.unpersist(), r.unpersist()


def test_longest_words():
    assert linkage.longest_words(None) == linkage.longest_words(b" \n") == []
    assert linkage.longest_words("bb a\x0bccc  ccc é ée aa".encode(), 3) == ["é ée", "ccc", "aa"]


def test_counting_features_moves_records(spark):
    cfg = Config(hashed=False)
    r = records(spark, 1000, "S1-", 1).persist()
    assert r.count() == 1000
    before = written(spark)
    counts = blocking.term_counts(r.unionByName(r), cfg)  # features of a record given twice are added
    assert counts.where("tf % 2 = 0").count() == counts.count() > 5000
    assert written(spark) - before < 5000  # two counts of 2,000 records
    r.unpersist()


def test_a_view_scores_once(spark, sf):
    v = queries.View(spark, sf)
    scored = v.scored()
    before = written(spark)
    assert v.scored() is scored and scored.count() > 0
    assert written(spark) - before < 50  # counts of tasks


def test_soft_jaccard_joins_weights_once_for_each_record(spark):
    q, r = records(spark, 60, "S1-", 1), records(spark, 90, "S2-", 2)
    idf, total = pair_ops.name_idf(q.unionByName(r))
    ids = q.select("country", q.entity_id.alias("s1_id")).join(r.select("country", r.entity_id.alias("cand_id")), "country").select("s1_id", "cand_id").persist()
    want = {(x.s1_id, x.cand_id): x.name_idf_soft_jaccard for x in pair_ops.soft_jaccard(pair_ops.attach(ids, q, r), idf, total).collect()}
    before = written(spark)
    got = pair_ops.soft_jaccard(pair_ops.attach(ids, *pair_ops.weighted(q, r, idf, total)), idf, total).collect()
    assert written(spark) - before < 3 * len(want)  # pairs go to each side's views, not to their names' weights
    assert len(got) == len(want) == 2700 and all(abs(x.name_idf_soft_jaccard - want[x.s1_id, x.cand_id]) < 1e-12 for x in got)
    ids.unpersist()


def test_what_no_part_keeps_is_never_kept():
    rng = np.random.default_rng(1)
    rules = (Prune(), Prune(confident=0.5, usable=0.3, cap_confident=3, cap=5, fallback=1), *metrics.SWEEP)
    for i in range(200):
        whole = np.round(np.sort(rng.random(120) * rng.choice([0.1, 0.3, 0.9, 1.0]))[::-1], 2)
        part = whole[rng.random(120) < rng.random()]
        for p in rules[i % 2 :]:
            best, rank = whole[0], np.arange(1, 121)
            floor, cap = (p.floor_confident, p.cap_confident) if best > p.confident else (p.floor, p.cap)
            kept = whole[(whole >= floor * best) & (rank <= cap) if best >= p.usable else rank <= p.fallback]
            held = part[retrieve.may_be_kept(part, (p,))] if len(part) else part
            assert set(part[part > kept[-1]]) <= set(held) and len(held) <= len(part)


def test_pruning_starts_in_the_parts(spark):
    cfg = Config(k=30, df_frac=1.0, hashed=False, score_digits=6)
    q, r = records(spark, 60, "S1-", 1), records(spark, 90, "S2-", 2)
    weights, idf = blocking.build_index(r, cfg)
    rows = lambda df: sorted(tuple(x) for x in df.collect())
    for rule in (Prune(), Prune(floor_confident=0.6, floor=0.6, cap_confident=4, cap=6), Prune(usable=20.0, confident=30.0)):
        for part in (4, 30, 1000):
            every, some = retrieve.top_k(q, weights, idf, cfg, part), retrieve.top_k(q, weights, idf, cfg, part, (rule,))
            assert rows(retrieve.prune(some, rule)) == rows(retrieve.prune(every, rule))
            assert part < 1000 or rule == Prune() or some.count() < every.count()


def test_a_sweep_reads_candidates_once(spark):
    cfg = Config(k=30, df_frac=1.0, hashed=False, score_digits=6)
    q, r = records(spark, 60, "S1-", 1), records(spark, 90, "S2-", 2)
    weights, idf = blocking.build_index(r, cfg)
    found = retrieve.top_k(q, weights, idf, cfg)
    truth = found.where("rank % 5 = 1").select("s1_id", "cand_id")
    rules = (*metrics.SWEEP, Prune(cap_confident=20, cap=20))
    got = metrics.prune_sweep(retrieve.top_k(q, weights, idf, cfg, 30, rules), truth, 60, rules, (8, 30)).collect()
    want = [x for k in (8, 30) for x in metrics.prune_sweep(found.where(f"rank <= {k}"), truth, 60, rules).withColumn("k", F.lit(k)).collect()]
    assert sorted(got) == sorted(want) and len({x.kept for x in got}) > 2


def test_labels_meet_ids_before_features(spark):
    cfg = Config(k=10, df_frac=1.0, hashed=False, score_digits=6)
    q, r = records(spark, 20, "S1-", 1), records(spark, 30, "S2-", 2)
    plain = linkage.pair_features(q, r, cfg)
    truth = linkage.candidates(q, r, cfg).where("rank = 1").select("s1_id", "cand_id")
    labelled = linkage.pair_features(q, r, cfg, truth)
    assert labelled.columns == [*plain.columns[:3], "label", *plain.columns[3:]]
    columns = sorted(labelled.columns)
    rows = lambda df: sorted(tuple(x) for x in df.select(*columns).collect())
    assert rows(labelled) == rows(model.label_pairs(plain, truth)) and labelled.where("label = 1").count() == 20
