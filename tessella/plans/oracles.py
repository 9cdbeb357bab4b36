"""DuckDB SQL for the linkage queries."""

from __future__ import annotations

from itertools import product

from ..functions.text import ADDRESS_FORMS, LEGAL_FORMS, LIGATURES, NUMERALS, SOUND_GROUPS
from ..operators.metrics import GRID, KS, PERCENTILES, SWEEP
from .linkage import ADDRESS_WORDS, NAME_WORDS
from .queries import CFG, LEAST, RULE


def _map(table: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in table.items()) + "}"


def _plain(x: str) -> str:
    s = f"strip_accents({x})"
    for a, b in LIGATURES.items():
        s = f"replace({s}, '{a}', '{b}')"
    return s


def _tokens(x: str) -> str:
    s = f"replace(lower({_plain(x)}), '&', ' and ')"
    s = rf"regexp_replace({s}, '\b([0-9]+)(st|nd|rd|th)\b', '\1', 'g')"
    for _ in range(2):  # matches overlap
        s = rf"regexp_replace({s}, '([a-z])0([a-z])', '\1o\2', 'g')"
    s = rf"regexp_replace({s}, '([a-z])([0-9])', '\1 \2', 'g')"
    s = rf"regexp_replace({s}, '([0-9])([a-z])', '\1 \2', 'g')"
    parts = f"list_filter(regexp_split_to_array({s}, '[^a-z0-9]+'), lambda t: t <> '')"
    return rf"list_transform({parts}, lambda t: CASE WHEN regexp_matches(t, '^[0-9]+$') THEN regexp_replace(t, '^0+([0-9])', '\1') ELSE coalesce({_map(NUMERALS)}[t], t) END)"


def _skeleton(t: str) -> str:
    for a, b in SOUND_GROUPS:
        t = f"replace({t}, '{a}', '{b}')"
    t = rf"regexp_replace(regexp_replace({t}, 'c([eiy])', 's\1', 'g'), 'c$', 's')"
    t = f"translate(regexp_replace(replace({t}, 'c', 'k'), '[aeiouh]', '', 'g'), 'gzvwm', 'jjbbn')"
    return f"list_reduce(list_prepend('', string_split({t}, '')), lambda a, c: CASE WHEN right(a, 1) = c THEN a ELSE a || c END)"


def _numbers(parts: str) -> str:
    return f"list_filter({parts}, lambda t: regexp_matches(t, '^[0-9]+$'))"


VIEW = rf"""
docs AS (
  SELECT doc_id, coalesce(lang, '') AS country, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), longest AS (
  SELECT doc_id, country, list_transform(list_sort(list_transform(list_distinct(w), lambda x: {{'n': -length(x), 'w': x}})), lambda x: x.w) AS w FROM docs
), recs AS (
  SELECT doc_id, country, array_to_string(w[1:{NAME_WORDS}], ' ') AS business_name, array_to_string(w[{NAME_WORDS + 1}:{NAME_WORDS + ADDRESS_WORDS}], ' ') AS business_address FROM longest
), heads AS (
  SELECT country, business_name, min(doc_id) AS head FROM recs GROUP BY ALL
), view_ AS (
  SELECT CASE WHEN doc_id = head THEN 'S1-' WHEN doc_id % 2 = 0 THEN 'S2-' ELSE 'S3-' END || doc_id AS entity_id, business_name, business_address, country, head
  FROM recs JOIN heads USING (country, business_name)
), truth AS (
  SELECT 'S1-' || head AS s1_id, entity_id AS cand_id, country FROM view_ WHERE entity_id NOT LIKE 'S1-%'
), entities AS (
  SELECT entity_id AS s1_id, country FROM view_ WHERE entity_id LIKE 'S1-%'
)"""
VIEWED = f"""{VIEW}, toks AS (
  SELECT *, {_tokens("business_name")} AS nt, list_transform({_tokens("business_address")}, lambda t: coalesce({_map(ADDRESS_FORMS)}[t], t)) AS addr FROM view_
), viewed AS (
  SELECT *, array_to_string(nt, ' ') AS name_raw, regexp_replace(array_to_string(nt, ' '), '( ({"|".join(LEGAL_FORMS)}))+$', '') AS name_core,
    list_transform(string_split(array_to_string(nt, ' '), ' '), lambda t: {_skeleton("t")}) AS nk, list_transform(addr, lambda t: {_skeleton("t")}) AS ak,
    {_numbers("addr")} AS nums,
    list_filter(list_transform(range(1, len(addr)), lambda i: addr[i] || '_' || addr[i + 1]), lambda p: regexp_matches(p, '^[0-9]+_')) AS np
  FROM toks
)"""
COUNTS = f"""{VIEWED}, feats AS (
  SELECT country, entity_id, unnest(list_concat(
    list_transform(nt, lambda t: 'n_' || t), list_transform(range(1, len(nt)), lambda i: 'b_' || nt[i] || '_' || nt[i + 1]),
    list_transform(list_filter(nk, lambda t: t <> ''), lambda t: 'k_' || t), list_transform(addr, lambda t: 'a_' || t), list_transform(nums, lambda t: 'd_' || t),
    list_transform(list_filter(ak, lambda t: t <> ''), lambda t: 'ak_' || t), list_transform(np, lambda t: 'dw_' || t))) AS fid
  FROM viewed
), tf AS (
  SELECT country, entity_id, fid, count(*) AS tf FROM feats GROUP BY ALL
), sizes AS (
  SELECT country, count(*) AS n FROM view_ WHERE entity_id NOT LIKE 'S1-%' GROUP BY ALL
), dfs AS (
  SELECT country, fid, count(*) AS df FROM tf WHERE entity_id NOT LIKE 'S1-%' GROUP BY ALL
), idf AS (
  SELECT country, fid, df, ln((n + 1.0) / (df + 1.0)) + 1.0 AS idf FROM dfs JOIN sizes USING (country) WHERE df <= {CFG.df_frac} * n
), raw AS (
  SELECT country, entity_id, fid, tf * idf AS w FROM tf JOIN idf USING (country, fid)
), weights AS (
  SELECT country, entity_id, fid, w / sqrt(sum(w * w) OVER (PARTITION BY country, entity_id)) AS w FROM raw
)"""
RANKED = f"""{COUNTS}, sums AS (
  SELECT q.country, q.entity_id AS s1_id, d.entity_id AS cand_id, round(sum(q.w * d.w), 6) AS score
  FROM weights q JOIN weights d ON q.country = d.country AND q.fid = d.fid
  WHERE q.entity_id LIKE 'S1-%' AND d.entity_id NOT LIKE 'S1-%' GROUP BY ALL
), ranked AS (
  SELECT s1_id, country, cand_id, score, CAST(row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_id) AS INTEGER) AS rank FROM sums WHERE score > 0
)"""


def _found(k: int) -> str:
    return f"{RANKED}, found AS (SELECT * FROM ranked WHERE rank <= {k})"


FOUND = _found(CFG.k)


def _keep(p) -> str:
    return (
        f"(best > 0 AND CASE WHEN best >= {p.usable} THEN CASE WHEN best > {p.confident} THEN score >= {p.floor_confident} * best AND rank <= {p.cap_confident}"
        f" ELSE score >= {p.floor} * best AND rank <= {p.cap} END ELSE rank <= {p.fallback} END)"
    )


PRUNED = f"""{FOUND}, bests AS (
  SELECT *, max(score) OVER (PARTITION BY s1_id) AS best FROM found
), pruned AS (
  SELECT s1_id, country, cand_id, score, rank FROM bests WHERE {_keep(CFG.prune)}
), scored AS (
  SELECT s1_id, country, cand_id, round(least(score, 1.0), 6) AS prob FROM pruned
)"""
CHOSEN = f"""{PRUNED}, places AS (
  SELECT *, max(prob) OVER (PARTITION BY s1_id) AS best, row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, cand_id) AS place FROM scored
), chosen AS (
  SELECT s1_id, cand_id, prob FROM places WHERE best >= {RULE.single} AND prob >= greatest({RULE.match}, {RULE.share} * best) AND place <= {RULE.cap}
), firsts AS (
  SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, cand_id) = 1 AS is_best FROM chosen
), resolved AS (
  SELECT s1_id, cand_id, prob FROM (SELECT *, row_number() OVER (PARTITION BY cand_id ORDER BY is_best DESC, prob DESC, s1_id) AS place FROM firsts) WHERE place = 1
)"""


def _f05(p: str, h: str, t: str) -> str:
    return f"CASE WHEN {p} = 0 AND {t} = 0 THEN 1.0 WHEN {p} = 0 OR {t} = 0 OR {h} = 0 THEN 0.0 ELSE 1.25 * ({h} / {p}) * ({h} / {t}) / (0.25 * ({h} / {p}) + ({h} / {t})) END"


def _entity(name: str, predicted: str) -> str:
    return f"""{name}_n AS (
  SELECT s1_id, (SELECT count(*) FROM {predicted} p WHERE p.s1_id = e.s1_id) AS n_pred, (SELECT count(*) FROM {predicted} p JOIN truth t ON p.s1_id = t.s1_id AND p.cand_id = t.cand_id WHERE p.s1_id = e.s1_id) AS n_hit,
    (SELECT count(*) FROM truth t WHERE t.s1_id = e.s1_id) AS n_true, country FROM entities e
), {name} AS (SELECT *, {_f05("n_pred", "n_hit", "n_true")} AS f05 FROM {name}_n)"""


_RULES = ", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for i, (a, b, c) in enumerate(product(*GRID)))
_GRID = f"""{PRUNED}, rules(rule, single, "match", share) AS (VALUES {_RULES}), places AS (
  SELECT *, max(prob) OVER (PARTITION BY s1_id) AS best, row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, cand_id) AS place FROM scored
), flagged AS (
  SELECT p.*, (t.cand_id IS NOT NULL)::INT AS hit FROM places p LEFT JOIN truth t ON p.s1_id = t.s1_id AND p.cand_id = t.cand_id
), kept AS (
  SELECT r.rule, f.s1_id, count(*) AS n, sum(hit) AS h FROM flagged f, rules r
  WHERE best >= r.single AND prob >= greatest(r."match", r.share * best) AND place <= 12 GROUP BY ALL
), every AS (
  SELECT r.*, e.s1_id, e.country, (SELECT count(*) FROM truth t WHERE t.s1_id = e.s1_id) AS n_true FROM rules r, entities e
), each AS (
  SELECT every.*, {_f05("coalesce(n, 0)", "coalesce(h, 0)", "n_true")} AS f FROM every LEFT JOIN kept USING (rule, s1_id)
)"""
_PAIRS = f"""{PRUNED}, pairs AS (
  SELECT s1_id, cand_id, q.name_raw AS name_1, r.name_raw AS name_2, q.name_core AS core_1, r.name_core AS core_2, q.business_address AS addr_1, r.business_address AS addr_2,
    q.addr AS words_1, r.addr AS words_2, q.nums AS nums_1, r.nums AS nums_2, r.business_name AS given_2
  FROM pruned JOIN viewed q ON q.entity_id = s1_id JOIN viewed r ON r.entity_id = cand_id
)"""


def _split(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '[\x20\x09-\x0D]+'), lambda t: t <> '')"


def _jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0 ELSE round(len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))), 6) END"


_LONG = "list_transform(list_filter(regexp_extract_all({0}, '[0-9]+'), lambda x: len(x) >= 4), lambda x: CAST(x AS HUGEINT))"
_NEAR = f"len(list_filter({_LONG.format('addr_1')}, lambda x: len(list_filter({_LONG.format('addr_2')}, lambda y: abs(x - y) <= 1)) > 0)) > 0"
_SHARED = "list_intersect(nums_1, nums_2)"


def _with(ctes: str, query: str) -> str:
    return f"WITH {ctes.strip()}\n{query}"


_SWEEP = " UNION ALL ".join(
    f"SELECT {k} AS k, {i} AS setting, count(*) FILTER (WHERE {_keep(p)}) AS kept, count(*) FILTER (WHERE {_keep(p)} AND t.cand_id IS NOT NULL) AS hits FROM bests b LEFT JOIN truth t ON b.s1_id = t.s1_id AND b.cand_id = t.cand_id WHERE rank <= {k}"
    for k in (50, 100)
    for i, p in enumerate(SWEEP)
)
_RULED = """SELECT rule, single, "match", share, country, macro_f05, n_entities FROM (
  SELECT *, row_number() OVER (PARTITION BY country ORDER BY macro_f05 DESC, rule) AS place FROM (
    SELECT rule, single, "match", share, country, round(avg(f), 6) AS macro_f05, count(*) AS n_entities FROM each GROUP BY ALL HAVING count(*) >= %d)) WHERE place = 1""" % LEAST
_LISTS = f"{VIEW}, lists AS (SELECT e.s1_id, coalesce((SELECT list(t.cand_id) FROM truth t WHERE t.s1_id = e.s1_id), CAST([] AS VARCHAR[])) AS ids FROM entities e)"

ORACLE_SQL = {
    "normalize_text": _with(VIEWED, "SELECT entity_id, name_raw, name_core, array_to_string(nk, ' ') AS name_skeleton, array_to_string(addr, ' ') AS address_words, array_to_string(nums, ' ') AS numbers, array_to_string(np, ' ') AS number_pairs FROM viewed"),
    "feature_counts": _with(COUNTS, "SELECT * FROM tf WHERE entity_id NOT LIKE 'S1-%'"),
    "document_frequencies": _with(COUNTS, "SELECT country, fid, df, round(idf, 6) AS idf FROM idf"),
    "tfidf_weights": _with(COUNTS, "SELECT country, entity_id, fid, round(w, 6) AS w FROM weights WHERE entity_id NOT LIKE 'S1-%'"),
    "topk_cosine": _with(FOUND, "SELECT * FROM found"),
    "adaptive_prune": _with(PRUNED, "SELECT * FROM pruned"),
    "retrieval_context": _with(PRUNED, """SELECT *, round(score / max(score) OVER (PARTITION BY s1_id), 6) AS score_over_best, round(max(score) OVER (PARTITION BY s1_id) - score, 6) AS gap_best,
  round(score - lead(score, 1, 0.0) OVER (PARTITION BY s1_id ORDER BY score DESC, cand_id), 6) AS gap_next FROM pruned"""),
    "candidate_lists": _with(PRUNED, "SELECT e.s1_id AS entity_id, coalesce(string_agg(cand_id, ',' ORDER BY rank), '') AS candidate_ids FROM entities e LEFT JOIN pruned p ON p.s1_id = e.s1_id GROUP BY ALL"),
    "name_idf": _with(VIEWED, f"""SELECT token, count(*) AS df, round(ln(((SELECT count(*) FROM viewed) + 1.0) / (count(*) + 1.0)) + 1.0, 6) AS idf
FROM (SELECT unnest(list_distinct({_split('name_core')})) AS token FROM viewed) GROUP BY token HAVING count(*) >= 2"""),
    "set_features": _with(_PAIRS, f"""SELECT s1_id, cand_id, {_jaccard(_split('core_1'), _split('core_2'))} AS core_token_jaccard, CAST(abs(length(core_1) - length(core_2)) AS DOUBLE) AS core_len_diff,
  {_jaccard(_split('addr_1'), _split('addr_2'))} AS addr_token_jaccard, {_jaccard('words_1', 'words_2')} AS addr_word_jaccard, {_jaccard('nums_1', 'nums_2')} AS num_jaccard,
  CAST(len({_SHARED}) AS DOUBLE) AS num_shared, CAST((len(nums_1) > 0 AND len(nums_2) > 0 AND len({_SHARED}) = 0) AS DOUBLE) AS num_conflict,
  CAST(coalesce(list_max(list_transform({_SHARED}, lambda x: len(x))), 0) AS DOUBLE) AS num_longest_shared_len, CAST({_NEAR} AS DOUBLE) AS postcode_delta,
  CAST(trim(addr_1) = '' AS DOUBLE) AS addr_empty_s1, CAST(trim(addr_2) = '' AS DOUBLE) AS addr_empty_cand, CAST(regexp_matches(given_2, '[^\\x00-\\x7f]') AS DOUBLE) AS name_nonlatin_cand,
  CAST(cand_id LIKE 'S3-%' AS DOUBLE) AS is_s3, CAST(len(list_filter({_SHARED}, lambda x: len(x) >= 4)) > 0 AS DOUBLE) AS long_num_exact,
  coalesce(CAST(nums_1[1] = nums_2[1] AS DOUBLE), 0.0) AS addr_housenum_exact FROM pairs"""),
    "soft_jaccard": _with(_PAIRS, f"""SELECT s1_id, cand_id, round(CASE WHEN sum(w) > 0 THEN sum(CASE WHEN shared THEN w ELSE 0.0 END) / sum(w) ELSE 1.0 END, 6) AS name_idf_soft_jaccard FROM (
  SELECT p.s1_id, p.cand_id, list_contains({_split('core_1')}, token) AND list_contains({_split('core_2')}, token) AS shared,
    CASE WHEN token IS NULL THEN 0.0 ELSE coalesce(i.idf, ln((n + 1.0) / 2.0) + 1.0) END AS w
  FROM pairs p LEFT JOIN (SELECT s1_id, cand_id, unnest(list_distinct(list_concat({_split('core_1')}, {_split('core_2')}))) AS token FROM pairs) u USING (s1_id, cand_id)
  CROSS JOIN (SELECT count(*) AS n FROM viewed)
  LEFT JOIN (SELECT token, ln(((SELECT count(*) FROM viewed) + 1.0) / (count(*) + 1.0)) + 1.0 AS idf
    FROM (SELECT unnest(list_distinct({_split('name_core')})) AS token FROM viewed) GROUP BY token HAVING count(*) >= 2) i USING (token)
) GROUP BY ALL"""),
    "jaro_winkler": _with(_PAIRS, "SELECT s1_id, cand_id, round(CASE WHEN name_1 = '' AND name_2 = '' THEN 1.0 ELSE jaro_winkler_similarity(name_1, name_2) END, 6) AS name_jaro FROM pairs"),
    "select_matches": _with(CHOSEN, "SELECT * FROM chosen"),
    "resolve_one_to_one": _with(CHOSEN, "SELECT * FROM resolved"),
    "entity_f05": _with(f"{CHOSEN}, {_entity('ent', 'chosen')}", "SELECT s1_id, n_pred, n_hit, n_true, round(f05, 6) AS f05 FROM ent"),
    "macro_f05": _with(f"{CHOSEN}, {_entity('one', 'chosen')}, {_entity('two', 'resolved')}", """SELECT round(avg(f05), 6) AS macro_f05, count(*) AS n_entities, 'selected' AS stage FROM one
UNION ALL SELECT round(avg(f05), 6), count(*), 'resolved' FROM two"""),
    "recall_curve": _with(_found(max(KS)), f"""SELECT k, hits, truths, round(hits / truths, 6) AS recall FROM (
  SELECT k, count(*) AS truths, count(*) FILTER (WHERE f.rank <= k) AS hits FROM truth t CROSS JOIN (SELECT unnest([{", ".join(map(str, KS))}]) AS k) LEFT JOIN found f ON f.s1_id = t.s1_id AND f.cand_id = t.cand_id GROUP BY k)"""),
    "prune_sweep": _with(f"{_found(100)}, bests AS (SELECT *, max(score) OVER (PARTITION BY s1_id) AS best FROM found)", f"SELECT k, setting, kept, hits, round(hits / (SELECT count(*) FROM truth), 6) AS recall, round(kept / (SELECT count(*) FROM entities), 6) AS mean_candidates FROM ({_SWEEP})"),
    "score_percentiles": _with(FOUND, f"""SELECT kind, count(*) AS n, {", ".join(f"round(quantile_cont(score, {p}), 4) AS p{round(100 * p)}" for p in PERCENTILES)} FROM (
  SELECT f.score, CASE WHEN t.cand_id IS NULL THEN 'other' ELSE 'true' END AS kind FROM found f LEFT JOIN truth t ON f.s1_id = t.s1_id AND f.cand_id = t.cand_id) GROUP BY kind"""),
    "rank_histogram": _with(FOUND, """SELECT worst_rank, count(*) AS entities FROM (
  SELECT t.s1_id, CAST(CASE WHEN count(*) = count(f.rank) THEN max(f.rank) ELSE 0 END AS INTEGER) AS worst_rank FROM truth t LEFT JOIN found f ON f.s1_id = t.s1_id AND f.cand_id = t.cand_id GROUP BY t.s1_id) GROUP BY worst_rank"""),
    "missed_by_country": _with(FOUND, "SELECT t.country, count(*) AS truths, count(*) FILTER (WHERE f.cand_id IS NULL) AS missed FROM truth t LEFT JOIN found f ON f.s1_id = t.s1_id AND f.cand_id = t.cand_id GROUP BY t.country"),
    "grid_search": _with(_GRID, 'SELECT rule, single, "match", share, round(avg(f), 6) AS macro_f05, count(*) AS n_entities FROM each GROUP BY ALL'),
    "country_rules": _with(_GRID, _RULED),
    "country_thresholds": _with(f"{_GRID}, ruled AS ({_RULED})", f"""SELECT s1_id, cand_id, country, prob FROM places LEFT JOIN ruled r USING (country)
WHERE best >= coalesce(r.single, {RULE.single}) AND prob >= greatest(coalesce(r."match", {RULE.match}), coalesce(r.share, {RULE.share}) * best) AND places.place <= {RULE.cap}"""),
    "transliterate_names": _with(VIEW, f"SELECT entity_id, {_plain('business_name')} AS business_name, {_plain('business_address')} AS business_address FROM view_"),
    "index_metadata": _with(COUNTS, f"SELECT country, n AS n_records, (SELECT count(*) FROM idf i WHERE i.country = s.country) AS features_kept, CAST({CFG.df_frac} AS DOUBLE) AS df_frac, 0 AS buckets FROM sizes s"),
    "record_scan": _with(VIEW, "SELECT entity_id, business_name, business_address, country FROM view_ WHERE entity_id IN (SELECT s1_id FROM truth)"),
    "truth_scan": _with(VIEW, "SELECT s1_id, cand_id FROM truth"),
    "entity_split": _with(VIEW, "SELECT s1_id, CAST('0x' || substr(md5(s1_id || '|42'), 1, 8) AS BIGINT) % 100 < 20 AS validation FROM entities"),
    "training_set": _with(f"""{PRUNED}, pseudo AS (SELECT DISTINCT s1_id, cand_id FROM scored WHERE country <> 'en' AND prob >= 0.5)""", """SELECT s.s1_id, s.cand_id, (t.cand_id IS NOT NULL)::INT AS label, false AS pseudo FROM scored s LEFT JOIN truth t ON t.s1_id = s.s1_id AND t.cand_id = s.cand_id WHERE s.country = 'en'
UNION ALL SELECT s.s1_id, s.cand_id, (p.cand_id IS NOT NULL)::INT, true FROM scored s LEFT JOIN pseudo p ON p.s1_id = s.s1_id AND p.cand_id = s.cand_id WHERE s.country <> 'en' AND s.s1_id IN (SELECT s1_id FROM pseudo)"""),
    "assembled_files": _with(CHOSEN, """SELECT 'matches' AS file, e.s1_id AS source1_entity_id, coalesce(string_agg(cand_id, ',' ORDER BY prob DESC, cand_id), '') AS ids FROM entities e LEFT JOIN resolved r ON r.s1_id = e.s1_id GROUP BY ALL
UNION ALL SELECT 'candidates', e.s1_id, coalesce(string_agg(cand_id, ',' ORDER BY prob DESC, cand_id), '') FROM entities e LEFT JOIN scored s ON s.s1_id = e.s1_id GROUP BY ALL"""),
    "resolver_report": _with(f"{CHOSEN}, {_entity('two', 'resolved')}", "SELECT (SELECT round(avg(f05), 6) FROM two) AS macro_f05, (SELECT count(*) FROM two) AS n_entities, (SELECT count(*) FROM chosen) AS n_claims, (SELECT count(*) FROM resolved) AS n_kept"),
    "top_score_percentiles": _with(FOUND, f"""SELECT kind, count(*) AS n, {", ".join(f"round(quantile_cont(score, {p}), 4) AS p{round(100 * p)}" for p in PERCENTILES)} FROM (
  SELECT e.s1_id, CASE WHEN e.s1_id IN (SELECT s1_id FROM truth) THEN 'matched' ELSE 'singleton' END AS kind, coalesce(max(f.score), 0.0) AS score FROM entities e LEFT JOIN found f ON f.s1_id = e.s1_id GROUP BY ALL) GROUP BY kind"""),
    "missed_examples": _with(PRUNED, "SELECT t.s1_id, t.cand_id, t.country FROM truth t LEFT JOIN pruned p ON p.s1_id = t.s1_id AND p.cand_id = t.cand_id WHERE p.cand_id IS NULL ORDER BY t.s1_id, t.cand_id LIMIT 20"),
    "oracle_by_depth": _with(f"""{_found(100)}, {", ".join(f"hit{k} AS (SELECT f.s1_id, f.cand_id FROM found f JOIN truth t ON f.s1_id = t.s1_id AND f.cand_id = t.cand_id WHERE f.rank <= {k}), {_entity(f'ent{k}', f'hit{k}')}" for k in (10, 50, 100))}""", " UNION ALL ".join(f"SELECT {k} AS k, round(avg(f05), 6) AS macro_f05 FROM ent{k}" for k in (10, 50, 100))),
    "profile_matched": _with(VIEW, r"""SELECT left(entity_id, 2) AS source, country, count(*) AS n_rows, count(*) FILTER (WHERE trim(business_name) = '') AS missing_name, count(*) FILTER (WHERE trim(business_address) = '') AS missing_address,
  count(*) FILTER (WHERE regexp_matches(business_name, '[^\x00-\x7f]')) AS nonlatin_name FROM view_ WHERE entity_id IN (SELECT cand_id FROM truth) GROUP BY ALL"""),
    "cross_country_examples": _with(VIEW, """SELECT q.entity_id AS s1_id, r.entity_id AS cand_id, q.country AS country_1, r.country AS country_2 FROM view_ q JOIN view_ r ON q.business_name = r.business_name
WHERE q.entity_id LIKE 'S1-%' AND r.entity_id NOT LIKE 'S1-%' AND q.country <> r.country ORDER BY 1, 2 LIMIT 5"""),
    "name_vanishes": _with(VIEWED, "SELECT entity_id, business_name FROM viewed WHERE trim(business_name) <> '' AND name_raw = ''"),
    "baselines": _with(f"""{PRUNED}, perfect AS (SELECT s.s1_id, s.cand_id FROM scored s JOIN truth t ON s.s1_id = t.s1_id AND s.cand_id = t.cand_id),
top1 AS (SELECT s1_id, cand_id FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, cand_id) AS place FROM scored) WHERE place = 1 AND prob >= 0.5),
{_entity("one", "perfect")}, {_entity("two", "top1")}""", """SELECT (SELECT round(avg(f05), 6) FROM one) AS oracle_f05, (SELECT round(avg((n_true = 0)::INT), 6) FROM one) AS all_empty_f05, (SELECT round(avg(f05), 6) FROM two) AS top1_f05"""),
    "weighted_f05": _with(f"""{CHOSEN}, {_entity("ent", "chosen")}, mix AS (SELECT country, n / (SELECT sum(n) FROM sizes) AS share FROM sizes),
per AS (SELECT country, avg(f05) AS f, coalesce(any_value(share), (SELECT min(share) FROM mix)) AS w FROM ent LEFT JOIN mix USING (country) GROUP BY country)""", "SELECT round(sum(w * f) / sum(w), 6) AS weighted_f05 FROM per"),
    "profile_source": _with(VIEW, r"""SELECT left(entity_id, 2) AS source, count(*) AS n_rows, count(*) FILTER (WHERE NOT regexp_matches(entity_id, '^S[123]-[0-9]{1,9}$')) AS bad_id, count(*) - count(DISTINCT entity_id) AS dup_id,
  CAST(min(length(entity_id) - 3) AS INTEGER) AS min_digits, CAST(max(length(entity_id) - 3) AS INTEGER) AS max_digits, count(*) FILTER (WHERE trim(business_name) = '') AS missing_name, count(*) FILTER (WHERE trim(business_address) = '') AS missing_address,
  count(*) FILTER (WHERE regexp_matches(business_name, '[^\x00-\x7f]')) AS nonlatin_name, count(*) FILTER (WHERE regexp_matches(business_address, '[^\x00-\x7f]')) AS nonlatin_address,
  count(*) FILTER (WHERE regexp_matches(business_name, '[^\x00-\x7f]') AND trim(regexp_replace(business_name, '[^\x00-\x7f]', '', 'g')) = '') AS nonlatin_only_name, count(DISTINCT country) AS countries
FROM view_ GROUP BY 1"""),
    "country_histogram": _with(VIEW, "SELECT country, count(*) AS n_rows FROM view_ GROUP BY country"),
    "profile_truth": _with(_LISTS, """SELECT count(*) AS n_entities, count(*) FILTER (WHERE len(ids) = 0) AS singletons, CAST(sum(len(ids)) AS BIGINT) AS n_pairs, max(len(ids)) AS longest, round(avg(len(ids)), 6) AS mean_size,
  CAST(sum(len(ids) - len(list_distinct(ids))) AS BIGINT) AS repeats, count(*) FILTER (WHERE list_contains(ids, s1_id)) AS self_matches, (SELECT count(*) FROM truth WHERE cand_id LIKE 'S2-%') AS from_s2,
  (SELECT count(*) FROM truth WHERE cand_id LIKE 'S3-%') AS from_s3, (SELECT count(*) FROM (SELECT cand_id FROM truth GROUP BY cand_id HAVING count(DISTINCT s1_id) > 1)) AS claimed_twice FROM lists"""),
    "list_sizes": _with(_LISTS, "SELECT CAST(len(ids) AS INTEGER) AS size, count(*) AS entities FROM lists GROUP BY 1"),
    "same_country_rate": _with(VIEW, """SELECT count(*) FILTER (WHERE q.country = r.country) AS same, count(*) FILTER (WHERE q.country <> r.country) AS cross, count(*) FILTER (WHERE q.country IS NULL OR r.country IS NULL) AS unknown
FROM truth t LEFT JOIN view_ q ON q.entity_id = t.s1_id LEFT JOIN view_ r ON r.entity_id = t.cand_id"""),
    "validate_output": _with(PRUNED, "SELECT 'matches' AS file, 'not_a_candidate' AS rule, t.s1_id, t.cand_id AS detail FROM truth t LEFT JOIN pruned p ON p.s1_id = t.s1_id AND p.cand_id = t.cand_id WHERE p.cand_id IS NULL"),
    "pseudo_labels": _with(PRUNED, "SELECT s1_id, cand_id, round(max(prob), 6) AS prob FROM scored WHERE country <> 'en' AND prob >= 0.5 GROUP BY ALL"),
    "hash_sample": _with(VIEW, "SELECT s1_id AS entity_id FROM entities ORDER BY md5(s1_id || '|42'), s1_id LIMIT 50"),
}
