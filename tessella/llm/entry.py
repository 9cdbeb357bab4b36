"""Queries of the corpus operators over the standard tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, lm, mixing, packing, pii, quality, simhash, topk, toxicity, urls
from .common import bucket, stored, words


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out: (doc_id, held_out, lang_pred, score)."""
    docs = _documents(spark, sf_dir)
    held_out = bucket(F.col("doc_id"), 5) == 0
    rows = langid.training_rows(docs, "doc_id", "text", "lang", ~held_out, langid.MAX_TRAIN_ROWS)
    return langid.identify(docs, langid.fit(rows), carry=(("held_out", held_out),))


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: (page_id, host, path, rule, verdict, llr)."""
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: (doc_id, fingerprint, component_id)."""
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best of all vectors for every query, by integer inner product: (query_id, rank, vec_id, score)."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, compression figures and verdict of every document."""
    return quality.judge(_documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels that are not held out, and its worst sentence."""
    docs = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = bucket(F.col("doc_id"), 4) == 2
    rows = toxicity.training_docs(docs, labels, "doc_id", "text", "toxic", ~held_out, toxicity.MAX_TRAIN_DOCS)
    return toxicity.assess(docs, toxicity.fit(rows), carry=(("held_out", held_out),))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket and batch of every document: (doc_id, n_tokens, bucket, bucket_len, shard, batch, batch_id)."""
    docs = _documents(spark, sf_dir)
    measured = stored(docs.select("doc_id", F.size(words(F.col("text"))).alias("size")), "sizes")
    return packing.pack(measured, length=F.col("size")).select("doc_id", "n_tokens", "bucket", "bucket_len", "shard", "batch", "batch_id")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts, digest of the fixed patterns' spans, all spans."""
    return pii.find(_documents(spark, sf_dir))


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and model scores of every document, learned from those that are not held out."""
    return lm.score(_documents(spark, sf_dir), bucket(F.col("doc_id"), 7) == 2)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and sampling decision of every document: (doc_id, source, lang, topic, weight, probability, selected)."""
    docs = _documents(spark, sf_dir)
    text = F.col("text")
    measured = stored(docs.select("doc_id", "source", "lang", mixing.topic(text).alias("kind"), F.size(words(text)).alias("size"), F.when(F.col("doc_id").isNull(), text).alias("text")), "kinds")
    mixed = mixing.mix(measured, topic_of=F.col("kind"), tokens_of=F.col("size"))
    return mixed.select("doc_id", "source", "lang", "topic", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "selected")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_urls": op2_urls,
    "op3_simhash": op3_simhash,
    "op4_topk": op4_topk,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_pii": op8_pii,
    "op9_lm": op9_lm,
    "op10_mixing": op10_mixing,
}



def _packing_sql(buckets: int = packing.BUCKETS, budget: int = packing.TOKEN_BUDGET, shard_rows: int = packing.SHARD_ROWS) -> str:
    """The dynamic programme level by level; ids must not be null, as rows without one are dealt by their place."""
    w = r"""WITH docs AS (
  SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n_tokens FROM documents
), hist AS (
  SELECT n_tokens AS top, row_number() OVER (ORDER BY n_tokens) AS j, sum(count(*)) OVER (ORDER BY n_tokens) AS n FROM docs GROUP BY n_tokens
), start AS (
  SELECT 0 AS j, 0::HUGEINT AS cost, 0 AS n
), level0 AS (
  SELECT h.j, h.top * h.n AS cost, 0 AS prev, h.n FROM hist h
)"""
    for k in range(1, buckets):
        w += f""", level{k} AS (
  SELECT j, b.cost, b.i AS prev, n FROM (SELECT h.j, any_value(h.n) AS n, min({{'cost': p.cost + h.top * (h.n - p.n), 'i': p.j}}) AS b FROM hist h JOIN level{k - 1} p ON p.j < h.j GROUP BY h.j)
)"""
    last = "(SELECT max(j) FROM hist)"
    w += ", totals AS (" + " UNION ALL ".join(f"SELECT {k} AS k, cost FROM level{k} WHERE j = {last}" for k in range(buckets)) + ")"
    w += f", best AS (SELECT min(k) AS k FROM totals WHERE cost = (SELECT min(cost) FROM totals)), end{buckets - 1} AS (SELECT k, {last} AS j FROM best)"
    for k in range(buckets - 1, 0, -1):
        w += f", end{k - 1} AS (SELECT e.k, CASE WHEN e.k >= {k} THEN l.prev ELSE e.j END AS j FROM end{k} e LEFT JOIN level{k} l ON l.j = e.j)"
    ends = " UNION ".join(f"SELECT j FROM end{k} WHERE j IS NOT NULL" for k in range(buckets))
    return f"""{w}, ends AS (
  SELECT top, row_number() OVER (ORDER BY top) - 1 AS bucket FROM hist WHERE j IN ({ends})
), placed AS (
  SELECT doc_id, n_tokens, bucket, top AS bucket_len FROM docs ASOF JOIN ends ON docs.n_tokens <= ends.top
), dealt AS (
  SELECT *, CAST('0x' || substr(md5(doc_id || '|' || n_tokens), 1, 8) AS BIGINT) % greatest(1, CAST(ceil(count(*) OVER (PARTITION BY bucket) / {shard_rows}) AS BIGINT)) AS shard FROM placed
), numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY bucket, shard ORDER BY n_tokens, doc_id) - 1) // greatest(1, {budget} // greatest(1, bucket_len)) AS batch FROM dealt
)
SELECT doc_id, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(bucket AS INTEGER) AS bucket, CAST(bucket_len AS BIGINT) AS bucket_len, CAST(shard AS INTEGER) AS shard, CAST(batch AS BIGINT) AS batch,
  bucket || '-' || shard || '-' || batch AS batch_id FROM numbered"""


def _mixing_sql(rounds: int = 300) -> str:
    """Plain raking to the tempered margins, ``rounds`` times; ids must not be null."""
    kind = "length(regexp_replace(text, '[^{0}]', '', 'g'))"
    goal = lambda m: f"(SELECT {m}, pow(sum(x), {mixing.TEMPER[m]}) / sum(pow(sum(x), {mixing.TEMPER[m]})) OVER () AS goal FROM cells GROUP BY {m})"  # noqa: E731
    step = "SELECT i + 1 AS i, source, lang, topic, x, w, g1, g2, g3 FROM rake WHERE i < " + str(rounds)
    for k, m in enumerate(mixing.MARGINS, 1):
        step = f"SELECT i, source, lang, topic, x, w * g{k} / sum(w) OVER (PARTITION BY {m}) AS w, g1, g2, g3 FROM ({step})"
    return rf"""WITH RECURSIVE docs AS (
  SELECT doc_id, source, lang, coalesce('=' || source, 'null') AS s, coalesce('=' || lang, 'null') AS l,
    CASE WHEN text IS NULL OR trim(text) = '' THEN 'none' WHEN 2 * {kind.format("A-Z")} > length(text) THEN 'upper' WHEN 20 * {kind.format("|")} > length(text) THEN 'table'
      WHEN 20 * {kind.format("#*$%&<>")} > length(text) THEN 'symbols' WHEN 10 * {kind.format("0-9")} > length(text) THEN 'numeric' ELSE 'prose' END AS topic,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-]+'), lambda w: w <> '')) AS n
  FROM documents
), cells AS (
  SELECT s AS source, l AS lang, topic, CAST(sum(n) AS DOUBLE) AS x FROM docs GROUP BY ALL HAVING sum(n) > 0
), rake AS (
  SELECT 0 AS i, c.source, c.lang, c.topic, x, x / sum(x) OVER () AS w, a.goal AS g1, b.goal AS g2, d.goal AS g3
  FROM cells c JOIN {goal("source")} a ON a.source = c.source JOIN {goal("lang")} b ON b.lang = c.lang JOIN {goal("topic")} d ON d.topic = c.topic
  UNION ALL {step}
), weights AS (
  SELECT source, lang, topic, x, w * (SELECT sum(x) FROM cells) / x AS weight FROM rake WHERE i = {rounds}
), scales AS (
  SELECT weight, ({mixing.FRACTION} * (SELECT sum(x) FROM cells) - coalesce(sum(x) OVER (ORDER BY weight DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(x * weight) OVER (ORDER BY weight DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale FROM weights
), best AS (
  SELECT max_by(scale, weight) AS scale FROM scales WHERE scale * weight <= 1 + 1e-12
), fitted AS (
  SELECT source, lang, topic, weight, least(1.0, (SELECT scale FROM best) * weight) AS probability FROM weights
)
SELECT doc_id, docs.source, docs.lang, docs.topic, round(coalesce(weight, 0.0), 6) AS weight, round(coalesce(probability, 0.0), 6) AS probability,
  CAST(CAST('0x' || substr(md5(doc_id || '|{mixing.SEED}'), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 < coalesce(probability, 0.0) AS selected
FROM docs LEFT JOIN fitted f ON f.source = docs.s AND f.lang = docs.l AND f.topic = docs.topic"""


ORACLE_SQL: dict[str, str] = {
    "op5_packing": _packing_sql(),
    "op10_mixing": _mixing_sql(),
    "op4_topk": """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM good q JOIN good c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
}
