"""URL filter: rules, and for the rest two character models whose log-likelihood ratio decides.  Native.

The models learn from URLs that a rule accepts or rejects, and from labels if the caller has any.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket, discard, stored

#: (verdict, rule): host suffix and path prefix.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Characters of a URL that the models tell apart: a-z, one digit, . - / _ and one for all else (32 codes).
LETTERS = "abcdefghijklmnopqrstuvwxyz0.-/_"
CODES = 32
#: Longest context, so that a model has at most CODES ** (MAX_CONTEXT + 1) entries whatever the input.
MAX_CONTEXT = 3
#: Weight of the shorter context when a longer one is smoothed by it.
BACK_OFF = 2.0
#: One URL in this many (by a hash) is kept out of the counts and calibrates the threshold.
CALIBRATE = 5


def host_path(url: Column) -> tuple[Column, Column]:
    """Host after the first '://' up to / ? # or end, A-Z lower-cased; path up to ? # or end; '' without '://'."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{rest}")
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def without_domain(host: Column, rules=RULES) -> Column:
    """A host without as many last labels as the longest rule's host has."""
    most = max((len(rule.partition("/")[0].split(".")) for _, rule in rules), default=0)
    return F.regexp_replace(host, rf"(?:(?:^|\.)[^.]*){{1,{most}}}$", "") if most else host


def _codes(text: Column) -> Column:
    """Array of character codes 0..31 with MAX_CONTEXT start codes before them and an end code behind."""
    folded = F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]", "0"), r"[^a-z0.\-/_]", "~")
    padded = F.concat(F.lit("~" * MAX_CONTEXT), folded, F.lit("~"))
    return F.transform(F.split(padded, ""), lambda c: F.when(c == "~", CODES - 1).otherwise(F.instr(F.lit(LETTERS), c) - 1))


def _characters(df: DataFrame, text_col: str, keep: str) -> DataFrame:
    """(keep, ctx, sym): for each character the code of its MAX_CONTEXT predecessors, and its own."""
    codes = df.select(F.col(keep).alias("keep"), _codes(F.col(text_col)).alias("codes"))
    return codes.select("keep", F.explode(_positions(F.col("codes"))).alias("x")).select(F.col("keep").alias(keep), "x.ctx", "x.sym")


def _positions(codes: Column) -> Column:
    """The structs of :func:`_characters`; ``codes`` must be a column, as each element looks into it."""
    n = MAX_CONTEXT
    index = F.sequence(F.lit(n + 1), F.size(codes))

    def at(i: Column) -> Column:
        ctx = F.lit(0)
        for k in range(n, 0, -1):
            ctx = ctx * CODES + F.get(codes, i - k - 1)
        return F.struct(ctx.cast("int").alias("ctx"), F.get(codes, i - 1).cast("int").alias("sym"))

    return F.filter(F.transform(index, at), lambda x: x.sym.isNotNull())


def model(training: DataFrame, text_col: str = "url_text", label_col: str = "accepted") -> DataFrame:
    """(ctx, ratios): log P(sym | ctx, accepted) - log P(sym | ctx, rejected), an array over the 32 symbols, for every context.

    Variable order: the counts of a context are smoothed by the next shorter one down to the uniform distribution,
    P = (n + B * P_shorter) / (N + B).  A context without counts thus has the probabilities of its longest suffix
    that has some.  Counts are per class over all training URLs; there are 32 ** 3 contexts of the longest order.
    """
    spark = training.sparkSession
    chars = _characters(training, text_col, label_col).withColumnRenamed(label_col, "accepted")
    counts = stored(chars.groupBy("ctx", "sym").agg(F.sum(F.col("accepted").cast("long")).alias("yes"), F.sum((~F.col("accepted")).cast("long")).alias("no")), "grams")

    def table(order: int) -> DataFrame:
        """Counts by symbol of each context of ``order`` characters, as arrays; 0 for contexts that were not seen."""
        cut = counts.select((F.col("ctx") % CODES**order).alias("ctx"), "sym", "yes", "no").groupBy("ctx", "sym").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        grouped = cut.groupBy("ctx").agg(F.map_from_entries(F.collect_list(F.struct("sym", F.struct("yes", "no")))).alias("m"))
        pick = lambda f: F.transform(F.sequence(F.lit(0), F.lit(CODES - 1)), lambda s: F.coalesce(F.col("m")[s][f], F.lit(0).cast("long")))
        every = spark.range(CODES**order).select(F.col("id").cast("int").alias("ctx"))
        return every.join(grouped, "ctx", "left").select("ctx", pick("yes").alias("yes"), pick("no").alias("no"))

    def smooth(n: Column, shorter: Column) -> Column:
        total = F.aggregate(n, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(n, shorter, lambda x, p: (x + BACK_OFF * p) / (total + BACK_OFF))

    uniform = F.transform(F.sequence(F.lit(0), F.lit(CODES - 1)), lambda _: F.lit(1.0 / CODES))
    level = table(0).select("ctx", smooth(F.col("yes"), uniform).alias("p_yes"), smooth(F.col("no"), uniform).alias("p_no"))
    for order in range(1, MAX_CONTEXT + 1):
        longer = table(order).withColumn("short", (F.col("ctx") % CODES ** (order - 1)).cast("int"))
        level = longer.join(level.withColumnRenamed("ctx", "short"), "short").select(
            "ctx", smooth(F.col("yes"), F.col("p_yes")).alias("p_yes"), smooth(F.col("no"), F.col("p_no")).alias("p_no")
        )
    return level.select("ctx", F.zip_with("p_yes", "p_no", lambda a, b: F.log(a) - F.log(b)).alias("ratios"))


def ratio(urls: DataFrame, grams: DataFrame, text_col: str, key: str) -> DataFrame:
    """(key, llr): mean log-likelihood ratio per character of each key's text, its end included.

    The model has 32 ** 3 rows of 32 doubles (8.4 MB) by construction, so it is broadcast.  Characters
    are summed before the shuffle: one partial row per URL.
    """
    met = _characters(urls, text_col, key).join(F.broadcast(grams), "ctx")
    return met.groupBy(key).agg(F.avg(F.get("ratios", F.col("sym"))).alias("llr"))


def threshold(scored: DataFrame, step: float = 0.01, cost: float = 2.0) -> float:
    """The ratio below which URLs are rejected: least share of rejected URLs passed plus ``cost`` times that of
    accepted URLs blocked, over (llr, accepted) rows.  A histogram of at most 2001 steps is all that is gathered."""
    cell = F.round(F.greatest(F.lit(-10.0), F.least(F.lit(10.0), F.col("llr"))) / step).cast("int")
    hist = sorted((r.cell, r.yes, r.no) for r in scored.groupBy(cell.alias("cell")).agg(F.sum(F.col("accepted").cast("long")).alias("yes"), F.sum((~F.col("accepted")).cast("long")).alias("no")).collect())
    yes, no = sum(r[1] for r in hist), sum(r[2] for r in hist)
    if not yes or not no:
        return -math.inf if not no else 0.0
    best, at, blocked, passed = math.inf, 0.0, 0, no
    for cell_, y, n in [(-1000, 0, 0), *hist]:
        blocked, passed = blocked + y, passed - n
        loss = cost * blocked / yes + passed / no
        if loss < best:
            best, at = loss, (cell_ + 0.5) * step
    return at


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, labels: DataFrame | None = None) -> DataFrame:
    """(id, host, path, rule, verdict, llr) for every row.

    Training: URLs that a rule allows are accepted and URLs that a rule blocks are rejected; ``labels`` (url,
    accepted) adds URLs of known worth.  The models see hosts without their last labels, as many as rules
    speak about: by these the rules decide already, and all other URLs would pass or go by them alone.  A fifth of the distinct URLs, by a hash of the URL, is kept out of the
    counts and sets the threshold, so no URL is on both sides.  Without accepted or without rejected URLs nothing
    is blocked but by rules.  Null urls and urls without '://' have empty host and path, no rule, no ``llr``, and are
    allowed (there is nothing to object to).  Repeated rows each get their row, rows without id too; an empty table
    gives none.  Columns other than the two named are not read.
    """
    def parsed(df: DataFrame, url: str, *keep: Column) -> DataFrame:
        host, path = host_path(F.col(url))
        return df.select(*keep, host.alias("host"), path.alias("path")).withColumn("text", F.concat(without_domain(F.col("host"), rules), "path"))

    rows = parsed(pages, url_col, F.col(id_col).cast("long").alias("id")).withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    known = rows.where("found is not null and text <> ''").select("text", (F.col("found.verdict") == "allow").alias("accepted"))
    if labels is not None:
        known = known.union(parsed(labels, "url", F.col("accepted")).where("accepted is not null and text <> ''").select("text", "accepted"))
    kept_out = bucket(F.xxhash64("text"), CALIBRATE) == 0
    grams = stored(model(known.where(~kept_out), "text"), "urls")
    texts = rows.where("text <> ''").select("text").union(known.where(kept_out).select("text")).distinct()
    scored = stored(ratio(texts, grams, "text", "text"), "ratios")
    discard(grams)
    limit = threshold(known.where(kept_out).join(scored, "text"))
    judged = F.coalesce("found.verdict", F.when(F.col("llr") < limit, "block").otherwise("allow"))
    return rows.join(scored, "text", "left").select(F.col("id").alias(id_col), "host", "path", F.col("found.rule").alias("rule"), judged.alias("verdict"), "llr")
