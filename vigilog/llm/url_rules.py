"""URL verdicts: listed rules first, then association rules between URL tokens and bad labels.

Spark's FP-growth mines token combinations from the bad ones among the labelled URLs. Two things come before it, without which the
tokens of long paths make every subset a combination: tokens that stand in the same labelled URLs are one token, the first by
name, and a token takes part only if bad URLs are ``LIFT`` times as frequent with it as among all, so none that most URLs
have does. A rule "these tokens, then bad" is kept if it reaches the support and confidence over all labelled URLs, and dropped
if a rule with fewer of its tokens is as confident. Combinations and rules are held against URLs by an inverted index: each
is posted under its rarest token, and a URL with that token is held against the whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from vigilog.llm.shared import stored, work_folder

SUPPORT = 0.002
CONFIDENCE = 0.6
LEAST_URLS = 10  # bad URLs behind a rule
LIFT = 1.25  # of a token by itself
NUMBER = "#"


@dataclass(frozen=True)
class Listed:
    """A rule for a host with its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str


#: The listed rules.
LISTED = (
    Listed("allow", "org", "/"),
    Listed("block", "example.org", "/es/"),
    Listed("block", "example.org", "/en/1"),
    Listed("allow", "com", "/fr/"),
    Listed("block", "com", "/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def listed_rule(rules=LISTED) -> tuple[Column, Column]:
    """The rule that fits ``host`` and ``path``, the longest first, and its verdict; null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")) & F.col("path").startswith(r.path)
        name = F.when(fits, F.lit(r.host + r.path)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """The different tokens of a URL: scheme, labels of the host, path segments with digits as ``#``, ending, query keys."""
    tagged = lambda tag, values: F.transform(values, lambda x: F.concat(F.lit(tag), x))
    segments = F.transform(F.split(path, "/"), lambda x: F.regexp_replace(x, r"\d+", NUMBER))
    query = F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&")
    parts = F.concat(
        F.array(F.concat(F.lit("scheme="), F.substring_index(url, "://", 1))),
        tagged("host=", F.split(host, r"\.")),
        F.array(F.concat(F.lit("site="), host)),
        tagged("path=", F.filter(segments, lambda x: x != "")),
        tagged("query=", F.filter(F.transform(query, lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")),
    )
    return F.array_distinct(F.array_compact(parts))


def useful_tokens(held: DataFrame, n: int, n_bad: int, least: float) -> DataFrame:
    """The tokens that can be part of a rule, from rows of ``id``, ``token`` and ``bad``; of those in the same URLs the first by name."""
    mark = F.xxhash64("id").cast("decimal(38,0)")
    sets = held.groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"), F.sum(mark).alias("sum"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("xor"))
    useful = sets.where((F.col("n_bad") >= least) & (F.col("n_bad") * n >= F.lit(LIFT * n_bad) * F.col("n")))
    return useful.groupBy("n", "sum", "xor").agg(F.min("token").alias("token")).select("token")


def mined_rules(tokens: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """``tokens`` (sorted), ``confidence`` and ``support`` of the kept rules, from rows with ``tokens`` and ``bad``."""
    folder = work_folder(tokens.sparkSession, "url-mining")
    rows = stored(tokens.select(F.monotonically_increasing_id().alias("id"), "tokens", "bad"), folder, "rows")
    n, n_bad = rows.agg(F.count("*"), F.count_if("bad")).first()
    least = max(LEAST_URLS, support * n)
    held = rows.select("id", "bad", F.explode("tokens").alias("token"))
    held = stored(held.join(useful_tokens(held, n, n_bad, least), "token", "left_semi"), folder, "held")
    items = held.where("bad").groupBy("id").agg(F.collect_list("token").alias("items"))
    items = stored(items.select("items"), folder, "items")
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, least / max(1, items.count()))).fit(items).freqItemsets
    sets = stored(found.select(F.array_sort("items").alias("tokens"), F.col("freq").alias("n_bad")).where(F.col("n_bad") >= least), folder, "sets")
    good = held.where("not bad").groupBy("id").agg(F.collect_list("token").alias("tokens"))
    counted = holding(good, sets.withColumn("rule", F.concat_ws(" ", "tokens")), "id").groupBy("rule").agg(F.count("*").alias("n_good"))
    rules = sets.join(counted, F.concat_ws(" ", "tokens") == F.col("rule"), "left").fillna(0, ["n_good"])
    shares = rules.select("tokens", (F.col("n_bad") / (F.col("n_bad") + F.col("n_good"))).alias("confidence"), (F.col("n_bad") / n).alias("support"))
    return shares.where(F.col("confidence") >= confidence)


def holding(urls: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """``key`` and ``rule`` for every row of ``urls`` (``key`` and ``tokens``) that holds all ``tokens`` of a ``rule``."""
    wanted = rules.select("rule", F.col("tokens").alias("wanted"), F.explode("tokens").alias("token"))
    held = urls.select(key, "tokens", F.explode("tokens").alias("token"))
    counts = held.join(wanted.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    order = F.struct(F.coalesce("n", F.lit(0)), "token")
    rarest = wanted.join(counts, "token", "left").groupBy("rule").agg(F.min_by(F.struct("token", "wanted"), order).alias("x"))
    index = rarest.select("rule", "x.token", "x.wanted")
    return held.join(index, "token").where(F.size(F.array_except("wanted", "tokens")) == 0).select(key, "rule")


def pruned(rules: DataFrame) -> DataFrame:
    """The rules without those that a rule of fewer tokens, all among theirs, makes needless by its confidence.

    A rule meets the shorter ones that are posted under one of its tokens.
    """
    rules = rules.withColumn("rule", F.concat_ws(" ", "tokens"))
    posted = rules.select(F.col("tokens")[0].alias("token"), F.col("tokens").alias("fewer"), F.col("confidence").alias("as_good"))
    met = rules.select("rule", "tokens", "confidence", F.explode("tokens").alias("token")).join(posted, "token")
    needless = met.where((F.size("fewer") < F.size("tokens")) & (F.col("as_good") >= F.col("confidence")) & (F.size(F.array_except("fewer", "tokens")) == 0))
    return rules.join(needless.select("rule").distinct(), "rule", "left_anti")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url`` and ``matched`` (the most confident rule) of the URLs, rows of ``url`` and ``tokens``, that hold a whole rule."""
    hits = holding(urls, rules, "url").join(rules.select("rule", "confidence"), "rule")
    return hits.groupBy("url").agg(F.max_by("rule", F.struct("confidence", "rule")).alias("matched"))


def url_verdicts(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``matched`` for every row of ``pages`` (page_id, url).

    The number in the last path segment of a URL names the document that the page shows; its ``labels`` (doc_id, quality)
    mark the URL as bad (quality 0) or not. Where no listed rule fits, a URL that matches a mined rule is blocked, any other
    allowed. A null URL or one without ``://`` has no host, path or tokens and is allowed. Equal URLs get one verdict.
    Without labelled URLs nothing is mined. An empty table gives no rows; other columns are ignored.
    """
    folder = work_folder(pages.sparkSession, "url-rules")
    host, path = host_and_path(F.col("url"))
    urls = pages.select("url").where(F.instr("url", "://") > 0).distinct()
    urls = urls.select("url", host.alias("host"), path.alias("path"))
    number = F.regexp_extract("path", r"([0-9]{1,18})[^/]*/?$", 1)
    doc_id = F.expr("try_cast(nullif(n, '') as long)")
    tokens = url_tokens(F.col("url"), F.col("host"), F.col("path"))
    urls = stored(urls.withColumn("n", number).select("url", tokens.alias("tokens"), doc_id.alias("doc_id")), folder, "urls")
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    learnt = stored(urls.join(known, "doc_id").select("tokens", (F.col("quality") == 0).alias("bad")), folder, "learnt")
    rules = stored(pruned(mined_rules(learnt)), folder, "rules")
    hits = matched(urls, rules)
    name, verdict = listed_rule()
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path")).join(hits, "url", "left")
    method = F.when(F.col("matched").isNotNull(), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "matched")
