"""Judge URLs by given host and path rules, and by association rules mined from labelled URLs.

FP-growth mines combinations of URL tokens that come with a label. A combination becomes a rule when its support and
its confidence for "block" reach their limits and no part of it does so with at least the same confidence. Rules are
looked up by inverted index, each under its rarest token, so a token that all URLs share is never a
join key unless it is a rule by itself.

A given rule always goes first; of several the one with the longest host, then path. A URL that no rule fits is
allowed. Null URLs and those without "://" have empty host and path, no tokens and are allowed. Repeated rows
are judged alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.sources.workspace import persisted

#: host and path of a rule, and its verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Share of labelled URLs that a combination occurs in, and share of those that are bad.
MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.6
#: Tokens of a combination.
MOST_TOKENS = 3

BAD = "=block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def url_tokens(url: Column) -> Column:
    """Distinct tokens: parts of the host, its last two parts, words of the path, names and values of the query."""
    host, path = host_and_path(url)
    parts = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    domain = F.array(F.concat(F.lit("d:"), F.substring_index(host, ".", -2)))
    words = F.transform(F.regexp_extract_all(path, F.lit(r"[A-Za-z][A-Za-z_-]*"), F.lit(0)), lambda x: F.concat(F.lit("p:"), F.lower(x)))
    query = F.transform(F.regexp_extract_all(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(r"[^&]+"), F.lit(0)), lambda x: F.concat(F.lit("q:"), x))
    return F.when(host != "", F.array_distinct(F.concat(parts, domain, words, query))).otherwise(F.array().cast("array<string>"))


def mine_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, most_tokens: int = MOST_TOKENS
) -> DataFrame:
    """Of (url, bad), rules: antecedent, confidence, support. A URL's tokens bound the number of rules by parameters alone."""
    baskets = labelled.select(F.when(F.col("bad"), F.array_append(url_tokens(F.col("url")), BAD)).otherwise(url_tokens(F.col("url"))).alias("items"))
    baskets = persisted(baskets.where(F.size("items") > 0), "url_baskets", shuffle=False)
    total = baskets.count()
    empty = "antecedent array<string>, confidence double, support double"
    if not total:
        return labelled.sparkSession.createDataFrame([], empty)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    sets = persisted(model.freqItemsets.where(F.size("items") <= most_tokens + 1), "url_itemsets", shuffle=False)
    with_bad = sets.where(F.array_contains("items", BAD) & (F.size("items") > 1))
    with_bad = with_bad.select(F.array_sort(F.array_remove("items", BAD)).alias("antecedent"), F.col("freq").alias("hits"))
    alone = sets.where(~F.array_contains("items", BAD)).select(F.array_sort("items").alias("antecedent"), "freq")
    rules = with_bad.join(alone, "antecedent").select("antecedent", (F.col("hits") / F.col("freq")).alias("confidence"), (F.col("hits") / total).alias("support"))
    rules = persisted(rules.where(F.col("confidence") >= min_confidence), "url_rules", shuffle=False)
    # A rule is idle if leaving out a token leaves a rule of the same confidence; most_tokens bounds the parts.
    parts = rules.where(F.size("antecedent") > 1).select(
        "antecedent", "confidence", F.explode("antecedent").alias("token")
    ).withColumn("part", F.array_remove("antecedent", F.col("token")))
    short = rules.select(F.col("antecedent").alias("part"), F.col("confidence").alias("of_part"))
    idle = parts.join(short, "part").where("of_part >= confidence").select("antecedent").distinct()
    return rules.join(idle, "antecedent", "left_anti")


def _matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct URLs that a mined rule fits, with its antecedent as text."""
    use = rules.select(F.explode("antecedent").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    posted = rules.withColumn("token", F.explode("antecedent")).join(use, "token")
    posted = posted.groupBy("antecedent", "confidence").agg(F.min(F.struct("n", "token")).alias("least")).select("antecedent", "confidence", "least.token")
    tokens = urls.where(F.col("url").isNotNull()).select("url", url_tokens(F.col("url")).alias("tokens"))
    hits = tokens.withColumn("token", F.explode("tokens")).join(posted, "token").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = F.max(F.struct("confidence", F.concat_ws("+", "antecedent").alias("mined"))).alias("best")
    return hits.groupBy("url").agg(best).select("url", F.col("best.mined").alias("mined"))


def judge_urls(pages: DataFrame, mined: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row of pages: id, host, path, rule, mined, verdict."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    judged = urls.select("id", "url", host.alias("host"), path.alias("path"))
    by_length = sorted(rules, key=lambda r: (-len(r[0]), -len(r[1]), r))
    fits = [((F.col("host") == h) | F.endswith(F.col("host"), F.lit(f".{h}"))) & F.startswith(F.col("path"), F.lit(p)) for h, p, _ in by_length]
    rule = F.coalesce(*(F.when(f, F.lit(h + p)) for f, (h, p, _) in zip(fits, by_length, strict=True)), F.lit(None).cast("string"))
    given = F.coalesce(*(F.when(f, F.lit(v)) for f, (_, _, v) in zip(fits, by_length, strict=True)), F.lit(None).cast("string"))
    # Mined rules fit few URLs, so only those are gathered.
    found = _matched(urls, mined).withColumnRenamed("url", "mined_url")
    judged = judged.withColumn("rule", rule).withColumn("given", given).join(found, F.col("url") == F.col("mined_url"), "left")
    verdict = F.coalesce("given", F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", "mined", verdict.alias("verdict"))
