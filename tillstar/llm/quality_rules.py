"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Each rule says good, bad or nothing about a document. A two-class model in which rules are independent given
the class is fitted by expectation-maximisation on the number of documents per vote pattern: it yields, for each
class, how often a rule votes either way or abstains. The share of good documents is given, as unlabelled
votes don't tell which of two classes is the good one. A document is kept
when the posterior probability of "good" reaches the limit and it passes the base rules.

Null and empty texts have no words; all counts are 0 and the base rules fail. Rows with null or repeated ids are
judged like any other; extra columns are ignored. An empty table has no patterns and gives no rows.
All work is in SQL functions, and a document's words never leave its row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.sources.workspace import persisted

WHITE = r"[\x20\x09-\x0D]+"
SOLID = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
UPPER = "[A-Z]"
WHITE_CHARS = " \t\n\x0b\x0c\r"

MIN_GOOD = 0.5
#: Share of good documents.
BALANCE = 0.9
#: Least log odds of a vote for "bad".
LEAST_SAY = math.log(2)
#: Most log odds of a vote for "good": the signs of good text are common in junk as well.
MOST_PRAISE = math.log(1.5)
ROUNDS = 25
#: Smoothing counts, so that no vote is ever impossible.
PRIOR = 1.0
#: Assumed share of right votes for "bad"; in the estimate it weighs as much as all votes of the rule.
RIGHT = 0.9


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each text by row. Windows are compared by two hashes of 96 bits together, whatever the length of the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.btrim(text, F.lit(WHITE_CHARS)).alias("inner"))
    rows = base.select(
        "id",
        "text",
        F.when(F.col("inner") == "", F.array().cast("array<string>")).otherwise(F.split("inner", WHITE)).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(SOLID)).alias("lines"),
    )
    n = F.size("words")
    word = lambda i: F.get("words", i)
    triples = F.when(n < 3, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))
    )
    rows = rows.withColumn("triples", triples)
    # Sorting brings equal windows together; most texts repeat no window and need none of it.
    named = F.transform(
        "triples", lambda h, i: F.struct(h.alias("h"), F.hash(word(i), word(i + 1), word(i + 2)).alias("g"), i.cast("long").alias("place"))
    )
    clear = F.size(F.array_distinct("triples")) == F.size("triples")
    rows = rows.withColumn("sorted", F.when(~clear, F.sort_array(named)))
    same = lambda x, y: F.coalesce((x["h"] == y["h"]) & (x["g"] == y["g"]), F.lit(False))
    twice = F.filter("sorted", lambda x, i: same(x, F.get("sorted", i + 1)) | same(x, F.get("sorted", i - 1)))
    rows = rows.withColumn("twice", F.coalesce(F.transform(twice, lambda x: x["place"]), F.array().cast("array<long>")))
    rows = rows.withColumn("places", F.sort_array("twice"))
    covered = F.aggregate(F.transform("places", lambda p, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("places", i + 1) - p, F.lit(3).cast("long")))), F.lit(0).cast("long"), lambda a, x: a + x)
    found = lambda pattern: F.regexp_count("text", F.lit(pattern)).cast("long")
    count = lambda char: (F.length("text") - F.length(F.replace("text", F.lit(char), F.lit("")))).cast("long")
    return rows.select(
        "id",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        found(SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        found(UPPER).alias("n_upper"),
        count("!").alias("n_shouts"),
        count(".").alias("n_stops"),
    )


def votes() -> dict[str, Column]:
    """1 for good, -1 for bad, 0 to abstain. Most rules know one kind of junk and say nothing about its absence."""
    c = F.col
    bad = lambda x: F.when(x, -1).otherwise(0).cast("int")
    good = lambda x: F.when(x, 1).otherwise(0).cast("int")
    words, chars = c("n_words"), c("word_chars")
    return {
        "symbols": bad(c("n_symbols") * 20 > chars),
        "marked_words": bad(c("n_symbols") * 4 > words),
        "repeats": bad(c("n_repeat_words") * 10 > words * 3),
        "lines": bad((c("n_dup_lines") >= 3) & (c("n_dup_lines") * 10 > c("n_lines") * 3)),
        "case": bad(c("n_upper") * 10 > chars * 4),
        "shouts": bad(c("n_shouts") * 5 > words),
        "word_length": bad((chars > words * 15) | (chars < words * 2)),
        "prose": good((c("n_upper") > 0) & (c("n_upper") * 10 <= chars) & (c("n_stops") * 60 >= words) & (c("n_stops") * 3 <= words)),
        "length": good(words >= 100),
    }


def _posterior(names: list[str], good: float, shares: dict) -> Column:
    """Probability of "good" given the votes.

    A rule is taken to be better than chance, and one that abstains says nothing; else the two classes may settle
    on another divide than good and bad, such as long and short. The weights are one array, so rounds share
    their compiled code.
    """
    side = {-1: lambda x: min(x, -LEAST_SAY), 0: lambda x: 0.0, 1: lambda x: min(max(x, 0.0), MOST_PRAISE)}
    weights = F.lit([side[v](math.log(shares[j, 1, v]) - math.log(shares[j, 0, v])) for j in range(len(names)) for v in (-1, 0, 1)])
    odds = F.get(F.lit([math.log(good) - math.log(1 - good)]), F.lit(0))
    for j, name in enumerate(names):
        odds = odds + F.get(weights, F.col(name) + (3 * j + 1))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fit(patterns: DataFrame, names: list[str], good: float = BALANCE, rounds: int = ROUNDS) -> dict:
    """Per rule, class and vote, its probability. patterns: a row per vote pattern, with n.

    There are at most 3 ** rules patterns however many documents there are; each round is one aggregate over them.
    """
    every = F.array(*names)
    weight = F.when(F.exists(every, lambda v: v == -1), 0.1).otherwise(0.9)
    shares, found = {}, 0.0
    for _ in range(rounds):
        cells = patterns.select((weight * F.col("n")).alias("w"), "n", F.posexplode(every).alias("rule", "vote"))
        sums = {(r["rule"], r["vote"]): (r["w"], r["n"] - r["w"]) for r in cells.groupBy("rule", "vote").agg(F.sum("w").alias("w"), F.sum("n").alias("n")).collect()}
        sums = {k: ((w[0] + (1 - RIGHT) * sum(w)) / 2, (w[1] + RIGHT * sum(w)) / 2) if k[1] == -1 else w for k, w in sums.items()}
        total = [max(1.0, *(sum(w[y] for (k, _), w in sums.items() if k == j) for j in range(len(names)))) for y in (0, 1)]
        before, found = found, total[0]
        shares = {
            (j, y, v): (sums.get((j, v), (0, 0))[1 - y] + PRIOR) / (total[1 - y] + 3 * PRIOR) for j in range(len(names)) for y in (0, 1) for v in (-1, 0, 1)
        }
        weight = _posterior(names, good, shares)
        if abs(found - before) <= 1e-6 * sum(total):
            break
    return shares


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_good: float = MIN_GOOD) -> DataFrame:
    """Per row of docs: the counts, base_failed, p_good and kept."""
    rules = votes()
    rows = persisted(features(docs, id_col, text_col), "quality_features", shuffle=False)
    voted = rows.select("*", *(v.alias(f"vote_{k}") for k, v in rules.items()))
    names = [f"vote_{k}" for k in rules]
    patterns = persisted(voted.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "vote_patterns", shuffle=False)
    shares = fit(patterns, names)
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    judged = voted.withColumn("base_failed", failed).withColumn("p_good", _posterior(names, BALANCE, shares))
    kept = ~F.col("base_failed") & (F.col("p_good") >= min_good)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(F.col("id").alias(id_col), *counts, "base_failed", "p_good", kept.alias("kept"))
