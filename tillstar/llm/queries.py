"""Named queries of the operators over the documents and pages tables, and the same results in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from pyspark.sql import functions as F

from tillstar.llm import byte_bpe, mixing, quality_classifier, source_divergence
from tillstar.llm.decontamination import judge_contamination
from tillstar.llm.html_extract import extract_text
from tillstar.llm.ngram_join import similar_documents
from tillstar.llm.periodic_runs import periodic_runs
from tillstar.llm.quality_rules import judge_quality
from tillstar.llm.substring_dedup import removed_words
from tillstar.llm.token_counts import count_tokens
from tillstar.llm.token_files import read_token_files, write_token_files
from tillstar.llm.url_rules import judge_urls, mine_rules


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_token_files(spark, location)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(_table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_words(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(_table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ("doc_id",))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages show documents whose id ends their path, so documents' labels are the pages' labels."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    shown = F.regexp_extract("url", r"/(\d+)(?:\.html|/)?(?:[?#].*)?$", 1).try_cast("long")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.coalesce(bad, F.lit(False)).alias("bad"))
    labelled = pages.withColumn("shown", shown).join(labels, F.col("shown") == F.col("doc_id")).select("url", "bad")
    return judge_urls(pages, mine_rules(labelled))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text that they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = byte_bpe.encode(_table(spark, sf_dir, "documents"), path)
    both = byte_bpe.decode(coded, path, carry=("doc_id", "ids"))
    return both.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def planted_runs(docs: DataFrame) -> DataFrame:
    """Documents, of which those with a checksum that ends in 0 repeat some of their words from some word on to the end."""
    code = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = docs.withColumn("code", code).withColumn("words", F.when(F.col("code") % 10 == 0, words))
    marked = chosen.withColumn("g", F.expr("code div 10")).withColumn("n", F.size("words"))
    marked = marked.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    marked = marked.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("transform(words, (word, i) -> if(i < a, word, words[int(a + (i - a) % p)]))")
    return marked.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least 6 words and 4 periods: their number, the longest one and digests."""
    found = periodic_runs(planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text")), min_length=6, min_exponent=4)
    # Longest first; then the smallest start, then the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    digests = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines"), "collapsed")
    return digests.select(
        "doc_id",
        "n_runs",
        (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.short")).alias("period"),
        F.expr("1000 * best.length div (-best.short)").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergence(_table(spark, sf_dir, "documents"), min_docs=10, top=10)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_html_extraction,
        op2_token_counts,
        op3_token_files,
        op4_ngram_jaccard_join,
        op5_substring_dedup,
        op6_decontamination,
        op7_mixing,
        op8_quality_rules,
        op9_quality_classifier,
        op10_url_filters,
        op11_byte_bpe,
        op12_periodic_runs,
        op13_source_divergence,
    )
    return {f.__name__: f for f in every}


def statements() -> dict[str, str]:
    return {"op7_mixing": mixing.SQL, "op13_source_divergence": source_divergence.SQL}
