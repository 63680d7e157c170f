"""From raw documents to token files: quality, near duplicates, benchmark items, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, the last one the rows of the token
files. The result of a stage is written as Parquet and read again as the input of the next.

Every stage takes null ids, texts, languages and sources, empty and very long texts, repeated rows and ids, empty tables and
further columns, which it drops. A null text counts as empty; it is judged by its own columns, resembles no other document,
holds no benchmark item, takes no words of the mix and so isn't in the token files.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import decontamination, mixing, ngram_join, quality_classifier, token_files
from tillstar.sources.workspace import persisted

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.score(docs, labels, COLUMNS).where("kept").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id; of rows that repeat id and text, one. Texts without words stay."""
    return ngram_join.one_per_group(docs, COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: a row per document of the mix."""
    location = token_files.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(spark, location)


STAGES = [
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", one_of_each),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_files", token_ids),
]

#: The classifier, the tokenizer and the groups of near copies have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = persisted(stage(spark, docs, sf_dir), name, shuffle=False)
    return STAGES[-1][1](spark, docs, sf_dir)
