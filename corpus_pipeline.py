"""From raw documents to token ids: quality, repeated lines, near-duplicates, benchmark overlaps, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. All but the last return the
columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstats.llm import bpe, common, decontaminate, line_dedup, quality, simhash
from fleetstats.storage import materialize

SHINGLE, MAX_BITS = 3, 3


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the classifier's threshold; it learns from the labels."""
    common.text_session(spark, docs)
    model = quality.train(docs, common.documents(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model).select(docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their text less the lines of repeated windows, `n_chars` in step."""
    common.text_session(spark, docs)
    found = line_dedup.line_dedup(docs)
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.col("n_removed") > 0, changed).otherwise(F.col("n_chars")))
    return found.select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates by SimHash the document of the smallest id."""
    common.text_session(spark, docs)
    return simhash.drop_near_duplicates(docs, shingle=SHINGLE, max_bits=MAX_BITS).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with the benchmark."""
    common.text_session(spark, docs)
    return decontaminate.decontaminate(docs, common.documents(spark, sf_dir, "benchmark")).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text they decode to."""
    common.text_session(spark, docs)
    coded = bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), decoded="decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", good_documents),
    ("line_dedup", without_repeated_lines),
    ("simhash", one_of_each),
    ("decontamination", without_benchmark),
    ("bpe", token_ids),
]

# The classifier has no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
