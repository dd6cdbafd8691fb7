"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from augury.llm.ngram_join import one_of_each_group
from augury.llm.packing import pack
from augury.llm.pii import mask_personal_data
from augury.llm.radix_dedup import drop_copies
from augury.llm.shared import rows_of, written
from augury.llm.toxicity import drop_toxic, fit_toxicity
from augury.session import importable


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model learns from the labels beside the documents."""
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drop_toxic(docs, fit_toxicity(rows_of(docs, "doc_id", "text"), labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    importable(spark)
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents, the one with the smallest id stays."""
    importable(spark)
    return one_of_each_group(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; ``n_chars`` follows the text."""
    importable(spark)
    masked = mask_personal_data(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of at most 2048 tokens."""
    importable(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("packing", packing),
]

#: No SQL: tokens, learned models and components are beyond it; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
