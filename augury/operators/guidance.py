"""Guidance extraction: one-to-many, table to table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from augury.functions import fixed_values as fixed
from augury.functions import guidance as g
from augury.functions.records import RECORD_TYPE, record_batches
from augury.functions.sentences import LOCATED_DDL, locate_batches
from augury.functions.text import truncate_sentence as truncated
from augury.operators.derive import add_parse_midpoint, add_range_width
from augury.operators.filings import filter_min_length
from augury.session import importable


def locate(df: DataFrame, text: str, priced: bool = False) -> DataFrame:
    """Replaces the text by ``located``, its sentences with their places and bounded contexts."""
    others = [c for c in df.columns if c != text]
    importable(df.sparkSession)
    fields = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*fields, T.StructField("located", T.DataType.fromDDL(LOCATED_DDL))])
    return df.select(*others, text).mapInArrow(locate_batches(text, priced), schema)


def split_sentences(df: DataFrame, text: str = "text") -> DataFrame:
    """G1: one row per sentence with its place and a bounded context; the text stays behind."""
    others = [c for c in df.columns if c != text]
    return locate(df, text).select(*others, F.inline("located")).select(
        *others, "sent_ord", "sentence", "sent_start", "context_start", "context"
    )


def filter_guidance_sentences(df: DataFrame) -> DataFrame:
    """G2."""
    return df.filter(g.has_guidance_verb(F.col("sentence")))


def detect_metrics(df: DataFrame) -> DataFrame:
    """One row per sentence and metric found, with the offset of its first mention."""
    return df.select("*", F.inline(g.metric_mentions(F.col("sentence"))))


def extract_values(df: DataFrame) -> DataFrame:
    """The value near the mention; rows without one are dropped."""
    at = F.col("sent_start") + F.col("metric_offset")
    snippet = g.value_window(F.col("context"), F.col("context_start"), at)
    # Inlined, so that the filter reads a finished value and nothing is matched twice.
    found = F.filter(F.array(g.read_amounts(snippet)), lambda v: v["val1"].isNotNull())
    return df.select("*", F.inline(found))


def detect_period(df: DataFrame) -> DataFrame:
    """G5."""
    window = g.period_window(F.col("context"), F.col("context_start"), F.col("sent_start"))
    return df.withColumn("pdicity", g.detect_period(window))


def detect_fiscal_year(df: DataFrame) -> DataFrame:
    """G6."""
    window = g.period_window(F.col("context"), F.col("context_start"), F.col("sent_start"))
    return df.withColumn("fiscal_year", g.detect_fiscal_year(window))


def detect_action(df: DataFrame) -> DataFrame:
    """G7."""
    window = g.action_window(F.col("context"), F.col("context_start"), F.col("sent_start"))
    return df.withColumn("action", g.detect_action(window))


def truncate_sentence(df: DataFrame) -> DataFrame:
    """G8."""
    return df.withColumn("sentence", truncated(F.col("sentence"), fixed.SENTENCE_CHARS))


def dedup_in_document(df: DataFrame, document: str = "accession_number") -> DataFrame:
    """D1 on rows: first record per document and (metric, val1, val2).

    A task keeps one row per key before the shuffle, so copies do not pile up.
    :func:`extract_guidance` does the same inside each document, without a shuffle.
    """
    w = W.partitionBy(document, "metric", "val1", "val2").orderBy("sent_ord", "metric_ord")
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def _able(df: DataFrame, text: str) -> DataFrame:
    # A record needs an amount, so texts without a dollar sign are left out early.
    return filter_min_length(df, text).filter(F.contains(F.col(text), F.lit("$")))


def extract_guidance(df: DataFrame, text: str = "text") -> DataFrame:
    """Texts to guidance records, with the columns that came beside the text.

    One narrow stage: texts go to Python, records come back. Sentences are located in time that
    follows the text's length; those with a dollar sign near go on. Labels are read after the
    in-document dedup, for records only.
    """
    others = [c for c in df.columns if c != text]
    importable(df.sparkSession)
    fields = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*fields, *RECORD_TYPE.fields])
    rows = _able(df, text).select(*others, text).mapInArrow(record_batches(text), schema)
    labelled = add_range_width(add_parse_midpoint(rows))
    return labelled.select(
        *others, "metric", "val1", "val2", "is_range", "midpoint", "range_width", "pdicity",
        "fiscal_year", "action", "sentence", "sent_ord", "metric_ord",
    )
