"""Projections and filters on filings."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from augury.functions import fixed_values as fixed
from augury.functions import keys


def _spellings(word: str) -> list[str]:
    """All mixtures of upper and lower case."""
    choices = [sorted({c.upper(), c.lower()}) for c in word]
    return ["".join(letters) for letters in product(*choices)]


def filter_form_type(df: DataFrame) -> DataFrame:
    """the two forms, in any case; the original spelling is kept.

    Listing the six spellings instead of upper-casing the column lets the filter reach
    a Parquet scan.
    """
    names = [s for form in fixed.FORM_TYPES for s in _spellings(form)]
    return df.filter(F.col("form_type").isin(names))


def extract_accession(df: DataFrame, accession_pattern: str = fixed.ACCESSION_PATTERN) -> DataFrame:
    """accession from the path, NULL without a match.

    ``ACCESSION_PATTERN_ANY`` also reads paths whose file is named after the accession.
    """
    return df.withColumn("accession_number", keys.accession_of(F.col("filename"), accession_pattern))


def add_padded_cik(df: DataFrame) -> DataFrame:
    """F3."""
    return df.withColumn("cik_padded", keys.pad_cik(F.col("cik")))


def coerce_dates(df: DataFrame, column: str = "date_filed") -> DataFrame:
    """F4."""
    return df.withColumn(column, keys.coerce_date(F.col(column)))


def require_accession(df: DataFrame) -> DataFrame:
    """F5."""
    return df.filter(F.col("accession_number").isNotNull() & (F.col("accession_number") != ""))


def add_filing_url(df: DataFrame) -> DataFrame:
    """F6."""
    return df.withColumn("filing_url", keys.filing_url(F.col("cik"), F.col("accession_number")))


def filter_min_length(df: DataFrame, column: str = "text") -> DataFrame:
    """NULL texts drop out with the short ones."""
    return df.filter(F.length(column) >= fixed.MIN_TEXT_CHARS)


def earnings_gate(
    df: DataFrame, column: str = "text", terms: list[str] = fixed.GATE_TERMS
) -> DataFrame:
    """F8: one of the terms stands in the upper-cased opening characters."""
    opening = F.upper(F.substring(column, 1, fixed.GATE_CHARS))
    return df.filter(opening.rlike("|".join(terms)))


def add_text_length(df: DataFrame, column: str = "text") -> DataFrame:
    """F9."""
    return df.withColumn("text_length", F.length(column))


def select_contract(
    df: DataFrame, schema: T.StructType, extra: list[str] | None = None
) -> DataFrame:
    """the contract's columns in order; columns the input lacks are left out."""
    names = [*schema.fieldNames(), *(extra or [])]
    return df.select([n for n in names if n in df.columns])


def slice_panel(
    panel: DataFrame,
    metric: str | None = None,
    pdicity: str | None = None,
    ranges_only: bool = False,
    actions: list[str] | None = None,
) -> DataFrame:
    """the usual slices; plain comparisons, so they reach a Parquet scan."""
    if metric is not None:
        panel = panel.filter(F.col("metric") == metric)
    if pdicity is not None:
        panel = panel.filter(F.col("pdicity") == pdicity)
    if ranges_only:
        panel = panel.filter(F.col("is_range"))
    if actions is not None:
        panel = panel.filter(F.col("action").isin(actions))
    return panel


def add_document_key(df: DataFrame, column: str = "url", params: dict | None = None) -> DataFrame:
    """F12."""
    return df.withColumn("document_key", keys.document_key(F.col(column), params))
