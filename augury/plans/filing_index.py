"""Index files to the filing index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from augury import schemas
from augury.functions import fixed_values as fixed
from augury.operators.filings import (
    add_padded_cik, coerce_dates, extract_accession, filter_form_type, select_contract,
)
from augury.operators.panel import sort_index
from augury.sources.index import scan_index_range


def filing_index(lines: DataFrame, accession_pattern: str = fixed.ACCESSION_PATTERN) -> DataFrame:
    """Parsed index lines to the ``FILING_INDEX`` contract: one narrow stage."""
    filings = extract_accession(filter_form_type(lines), accession_pattern)
    return select_contract(add_padded_cik(coerce_dates(filings)), schemas.FILING_INDEX)


def build_filing_index(
    spark: SparkSession, base: str, start_year: int, end_year: int, ordered: bool = True
) -> DataFrame:
    """S1, S2, F1-F4, U1, O1. Leave ``ordered`` off when another job reads the result."""
    index = filing_index(scan_index_range(spark, base, start_year, end_year))
    return sort_index(index) if ordered else index
