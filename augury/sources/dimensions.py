"""Ticker mapping and company metadata from staged JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from augury import schemas
from augury.functions.keys import pad_cik


def parse_tickers(documents: DataFrame, column: str = "value") -> DataFrame:
    """JSON objects of entries keyed by position to one row per entry."""
    entries = F.explode(F.map_entries(F.from_json(F.col(column), schemas.TICKER_FILE)))
    return documents.select(entries.alias("e")).select(
        pad_cik(F.col("e.value.cik_str")).alias("cik"),
        F.col("e.value.ticker").alias("ticker"),
        F.col("e.value.title").alias("company_name_sec"),
        F.col("e.key").cast("int").alias("ticker_ord"),
    )


def scan_tickers(spark: SparkSession, path: str) -> DataFrame:
    """The staged ticker files."""
    return parse_tickers(spark.read.text(path, wholetext=True))


def parse_company_metadata(
    documents: DataFrame, column: str = "value", keys: tuple[str, ...] = ("cik",)
) -> DataFrame:
    """Submissions JSON to flat text columns; absent ones are empty."""
    doc = F.from_json(F.col(column), schemas.SUBMISSIONS_JSON)
    empty = F.lit("")
    return documents.select(*keys, doc.alias("d")).select(
        *keys,
        F.coalesce("d.sic", empty).alias("sic"),
        F.coalesce("d.sicDescription", empty).alias("sic_description"),
        F.coalesce("d.stateOfIncorporation", empty).alias("state_of_incorporation"),
        F.coalesce("d.fiscalYearEnd", empty).alias("fiscal_year_end"),
        F.coalesce(F.get("d.exchanges", F.lit(0)), empty).alias("exchange"),
        F.coalesce("d.category", empty).alias("category"),
    )


def scan_company_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Staged ``CIK##########.json`` files; the CIK comes from the file name."""
    files = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_name"), r"CIK([0-9]+)\.json$", 1).alias("cik"),
        "value",
    )
    return parse_company_metadata(files)
