"""Aggregates and run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.functions import fixed_values as fixed
from augury.operators.panel import DEDUP_KEY
from augury.session import broadcast_if_small


def summarise_panel(panel: DataFrame) -> DataFrame:
    """A1: per filing year and metric; rows with a missing key are left out."""
    return (
        panel.filter(F.col("file_year").isNotNull() & F.col("metric").isNotNull())
        .groupBy("file_year", "metric")
        .agg(
            F.count("*").alias("n_guidance"),
            F.countDistinct("cik").alias("n_firms"),
            F.avg(F.col("is_range").cast("int")).alias("pct_range"),
            F.avg("midpoint").alias("avg_midpoint"),
        )
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """A2: rows per value, most frequent first; missing values are left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), column)
    )


def all_value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """A2 of several columns (``column_name``, ``value``, ``n``) in one pass."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column_name", "value")
    return long.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count("*").alias("n"))


def table_profile(df: DataFrame) -> DataFrame:
    """A3: one row of counts and dates; ticker only where there is one."""
    distinct = [F.countDistinct("cik").alias("n_ciks")]
    if "ticker" in df.columns:
        distinct.append(F.countDistinct("ticker").alias("n_tickers"))
    return df.agg(
        F.count("*").alias("n_rows"),
        *distinct,
        F.min("date_filed").alias("first_date"),
        F.max("date_filed").alias("last_date"),
    )


def ticker_match_rate(joined: DataFrame) -> DataFrame:
    """A4: over the rows of J1; NULL for no rows."""
    matched, total = F.count("ticker"), F.count("*")
    return joined.agg(
        matched.alias("n_matched"),
        total.alias("n_total"),
        (100.0 * matched / F.nullif(total, F.lit(0))).alias("pct_matched"),
    )


def extraction_funnel(documents: DataFrame, guidance: DataFrame) -> DataFrame:
    """A5: documents, documents with a record, records.

    The two tables are only counted: no join, and no text is read.
    """
    seen = documents.agg(F.count("*").alias("documents"))
    found = guidance.agg(
        F.countDistinct("accession_number").alias("with_guidance"), F.count("*").alias("records")
    )
    both = seen.unionByName(found, allowMissingColumns=True)
    return both.agg(
        F.sum("documents").alias("n_documents"),
        F.sum("with_guidance").alias("n_with_guidance"),
        F.sum("records").alias("n_records"),
    )


def dedup_report(df: DataFrame, key: list[str] = DEDUP_KEY) -> DataFrame:
    """Rows before and after D2, and the difference; counted per key, nothing is sorted."""
    groups = df.groupBy(*key).agg(F.count("*").alias("copies"))
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_before"),
        F.count("*").alias("n_after"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n_removed"),
    )


def filings_per_quarter(index: DataFrame) -> DataFrame:
    """A7."""
    return index.groupBy("year", "quarter").agg(F.count("*").alias("n_filings"))


def price_table(df: DataFrame) -> DataFrame:
    """The fixed prices as a table beside ``df``'s session."""
    rows = [(m, i, o) for m, (i, o) in fixed.MODEL_PRICES.items()]
    schema = "model string, price_in double, price_out double"
    return df.sparkSession.createDataFrame(rows, schema)


def add_cost(usage: DataFrame) -> DataFrame:
    """``cost`` in USD from input and output tokens; an unknown model has the default price."""
    default_in, default_out = fixed.MODEL_PRICES[fixed.DEFAULT_MODEL]
    return usage.join(broadcast_if_small(price_table(usage)), "model", "left").withColumn(
        "cost",
        F.col("tokens_in") / 1e6 * F.coalesce("price_in", F.lit(default_in))
        + F.col("tokens_out") / 1e6 * F.coalesce("price_out", F.lit(default_out)),
    ).drop("price_in", "price_out")


def usage_cost(usage: DataFrame) -> DataFrame:
    """Tokens and cost per model. Tokens are summed before they are priced."""
    totals = usage.groupBy("model").agg(
        F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out")
    )
    return add_cost(totals)


def flag_total(df: DataFrame, column: str = "is_adjusted") -> DataFrame:
    """A9."""
    return df.agg(F.count_if(column).alias("n_flagged"), F.count("*").alias("n_rows"))
