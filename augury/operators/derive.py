"""Derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.functions import fixed_values as fixed


def add_parse_midpoint(df: DataFrame) -> DataFrame:
    """C1 as the parse step has it: a zero or missing high value leaves the low one."""
    both = F.col("val2").isNotNull() & (F.col("val2") != 0)
    return df.withColumn(
        "midpoint", F.when(both, (F.col("val1") + F.col("val2")) / 2).otherwise(F.col("val1"))
    )


def add_midpoint(df: DataFrame) -> DataFrame:
    """C1 as the panel has it."""
    differs = F.col("val2").isNotNull() & F.col("val1").isNotNull() & (F.col("val2") != F.col("val1"))
    return df.withColumn(
        "midpoint", F.when(differs, (F.col("val1") + F.col("val2")) / 2).otherwise(F.col("val1"))
    )


def add_range_width(df: DataFrame) -> DataFrame:
    """C2."""
    return df.withColumn(
        "range_width", F.when(F.col("is_range"), F.col("val2") - F.col("val1")).otherwise(0.0)
    )


def add_file_period(df: DataFrame, column: str = "date_filed") -> DataFrame:
    """NULL labels for a missing date."""
    year, quarter = F.year(column), F.quarter(column)
    return df.withColumns(
        {
            "file_year": year,
            "file_quarter": quarter,
            "file_yearq": F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string")),
        }
    )


def add_is_per_share(df: DataFrame) -> DataFrame:
    """C4: comparisons with a missing value are false."""

    def small(column: str):
        return F.coalesce(F.abs(column) < fixed.PER_SHARE_LIMIT, F.lit(False))

    named = F.coalesce(F.col("metric").isin(fixed.PER_SHARE_METRICS), F.lit(False))
    return df.withColumn("is_per_share", named | (small("val1") & small("val2")))


def nan_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers written by tools that mark a missing value with NaN."""
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in columns})
