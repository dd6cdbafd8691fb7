"""Dedup, order, limits and numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from augury.functions import fixed_values as fixed
from augury.session import freeze

DEDUP_KEY = ["cik_padded", "date_filed", "metric", "val1", "val2"]
# Input order, made explicit: filing, sentence, metric, ticker.
DEDUP_ORDER = ["accession_number", "sent_ord", "metric_ord", "ticker_ord"]


def dedup_panel(df: DataFrame, key: list[str] = DEDUP_KEY) -> DataFrame:
    """First record per key, missing keys equal.

    Rank 1 is kept per task before the shuffle (``WindowGroupLimit``), so a key that
    holds a third of all rows sends one row per task.
    """
    order = [F.col(c).asc_nulls_last() for c in DEDUP_ORDER if c in df.columns]
    w = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def dedup_ledger(*ledgers: DataFrame, column: str = "accession_number") -> DataFrame:
    """D3: every processed key once."""
    keys = ledgers[0].select(column)
    for other in ledgers[1:]:
        keys = keys.union(other.select(column))
    return keys.distinct()


def sort_index(df: DataFrame) -> DataFrame:
    """O1: by date, then CIK as text; missing last."""
    return df.orderBy(
        F.col("date_filed").asc_nulls_last(), F.col("cik").asc_nulls_last(),
        F.col("filename").asc_nulls_last(),
    )


def panel_order(df: DataFrame) -> list:
    """O2's order with tie-breakers, which also split a ticker that holds many rows."""
    names = [
        "ticker", "date_filed", "metric", "cik", "accession_number", "sent_ord", "val1", "val2",
    ]
    return [F.col(c).asc_nulls_last() for c in names if c in df.columns]


def sort_panel(df: DataFrame) -> DataFrame:
    """O2: for sinks that need a global order."""
    return df.orderBy(*panel_order(df))


def head_sample(df: DataFrame, rows: int = fixed.SAMPLE_ROWS) -> DataFrame:
    """O3: the first rows of O2, as a top-k: no global sort."""
    return df.orderBy(*panel_order(df)).limit(rows)


def limit_filings(df: DataFrame, rows: int) -> DataFrame:
    """The first filings of O1; 0 means all."""
    return sort_index(df).limit(rows) if rows > 0 else df


def number_rows(df: DataFrame, key: list[str], partitions: int | None = None) -> DataFrame:
    """``row_no`` from 0 in key order, without pulling all rows into one task.

    Range-partition on the key, freeze, number within each range and add the rows of
    the ranges in front. Only the per-range counts meet in one task, and only they are
    broadcast: there are as many as ``partitions``.
    """
    # The tie-breaker lets ranges split a key that holds many rows.
    tied = df.withColumn("_tie", F.xxhash64(*df.columns))
    order = [F.col(c).asc_nulls_last() for c in key] + [F.col("_tie")]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = freeze(
        tied.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id())
    )
    counts = ranged.groupBy("_range").count()
    ahead = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "_range", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("_ahead")
    )
    within = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    return (
        ranged.withColumn("_within", within)
        .join(F.broadcast(offsets), "_range")
        .withColumn("row_no", F.col("_ahead") + F.col("_within") - 1)
        .drop("_range", "_within", "_ahead", "_tie")
    )


def chunk_rows(df: DataFrame, key: list[str], size: int) -> DataFrame:
    """``chunk_no`` in fixed-size chunks of key order."""
    numbered = number_rows(df, key)
    return numbered.withColumn("chunk_no", F.floor(F.col("row_no") / size)).drop("row_no")
