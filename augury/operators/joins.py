"""Joins with dimensions, ledgers, listings and bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from augury.bitmaps import may_pass
from augury.functions import fixed_values as fixed
from augury.functions.keys import pad_cik, without_dashes
from augury.session import broadcast_if_small, is_small


def join_tickers(guidance: DataFrame, tickers: DataFrame, read: DataFrame | None = None) -> DataFrame:
    """Left join on the padded CIK; several tickers of a firm multiply its rows.

    ``read`` is the table that ``tickers`` was picked from: its size is looked at, so that
    the picking does not run for the look.
    """
    side = tickers.withColumnRenamed("cik", "cik_padded")
    small = is_small(tickers if read is None else read)
    return guidance.join(F.broadcast(side) if small else side, "cik_padded", "left")


def first_ticker(tickers: DataFrame) -> DataFrame:
    """Each firm's first ticker by position: what is left of J1 after D2."""
    w = W.partitionBy("cik").orderBy("ticker_ord", "ticker")
    return tickers.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


#: Bits of the map of a batch's keys: 8 MB; a batch of a million keys passes 2 % of a ledger.
BATCH_BITS = 1 << 26


def ledger_overlap(df: DataFrame, ledger: DataFrame, column: str, bits: int = BATCH_BITS) -> DataFrame:
    """The ledger's keys that may be among the rows' keys, each once.

    The map of the rows' keys has a fixed size; the more keys, the more of the ledger passes, at
    worst all of it.
    """
    return may_pass(ledger.select(column), df.select(column), column, bits=bits).distinct()


def exclude_processed(
    df: DataFrame, ledger: DataFrame, column: str = "accession_number", bits: int = BATCH_BITS, **bounds: int
) -> DataFrame:
    """Rows whose key is not in the ledger.

    A ledger proven small is sent to the rows. Of any other only those keys are shuffled that may
    be among the rows': what moves follows the rows and the overlap, not the ledger. The rows'
    keys are read once more for that.
    """
    keys = ledger.select(column)
    if is_small(keys, **bounds):
        return df.join(F.broadcast(keys), column, "left_anti")
    return df.join(ledger_overlap(df, ledger, column, bits), column, "left_anti")


def lookup_metric(df: DataFrame, column: str = "forecast_metric") -> DataFrame:
    """The model's metric names to the panel's; unknown ones pass through."""
    pairs = [F.lit(x) for pair in fixed.MODEL_METRICS.items() for x in pair]
    name = F.col(column)
    return df.withColumn(
        "metric", F.coalesce(F.try_element_at(F.create_map(*pairs), name), name)
    )


def lookup_ticker_literal(df: DataFrame, tickers: DataFrame) -> DataFrame:
    """One ticker per unpadded CIK, NULL without one."""
    return df.join(broadcast_if_small(tickers.select("cik", "ticker")), "cik", "left")


def enrich_company(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Company metadata on the padded CIK."""
    side = metadata.withColumn("cik_padded", pad_cik(F.col("cik"))).drop("cik")
    return df.join(broadcast_if_small(side), "cik_padded", "left")


def nearest_copy(wanted: DataFrame, staged: DataFrame, *keys: str) -> DataFrame:
    """Whose copy each filer takes: ``cik``, the keys and ``copy_cik``.

    Filers of one filing each have a folder. Who has none of their own takes the copy of the
    lowest CIK that has one, and exactly that. Only keys are read and moved.
    """
    theirs = staged.select(F.col("cik").alias("copy_cik"), *keys).distinct()
    by_number = F.struct(F.length("copy_cik"), F.col("copy_cik").alias("cik"))
    lowest = theirs.groupBy(*keys).agg(F.min(by_number)["cik"].alias("lowest_cik"))
    own = theirs.withColumn("cik", F.col("copy_cik"))
    return (
        wanted.select("cik", *keys).distinct()
        .join(lowest, list(keys))
        .join(own, ["cik", *keys], "left")
        .select("cik", *keys, F.coalesce("copy_cik", "lowest_cik").alias("copy_cik"))
    )


def attach_listing(filings: DataFrame, listings: DataFrame, staged: DataFrame | None = None) -> DataFrame:
    """The metadata half of J6: filings with their chosen exhibit and ``accession_key``, no text.

    ``staged`` has the keys of all listings, also of those without an exhibit: who has such a
    listing takes no one else's.
    """
    keyed = filings.withColumn("accession_key", without_dashes(F.col("accession_number")))
    taken = nearest_copy(keyed, listings if staged is None else staged, "accession_key")
    chosen = listings.drop("filing_url").withColumnRenamed("cik", "copy_cik")
    return (
        keyed.join(taken, ["cik", "accession_key"])
        .join(chosen, ["copy_cik", "accession_key"])
        .drop("copy_cik")
    )


def attach_exhibit(
    filings: DataFrame, listings: DataFrame, bodies: DataFrame,
    staged_listings: DataFrame | None = None, staged_bodies: DataFrame | None = None,
) -> DataFrame:
    """Filings with their chosen exhibit and its body, one row for each filing at most.

    ``filings`` carry ``cik`` and ``accession_number``, ``listings`` (E5) and ``bodies`` (S7)
    ``cik`` and ``accession_key``. Filers of one filing take their own copies, or else the
    lowest CIK's (:func:`nearest_copy`). Texts move once: AQE picks the join from measured
    sizes and splits skewed keys. To keep texts out of the shuffle, extract first and attach
    the small records instead: see :func:`augury.plans.guidance.guidance_from_bodies`.
    """
    chosen = attach_listing(filings, listings, staged_listings)
    named = chosen.withColumnRenamed("exhibit_filename", "filename")
    keys = ["accession_key", "filename"]
    taken = nearest_copy(named, bodies if staged_bodies is None else staged_bodies, *keys)
    text = bodies.withColumnRenamed("cik", "copy_cik")
    return (
        named.join(taken, ["cik", *keys])
        .join(text, ["copy_cik", *keys])
        .drop("accession_key", "copy_cik")
        .withColumnRenamed("filename", "exhibit_filename")
    )
