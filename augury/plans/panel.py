"""Guidance records to the panel."""

from __future__ import annotations

from pyspark.sql import DataFrame

from augury import schemas
from augury.operators.derive import add_file_period, add_is_per_share, add_midpoint
from augury.operators.filings import add_padded_cik, coerce_dates, select_contract
from augury.operators.joins import first_ticker, join_tickers
from augury.operators.panel import dedup_panel, sort_panel


def build_panel(
    guidance: DataFrame,
    tickers: DataFrame,
    keep_enriched: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """F3, F4, D2, J1, C1, C3, C4, F10, O2.

    D2 would keep a firm's first ticker only, so each firm enters the join with just
    that one: rows do not multiply first to be deduped later. One shuffle, for D2.
    """
    keyed = coerce_dates(add_padded_cik(guidance))
    unique = join_tickers(dedup_panel(keyed), first_ticker(tickers).drop("ticker_ord"), tickers)
    derived = add_is_per_share(add_midpoint(add_file_period(unique)))
    if ordered:
        derived = sort_panel(derived)
    extra = schemas.ENRICHED_COLUMNS if keep_enriched else []
    return select_contract(
        derived.drop("cik").withColumnRenamed("cik_padded", "cik"), schemas.PANEL, extra
    )
