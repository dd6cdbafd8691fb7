"""Ticker mapping and company metadata from staged files."""

import json

from augury.operators.joins import enrich_company
from augury.sources.dimensions import scan_company_metadata, scan_tickers


def test_tickers(spark, tmp_path):
    entries = {
        "0": {"cik_str": 320193, "ticker": "AAPL", "title": "Apple Inc."},
        "10": {"cik_str": 5, "ticker": "B-A", "title": "Five"},
        "2": {"cik_str": 5, "ticker": "B", "title": None},
    }
    (tmp_path / "tickers.json").write_text(json.dumps(entries, indent=1))
    rows = scan_tickers(spark, str(tmp_path / "tickers.json")).orderBy("ticker_ord").collect()
    assert [tuple(r) for r in rows] == [
        ("0000320193", "AAPL", "Apple Inc.", 0), ("0000000005", "B", None, 2), ("0000000005", "B-A", "Five", 10),
    ]


def test_metadata(spark, tmp_path):
    full = {"sic": "3571", "sicDescription": "Computers", "stateOfIncorporation": "CA", "fiscalYearEnd": "0930",
            "exchanges": ["Nasdaq", "NYSE"], "category": "Large", "other": {"x": 1}}
    for cik, doc in (("0000000001", full), ("0000000002", {"exchanges": []}), ("0000000003", {"exchanges": None, "sic": None})):
        (tmp_path / f"CIK{cik}.json").write_text(json.dumps(doc))
    found = scan_company_metadata(spark, str(tmp_path))
    rows = {r["cik"]: tuple(r)[1:] for r in found.collect()}
    assert rows["0000000001"] == ("3571", "Computers", "CA", "0930", "Nasdaq", "Large")
    assert rows["0000000002"] == rows["0000000003"] == ("",) * 6
    firms = spark.createDataFrame([("0000000001",), ("0000000009",)], "cik_padded string")
    joined = {r["cik_padded"]: r["exchange"] for r in enrich_company(firms, found).collect()}
    assert joined == {"0000000001": "Nasdaq", "0000000009": None}
