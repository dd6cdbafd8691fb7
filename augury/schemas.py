"""Declared schemas: the contract between the steps. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """Flat ``name type, ...``; unlike ``fromDDL`` it needs no session at import."""
    fields = [pair.split() for pair in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


INDEX_LINE_COLUMNS = ["cik", "company_name", "form_type", "date_filed", "filename"]

FILING_INDEX = _struct(
    "cik string, company_name string, form_type string, date_filed timestamp, filename string, "
    "accession_number string, year int, quarter int, cik_padded string"
)

EXHIBITS = _struct(
    "cik string, company_name string, accession_number string, date_filed string, "
    "form_type string, exhibit_url string, exhibit_filename string, exhibit_description string, "
    "items string, text string, text_length int"
)

FILING_KEYS = [
    "cik", "company_name", "accession_number", "date_filed", "form_type", "exhibit_url",
]

GUIDANCE = _struct(
    "cik string, company_name string, accession_number string, date_filed string, "
    "form_type string, exhibit_url string, metric string, val1 double, val2 double, "
    "is_range boolean, midpoint double, range_width double, pdicity string, fiscal_year int, "
    "action string, sentence string, sent_ord int, metric_ord int"
)

ENRICHED_COLUMNS = [
    "forecast_metric", "estimate_type", "value_low", "value_high", "value_point", "unit",
    "direction", "confidence_language", "is_adjusted",
]

PANEL_COLUMNS = [
    "cik", "ticker", "company_name", "company_name_sec", "accession_number", "date_filed",
    "file_year", "file_quarter", "file_yearq", "form_type", "metric", "pdicity", "fiscal_year",
    "val1", "val2", "midpoint", "range_width", "is_range", "action", "is_per_share", "sentence",
    "exhibit_url",
]

PANEL = _struct(
    "cik string, ticker string, company_name string, company_name_sec string, "
    "accession_number string, date_filed timestamp, file_year int, file_quarter int, "
    "file_yearq string, form_type string, metric string, pdicity string, fiscal_year int, "
    "val1 double, val2 double, midpoint double, range_width double, is_range boolean, "
    "action string, is_per_share boolean, sentence string, exhibit_url string"
)

TICKER_FILE = T.MapType(
    T.StringType(), _struct("cik_str bigint, ticker string, title string")
)
TICKERS = _struct("cik string, ticker string, company_name_sec string, ticker_ord int")

_LISTED = T.StructType(
    [T.StructField("item", T.ArrayType(_struct("name string, type string")))]
)
LISTING_JSON = T.StructType(
    [T.StructField("directory", _LISTED), T.StructField("_corrupt_record", T.StringType())]
)

SUBMISSIONS_JSON = T.StructType(
    _struct(
        "sic string, sicDescription string, stateOfIncorporation string, fiscalYearEnd string, "
        "category string"
    ).fields
    + [T.StructField("exchanges", T.ArrayType(T.StringType()))]
)

MODEL_ITEM = _struct(
    "forecast_metric string, time_horizon string, fiscal_year int, estimate_type string, "
    "value_low double, value_high double, value_point double, unit string, direction string, "
    "confidence_language string, is_adjusted boolean, context_sentence string"
)
MODEL_RESPONSE = T.StructType(
    [
        # Every field as the text it came as: one of the wrong type spoils no other.
        T.StructField(
            "guidance_items",
            T.ArrayType(T.StructType([T.StructField(f.name, T.StringType()) for f in MODEL_ITEM])),
        ),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

LEDGER = _struct("accession_number string, status string")
