"""Identifiers and dates as column expressions."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from augury.functions import fixed_values as fixed


def pad_cik(cik: Column) -> Column:
    """Left-pad to ten digits; longer values stay whole (``lpad`` alone would cut them)."""
    text = cik.cast("string")
    return F.when(F.length(text) >= 10, text).otherwise(F.lpad(text, 10, "0"))


def accession_of(filename: Column, regex: str = fixed.ACCESSION_PATTERN) -> Column:
    return F.nullif(F.regexp_extract(filename, regex, 1), F.lit(""))


def without_dashes(accession: Column) -> Column:
    return F.replace(accession, F.lit("-"), F.lit(""))


def filing_url(cik: Column, accession: Column, base: str = fixed.ARCHIVE_BASE) -> Column:
    return F.concat(F.lit(f"{base}/edgar/data/"), cik, F.lit("/"), without_dashes(accession))


def coerce_date(text: Column) -> Column:
    """Date text to timestamp; NULL when it is not a date."""
    return text.try_cast("timestamp")


def document_key(url: Column, params: dict | None = None) -> Column:
    """SHA-256 of the address and its key-sorted parameters."""
    return F.sha2(F.concat(url, F.lit(json.dumps(params or {}, sort_keys=True))), 256)


def resolve_url(href: Column, base: Column) -> Column:
    return (
        F.when(href.startswith("/"), F.concat(F.lit(fixed.ARCHIVE_HOST), href))
        .when(~href.startswith("http"), F.concat(base, F.lit("/"), href))
        .otherwise(href)
    )


def has_extension(name: Column, extensions: list[str] = fixed.DOCUMENT_EXTENSIONS) -> Column:
    """The lower-cased name contains one of the extensions, anywhere."""
    lowered = F.lower(name)
    test = F.lit(False)
    for extension in extensions:
        test = test | F.contains(lowered, F.lit(extension))
    return test
