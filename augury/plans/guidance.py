"""Z3: exhibits to guidance records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury import schemas
from augury.operators.filings import earnings_gate, select_contract
from augury.operators.guidance import extract_guidance
from augury.plans.exhibits import chosen_names, wanted_bodies
from augury.session import freeze
from augury.sources.filings import body_text


def build_guidance(exhibits: DataFrame) -> DataFrame:
    """Z3: one narrow stage over seven columns; nothing is shuffled."""
    return extract_guidance(exhibits.select(*schemas.FILING_KEYS, "text"))


def guidance_from_bodies(
    index: DataFrame, listings: DataFrame, bodies: DataFrame, ledger: DataFrame | None = None
) -> DataFrame:
    """Z2 and Z3 in one, for large corpora: the same records, but no text is shuffled.

    Records are read where the bodies lie, from those that may be chosen; a few small rows per
    body then meet the filing.
    """
    names = freeze(chosen_names(index, listings, bodies, ledger))
    keys = ["copy_cik", "accession_key", "filename"]
    texts = earnings_gate(body_text(wanted_bodies(names, bodies))).select(*keys, "text")
    records = extract_guidance(texts)
    found = names.select(*schemas.FILING_KEYS, *keys).join(records, keys)
    return select_contract(
        found.withColumn("date_filed", F.col("date_filed").cast("string")), schemas.GUIDANCE
    )
