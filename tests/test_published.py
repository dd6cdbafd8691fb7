"""Derived columns, dedup and order against published panel records."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from augury.operators import derive, panel, profile

# Published records (date filed, metric, val1, val2, is range; then year, quarter,
# label, midpoint, width, per-share flag).
RECORDS = [
    ("2025-01-22", "EBITDA", 44.5e9, 45.5e9, True, 2025, 1, "2025Q1", 45e9, 1e9, False),
    ("2025-02-06", "Capex", 650e9, 670e9, True, 2025, 1, "2025Q1", 660e9, 20e9, False),
    ("2025-01-28", "EPS", 3.22, 3.32, True, 2025, 1, "2025Q1", 3.27, 0.09999999999999964, True),
    ("2025-01-30", "Gross_Margin", 89e9, 93e9, True, 2025, 1, "2025Q1", 91e9, 4e9, False),
    ("2025-02-20", "EPS", 3.27, 3.3, True, 2025, 1, "2025Q1", 3.285, 0.029999999999999805, True),
    ("2025-03-04", "EPS", 4.74e9 * 1000, 4.81e9 * 1000, True, 2025, 1, "2025Q1", 4775e9, 70e9, True),
    ("2025-01-29", "EPS", 16.5, 17.0, True, 2025, 1, "2025Q1", 16.75, 0.5, True),
    ("2025-01-28", "Revenue", 268e9, 272e9, True, 2025, 1, "2025Q1", 270e9, 4e9, False),
    ("2025-02-05", "Cash_Flow", 8199999999.999999, 8.8e9, True, 2025, 1, "2025Q1", 8.5e9, 600000000.000001, False),
]
INPUT = "date_filed string, metric string, val1 double, val2 double, is_range boolean"
DERIVED = ["file_year", "file_quarter", "file_yearq", "midpoint", "range_width", "is_per_share"]


def derived(df):
    dated = derive.add_file_period(df.withColumn("date_filed", F.to_timestamp("date_filed")))
    return derive.add_is_per_share(derive.add_range_width(derive.add_midpoint(dated)))


def same(found, expected):
    return all(a == b if isinstance(b, (str, bool)) else a == pytest.approx(b, rel=1e-9) for a, b in zip(found, expected))


def test_derived_columns_equal_published_records(spark):
    df = spark.createDataFrame([(i, *r[:5]) for i, r in enumerate(RECORDS)], f"i int, {INPUT}")
    for row in derived(df).collect():
        assert same([row[c] for c in DERIVED], RECORDS[row["i"]][5:]), row


@pytest.mark.skipif("AUGURY_PUBLISHED_PANEL" not in os.environ, reason="names a panel file to compare with")
def test_a_whole_published_panel(spark):
    """Every record of the file named by the setting: C1 to C4, D2, O2 and A1."""
    with open(os.environ["AUGURY_PUBLISHED_PANEL"], newline="", encoding="utf-8") as f:
        rows = [r for r in csv.DictReader(line for line in f if not line.startswith("#")) if r["val1"]]
    number = lambda x: float(x) if x else None
    data = [
        (i, r["date_filed"], r["metric"], number(r["val1"]), number(r["val2"]), r["is_range"] == "True", r["cik"], r["ticker"], r["accession_number"])
        for i, r in enumerate(rows)
    ]
    df = spark.createDataFrame(data, f"i int, {INPUT}, cik string, ticker string, accession_number string")
    found = derived(df)
    for row in found.collect():
        r = rows[row["i"]]
        expected = [int(r["file_year"]), int(r["file_quarter"]), r["file_yearq"], number(r["midpoint"]), number(r["range_width"]), r["is_per_share"] == "True"]
        assert same([row[c] for c in DERIVED], expected), r
    assert panel.dedup_panel(df.withColumn("cik_padded", F.col("cik"))).count() == len(rows)
    ordered = [(r["ticker"], r["date_filed"], r["metric"]) for r in panel.sort_panel(df).collect()]
    assert ordered == [(r["ticker"], r["date_filed"], r["metric"]) for r in rows]
    summary = profile.summarise_panel(found).agg(F.sum("n_guidance")).first()[0]
    assert summary == len(rows)
