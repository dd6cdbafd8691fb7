"""Amounts, periods, years and actions, case by case."""

import pytest
from pyspark.sql import functions as F

from augury.functions import guidance as g
from augury.functions.text import fold, strip

AMOUNTS = [
    ("$1.50 to $1.60", 1.5, 1.6, True),
    ("$10 to $12 million", 10e6, 12e6, True),
    ("$10 million to $12", 10e6, 12e6, True),
    ("$950 million to $1.1 billion", 950e6, 1.1e9, True),
    ("$14.0 billion and $18.0 billion", 14e9, 18e9, True),
    ("$5 to $3", 3.0, 5.0, True),
    ("$2 mm – $3 bn", 2e6, 3e9, True),
    ("$2—$3 thousand", 2e3, 3e3, True),
    ("($1.10) through ($1.20)", 1.1, 1.2, True),
    ("$1.50-1.60", 1.5, 1.5, False),
    ("($0.50)", 0.5, 0.5, False),
    ("$1,500", 1500.0, 1500.0, False),
    ("$1500", 150.0, 150.0, False),
    ("$0.12345", 0.1234, 0.1234, False),
    ("$5 more", 5e6, 5e6, False),
    ("$5 base", 5e9, 5e9, False),
    ("$7 K", 7e3, 7e3, False),
    ("$ 7 MILLION", 7e6, 7e6, False),
    ("$7 K", 7e3, 7e3, False),
    ("$3 then $4 to $5", 4.0, 5.0, True),
    ("46% to 47%", None, None, None),
    ("$ none", None, None, None),
]


def test_amounts(spark):
    df = spark.createDataFrame([(a[0],) for a in AMOUNTS], "s string")
    rows = df.select("s", g.read_amounts(F.col("s")).alias("v")).collect()
    got = {r["s"]: (r["v"]["val1"], r["v"]["val2"], r["v"]["is_range"]) if r["v"] else (None,) * 3 for r in rows}
    assert got == {a[0]: a[1:] for a in AMOUNTS}


def test_has_amount_is_exact(spark):
    df = spark.createDataFrame([(a[0],) for a in AMOUNTS], "s string")
    rows = df.select(
        g.has_amount(F.col("s")).alias("has"), g.read_amounts(F.col("s"))["val1"].isNotNull().alias("read")
    ).collect()
    assert all(r["has"] == r["read"] for r in rows)


@pytest.mark.parametrize(
    "text, period, year, action",
    [
        ("the First-Quarter of 2025", "Q1", 2025, "issues"),
        ("2nd  quarter and Q1", "Q1", None, "issues"),
        ("full year FY2026", "FY", 2026, "issues"),
        ("fiscal 2025", "Unknown", 2025, "issues"),
        ("fiscal year, second half", "FY", None, "issues"),
        ("first half", "H1", None, "issues"),
        ("year ended 12024", "FY", 2024, "issues"),
        ("we increased and lowered it", "Unknown", None, "raises"),
        ("prices were cut.", "Unknown", None, "lowers"),
        ("cuté and narrowing", "Unknown", None, "narrows"),
        ("confirms", "Unknown", None, "reaffirms"),
        ("providing  new", "Unknown", None, "initiates"),
        ("provides guidance", "Unknown", None, "issues"),
        ("WITHDRAWN", "Unknown", None, "withdraws"),
        ("raiſes", "Unknown", None, "raises"),
    ],
)
def test_labels(spark, text, period, year, action):
    row = spark.createDataFrame([(text,)], "s string").select(
        g.detect_period(F.col("s")), g.detect_fiscal_year(F.col("s")), g.detect_action(F.col("s"))
    ).first()
    assert tuple(row) == (period, year, action)


@pytest.mark.parametrize(
    "sentence, found",
    [
        ("We expect sales", True), ("We expected sales", False), ("anticipating sales", False),
        ("We oversee sales", True), ("It expects: sales", False), ("calls  for sales", True),
        ("calls sales", False), ("guidance is", True), ("EXPECTS sales", True),
        ("We expect", False), ("Issued today", True),
    ],
)
def test_verbs(spark, sentence, found):
    row = spark.createDataFrame([(sentence,)], "s string").select(g.has_guidance_verb(F.col("s"))).first()
    assert row[0] is found


@pytest.mark.parametrize(
    "sentence, mentions",
    [
        ("steps were taken", [("EPS", 2)]),
        ("net income per share", [("EPS", 0), ("Net_Income", 0)]),
        ("Total  revenues", [("Revenue", 0)]),
        ("total costs and sales", [("Revenue", 16)]),
        ("an effort", [("FFO", 4)]),
        ("adjusted FFO per share", [("FFO", 0)]),
        ("Operating cash flow", [("Cash_Flow", 0)]),
        ("free operating cash flow", [("Cash_Flow", 5)]),
        ("\U0001f600\U0001f600 EBITDA", [("EBITDA", 3)]),
        ("İİ capex", [("Capex", 3)]),
        ("diluted EPS and tax rate", [("EPS", 0), ("Tax_Rate", 16)]),
        ("earnings per common share", [("EPS", 0)]),
        ("gross profit, profit from operations", [("Operating_Income", 14), ("Gross_Margin", 0)]),
    ],
)
def test_metrics(spark, sentence, mentions):
    row = spark.createDataFrame([(sentence,)], "s string").select(g.metric_mentions(F.col("s"))).first()
    assert [(m["metric"], m["metric_offset"]) for m in row[0]] == mentions


def test_fold_keeps_code_points(spark):
    odd = "İıſK \U0001f600X Äẞ"
    folded, size = spark.createDataFrame([(odd,)], "s string").select(
        fold(F.col("s")), F.length("s")
    ).first()
    assert len(folded) == size == len(odd)
    assert folded.startswith("iisk �x ä")


def test_strip_knows_all_white_space(spark):
    white = "\t\n\x0b\x0c\r\x1c\x1f \x85\xa0       　"
    row = spark.createDataFrame([(white + "​x​" + white,)], "s string").select(strip(F.col("s"))).first()
    assert row[0] == (white + "​x​" + white).strip() == "​x​"
