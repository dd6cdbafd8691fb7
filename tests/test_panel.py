"""Derived columns, dedup, joins, order, aggregates."""

import datetime

from pyspark.sql import functions as F

from augury import schemas
from augury.operators import derive, filings, joins, panel, profile
from augury.plans.panel import build_panel
from augury.plans.publish import publish
from augury.session import fresh_folder, is_small
from augury.sources.tables import read_csv

GUIDANCE = "cik string, company_name string, accession_number string, date_filed string, form_type string, " \
    "exhibit_url string, metric string, val1 double, val2 double, is_range boolean, midpoint double, " \
    "range_width double, pdicity string, fiscal_year int, action string, sentence string, sent_ord int, metric_ord int"


def guidance(spark, *rows):
    full = [
        (r.get("cik", "7"), "ACME", r.get("acc", "a-1"), r.get("date", "2025-02-03"), "8-K", "u",
         r.get("metric", "EPS"), r.get("val1", 1.0), r.get("val2", 1.0), r.get("is_range", False), None, 0.0,
         "FY", 2025, "issues", r.get("sentence", 's "quoted",\nover lines'), r.get("ord", 0), 0)
        for r in rows
    ]
    return spark.createDataFrame(full, GUIDANCE)


def tickers(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.TICKERS)


def test_padding_never_shortens(spark):
    df = spark.createDataFrame([("7",), ("12345678901",), (None,)], "cik string")
    got = [r["cik_padded"] for r in filings.add_padded_cik(df).collect()]
    assert got == ["0000000007", "12345678901", None]


def test_midpoints(spark):
    rows = [(1.0, 3.0), (2.0, 2.0), (1.0, None), (None, 2.0), (1.0, 0.0)]
    df = spark.createDataFrame(rows, "val1 double, val2 double")
    assert [r["midpoint"] for r in derive.add_midpoint(df).collect()] == [2.0, 2.0, 1.0, None, 0.5]
    assert [r["midpoint"] for r in derive.add_parse_midpoint(df).collect()] == [2.0, 2.0, 1.0, None, 1.0]


def test_per_share_treats_missing_as_false(spark):
    rows = [("EPS", None, None), ("Revenue", 1.0, None), ("Revenue", -199.0, 5.0), ("Revenue", 200.0, 5.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "metric string, val1 double, val2 double")
    assert [r["is_per_share"] for r in derive.add_is_per_share(df).collect()] == [True, False, True, False, True]


def test_nan_becomes_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert [r["v"] for r in derive.nan_to_null(df, ["v"]).collect()] == [None, 1.0, None]


def test_panel_dedup_order_and_missing_dates(spark):
    rows = guidance(
        spark,
        {"acc": "a-2", "val1": 1.0}, {"acc": "a-1", "val1": 1.0, "ord": 3}, {"acc": "a-1", "val1": 1.0, "ord": 1, "sentence": "kept"},
        {"date": "2025-13-40", "val1": None, "val2": None, "acc": "b-2"}, {"date": "bad", "val1": None, "val2": None, "acc": "b-1"},
        {"cik": "9", "metric": "Revenue", "val1": 5.0, "val2": 7.0, "is_range": True},
    )
    names = tickers(spark, ("0000000009", "ZZ", "Nine B", 4), ("0000000009", "AA", "Nine", 2))
    got = build_panel(rows.repartition(3), names).collect()
    assert [(r["ticker"], r["accession_number"], r["sentence"] == "kept") for r in got] == [
        ("AA", "a-1", False), (None, "a-1", True), (None, "b-1", False),
    ]
    assert got[0]["cik"] == "0000000009" and got[0]["midpoint"] == 6.0
    assert got[0]["date_filed"] == datetime.datetime(2025, 2, 3) and got[0]["file_yearq"] == "2025Q1"
    assert got[2]["file_year"] is None and got[2]["file_yearq"] is None
    assert build_panel(rows, names).columns == schemas.PANEL_COLUMNS


def test_early_ticker_choice_equals_fan_out_then_dedup(spark):
    rows = guidance(spark, *[{"cik": str(i % 4), "acc": f"a-{i}", "val1": float(i % 6)} for i in range(40)])
    names = tickers(spark, *[(f"{c:010d}", f"T{c}{k}", "N", 10 * c + k) for c in range(3) for k in (2, 1, 0)])
    fanned = joins.join_tickers(filings.coerce_dates(filings.add_padded_cik(rows)), names)
    late = panel.dedup_panel(fanned).select("cik_padded", "val1", "accession_number", "ticker")
    early = build_panel(rows, names, ordered=False).select("cik", "val1", "accession_number", "ticker")
    assert sorted(map(tuple, late.collect()), key=str) == sorted(map(tuple, early.collect()), key=str)


def test_summary_skips_missing_keys(spark):
    rows = guidance(
        spark, {"val1": 1.0, "val2": 3.0, "is_range": True}, {"cik": "8", "val1": 5.0, "val2": 5.0}, {"date": "bad"},
    )
    (row,) = profile.summarise_panel(build_panel(rows, tickers(spark))).collect()
    assert tuple(row) == (2025, "EPS", 2, 2, 0.5, 3.5)


def test_match_rate_of_nothing_is_missing(spark):
    empty = spark.createDataFrame([], "ticker string")
    assert tuple(profile.ticker_match_rate(empty).first()) == (0, 0, None)


def test_dedup_report_and_funnel(spark, texts):
    rows = filings.coerce_dates(filings.add_padded_cik(guidance(spark, {}, {"acc": "a-2"}, {"val1": 2.0})))
    assert tuple(profile.dedup_report(rows).first()) == (3, 2, 1)
    assert tuple(profile.extraction_funnel(texts("x", "y", "z"), rows).first()) == (3, 2, 3)


def test_ledger_and_anti_join(spark, texts):
    one = spark.createDataFrame([("a-0000",), ("a-0001",)], "accession_number string")
    two = spark.createDataFrame([("a-0001",)], "accession_number string")
    ledger = panel.dedup_ledger(one, two)
    assert ledger.count() == 2
    left = joins.exclude_processed(texts("x", "y", "z"), ledger)
    assert [r["accession_number"] for r in left.collect()] == ["a-0002"]


def test_numbering_is_whole_and_in_order(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.lpad("id", 5, "0")).alias("k")).repartition(7)
    rows = {r["k"]: r["row_no"] for r in panel.number_rows(df, ["k"], partitions=5).collect()}
    assert rows == {f"k{i:05d}": i for i in range(1000)}
    chunks = panel.chunk_rows(df, ["k"], 300).groupBy("chunk_no").count().orderBy("chunk_no").collect()
    assert [tuple(r) for r in chunks] == [(0, 300), (1, 300), (2, 300), (3, 100)]


def test_numbering_splits_a_key_that_holds_many_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "z").alias("k"), "id")
    ranged = panel.number_rows(df, ["k"], partitions=6)
    assert sorted(r["row_no"] for r in ranged.collect()) == list(range(3000))
    missing = [r["row_no"] for r in ranged.filter("k IS NULL").collect()]
    assert min(missing) == 2000


def test_limits_and_counts(spark):
    df = spark.createDataFrame(
        [("2", "2025-01-02", "f"), ("10", "2025-01-02", "g"), ("1", None, "h")], "cik string, date_filed string, filename string"
    )
    assert [r["filename"] for r in panel.limit_filings(df, 2).collect()] == ["g", "f"]
    assert panel.limit_filings(df, 0).count() == 3
    counted = profile.value_counts(df, "date_filed").collect()
    assert [tuple(r) for r in counted] == [("2025-01-02", 2)]


def test_publish_round_trip(spark):
    rows = guidance(spark, *[{"acc": f"a-{i}", "val1": float(i), "date": f"202{i % 3}-05-01"} for i in range(30)])
    panel_df = build_panel(rows, tickers(spark, ("0000000007", "T", "Seven", 0)), ordered=False)
    paths = publish(panel_df, fresh_folder(spark, "published"))
    assert spark.read.parquet(paths["panel"]).count() == 30
    sample = read_csv(spark, paths["sample"], schemas.PANEL)
    assert sample.count() == 30 and sample.first()["sentence"] == 's "quoted",\nover lines'
    assert sample.first()["ticker"] == "T"
    assert spark.read.option("header", True).csv(paths["summary"]).count() == 3


def test_small_means_both_bounds(spark):
    df = spark.range(100)
    assert is_small(df) and not is_small(df, max_rows=99) and not is_small(df, max_bytes=10)


def test_slices(spark):
    built = build_panel(guidance(spark, {}, {"metric": "Revenue", "val1": 300.0}), tickers(spark))
    assert filings.slice_panel(built, metric="EPS", pdicity="FY").count() == 1
    assert filings.slice_panel(built, ranges_only=True).count() == 0
    assert filings.slice_panel(built, actions=["issues"]).count() == 2


def test_large_ledger_moves_only_what_overlaps(spark):
    ledger = spark.range(200_000).selectExpr("concat('a', id) AS accession_number").union(
        spark.createDataFrame([(None,), ("a5",)], "accession_number string")
    )
    rows = spark.createDataFrame([(f"a{n}", n) for n in range(199_990, 200_040)] + [(None, -1), ("a5", 5), ("a5", 6)], "accession_number string, n int")
    plain = rows.join(ledger, "accession_number", "left_anti")
    left = joins.exclude_processed(rows, ledger, max_rows=10)
    assert sorted(r["n"] for r in left.collect()) == sorted(r["n"] for r in plain.collect()) == [-1, *range(200_000, 200_040)]
    moved = joins.ledger_overlap(rows, ledger, "accession_number").count()
    assert 11 <= moved < 40  # ten at the end and a5; others only where hashes meet in a bit
    # With a map far too small everything passes, and the rows are still right.
    assert sorted(r["n"] for r in joins.exclude_processed(rows, ledger, bits=32_768, max_rows=10).collect()) == [-1, *range(200_000, 200_040)]
