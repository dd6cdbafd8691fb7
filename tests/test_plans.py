"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from augury import schemas
from augury.operators import joins, panel
from augury.operators.filings import filter_form_type, slice_panel
from augury.plans.guidance import build_guidance
from augury.plans.panel import build_panel
from augury.bitmaps import bit_map, may_be_in, may_pass
from augury.operators.joins import exclude_processed
from augury.session import broadcast_if_small, fresh_folder


def plan(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture()
def stored(spark, texts):
    path = fresh_folder(spark, "exhibits")
    texts("x", "y").withColumns(
        {"exhibit_filename": F.lit("b"), "exhibit_description": F.lit("d"), "items": F.lit(""), "text_length": F.lit(1)}
    ).write.parquet(path)
    return spark.read.schema(schemas.EXHIBITS).parquet(path)


def test_extraction_is_one_narrow_stage_over_seven_columns(stored, capsys):
    out = plan(build_guidance(stored), capsys)
    assert "Exchange" not in out and "Python" not in out
    schema = re.search(r"ReadSchema: struct<(.*)>", out).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {*schemas.FILING_KEYS, "text"}
    assert "StringContains(text,$)" in out
    # The records are computed in the generator only, not again in a filter below it.
    assert out.count("posexplode") == 0 and "size(" not in re.search(r"Condition : (.*)", out).group(1)


def test_no_text_in_a_panel_exchange(stored, spark, capsys):
    tickers = spark.createDataFrame([("0000000007", "T", "Seven", 0)], schemas.TICKERS)
    out = plan(build_panel(build_guidance(stored), tickers, ordered=False), capsys)
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", out)
    assert exchanges and not any(re.search(r"\btext#", e) for e in exchanges)
    # One shuffle for the records, one for the ticker choice; the tickers are broadcast.
    assert len(exchanges) == 2 and "BroadcastHashJoin LeftOuter BuildRight" in out


def test_dedup_prunes_before_its_shuffle(stored, capsys):
    df = build_guidance(stored).withColumn("cik_padded", F.col("cik"))
    out = plan(panel.dedup_panel(df), capsys)
    assert "WindowGroupLimit" in out[: out.index("Exchange")] or out.count("WindowGroupLimit") >= 2
    assert re.search(r"row_number\(\), 1, Partial", out)


def test_large_sides_are_not_broadcast(spark, stored):
    side = spark.range(1000).select(F.col("id").cast("string").alias("accession_number"))
    hinted = broadcast_if_small(side)._jdf.queryExecution().analyzed().toString()
    plain = broadcast_if_small(side, max_rows=10)._jdf.queryExecution().analyzed().toString()
    assert "UnresolvedHint" in hinted or "ResolvedHint" in hinted
    assert "Hint" not in plain


def test_slices_and_samples(spark, stored, capsys):
    tickers = spark.createDataFrame([], schemas.TICKERS)
    path = fresh_folder(spark, "panel")
    build_panel(build_guidance(stored), tickers, ordered=False).write.parquet(path)
    stored_panel = spark.read.schema(schemas.PANEL).parquet(path)
    out = plan(slice_panel(stored_panel, metric="EPS", actions=["raises", "lowers"]), capsys)
    assert "EqualTo(metric,EPS)" in out and "In(action, [lowers,raises])" in out.replace("[raises,lowers]", "[lowers,raises]")
    assert "TakeOrderedAndProject" in plan(panel.head_sample(stored_panel), capsys)


def test_anti_join_reads_keys_only(spark, stored, capsys):
    ledger = stored.withColumn("status", F.lit("ok"))
    out = plan(joins.exclude_processed(stored.select("accession_number"), ledger), capsys)
    assert "LeftAnti" in out and "text" not in out
    assert "In(form_type, [8-K,8-K/A,8-K/a,8-k,8-k/A,8-k/a])" in plan(filter_form_type(stored), capsys)


def test_bit_maps_pass_every_key_and_few_others(spark):
    table = spark.range(0, 30_000).selectExpr("id", "cast(id AS string) AS s")
    packed = bit_map(table.filter("id < 3000"), "id", "s", bits=1 << 18)
    passed = table.filter(may_be_in(packed, "id", "s"))
    assert passed.filter("id < 3000").count() == 3000 and passed.count() < 3600
    assert table.filter(may_be_in(bit_map(table.limit(0), "id", "s"), "id", "s")).count() == 0


def test_maps_of_keys_are_not_spelled_out_in_plans(spark):
    table = spark.range(20000).selectExpr("id", "cast(id as string) AS s")
    few = table.filter("id < 3000")
    passed = may_pass(table, few, "id", "s", bits=1 << 18)
    assert passed.columns == ["id", "s"]
    assert passed.join(few, ["id", "s"]).count() == 3000 and passed.count() < 3500
    assert may_pass(table, table.limit(0), "id", "s").count() == 0
    todo = exclude_processed(table, few, "s", max_rows=0)
    assert todo.count() == 17000
    for df in (passed, todo):
        assert len(df._jdf.queryExecution().toString()) < 100_000
