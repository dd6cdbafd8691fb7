"""Index files: headers, lines, accessions, dates, missing quarters."""

import os

from augury import schemas
from augury.functions import fixed_values as fixed
from augury.plans.filing_index import build_filing_index, filing_index
from augury.sources.index import parse_index_lines, scan_master_index

HEADER = "Description: x\n1|ABOVE|8-K|2025-01-01|edgar/data/1/9/f.txt\nCIK|Company Name|Form Type|Date Filed|Filename\n-----\n"
BODY = (
    " 1234 |ACME CORP|8-K|2025-01-30|edgar/data/1234/000000123425000001/filing.txt\r\n"
    "12345678901|BIG|8-k/a|2025-13-40|edgar/data/5/0000001234-25-000002.txt\n"
    "6|PIPE|NAME|8-K|2025-01-30|edgar/data/6/1/f.txt\n"
    "7|FOUR|8-K|2025-01-30\n"
    "8|OTHER|10-Q|2025-01-30|edgar/data/8/1/f.txt\n"
    "9|TAIL|8-K|2025-01-30|edgar/data/9/1-2-3/f.txt|\n"
)


def put(folder, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "master.idx"), "w", newline="") as f:
        f.write(text)


def test_header_rule_and_parts(spark, tmp_path):
    put(tmp_path / "2024/QTR1", HEADER + BODY)
    put(tmp_path / "2024/QTR2", "CIK|a|8-K|b|c\n5|NO DASHES|8-K|2024-05-01|edgar/data/5/1/f.txt\nCIK|late|8-K|x|y\n")
    put(tmp_path / "2024/QTR3", "only text\n")
    df = scan_master_index(spark, f"{tmp_path}/*/*")
    rows = sorted((r["cik"], r["company_name"], r["year"], r["quarter"]) for r in df.collect())
    assert rows == [
        ("1234", "ACME CORP", 2024, 1), ("12345678901", "BIG", 2024, 1), ("5", "NO DASHES", 2024, 2),
        ("8", "OTHER", 2024, 1), ("CIK", "late", 2024, 2),
    ]


def test_lines_above_the_dashes_go_whatever_the_splits(spark, tmp_path):
    many = "".join(f"{i}|FIRM {i}|8-K|2025-01-30|edgar/data/{i}/1/f.txt\n" for i in range(3000))
    put(tmp_path / "2025/QTR1", many + "---\n" + many)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = scan_master_index(spark, f"{tmp_path}/*/*")
        assert df.count() == 3000 and df.select("cik").distinct().count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_index_contract_and_both_accession_forms(spark):
    lines = spark.createDataFrame([(line, 2025, 1) for line in BODY.split("\n")], "value string, year int, quarter int")
    index = filing_index(parse_index_lines(lines))
    assert index.columns == schemas.FILING_INDEX.fieldNames()
    rows = {r["cik"]: r for r in index.collect()}
    assert set(rows) == {"1234", "12345678901"}
    assert rows["1234"]["accession_number"] == "000000123425000001"
    assert rows["12345678901"]["accession_number"] is None
    assert rows["12345678901"]["date_filed"] is None
    assert rows["12345678901"]["cik_padded"] == "12345678901"
    wide = filing_index(parse_index_lines(lines), fixed.ACCESSION_PATTERN_ANY)
    assert {r["accession_number"] for r in wide.collect()} == {"000000123425000001", "0000001234-25-000002"}


def test_years_without_files_are_skipped(spark, tmp_path):
    for year, quarter in ((2003, 4), (2004, 1), (2006, 3)):
        put(tmp_path / f"year={year}/quarter={quarter}", HEADER + BODY)
    index = build_filing_index(spark, str(tmp_path), 2004, 2010)
    assert [(r["year"], r["quarter"]) for r in index.select("year", "quarter").distinct().orderBy("year").collect()] == [
        (2004, 1), (2006, 3),
    ]
    assert index.columns == schemas.FILING_INDEX.fieldNames()


def test_lines_are_neither_written_nor_shuffled(spark, tmp_path):
    put(tmp_path / "2024/QTR1", HEADER + BODY)
    df = scan_master_index(spark, f"{tmp_path}/*/*")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ExistingRDD" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # of the files' starts


def test_headers_of_split_files_with_carriage_returns(spark, tmp_path):
    body = "".join(f"{i}|FIRM {i}|8-K|2025-01-30|edgar/data/{i}/1/f.txt\r\n" for i in range(2000))
    for quarter in (1, 2, 3):
        put(tmp_path / f"2025/QTR{quarter}", HEADER.replace("\n", "\r\n") + body)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = scan_master_index(spark, f"{tmp_path}/*/*").groupBy("quarter").count().collect()
        assert {(r["quarter"], r["count"]) for r in rows} == {(1, 2000), (2, 2000), (3, 2000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
