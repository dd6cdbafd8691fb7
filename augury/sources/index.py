"""Quarterly filing indexes: pipe-delimited text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from augury import schemas
from augury.functions.text import strip
from augury.session import BROADCAST_MAX_ROWS

# Layouts of a path that name the quarter.
_QUARTER_IN_PATH = [
    r"year=([0-9]{4})/quarter=([1-4])",
    r"([0-9]{4})/QTR([1-4])",
    r"([0-9]{4})_Q([1-4])",
]


def parse_index_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines of exactly five parts to named, stripped columns; other columns are kept."""
    parts = F.split(F.col(column), r"\|", -1)
    named = [strip(F.col("_parts")[i]).alias(c) for i, c in enumerate(schemas.INDEX_LINE_COLUMNS)]
    others = [c for c in lines.columns if c != column]
    return (
        lines.withColumn("_parts", parts).filter(F.size("_parts") == 5).select(*named, *others)
    )


def _quarter_of_path(path, group: int):
    found = [F.nullif(F.regexp_extract(path, p, group), F.lit("")) for p in _QUARTER_IN_PATH]
    return F.coalesce(*found).cast("int")


def skip_headers(lines: DataFrame) -> DataFrame:
    """Drop what stands above each file's first dashes line.

    A file without dashes starts at its first piped line that does not begin with
    ``CIK``. The rule needs a line's place in its file: block offset, then read order
    within the task, which the files and settings alone decide. So the places of the lines that
    start a file, one small row a file, fit a second reading of the same files, also by another
    executor. Lines are neither written nor shuffled while the files are few enough to send
    their starts to every task.
    """
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("line")
    placed = lines.select("*", F.struct("block", in_task).alias("place"))
    dashes = F.col("value").startswith("---")
    opener = F.contains("value", F.lit("|")) & ~F.col("value").startswith("CIK")
    starts = placed.filter(dashes | opener).groupBy("path").agg(
        F.min(F.when(dashes, F.col("place"))).alias("dash"),
        F.min(F.when(opener, F.col("place"))).alias("opener"),
    )
    body = F.when(F.col("dash").isNotNull(), F.col("place") > F.col("dash")).otherwise(
        F.col("place") >= F.col("opener")
    )
    few = len(lines.inputFiles()) <= BROADCAST_MAX_ROWS
    return placed.join(F.broadcast(starts) if few else starts, "path").filter(body).select(lines.columns)


def scan_master_index(
    spark: SparkSession, paths: str | list[str], exact_headers: bool = True
) -> DataFrame:
    """Index files to rows with the year and quarter of their path.

    With ``exact_headers`` off, files are read once instead of twice and a data line above
    the dashes would be kept; the header's own line falls to the form filter anyway.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    body = skip_headers(lines) if exact_headers else lines
    return parse_index_lines(body).select(
        *schemas.INDEX_LINE_COLUMNS,
        _quarter_of_path(F.col("path"), 1).alias("year"),
        _quarter_of_path(F.col("path"), 2).alias("quarter"),
    )


def scan_index_range(
    spark: SparkSession, base: str, start_year: int, end_year: int, exact_headers: bool = True
) -> DataFrame:
    """All quarters of the years in one read; quarters without a file are skipped.

    Only the files of these years are listed. ``base`` holds ``year=Y/quarter=Q`` folders.
    """
    years = ",".join(str(y) for y in range(start_year, end_year + 1))
    return scan_master_index(spark, f"{base}/year={{{years}}}/quarter=*", exact_headers)
