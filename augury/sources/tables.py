"""Parquet and CSV tables between the steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet_table(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """S3: a step's input under its declared schema; only used columns reach the scan."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))


def write_parquet_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite"
) -> None:
    """A step's output. Tasks write their own files; no shuffle beforehand."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; quotes doubled, embedded newlines kept inside quotes."""
    plain = df.select(
        [
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, (T.BooleanType, T.TimestampType))
            else F.col(f.name)
            for f in df.schema
        ]
    )
    plain.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S5, reading back: records may span lines."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .csv(path)
    )


def compact_batches(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType | None = None,
    files: int | None = None,
) -> DataFrame:
    """All batch files to one table of fewer, larger files."""
    batches = read_parquet_table(spark, source, schema)
    # Round-robin: even files whatever the batch sizes were, no key to be skewed on.
    even = batches.repartition(files) if files else batches.hint("rebalance")
    write_parquet_table(even, target)
    return read_parquet_table(spark, target, schema)
