"""The panel's files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from augury import schemas
from augury.operators.panel import head_sample
from augury.operators.profile import summarise_panel
from augury.sources.tables import read_parquet_table, write_csv, write_parquet_table


def publish(panel: DataFrame, folder: str) -> dict[str, str]:
    """Panel as Parquet by filing year, summary and sample as CSV.

    The panel is computed once: summary and sample read the written table. Rebalancing
    on the year gives even files, also when one year holds most rows.
    """
    paths = {name: f"{folder}/{name}" for name in ("panel", "summary", "sample")}
    even = panel.hint("rebalance", "file_year")
    write_parquet_table(even, paths["panel"], partition_by=["file_year"])
    written = read_parquet_table(panel.sparkSession, paths["panel"], schemas.PANEL)
    summary = summarise_panel(written).orderBy("file_year", "metric").coalesce(1)
    write_csv(summary, paths["summary"])
    sample = head_sample(written.select(schemas.PANEL_COLUMNS)).coalesce(1)
    write_csv(sample, paths["sample"])
    return paths
