"""Sinks: facility-level results and small reports. Marts are published, see `publication`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def save_facility_level(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Portfolio-size result, written in parallel by all tasks."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def save_report(df: DataFrame, path: str, as_csv: bool = False) -> None:
    """Report of a few rows as one file. Not for facility-level results."""
    writer = df.coalesce(1).write.mode("overwrite")
    if as_csv:
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
