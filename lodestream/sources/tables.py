"""Parquet tables of a folder, one file or folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of ``folder``; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
