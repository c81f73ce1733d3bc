"""Parquet table reader for the driver's tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    """Parquet path of one driver table."""
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(
    spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None
) -> DataFrame:
    """Read one table; selecting ``columns`` up front keeps the scan's
    ReadSchema to what the query needs."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
