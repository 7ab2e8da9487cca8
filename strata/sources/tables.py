"""Parquet tables addressed by folder (``<root>/<name>.parquet``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Scan one parquet table; naming ``columns`` up front keeps the ReadSchema narrow."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
