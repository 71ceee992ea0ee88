"""Parquet table access for the landed tables (one dataset per name)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(base_dir: str, name: str) -> str:
    return os.path.join(base_dir, f"{name}.parquet")


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Scan one table; projections and filters applied later reach the scan."""
    return spark.read.parquet(table_path(base_dir, name))
