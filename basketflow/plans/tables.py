"""Loading the driver tables (one parquet file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet`` of one table; column pruning and filter
    pushdown happen in the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
