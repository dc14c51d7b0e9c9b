"""View events from text files or from any table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.functions.parse import parse_view_line


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value`` (splittable, pruned by Spark)."""
    return spark.read.text(path)


def views_from_text(spark: SparkSession, path: str, on_malformed: str = "fail") -> DataFrame:
    """S1 + P1: ``"<user> <item>"`` lines -> ``(user, item)`` strings."""
    return parse_view_line(read_text_lines(spark, path), "value", on_malformed)


def views_from_table(df: DataFrame, user: str, item: str) -> DataFrame:
    """Map any two columns of a table to ``(user, item)``.

    Only the two columns are selected, so a parquet scan reads just them.
    """
    return df.select(F.col(user).alias("user"), F.col(item).alias("item"))
