"""M1: a deterministic, SQL-reproducible train/test assignment.

The reference splits 70/30 without a seed. ``randomSplit`` with a seed is
repeatable only for a fixed partitioning; the hash split depends on the key
alone, so it is stable across partitionings and cluster sizes and can be
recomputed by any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(key: str | Column, buckets: int = 10) -> Column:
    """First 8 hex digits of ``md5(key)`` as an integer, modulo ``buckets``."""
    k = F.col(key) if isinstance(key, str) else key
    head = F.substring(F.md5(k.cast("string")), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


def hash_split_flag(key: str | Column, train_fraction: float = 0.7,
                    buckets: int = 10) -> Column:
    """True for rows assigned to the training side."""
    cut = int(round(train_fraction * buckets))
    return hash_bucket(key, buckets) < F.lit(cut)


def order_hash(key: str | Column) -> Column:
    """The first 15 hex digits of ``md5(key)`` as a number (60 bits)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 15), 16, 10).cast("bigint")
