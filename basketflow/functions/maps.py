"""Merge two count maps by adding counts per key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def merge_count_maps(left: str | Column, right: str | Column) -> Column:
    """``{k: a} + {k: b}`` -> ``{k: a + b}``; a missing side counts as 0.

    A null map is treated as empty.
    """
    lc = F.col(left) if isinstance(left, str) else left
    rc = F.col(right) if isinstance(right, str) else right
    empty = F.create_map().cast("map<string,bigint>")
    return F.map_zip_with(
        F.coalesce(lc, empty), F.coalesce(rc, empty),
        lambda k, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
