"""Turning raw message text into (user, item) view events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MALFORMED_MODES = ("fail", "drop")


def message_value(col: str | Column = "value") -> Column:
    """The message value as a string (Kafka values arrive as binary)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def parse_view_line(df: DataFrame, col: str = "value", on_malformed: str = "fail",
                    user: str = "user", item: str = "item") -> DataFrame:
    """Split a ``"<user> <item>"`` line on single spaces.

    Field 0 is the user and field 1 the item; further fields are ignored and a
    doubled space yields an empty item. A line with fewer than two fields
    fails the job (``on_malformed="fail"``, reference behaviour) or is dropped
    (``"drop"``). The split is a Catalyst expression, so the whole parse stays
    inside whole-stage codegen.
    """
    if on_malformed not in MALFORMED_MODES:
        raise ValueError(f"on_malformed must be one of {MALFORMED_MODES}")
    parts = F.split(F.col(col), " ", -1)
    out = df.select(parts.alias("_parts"))
    if on_malformed == "drop":
        out = out.where(F.size("_parts") >= 2)
        first, second = F.get("_parts", 0), F.get("_parts", 1)
    else:
        bad = F.size("_parts") < 2
        first = F.get("_parts", 0)
        second = F.when(bad, F.raise_error(F.concat(
            F.lit("malformed view event, expected '<user> <item>': "),
            F.array_join("_parts", " ")))).otherwise(F.get("_parts", 1))
    return out.select(first.alias(user), second.cast("string").alias(item))
