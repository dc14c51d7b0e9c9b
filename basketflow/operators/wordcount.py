"""A4: word counts over text, with either split rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions.tokens import split_drop_trailing, split_keep_all

SPLIT_RULES = {"keep_all": split_keep_all, "drop_trailing": split_drop_trailing}


def tokens(lines: DataFrame, col: str = "value", rule: str = "keep_all") -> DataFrame:
    """One row per token (column ``word``), whole texts, no length cap."""
    try:
        splitter = SPLIT_RULES[rule]
    except KeyError:
        raise ValueError(f"rule must be one of {sorted(SPLIT_RULES)}") from None
    return lines.select(F.explode(splitter(col)).alias("word"))


def word_counts(lines: DataFrame, col: str = "value", rule: str = "keep_all") -> DataFrame:
    """``(word, cnt)``; partial aggregation before the shuffle on ``word``.

    A word that makes up a third of all tokens costs one partial row per map
    task, so the final aggregation is not skewed.
    """
    return (tokens(lines, col, rule).groupBy("word")
            .agg(F.count(F.lit(1)).alias("cnt")))
