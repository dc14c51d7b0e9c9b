"""M1-M4: splitting, string indexing and feature assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions.splits import hash_split_flag


def random_split(df: DataFrame, train_fraction: float = 0.7,
                 seed: int | None = 42) -> tuple[DataFrame, DataFrame]:
    """M1 as in the reference (``randomSplit``), with a seed by default.

    Repeatable only for the same input partitioning; prefer
    :func:`hash_split` where results must be reproducible.
    """
    train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed)
    return train, test


def hash_split(df: DataFrame, key: str, train_fraction: float = 0.7
               ) -> tuple[DataFrame, DataFrame]:
    """M1, deterministic: a row's side depends on ``md5(key)`` only.

    Two filters over the same input; no shuffle.
    """
    flag = hash_split_flag(key, train_fraction)
    return df.where(flag), df.where(~flag)


def with_sides(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both sides of a split in one frame, told apart by ``side``."""
    return (train.withColumn("side", F.lit("train"))
            .unionByName(test.withColumn("side", F.lit("test"))))


def index_strings(input_cols: Sequence[str], output_cols: Sequence[str] | None = None,
                  handle_invalid: str = "error") -> StringIndexer:
    """M2 / M3: one (multi-column) ``StringIndexer``.

    Labels are ordered by frequency, descending, ties alphabetically.
    ``handle_invalid="error"`` fails on a value unseen at fit time;
    ``"keep"`` maps unseen values and NULL to the extra index
    ``number of labels``.
    """
    input_cols = list(input_cols)
    output_cols = list(output_cols or [f"{c}_idx" for c in input_cols])
    if len(input_cols) == 1:
        return StringIndexer(inputCol=input_cols[0], outputCol=output_cols[0],
                             handleInvalid=handle_invalid,
                             stringOrderType="frequencyDesc")
    return StringIndexer(inputCols=input_cols, outputCols=output_cols,
                         handleInvalid=handle_invalid, stringOrderType="frequencyDesc")


def assemble(input_cols: Sequence[str], output_col: str = "features",
             handle_invalid: str = "error") -> VectorAssembler:
    """M4: numeric and indexed columns into one vector (null -> error)."""
    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col,
                           handleInvalid=handle_invalid)


def vector_column_to_array(col: str | Column) -> Column:
    """A vector column as ``array<double>`` for SQL consumers and parquet."""
    return vector_to_array(F.col(col) if isinstance(col, str) else col)
