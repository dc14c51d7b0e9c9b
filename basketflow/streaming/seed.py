"""The initial state of a stream, stored once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.session import path_exists


def store_seed(spark: SparkSession, path: str, initial: DataFrame | None,
               schema: str) -> DataFrame:
    """The seed kept at ``path``, written there on the first start.

    Later starts get the stored seed whether or not they pass one; passing a
    different one raises, as it can not be what the running totals began from.
    Without ``initial`` the first start stores an empty seed.
    """
    empty = spark.createDataFrame([], schema)
    if not path_exists(spark, path + "/_SUCCESS"):
        rows = empty if initial is None else initial.select(
            *[F.col(f.name).cast(f.dataType) for f in empty.schema])
        rows.write.mode("overwrite").parquet(path)
        return spark.read.schema(schema).parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    if initial is not None:
        given = initial.select(*[F.col(f.name).cast(f.dataType) for f in empty.schema])
        if _digest(given) != _digest(stored):
            raise ValueError(f"another initial state is already stored at {path}")
    return stored


def _digest(df: DataFrame) -> tuple:
    h = F.xxhash64(*df.columns)
    return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first())
