"""Attaching group sizes without meeting a hot group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def size_lookup(df: DataFrame, keys: Sequence[str], limit: int, size: str,
                partitions: int) -> tuple[DataFrame, DataFrame]:
    """``(keys..., _salts)`` of the hot groups, those with more than a
    ``partitions``-th of all rows (so fewer than ``partitions`` of them), and
    the lookup ``(keys..., size, _salt)`` of all groups of more than ``limit``
    rows: one row per group, a hot one under each of its salts.

    A hot group has eight salts per fair share that it holds (so that equal
    hashes even out), and no more than eight per ``limit`` rows: the lookup has
    at most ``9 * rows / limit`` rows, whatever the partitions.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(size))
    rows = sizes.agg(F.sum(size)).scalar()
    n, p = F.col(size), F.lit(partitions)
    salts = F.least(8 * F.ceil(n * p / rows), F.ceil(8 * n / F.lit(limit))).cast("int")
    large = sizes.where(n > F.lit(limit)) \
        .withColumn("_salts", F.when(n * p > rows, salts).otherwise(F.lit(1)))
    hot = large.where("_salts > 1").select(*keys, "_salts")
    return hot, large.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")


def with_large_size(df: DataFrame, keys: Sequence[str], entry: str, limit: int,
                    size: str = "n", partitions: int | None = None) -> DataFrame:
    """``df`` with ``size``: the rows of the row's group if the group has more
    than ``limit`` rows, else NULL.

    A plain join with the group counts would bring a hot group's rows into one
    task, and AQE can not split it (the counts reach the join through an
    aggregate). So the rows of hot groups are dealt over salts, by a hash of
    ``entry``; which groups those are is broadcast (fewer than the shuffle
    partitions). No other group exceeds a task's fair share: those are joined
    plainly (:func:`size_lookup`).
    """
    keys = list(keys)
    p = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot, lookup = size_lookup(df, keys, limit, size, p)
    salt = F.coalesce(F.pmod(F.xxhash64(entry), F.col("_salts")).cast("int"), F.lit(0))
    tagged = df.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_salts")
    return tagged.join(lookup, keys + ["_salt"], "left").drop("_salt")
