"""M1 with exact sizes: a split at one order statistic of a hash.

A hash split gives each side a share that is only near the fraction. Here the
training side is the ``round(fraction * n)`` rows with the smallest hashes. The
boundary is found by distributed selection: a histogram of the hash range is
counted, then one of the bin that holds the wanted rank, until that bin has few
values. Nothing is sorted, and the driver sees one histogram at a time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.functions.splits import order_hash

#: Bins of a histogram, and rows of a bin that are looked at one by one.
BINS = 4096
FEW = 2000
HASH_BITS = 60


def order_statistic(df: DataFrame, value: Column, k: int, bins: int = BINS,
                    few: int = FEW) -> tuple[int, int]:
    """The ``k``-th smallest (from 1) of a column of numbers from 0 to 2**60 - 1,
    and how many rows are smaller. Each pass reads the rows of the current
    bin and returns at most ``bins`` counts; a bin of at most ``few`` rows ends
    the search, as does one of a single value, however often it occurs."""
    values = df.select(value.alias("v")).where("v is not null")
    lo, hi, below = 0, 1 << HASH_BITS, 0
    while True:
        width = -(-(hi - lo) // bins)
        inside = values.where((F.col("v") >= lo) & (F.col("v") < hi))
        counts = inside.groupBy(F.expr(f"(v - {lo}) div {width}").alias("b")).agg(F.count(F.lit(1)).alias("n"))
        counts = sorted((r.b, r.n) for r in counts.collect())
        for b, n in counts:
            if below + n >= k:
                break
            below += n
        else:
            raise ValueError("k is beyond the number of rows")
        lo, hi = lo + b * width, min(hi, lo + (b + 1) * width)
        if hi - lo == 1:
            return lo, below
        if n <= few:
            own = sorted(r.v for r in values.where((F.col("v") >= lo) & (F.col("v") < hi)).collect())
            found = own[k - below - 1]
            return found, below + sum(v < found for v in own)


def exact_split(df: DataFrame, key: str, train_fraction: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """M1, exact and deterministic: (train, test) with
    ``floor(train_fraction * n + 0.5)`` rows in train, those with the smallest
    ``order_hash(key)``; rows of equal keys are ordered by a hash of the whole
    row, and equal rows are interchangeable.

    A null key counts as the empty text. Columns must be comparable (no maps).
    The order does not depend on partitions or row order. One key may hold any
    share of the rows: ties are found by the same selection.
    """
    n = df.count()
    k = math.floor(train_fraction * n + 0.5)
    if k <= 0 or k >= n:
        return (df, df.limit(0)) if k else (df.limit(0), df)
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    first = order_hash(text)
    cut, below = order_statistic(df, first, k)
    tied = df.where(first == cut)
    # Rows of the boundary's hash: nearly always one row, or one key's.
    row = F.shiftrightunsigned(F.xxhash64(text, *[F.col(c) for c in df.columns]), 64 - HASH_BITS)
    cut2, below2 = order_statistic(tied, row, k - below)
    left = k - below - below2
    same = tied.where(row == cut2)
    # Equal rows (or, next to impossible, equal hashes): the first ``left``.
    names = df.columns
    counted = same.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shared = counted.withColumn("_to", F.sum("_n").over(upto)) \
        .withColumn("_own", F.greatest(F.lit(0), F.least(F.col("_n"), F.lit(left) - F.col("_to") + F.col("_n"))))

    def copies(count: Column) -> DataFrame:
        return shared.withColumn("_copy", F.explode(F.when(count > 0, F.sequence(F.lit(1).cast("bigint"), count)))) \
            .select(*names)

    train = df.where(first < cut).union(tied.where(row < cut2)).union(copies(F.col("_own")))
    test = df.where(first > cut).union(tied.where(row > cut2)).union(copies(F.col("_n") - F.col("_own")))
    return train, test
