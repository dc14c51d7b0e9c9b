"""M2 / M3 at any size: string codes as a table.

``StringIndexer`` gathers a column's distinct values on the driver, which an id
column does not allow. Here the codes (0 for the most frequent value, ties
alphabetical, as there) are a table: counted with partial aggregation, dealt
into ranges of (frequency, value), numbered inside each range, and shifted by
the sizes of the ranges before it. They are applied by a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.session import materialise

#: Bits of ``monotonically_increasing_id`` that number a partition's rows.
_ROW_BITS = 33


def fit_codes(df: DataFrame, col: str) -> DataFrame:
    """``(value, code)`` of the non-null values of a column, as text; written
    to the shared scratch folder. Only the sizes of the ranges (one row per
    shuffle partition) meet in one task."""
    p = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = (df.select(F.col(col).cast("string").alias("value")).where("value is not null")
              .groupBy("value").agg(F.count(F.lit(1)).alias("n")))
    order = [F.col("n").desc(), F.col("value").asc()]
    rows = (counts.repartitionByRange(p, *order).sortWithinPartitions(*order)
            .select("value", F.monotonically_increasing_id().alias("at")))
    # Written before it is used twice: a range's number must stay what it is.
    rows = materialise(rows.select("value", F.shiftright("at", _ROW_BITS).alias("part"),
                                   (F.col("at") % F.lit(1 << _ROW_BITS)).alias("nth")), "codes-ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("part").agg(F.count(F.lit(1)).alias("size")) \
        .select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return materialise(rows.join(F.broadcast(offsets), "part")
                       .select("value", (F.col("offset") + F.col("nth")).alias("code")), "codes")


def apply_codes(df: DataFrame, col: str, codes: DataFrame, output_col: str | None = None,
                handle_invalid: str = "error") -> DataFrame:
    """``df`` with the code of ``col`` as a double in ``output_col``.

    ``"error"`` fails on a null or a value without a code, ``"keep"`` gives
    it the number of codes. The codes are a written table, so the join's other
    side is a plain shuffle, which AQE splits where one value is hot, and a
    small table is broadcast by its size.
    """
    if handle_invalid not in ("error", "keep"):
        raise ValueError("handle_invalid is 'error' or 'keep'")
    output_col = output_col or f"{col}_idx"
    key = F.col(col).cast("string")
    if handle_invalid == "keep":
        other = codes.agg(F.count(F.lit(1))).scalar()
    else:
        other = F.raise_error(F.concat(F.lit(f"no code for {col}: "), F.coalesce(key, F.lit("null")))).cast("bigint")
    table = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    code = F.when(F.col("_code").isNotNull(), F.col("_code")).otherwise(other)
    return df.join(table, key == F.col("_value"), "left") \
        .withColumn(output_col, code.cast("double")).drop("_value", "_code")
