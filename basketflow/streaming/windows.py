"""T5, event-time variant: co-occurrence per event-time window.

Baskets are the distinct items a user viewed inside one window of event time
(``window(ts, "1 day")``), however the views are spread over micro-batches.
One watermarked streaming aggregation de-duplicates ``(window, user, item)``
in append mode: its state is one small row per distinct view of the windows
that are still open, spread over all state partitions however hot a user or a
window is. When the watermark (latest event time seen minus the delay) passes a
window's end, Spark emits all its rows in one micro-batch and drops them from
the state; that batch is paired by the blocked, skew-safe batch operator,
scoped by window. Late rows are Spark's to drop.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketflow.operators.recommender import DEFAULT_BLOCK_SIZE, pair_support

CLOSING_SCHEMA = "ts timestamp_ntz, user string, item string"


def closed_views(views: DataFrame, ts: str = "ts", window: str = "1 day",
                 delay: str = "0 seconds") -> DataFrame:
    """Streaming ``(window_start, window_end, user, item)``: the distinct views
    of windows that have closed. Rows without a time are ignored."""
    w = F.window("ts", window)
    rows = (views.select(F.col(ts).cast("timestamp").alias("ts"), F.col("user").cast("string").alias("user"),
                         F.col("item").cast("string").alias("item"))
            .where("ts is not null").withWatermark("ts", delay))
    return (rows.groupBy(w.alias("w"), "user", "item").count()
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "user", "item"))


def start_windowed_pairs(views: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None],
                         ts: str = "ts", window: str = "1 day", delay: str = "0 seconds",
                         min_basket: int = 2, min_support: int = 1,
                         block_size: int = DEFAULT_BLOCK_SIZE,
                         trigger: dict | None = None) -> StreamingQuery:
    """Start the query; ``sink(df, batch_id)`` receives ``(window_start,
    window_end, a, b, cnt)`` for the windows that the batch closed. The session
    time zone must be UTC if ``ts`` has no zone (the package default)."""
    def emit(batch: DataFrame, batch_id: int) -> None:
        sink(pair_support(batch, min_basket, min_support, block_size,
                          scope=("window_start", "window_end")), batch_id)

    return (closed_views(views, ts, window, delay).writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint).foreachBatch(emit)
            .trigger(**(trigger or {"availableNow": True})).start())


def closing_row(spark: SparkSession, latest: datetime, days: float) -> DataFrame:
    """One ``(ts, user, item)`` row without user and item, ``days`` after
    ``latest``: as the last input of a bounded replay it moves the watermark
    past the windows that are still open. ``days`` must exceed the delay plus
    the window. A live stream's open windows may still get rows: never use it
    there."""
    return spark.createDataFrame([(latest + timedelta(days=days), None, None)], CLOSING_SCHEMA)
