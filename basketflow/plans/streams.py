"""Streaming queries over the driver tables.

Each query replays a table as a file stream in time-ordered slices (one
micro-batch per slice, the query restarted from its checkpoint before every
slice) and returns the sink's table as a DataFrame.

Slices: ``events`` by 10-day windows of ``ts`` from 2024-01-01; ``documents``
by language (alphabetical). Batch ids are the slice ordinals.
"""

from __future__ import annotations

import os
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.functions.payload import recommendation_payload, word_count_payload
from basketflow.functions.parse import parse_view_line
from basketflow.operators.recommender import nest_recommendations, recommendations_flat
from basketflow.operators.wordcount import word_counts
from basketflow.plans.tables import table
from basketflow.session import scratch_dir
from basketflow.sinks.delivery import FileDelivery, read_delivered, start_delivery
from basketflow.sinks.writers import BatchTableWriter, read_batches
from basketflow.streaming.counts import running_word_counts, start_counts
from basketflow.streaming.harness import SlicedFileStream, slice_ids
from basketflow.streaming.recommend import BatchScopedPairs, RunningRecommender
from basketflow.streaming.windows import closing_row, start_windowed_pairs

# Slicing of the events table into micro-batches.
SLICE_ORIGIN = "2024-01-01"
SLICE_DAYS = 10
# Items of the event stream: event type plus a 7-way split of event ids.
ITEM_VARIANTS = 7


def event_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with a ``slice`` column (10-day windows)."""
    ev = table(spark, sf_dir, "events")
    days = F.datediff(F.col("ts").cast("date"), F.to_date(F.lit(SLICE_ORIGIN)))
    return ev.withColumn("slice", F.floor(days / F.lit(SLICE_DAYS)).cast("int"))


def in_event_slice(s: int, ts: str = "ts"):
    """``slice == s`` as a ``ts`` range, so the scan can skip row groups."""
    lo = (datetime.fromisoformat(SLICE_ORIGIN) + timedelta(days=SLICE_DAYS * s))
    hi = lo + timedelta(days=SLICE_DAYS)
    return ((F.col(ts) >= F.lit(lo.isoformat(" ")).cast("timestamp_ntz"))
            & (F.col(ts) < F.lit(hi.isoformat(" ")).cast("timestamp_ntz")))


def event_view_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(slice, value)`` view lines ``"<user> <item>"`` from events."""
    ev = event_slices(spark, sf_dir)
    item = F.concat(F.col("event_type"),
                    (F.col("event_id") % F.lit(ITEM_VARIANTS)).cast("string"))
    return ev.select("slice", "ts", F.concat_ws(" ", F.col("user_id").cast("string"),
                                                item).alias("value"))


def _replay(spark: SparkSession, sliced: DataFrame, start, by_ts: bool = True
            ) -> SlicedFileStream:
    """Stage ``sliced`` (columns ``slice``, ``value`` and, for events, ``ts``)
    slice by slice and run; event slices are selected by ``ts`` range."""
    stream = SlicedFileStream(spark, sliced.select("value").schema)
    for s in slice_ids(sliced, "slice"):
        cond = in_event_slice(s) if by_ts else F.col("slice").eqNullSafe(F.lit(s))
        stream.stage(sliced.where(cond).select("value"))
        stream.run_once(start)
    return stream


def _update_counts_stream(spark: SparkSession, sf_dir: str) -> SlicedFileStream:
    lines = event_slices(spark, sf_dir).select("slice", "ts",
                                               F.col("event_type").alias("value"))
    holder = {}

    def start(stream_df, checkpoint):
        sink = holder.setdefault("sink", BatchTableWriter(os.path.join(
            os.path.dirname(checkpoint), "output")))
        counts = running_word_counts(stream_df, "value", "drop_trailing")
        return start_counts(counts, checkpoint, sink, "update")

    return _replay(spark, lines, start)


def wc_stream_warm_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 for T3: running event-type counts seeded with the batch word count
    of the first slice, then streaming the other slices; batch ids shifted
    by one to line up with the cold-start run."""
    lines = event_slices(spark, sf_dir).select("slice", "ts",
                                               F.col("event_type").alias("value"))
    ids = slice_ids(lines, "slice")
    seed = word_counts(lines.where(in_event_slice(ids[0])).select("value"), "value",
                       "drop_trailing")
    stream = SlicedFileStream(spark, lines.select("value").schema)
    sink = BatchTableWriter(stream.output_dir)

    def start(stream_df, checkpoint):
        counts = running_word_counts(stream_df, "value", "drop_trailing")
        return start_counts(counts, checkpoint, sink, "update", initial_state=seed)

    for s_id in ids[1:]:
        stream.stage(lines.where(in_event_slice(s_id)).select("value"))
        stream.run_once(start)
    out = read_batches(spark, stream.output_dir, "word string, cnt bigint, batch_id int")
    return out.select((F.col("batch_id") + 1).alias("batch_id"), "word", "cnt",
                      word_count_payload("word", "cnt").alias("payload"))


def wc_stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 + K1: running event-type counts, update mode, one row per word
    touched in each batch with its cumulative total and rendered payload."""
    stream = _update_counts_stream(spark, sf_dir)
    out = read_batches(spark, stream.output_dir, "word string, cnt bigint, batch_id int")
    return out.select("batch_id", "word", "cnt",
                      word_count_payload("word", "cnt").alias("payload"))


def stream_restart_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after every slice ran as a restart from the checkpoint;
    the last emission per word must equal the batch total."""
    stream = _update_counts_stream(spark, sf_dir)
    out = read_batches(spark, stream.output_dir, "word string, cnt bigint, batch_id int")
    return out.groupBy("word").agg(F.max_by("cnt", "batch_id").alias("cnt"))


def wc_stream_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured word count (keep-all split) in complete mode over the
    documents, one language per batch; every batch re-emits the whole
    table."""
    docs = table(spark, sf_dir, "documents")
    # slice = language; batches in alphabetical order, filter pushed to the scan
    lines = docs.select(F.col("lang").alias("slice"), F.col("text").alias("value"))
    holder = {}

    def start(stream_df, checkpoint):
        sink = holder.setdefault("sink", BatchTableWriter(os.path.join(
            os.path.dirname(checkpoint), "output")))
        counts = running_word_counts(stream_df, "value", "keep_all")
        return start_counts(counts, checkpoint, sink, "complete")

    stream = _replay(spark, lines, start, by_ts=False)
    return read_batches(spark, stream.output_dir, "word string, cnt bigint, batch_id int")


def reco_stream_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: pair counts computed inside each micro-batch of view events."""
    holder = {}

    def start(stream_df, checkpoint):
        sink = holder.setdefault("sink", BatchTableWriter(os.path.join(
            os.path.dirname(checkpoint), "output")))
        views = _parse(stream_df)
        return (views.writeStream.option("checkpointLocation", checkpoint)
                .foreachBatch(BatchScopedPairs(sink)).trigger(availableNow=True).start())

    stream = _replay(spark, event_view_slices(spark, sf_dir), start)
    return read_batches(spark, stream.output_dir, "a string, b string, cnt bigint, batch_id int")


def _parse(stream_df: DataFrame) -> DataFrame:
    return parse_view_line(stream_df, "value", "fail")


LISTS = "batch bigint, item string, other string, cnt bigint"


def _running_stream(spark: SparkSession, sliced: DataFrame, slices: list,
                    seed: DataFrame | None = None) -> tuple[RunningRecommender, DataFrame]:
    """The recommender after replaying the given event slices, each one a
    restart of its queries, and all that it emitted. The seed is passed at the
    first start only."""
    stream = SlicedFileStream(spark, sliced.select("value").schema)
    sink = BatchTableWriter(stream.output_dir)
    reco = None
    for s_id in slices:
        stream.stage(sliced.where(in_event_slice(s_id)).select("value"))
        reco = RunningRecommender(spark, os.path.join(stream.root, "reco"), sink,
                                  initial_state=seed if reco is None else None)
        reco.drain(_parse(stream.read_stream()))
    out = spark.read.schema(LISTS).parquet(stream.output_dir)
    return reco, out.select(F.col("batch").alias("batch_id"), "item", "other", "cnt")


def reco_stream_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: per batch, the whole accumulated neighbour list of every item
    that got a pair in the batch, from Spark's keyed map state."""
    sliced = event_view_slices(spark, sf_dir)
    return _running_stream(spark, sliced, slice_ids(sliced, "slice"))[1]


def reco_stream_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 + A3 + K2: the rendered message per touched item and batch."""
    nested = nest_recommendations(reco_stream_running(spark, sf_dir), keys=("batch_id", "item"))
    return nested.select("batch_id", "item",
                         recommendation_payload("item", "recs").alias("payload"))


def reco_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 for T4: the recommender's keyed state after the last restart, read
    from its checkpoint by the state data source."""
    sliced = event_view_slices(spark, sf_dir)
    return _running_stream(spark, sliced, slice_ids(sliced, "slice"))[0].state()


def reco_stream_warm_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running recommender seeded with the batch recommender's
    result over the first slice (Spark's initial state), then streaming the
    other slices. Batch ids are shifted by one so the output lines up with the
    cold-start run."""
    sliced = event_view_slices(spark, sf_dir)
    ids = slice_ids(sliced, "slice")
    first = sliced.where(in_event_slice(ids[0])).select("value")
    seed = recommendations_flat(parse_view_line(first, "value"), min_support=1)
    out = _running_stream(spark, sliced, ids[1:], seed)[1]
    return out.withColumn("batch_id", F.col("batch_id") + 1)


def reco_window_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 event-time variant: pair counts per 1-day window of event time,
    emitted when the watermark (40 days behind) passes the window end. The
    slices arrive out of order (every two swapped), within the delay; a last
    row closes the windows open at the end of the replay."""
    ev = event_slices(spark, sf_dir)
    item = F.concat(F.col("event_type"),
                    (F.col("event_id") % F.lit(ITEM_VARIANTS)).cast("string"))
    rows = ev.select("slice", "ts", F.col("user_id").cast("string").alias("user"),
                     item.alias("item"))
    stream = SlicedFileStream(spark, rows.drop("slice").schema)
    sink = BatchTableWriter(stream.output_dir)
    delay = 4 * SLICE_DAYS

    def start(stream_df, checkpoint):
        return start_windowed_pairs(stream_df, checkpoint, sink, "ts", "1 day", f"{delay} days")

    ids = slice_ids(rows, "slice")
    for s_id in [s for i in range(0, len(ids), 2) for s in reversed(ids[i:i + 2])]:
        stream.stage(rows.where(in_event_slice(s_id)).drop("slice"))
        stream.run_once(start)
    latest = rows.agg(F.max("ts")).first()[0]
    if latest is not None:
        stream.stage(closing_row(spark, latest, delay + 2))
        stream.run_once(start)
    out = read_batches(spark, stream.output_dir,
                       "window_start timestamp_ntz, window_end timestamp_ntz, a string, "
                       "b string, cnt bigint, batch_id int")
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      "a", "b", "cnt")


def wc_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 for T3: the running counts' keyed state after the last restart, read
    from the checkpoint by the state data source."""
    stream = _update_counts_stream(spark, sf_dir)
    state = spark.read.format("statestore").load(stream.checkpoint_dir)
    return state.select("key.word", F.col("value.count").alias("cnt"))


def wc_stream_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U3 + K1: the running counts' payloads sent partition by partition, one
    transaction per epoch and partition, and read back from the transport."""
    lines = event_slices(spark, sf_dir).select("slice", "ts", F.col("event_type").alias("value"))
    folder = scratch_dir(spark, "delivered")

    def start(stream_df, checkpoint):
        counts = running_word_counts(stream_df, "value", "drop_trailing")
        return start_delivery(counts, word_count_payload("word", "cnt"), "word", checkpoint,
                              FileDelivery(folder), partitions=4)

    _replay(spark, lines, start)
    return read_delivered(spark, folder).select(F.col("epoch").alias("batch_id"), F.col("value").alias("payload"))


STREAM_QUERIES = {
    "wc_stream_delivered": wc_stream_delivered,
    "wc_stream_update": wc_stream_update,
    "stream_restart_counts": stream_restart_counts,
    "wc_stream_warm_start": wc_stream_warm_start,
    "wc_stream_complete": wc_stream_complete,
    "reco_stream_pairs": reco_stream_pairs,
    "reco_stream_running": reco_stream_running,
    "reco_stream_payload": reco_stream_payload,
    "reco_stream_warm_start": reco_stream_warm_start,
    "reco_window_pairs": reco_window_pairs,
    "reco_stream_state": reco_stream_state,
    "wc_stream_state": wc_stream_state,
}
