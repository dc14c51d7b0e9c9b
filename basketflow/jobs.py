"""The five reference jobs as runnable Spark jobs.

    python -m basketflow.jobs recommend-batch --views data/views.txt --out /shared/recs
    python -m basketflow.jobs recommend-stream --brokers b:9092 --topics views \\
        --out-topic recs --checkpoint /shared/ckpt/reco
    python -m basketflow.jobs word-count-stateful --brokers b:9092 --topics wc-topic \\
        --checkpoint /shared/ckpt/wc
    python -m basketflow.jobs word-count-structured --brokers b:9092 --topics wc-topic \\
        --checkpoint /shared/ckpt/wcs
    python -m basketflow.jobs churn --csv churn.all/ --model-out /shared/models/churn

Streams read Kafka when ``--brokers`` is given, else a folder of text files
(``--input-dir``). Every stream keeps its state under ``--checkpoint`` and
resumes from it on restart.
"""

from __future__ import annotations

import argparse
import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from basketflow.functions.parse import message_value, parse_view_line
from basketflow.functions.payload import recommendation_payload, word_count_payload
from basketflow.ml.evaluation import auroc
from basketflow.ml.features import hash_split, random_split, with_sides
from basketflow.ml.models import churn_pipeline, product_pipeline, save_model
from basketflow.operators.recommender import cooccurrence, nest_recommendations
from basketflow.session import get_session
from basketflow.sinks.writers import BatchTableWriter, console_sink, kafka_write_batch
from basketflow.sources.csv import CHURN_SCHEMA, PRODUCT_SCHEMA, read_csv_by_position
from basketflow.sources.kafka import read_kafka_stream
from basketflow.sources.views import views_from_text
from basketflow.streaming.counts import running_word_counts, with_stored_seed
from basketflow.streaming.observed import BatchLog, observed
from basketflow.streaming.recommend import RunningQueries, RunningRecommender
from basketflow.streaming.settings import stream_partitions
from basketflow.streaming.triggers import (
    RECOMMENDER_INTERVAL, STATEFUL_WORD_COUNT_INTERVAL, STRUCTURED_WORD_COUNT_INTERVAL,
    with_trigger,
)

# Default topic of the stateful word count's results.
WORD_COUNT_RESULT_TOPIC = "wc-result"
# Entries of a recommendation list per row or message; longer lists continue
# in further rows.
MAX_PER_ROW = 10_000


# ---- J1: batch recommender -------------------------------------------------
def batch_recommendations(spark: SparkSession, views_path: str, out_path: str,
                          min_support: int = 2, prune: bool = False,
                          on_malformed: str = "fail",
                          max_per_row: int | None = MAX_PER_ROW) -> DataFrame:
    """Text views -> ``(item, recs, payload)`` written as parquet.

    The result is written, not collected: it has one row per item (or per
    item part with ``max_per_row``).
    """
    views = views_from_text(spark, views_path, on_malformed)
    recs = cooccurrence(views, min_support=min_support, prune=prune,
                        max_per_row=max_per_row)
    out = recs.withColumn("payload", recommendation_payload("item", "recs"))
    out.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


# ---- stream sources ----------------------------------------------------------
def message_lines(spark: SparkSession, brokers: str | None, topics: str | None,
                  input_dir: str | None) -> DataFrame:
    """Streaming ``value`` strings from Kafka or from a folder of text files."""
    if brokers:
        return read_kafka_stream(spark, brokers, topics).select(
            message_value("value").alias("value"))
    if not input_dir:
        raise ValueError("give --brokers/--topics or --input-dir")
    return spark.readStream.text(input_dir)


# ---- J2: streaming recommender ---------------------------------------------
def streaming_recommendations(spark: SparkSession, lines: DataFrame, checkpoint: str,
                              out_topic: str | None = None, brokers: str | None = None,
                              out_path: str | None = None,
                              interval: str = RECOMMENDER_INTERVAL,
                              initial_state: DataFrame | None = None,
                              max_per_row: int | None = MAX_PER_ROW) -> RunningQueries:
    """Each batch: batch-scoped pairs, merged into the running per-item lists;
    the full list of every touched item goes to Kafka (K2) or parquet, in
    several messages if it is longer than ``max_per_row``."""
    def emit(current: DataFrame, batch_id: int) -> None:
        nested = nest_recommendations(current, ("batch", "item"), max_per_row)
        two_sinks = bool(brokers and out_topic and out_path)
        if two_sinks:  # C1: compute the batch's lists once for both writes
            nested = nested.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if brokers and out_topic:
                kafka_write_batch(nested, recommendation_payload("item", "recs"), brokers,
                                  out_topic)
            if out_path:
                BatchTableWriter(out_path).write(
                    nested.withColumn("payload", recommendation_payload("item", "recs")),
                    batch_id)
        finally:
            if two_sinks:
                nested.unpersist()

    reco = RunningRecommender(spark, checkpoint, emit, initial_state=initial_state)
    return reco.start(parse_view_line(lines, "value"), {"processingTime": interval})


# ---- J3: stateful word count -------------------------------------------------
def stateful_word_count(lines: DataFrame, checkpoint: str, brokers: str | None = None,
                        out_topic: str = WORD_COUNT_RESULT_TOPIC,
                        out_path: str | None = None,
                        interval: str = STATEFUL_WORD_COUNT_INTERVAL,
                        initial_state: DataFrame | None = None) -> StreamingQuery:
    """Running totals (update mode); each batch prints its first rows (K4) and
    sends ``(word,count)`` per touched word (K1). ``initial_state``
    ``(word, cnt)`` seeds the totals (empty by default, as in the reference)."""
    counts = running_word_counts(lines, "value", "drop_trailing")

    def emit(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            batch.show(10, truncate=False)
            if brokers:
                kafka_write_batch(batch, word_count_payload(), brokers, out_topic)
            if out_path:
                BatchTableWriter(out_path).write(
                    batch.withColumn("payload", word_count_payload()), batch_id)
        finally:
            batch.unpersist()

    sink = with_stored_seed(lines.sparkSession, checkpoint, emit, initial_state)
    writer = with_trigger(observed(counts).writeStream.outputMode("update")
                          .option("checkpointLocation", checkpoint).foreachBatch(sink), interval)
    with stream_partitions(lines.sparkSession):
        return writer.start()


# ---- J4: structured word count -----------------------------------------------
def structured_word_count(lines: DataFrame, checkpoint: str,
                          interval: str = STRUCTURED_WORD_COUNT_INTERVAL) -> StreamingQuery:
    """Whole table re-printed every trigger (complete mode, console)."""
    counts = running_word_counts(lines, "value", "keep_all")
    writer = with_trigger(console_sink(observed(counts), "complete", num_rows=20)
                          .option("checkpointLocation", checkpoint), interval)
    with stream_partitions(lines.sparkSession):
        return writer.start()


# ---- J5: classification ----------------------------------------------------
def churn_classification(spark: SparkSession, csv_path: str, kind: str = "rf",
                         seed: int | None = 42, split_key: str | None = None,
                         model_out: str | None = None) -> tuple[DataFrame, float]:
    """CSV by position -> 70/30 split -> pipeline -> AUROC on the test side."""
    data = read_csv_by_position(spark, csv_path, CHURN_SCHEMA)
    train, test = hash_split(data, split_key) if split_key else random_split(data, 0.7, seed)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = churn_pipeline(kind, seed=seed).fit(train)
    finally:
        train.unpersist()
    if model_out:
        save_model(model, model_out)
    predictions = model.transform(test)
    value = auroc(predictions) if kind != "dtr" else float("nan")
    return predictions, value


def product_classification(spark: SparkSession, csv_path: str, seed: int | None = 42,
                           max_bins: int = 600) -> DataFrame:
    """Product-flag CSV -> 11 keep indexers + forest; scores both sides, told
    apart by ``side``."""
    data = read_csv_by_position(spark, csv_path, PRODUCT_SCHEMA)
    train, test = random_split(data, 0.7, seed)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = product_pipeline(max_bins, seed).fit(train)
    finally:
        train.unpersist()
    return model.transform(with_sides(train, test))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="basketflow.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    b = sub.add_parser("recommend-batch")
    b.add_argument("--views", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--min-support", type=int, default=2)
    b.add_argument("--prune", action="store_true")
    b.add_argument("--max-per-row", type=int, default=MAX_PER_ROW)
    for name in ("recommend-stream", "word-count-stateful", "word-count-structured"):
        s = sub.add_parser(name)
        s.add_argument("--brokers")
        s.add_argument("--topics")
        s.add_argument("--input-dir")
        s.add_argument("--checkpoint")
        s.add_argument("--out-topic")
        s.add_argument("--out-path")
        if name != "word-count-structured":
            s.add_argument("--initial-state", help="Parquet folder with the totals to start from")
    c = sub.add_parser("churn")
    c.add_argument("--csv", required=True)
    c.add_argument("--kind", default="rf", choices=["rf", "dt", "gbt", "dtr"])
    c.add_argument("--seed", type=int, default=42)
    c.add_argument("--model-out")
    d = sub.add_parser("product")
    d.add_argument("--csv", required=True)
    args = p.parse_args(argv)

    spark = get_session()
    if args.job == "recommend-batch":
        batch_recommendations(spark, args.views, args.out, args.min_support, args.prune,
                              max_per_row=args.max_per_row)
    elif args.job == "churn":
        read_csv_by_position(spark, args.csv, CHURN_SCHEMA).show()
        preds, value = churn_classification(spark, args.csv, args.kind, args.seed,
                                            model_out=args.model_out)
        preds.show()
        print(value)
    elif args.job == "product":
        scored = product_classification(spark, args.csv)
        for side in ("train", "test"):
            scored.where(scored["side"] == side).show()
    else:
        if not args.checkpoint:
            p.error(f"{args.job} needs --checkpoint (a shared folder for its state)")
        lines = message_lines(spark, args.brokers, args.topics, args.input_dir)
        start = getattr(args, "initial_state", None)
        initial = spark.read.parquet(start) if start else None
        if args.job == "recommend-stream":
            q = streaming_recommendations(spark, lines, args.checkpoint, args.out_topic,
                                          args.brokers, args.out_path, initial_state=initial)
        elif args.job == "word-count-stateful":
            q = stateful_word_count(lines, args.checkpoint, args.brokers,
                                    args.out_topic or WORD_COUNT_RESULT_TOPIC, args.out_path,
                                    initial_state=initial)
        else:
            q = structured_word_count(lines, args.checkpoint)
        # One line per micro-batch, from Spark's listener.
        spark.streams.addListener(BatchLog(print))
        q.awaitTermination()


if __name__ == "__main__":
    main()
