"""Kafka topics as a streaming DataFrame.

The Kafka connector jar must be on the classpath (``--packages
org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>``). Everything
downstream only needs a streaming DataFrame with a ``value`` column, so tests
drive the same operators from file streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(brokers: str, topics: str | list[str],
                  starting_offsets: str = "latest", extra: dict | None = None) -> dict:
    """Reader options. ``topics`` may be a comma list or a list.

    ``latest`` matches a consumer with no ``auto.offset.reset`` setting.
    """
    if isinstance(topics, (list, tuple)):
        topics = ",".join(topics)
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": topics,
            "startingOffsets": starting_offsets}
    opts.update(extra or {})
    return opts


def read_kafka_stream(spark: SparkSession, brokers: str, topics: str | list[str],
                      starting_offsets: str = "latest", extra: dict | None = None) -> DataFrame:
    """Streaming rows ``(key, value, topic, partition, offset, timestamp, ...)``."""
    reader = spark.readStream.format("kafka")
    for k, v in kafka_options(brokers, topics, starting_offsets, extra).items():
        reader = reader.option(k, v)
    return reader.load()
