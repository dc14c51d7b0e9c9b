"""Readers: text views, declared-schema CSV, nested JSON, Kafka, file streams."""

from basketflow.sources.views import read_text_lines, views_from_table, views_from_text
from basketflow.sources.csv import read_csv_by_position
from basketflow.sources.json import flatten_product_views, read_product_views
from basketflow.sources.kafka import kafka_options, read_kafka_stream

__all__ = [
    "read_text_lines", "views_from_table", "views_from_text", "read_csv_by_position",
    "flatten_product_views", "read_product_views", "kafka_options", "read_kafka_stream",
]
