"""Writers: idempotent per-batch parquet, per-partition delivery, Kafka payload topics, console."""

from basketflow.sinks.delivery import FileDelivery, PartitionWriter, read_delivered, start_delivery
from basketflow.sinks.writers import (
    BatchTableWriter, console_sink, kafka_write_batch, read_batches,
)

__all__ = ["BatchTableWriter", "FileDelivery", "PartitionWriter", "console_sink", "kafka_write_batch",
           "read_batches", "read_delivered", "start_delivery"]
