"""Per-partition delivery of streamed rows, nothing sent twice.

``writeStream.foreach`` calls open, process and close once per partition and
micro-batch. :class:`PartitionWriter` turns that into one transaction per
(epoch, partition): messages are staged, and closing commits them together
with a record of the pair. A task that is retried, or a batch that is run again
after a failure, finds the record and sends nothing; one that failed half-way
left nothing behind. Both need a partition to hold the same rows when an epoch
is run again, so :func:`start_delivery` deals rows by a key into a number of
partitions that is fixed at the first start.

:class:`FileDelivery` keeps the messages as files in a shared folder. A broker's
transactional producer fits the same four calls.
"""

from __future__ import annotations

import json
import os
import uuid
from typing import Protocol

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketflow.session import path_exists, ship_package


class Delivery(Protocol):
    """What a transport offers to a partition's writer."""

    def begin(self, partition: int, epoch: int) -> bool:
        """Start a transaction; False if this one is committed already."""

    def send(self, value: str) -> None:
        """Stage one message."""

    def commit(self) -> None:
        """Make the staged messages and the record visible, at once."""

    def abort(self) -> None:
        """Drop the staged messages."""


class FileDelivery:
    """Messages of an epoch's partition as one file of JSON lines. The file
    appears under its final name by a hard link, which fails if another
    attempt was first: file and commit record are the same thing. ``root``
    must be a folder that all executors mount."""

    def __init__(self, root: str):
        self.root = root.removeprefix("file://").removeprefix("file:")
        if "://" in self.root:
            raise ValueError(f"{root} is no mounted folder")

    def begin(self, partition: int, epoch: int) -> bool:
        self.final = os.path.join(self.root, f"epoch={epoch}", f"part-{partition:05d}.json")
        if os.path.exists(self.final):
            return False
        os.makedirs(os.path.dirname(self.final), exist_ok=True)
        os.makedirs(os.path.join(self.root, "_attempts"), exist_ok=True)
        self.attempt = os.path.join(self.root, "_attempts", uuid.uuid4().hex)
        self.file = open(self.attempt, "w", encoding="utf-8")
        return True

    def send(self, value: str) -> None:
        self.file.write(json.dumps({"value": value}) + "\n")

    def commit(self) -> None:
        self.file.flush()
        os.fsync(self.file.fileno())
        self.file.close()
        try:
            os.link(self.attempt, self.final)
        except FileExistsError:
            pass
        os.unlink(self.attempt)

    def abort(self) -> None:
        self.file.close()
        os.unlink(self.attempt)


class PartitionWriter:
    """Row-level writer for ``writeStream.foreach``: sends the ``value`` column
    of each row through a :class:`Delivery`."""

    def __init__(self, delivery: Delivery):
        self.delivery = delivery
        self.live = False

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.live = self.delivery.begin(partition_id, epoch_id)
        return self.live

    def process(self, row: Row) -> None:
        self.delivery.send(row.value)

    def close(self, error: Exception | None) -> None:
        if not self.live:
            return
        self.live = False
        if error is None:
            self.delivery.commit()
        else:
            self.delivery.abort()


def start_delivery(rows: DataFrame, value: Column, key: str, checkpoint: str, delivery: Delivery,
                   partitions: int, output_mode: str = "update",
                   trigger: dict | None = None) -> StreamingQuery:
    """Send ``value`` of every streamed row, partition by partition. Rows are
    dealt by ``key`` into ``partitions`` partitions; the number of the first
    start holds for all later ones (stored next to the checkpoint)."""
    spark = rows.sparkSession
    ship_package(spark)
    stored = checkpoint.rstrip("/") + "-partitions"
    if not path_exists(spark, stored + "/_SUCCESS"):
        spark.range(partitions, partitions + 1).write.mode("overwrite").parquet(stored)
    fixed = spark.read.schema("id bigint").parquet(stored).first().id
    return (rows.select(F.col(key), value.cast("string").alias("value")).repartition(fixed, key)
            .writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
            .foreach(PartitionWriter(delivery)).trigger(**(trigger or {"availableNow": True})).start())


def read_delivered(spark: SparkSession, root: str) -> DataFrame:
    """``(value, epoch)`` of the committed messages of a :class:`FileDelivery`."""
    return spark.read.schema("value string, epoch bigint").json(root)
