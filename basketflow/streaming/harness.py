"""Driving file streams in exact micro-batches (tests, replays, backfills).

Each slice of an input is written as its own folder under a source folder,
then the streaming query is (re)started from its checkpoint with
``trigger(availableNow=True)``: it processes exactly the files it has not
seen, as one micro-batch, and stops. Slice ``k`` is therefore micro-batch
``k`` and every slice after the first is also a restart from the checkpoint.
All folders live under the shared checkpoint folder.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from basketflow.session import scratch_dir
from basketflow.streaming.settings import stream_partitions


class SlicedFileStream:
    """A parquet file source fed one slice at a time."""

    def __init__(self, spark: SparkSession, schema: StructType, root: str | None = None,
                 partitions: int | None = None):
        self.spark = spark
        self.partitions = partitions
        self.schema = schema
        self.root = root or scratch_dir(spark, "stream")
        self.source_dir = os.path.join(self.root, "source")
        self.checkpoint_dir = os.path.join(self.root, "checkpoint")
        self.output_dir = os.path.join(self.root, "output")
        self.slices = 0

    def stage(self, df: DataFrame) -> None:
        """Write the next slice (in parallel; many files are fine)."""
        path = os.path.join(self.source_dir, f"slice-{self.slices:06d}")
        df.select(*[f.name for f in self.schema.fields]).write.mode("overwrite").parquet(path)
        self.slices += 1

    def read_stream(self) -> DataFrame:
        """The streaming DataFrame over every staged slice."""
        return (self.spark.readStream.schema(self.schema)
                .option("recursiveFileLookup", "true")
                .parquet(self.source_dir))

    def run_once(self, start: Callable[[DataFrame, str], StreamingQuery]) -> None:
        """Start the query from the checkpoint and let it drain what is new.

        ``start(stream_df, checkpoint_dir)`` must build and start the query
        with ``trigger(availableNow=True)``.
        """
        with stream_partitions(self.spark, self.partitions):
            query = start(self.read_stream(), self.checkpoint_dir)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))

    def run_slices(self, slices: Sequence[DataFrame],
                   start: Callable[[DataFrame, str], StreamingQuery]) -> None:
        """Stage and process each slice in turn: one micro-batch per slice."""
        for df in slices:
            self.stage(df)
            self.run_once(start)


def slice_ids(df: DataFrame, col: str) -> list:
    """The distinct slice numbers or names, sorted, null last (a handful of values)."""
    return sorted((r[0] for r in df.select(col).distinct().collect()), key=lambda s: (s is None, s))
