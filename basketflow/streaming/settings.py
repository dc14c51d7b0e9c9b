"""Settings of streaming queries: partitions and the store of keyed state.

A streaming query copies the session's settings when it starts. Its stateful
operators use ``spark.sql.shuffle.partitions`` as it was at the query's *first*
start, which is then fixed in the checkpoint: AQE never changes the number of
state partitions. So the count is chosen explicitly per query: by default one
partition per core of the cluster, which keeps every state-store partition busy
without the overhead of hundreds of near-empty tasks per micro-batch.

Keyed map state (``transformWithState``) needs the RocksDB state store. It is
set for the query itself, so a session that was built elsewhere will do.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from basketflow.session import STATE_STORE_CONF

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def default_state_partitions(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


@contextmanager
def stream_partitions(spark: SparkSession, partitions: int | None = None) -> Iterator[int]:
    """Set the shuffle partitions seen by a query started inside the block;
    the session's own value is restored afterwards."""
    n = partitions or default_state_partitions(spark)
    with _settings(spark, {SHUFFLE_PARTITIONS: str(n)}):
        yield n


@contextmanager
def keyed_state_store(spark: SparkSession) -> Iterator[None]:
    """RocksDB as the state store of a query started inside the block,
    whatever the session has; its own settings are restored afterwards."""
    with _settings(spark, STATE_STORE_CONF):
        yield


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    old = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
