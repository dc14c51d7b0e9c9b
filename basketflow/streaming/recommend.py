"""The streaming recommender.

Semantics (as in the reference stream job):

* **T5, batch-scoped baskets.** Baskets, pairs and pair counts are computed
  inside each micro-batch: two views pair up only if they arrive in the same
  batch, and the stream keeps every pair (support 1).
* **T4, running recommendation.** Per item, a map ``other -> count`` is
  accumulated over batches. Each batch emits, for every item that got a pair
  in that batch, its *whole* accumulated list, including neighbours not seen
  in this batch. Entries never expire.

Two streaming queries, each with its own checkpoint:

1. *pairs*: counts every micro-batch's pairs with the batch operator
   (``foreachBatch``) and publishes them as one folder per batch, by one
   rename. A replayed batch that is already published is skipped, so a folder
   is seen whole, once.
2. *lists*: reads those folders as a file stream, grouped by (item, salt), and
   keeps the maps as Spark's own keyed state (``transformWithState``, a map
   state per salted item in RocksDB). ``salt`` is a hash of the other item, so a
   popular item's map is spread over ``salts`` keys, tasks and state partitions.
   Every salt of a touched item gets a mark, so that the whole list is emitted.

Rows carry the number of the micro-batch they come from. If *lists* falls
behind and takes several folders at once, it still emits each one's lists.

A warm start (T7) is handed to the first batch of *lists* as Spark's initial
state. It is stored at the first start: later starts need not pass it, and
passing another one raises.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import groupby

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from basketflow.operators.recommender import (
    DEFAULT_BLOCK_SIZE, pair_support, recommendations_flat,
)
from basketflow.session import path_exists, publish, ship_package
from basketflow.streaming.seed import store_seed
from basketflow.streaming.settings import keyed_state_store, stream_partitions

SEED_SCHEMA = "item string, other string, cnt bigint"
DELTA_SCHEMA = "batch bigint, item string, salt int, other string, cnt bigint"
LIST_SCHEMA = "batch bigint, item string, other string, cnt bigint"
#: Name of the map state, for readers of the checkpoint.
STATE_NAME = "counts"
SALTS = 8


class BatchScopedPairs:
    """T5: ``foreachBatch`` function emitting ``(a, b, cnt)`` per batch."""

    def __init__(self, sink: Callable[[DataFrame, int], None], min_basket: int = 2,
                 min_support: int = 1, block_size: int = DEFAULT_BLOCK_SIZE):
        self.sink = sink
        self.min_basket = min_basket
        self.min_support = min_support
        self.block_size = block_size

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        pairs = pair_support(batch, self.min_basket, self.min_support, self.block_size)
        self.sink(pairs, batch_id)


def _salt(other: str, salts: int) -> Column:
    return F.pmod(F.xxhash64(other), F.lit(salts)).cast("int")


class PairDeltas:
    """``foreachBatch`` function that publishes each batch's symmetric pair
    counts, and a mark (``other`` null) for every salt of the items in them, as
    the folder ``batch_id=n``."""

    def __init__(self, spark: SparkSession, root: str, min_basket: int, block_size: int, salts: int):
        self.spark = spark
        self.folder = os.path.join(root, "deltas")
        self.staging = os.path.join(root, "staging")
        self.min_basket = min_basket
        self.block_size = block_size
        self.salts = salts

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        target = os.path.join(self.folder, f"batch_id={batch_id}")
        if path_exists(self.spark, target):
            return
        staged = os.path.join(self.staging, f"batch_id={batch_id}")
        pairs = os.path.join(staged, "pairs")
        number = F.lit(batch_id).cast("bigint").alias("batch")
        (recommendations_flat(batch, self.min_basket, 1, self.block_size)
         .select(number, "item", _salt("other", self.salts).alias("salt"), "other", "cnt")
         .write.mode("overwrite").parquet(pairs))
        every = F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))).alias("salt")
        (self.spark.read.schema(DELTA_SCHEMA).parquet(pairs).select("item").distinct()
         .select(number, "item", every, F.lit(None).cast("string").alias("other"),
                 F.lit(0).cast("bigint").alias("cnt"))
         .write.mode("overwrite").parquet(os.path.join(staged, "touched")))
        publish(self.spark, staged, target)


class RunningList(StatefulProcessor):
    """The accumulated counts of one (item, salt): a map state, passed over
    entry by entry, never held whole."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState(STATE_NAME, "other string", "cnt bigint")

    def _add(self, other: str, cnt: int) -> None:
        old = self.counts.getValue((other,))
        self.counts.updateValue((other,), (cnt + (old[0] if old else 0),))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # This salt's pairs of the batches that came together, oldest first.
        for batch, own in groupby(sorted(rows, key=lambda r: r.batch), lambda r: r.batch):
            for r in own:
                if r.other is not None:
                    self._add(r.other, r.cnt)
            for (other,), (cnt,) in self.counts.iterator():
                yield Row(batch=batch, item=key[0], other=other, cnt=cnt)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self._add(initialState.other, initialState.cnt)

    def close(self) -> None:
        pass


class RunningRecommender:
    """T4 (+T7): the two queries over a stream of views.

    ``sink(df, epoch)`` receives ``(batch, item, other, cnt)``: cumulative
    counts for the items touched in micro-batch ``batch`` of the views (one
    value per epoch unless *lists* has fallen behind). Everything lies below
    ``root``, a shared folder whose renames are atomic, as stream checkpoints
    need them. ``salts`` is fixed at the first start. Published folders are
    removed by the file source once their batch is committed.
    """

    def __init__(self, spark: SparkSession, root: str, sink: Callable[[DataFrame, int], None],
                 min_basket: int = 2, initial_state: DataFrame | None = None,
                 block_size: int = DEFAULT_BLOCK_SIZE, salts: int = SALTS):
        if salts < 1:
            raise ValueError("salts must be positive")
        self.spark = spark
        self.root = root
        self.sink = sink
        self.seed = store_seed(spark, os.path.join(root, "seed"), initial_state, SEED_SCHEMA)
        self.salts = self._stored_salts(salts)
        self.deltas = PairDeltas(spark, root, min_basket, block_size, self.salts)
        self.pairs_checkpoint = os.path.join(root, "pairs-checkpoint")
        self.lists_checkpoint = os.path.join(root, "lists-checkpoint")

    def _stored_salts(self, salts: int) -> int:
        path = os.path.join(self.root, "salts")
        if not path_exists(self.spark, path + "/_SUCCESS"):
            self.spark.range(salts, salts + 1).write.mode("overwrite").parquet(path)
        return self.spark.read.schema("id bigint").parquet(path).first().id

    def start_pairs(self, views: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        return (views.writeStream.option("checkpointLocation", self.pairs_checkpoint)
                .foreachBatch(self.deltas).trigger(**(trigger or {"availableNow": True})).start())

    def start_lists(self, trigger: dict | None = None) -> StreamingQuery:
        ship_package(self.spark)
        if not path_exists(self.spark, self.deltas.folder):
            self.spark.createDataFrame([], DELTA_SCHEMA).write.parquet(
                os.path.join(self.deltas.folder, "none"))
        rows = (self.spark.readStream.schema(DELTA_SCHEMA).option("recursiveFileLookup", "true")
                .option("cleanSource", "delete").parquet(self.deltas.folder))
        seed = self.seed.withColumn("salt", _salt("other", self.salts)).groupBy("item", "salt")
        lists = rows.groupBy("item", "salt").transformWithState(
            RunningList(), LIST_SCHEMA, "Update", "None", seed)
        with keyed_state_store(self.spark):
            return (lists.writeStream.option("checkpointLocation", self.lists_checkpoint)
                    .outputMode("update").foreachBatch(self.sink)
                    .trigger(**(trigger or {"availableNow": True})).start())

    def start(self, views: DataFrame, trigger: dict,
              partitions: int | None = None) -> RunningQueries:
        """Both queries, side by side."""
        with stream_partitions(self.spark, partitions):
            return RunningQueries(self.start_pairs(views, trigger), self.start_lists(trigger))

    def drain(self, views: DataFrame, partitions: int | None = None) -> None:
        """Process what is new in ``views``, pairs first, and stop."""
        with stream_partitions(self.spark, partitions):
            for start in (lambda: self.start_pairs(views), self.start_lists):
                query = start()
                query.awaitTermination()
                if query.exception() is not None:
                    raise RuntimeError(str(query.exception()))

    def state(self) -> DataFrame:
        """(item, other, cnt): the keyed state of the last committed batch,
        read from the checkpoint by the state data source."""
        return (self.spark.read.format("statestore").option("stateVarName", STATE_NAME)
                .load(self.lists_checkpoint)
                .select("key.item", "user_map_key.other", "user_map_value.cnt"))


class RunningQueries:
    """The two queries of a running recommender, handled as one."""

    def __init__(self, pairs: StreamingQuery, lists: StreamingQuery):
        self.pairs = pairs
        self.lists = lists

    def processAllAvailable(self) -> None:  # noqa: N802 - as a StreamingQuery
        self.pairs.processAllAvailable()
        self.lists.processAllAvailable()

    def awaitTermination(self, timeout: int | None = None) -> bool | None:  # noqa: N802
        """Until one of the two ends; the other is stopped then, and a failure
        of either raises."""
        waited = 0
        while self.pairs.isActive and self.lists.isActive and (timeout is None or waited < timeout):
            self.pairs.awaitTermination(1)
            waited += 1
        if self.pairs.isActive and self.lists.isActive:
            return False
        self.stop()
        for query in (self.pairs, self.lists):
            if query.exception() is not None:
                raise RuntimeError(str(query.exception()))
        return True

    def exception(self):
        return self.pairs.exception() or self.lists.exception()

    @property
    def isActive(self) -> bool:  # noqa: N802
        return self.pairs.isActive and self.lists.isActive

    def stop(self) -> None:
        self.pairs.stop()
        self.lists.stop()
