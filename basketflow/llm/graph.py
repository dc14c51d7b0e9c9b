"""Distributed connected components by alternating star contraction."""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.words import ready
from basketflow.session import scratch_dir

#: Edges that one task reduces at a time, and edges per task of later steps.
CHUNK = 2_000_000
EDGES = 50_000


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: a lineage
    cut that survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps: it removes
    those that no live plan refers to, but only looks when the driver collects
    its garbage, which a small driver may not do for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _forest(batches):
    """Edges of the components of a task's edges: every node with the smallest
    one of its component, CHUNK edges at a time. Narrows the graph before it
    is shuffled."""
    def star(parts):
        a, b = (np.concatenate(c) for c in zip(*parts))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        i, j, label = at[:len(a)], at[len(a):], np.arange(len(nodes))
        while True:
            was = label.copy()
            least = np.minimum(label[i], label[j])
            np.minimum.at(label, i, least)
            np.minimum.at(label, j, least)
            label = label[label]
            if (was == label).all():
                break
        return pa.record_batch([pa.array(nodes), pa.array(nodes[label])], names=["a", "b"])

    parts, n = [], 0
    for batch in batches:
        parts.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        n += batch.num_rows
        if n >= CHUNK:
            yield star(parts)
            parts, n = [], 0
    if n:
        yield star(parts)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns ``a``,
    ``b``); the component is its smallest node. Self loops only name a node;
    rows with a null end are ignored.

    Edges are made distinct, then every task reduces its own to a forest of stars. Then
    large-star and small-star steps alternate until the edges stop changing:
    every node hangs its larger neighbours, then its smaller ones, below the
    smallest one. Rounds grow with the logarithm of the longest path. A node
    with very many neighbours is met by a partially aggregated minimum and a
    join with the table of minima, written first so that Spark can split the
    join; nothing is gathered.
    """
    spark = edges.sparkSession
    ready(spark, 10_000)
    pair = "a long, b long"
    # Equal edges of all tasks first: else each task repeats a hub's star.
    cur = written(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
                  .where("a is not null and b is not null").distinct().mapInArrow(_forest, pair), name)
    seen = None
    while True:
        mark = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
        if mark == seen:
            break
        seen = mark
        # No more tasks than the edges need: late rounds are small.
        few = max(4, mark[0] // EDGES)
        stars = cur.mapInArrow(_forest, pair)
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).coalesce(few), name)
        large = written(both.join(low, "a").where("b >= a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                        .coalesce(few).distinct().coalesce(few), name)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(low, "a").coalesce(few)
        small = hung.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                              F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")) \
            .select("e.*").distinct().coalesce(few)
        cur = written(small, name)
    return cur.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
