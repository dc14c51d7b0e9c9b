"""Nearest neighbours with one vantage-point tree per shard.

Rows are dealt to shards of bounded size. A shard's task builds a tree: every
node picks a vantage point, splits its vectors at the median distance to it
and keeps both halves' distance ranges. Blocks of queries go through every
shard's tree together; a half is left out for a query when ``factor`` times
the triangle-inequality bound exceeds the distance of its k-th best so far.
Factor 1 leaves out only what cannot matter (exact search); larger factors
prune more and may miss. A query's best of all shards are ranked at the end.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.vectors import usable
from basketflow.llm.words import ready

#: Rows in a shard, vectors in a leaf and queries in a block.
SHARD = 8192
LEAF = 128
QUERIES = 256


class VPTree:
    """Tree over the rows of a matrix, which it reorders leaf by leaf."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, seed: int = 0):
        self.rng = np.random.Generator(np.random.PCG64([seed, len(ids)]))
        self.ids, self.x = ids, x
        self.order = np.arange(len(ids))
        self.root = self._build(0, len(ids))
        self.ids, self.x = ids[self.order], np.ascontiguousarray(x[self.order])
        del self.order

    def _build(self, lo: int, hi: int):
        if hi - lo <= LEAF:
            return lo, hi
        rows = self.order[lo:hi]
        point = self.x[rows[self.rng.integers(hi - lo)]].copy()
        d = distances(point[None], self.x[rows])[0]
        by = np.argsort(d, kind="stable")
        self.order[lo:hi], d = rows[by], d[by]
        mid = (hi - lo) // 2
        return (point, float(d[mid - 1]), (float(d[0]), float(d[mid - 1])), (float(d[mid]), float(d[-1])),
                self._build(lo, lo + mid), self._build(lo + mid, hi))

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, factor: float = 1.0):
        """(distances, ids) of the k best per query, nearest first, ties to
        the smaller id; rows with the query's own id are left out and missing
        places have distance infinity. ``self.seen`` counts distances worked
        out."""
        best = np.full((len(q), k), np.inf)
        names = np.full((len(q), k), np.iinfo(np.int64).max)
        self.seen = 0

        def leaf(lo: int, hi: int, at: np.ndarray) -> None:
            d = distances(q[at], self.x[lo:hi])
            self.seen += d.size
            ids = np.broadcast_to(self.ids[lo:hi], d.shape)
            d[ids == query_ids[at][:, None]] = np.inf
            d, ids = np.concatenate([best[at], d], axis=1), np.concatenate([names[at], ids], axis=1)
            first = np.lexsort((ids, d), axis=1)[:, :k]
            best[at], names[at] = np.take_along_axis(d, first, 1), np.take_along_axis(ids, first, 1)

        def visit(node, at: np.ndarray) -> None:
            if not len(at):
                return
            if len(node) == 2:
                leaf(*node, at)
                return
            point, edge, inner, outer, left, right = node
            d = distances(q[at], point[None])[:, 0]
            self.seen += len(at)
            inside = d <= edge
            visit(left, at[inside])
            visit(right, at[~inside])
            for side, (low, high), mine in ((right, outer, inside), (left, inner, ~inside)):
                bound = np.maximum(np.maximum(low - d[mine], d[mine] - high), 0.0)
                reach = best[at[mine], k - 1] * (1 + 1e-12)
                visit(side, at[mine][factor * bound <= reach])

        if len(self.ids):
            visit(self.root, np.arange(len(q)))
        names[np.isinf(best)] = np.iinfo(np.int64).max
        return best, names


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of a and b, by differences."""
    out, step = np.empty((len(a), len(b))), max(1, 1_000_000 // max(1, b.size))
    for lo in range(0, len(a), step):
        diff = a[lo:lo + step, None, :] - b[None, :, :]
        out[lo:lo + step] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.0, shard: int = SHARD,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest rows of ``vectors`` for each row of ``queries`` (both with
    ``id_col`` and ``vector_col``): (query_id, rank, id_col, score), score the
    Euclidean distance in double precision, ties to the smaller id. Rows with
    a query's own id are no candidates for it; fewer than k candidates give
    fewer rows.

    Ids are integers; rows without one take no part, nor do vectors that are
    null, empty, zero or hold null or non-finite components. Vectors meet only
    vectors of their own length. Rows that repeat an id count each; empty
    tables give an empty result; other columns are ignored.
    """
    def able(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")) \
            .where(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))

    ready(vectors.sparkSession, 4096)
    rows, asked = able(vectors), able(queries)
    shards = max(1, math.ceil(rows.count() / shard))
    held = rows.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int")).withColumn("ask", F.lit(False))
    sent = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("ask", F.lit(True))
    cols = ["shard", "dim", "ask", "id", "v"]
    # One shard per partition as far as the hash allows; queries follow its rows.
    dealt = held.select(*cols).union(sent.select(*cols)).repartition(shards, "shard", "dim") \
        .sortWithinPartitions("shard", "dim", "ask")
    found = dealt.mapInArrow(_search_shards(k, factor), "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", F.col("id").alias(id_col), "score")


def _search_shards(k: int, factor: float):
    def run(batches):
        now, tree, ids, rows, ask_ids, ask = None, None, [], [], [], []

        def answer():
            nonlocal ask_ids, ask
            if ask and tree is not None:
                q_ids, q = np.concatenate(ask_ids), np.concatenate(ask)
                for lo in range(0, len(q), QUERIES):
                    d, names = tree.search(q_ids[lo:lo + QUERIES], q[lo:lo + QUERIES], k, factor)
                    at, place = np.nonzero(np.isfinite(d))
                    yield pa.record_batch([pa.array(q_ids[lo:lo + QUERIES][at]), pa.array(names[at, place]), pa.array(d[at, place])],
                                          names=["query_id", "id", "score"])
            ask_ids, ask = [], []

        for batch in batches:
            shard, dim, asks, vec = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            lists = batch.column(4)
            flat, offs = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            offs = offs - offs[0]
            cut = np.flatnonzero((np.diff(shard) != 0) | (np.diff(dim) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(vec)]):
                if (shard[lo], dim[lo]) != now:
                    yield from answer()
                    now, tree, ids, rows = (shard[lo], dim[lo]), None, [], []
                part = flat[offs[lo]:offs[hi]].reshape(hi - lo, dim[lo])
                if not asks[lo]:
                    ids.append(vec[lo:hi])
                    rows.append(part)
                    continue
                if tree is None and rows:
                    tree = VPTree(np.concatenate(ids), np.concatenate(rows), int(shard[lo]))
                ask_ids.append(vec[lo:hi])
                ask.append(part)
                if sum(map(len, ask_ids)) >= QUERIES:
                    yield from answer()
        yield from answer()

    return run
