"""Embedding near-duplicates by random-hyperplane signs.

Each of several tables cuts the space by random hyperplanes; the signs of a
vector's projections are its code in that table, and vectors that agree on one
code are compared by exact cosine. The number of planes follows the number of
vectors (so that unrelated vectors rarely meet) and the number of tables
follows the planes (so that a pair at the threshold is found with the same
probability at every size). Equal vectors are compared once. A code's vectors
are compared block by block and a pair is counted in its first common table
only, so no pairs are written and no code is gathered whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.llm.blocks import by_spot, in_blocks
from basketflow.llm.graph import components, written
from basketflow.llm.words import ready

#: Vectors in a block of one code.
BLOCK = 256
#: Unrelated vectors of a label that may share a code, on average.
SHARED = 4


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: not null or empty, no null, infinite
    or not-a-number component, and not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def plan_tables(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """(planes per table, tables) for n vectors of one label: a pair at the
    threshold shares no code with probability at most ``miss``."""
    planes = min(31, max(8, math.ceil(math.log2(max(1, n) / SHARED))))
    agree = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, math.ceil(math.log(miss) / math.log(1 - agree))


def _coder(dim_seed: int, planes: int, tables: int):
    """Codes (vectors, tables) of a matrix, by fixed hyperplanes."""
    cache: dict[int, np.ndarray] = {}

    def codes(m: np.ndarray) -> np.ndarray:
        d = m.shape[1]
        if d not in cache:
            cache.clear()
            cache[d] = np.random.Generator(np.random.PCG64([dim_seed, d])).standard_normal((d, planes * tables))
        bits = ((m / np.abs(m).max(axis=1, keepdims=True)) @ cache[d] > 0).reshape(len(m), tables, planes)
        return bits.astype(np.int64) @ (1 << np.arange(planes, dtype=np.int64))

    return codes


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, miss: float = 1e-3, seed: int = 5,
                    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Links between vectors of equal, non-null label with cosine (in double
    precision) of at least ``threshold``, and their components.

    Returns per row ``(id_col, n_links, component_id, kept)``: other rows
    linked directly, smallest id reachable by links, and whether that is the
    row's own. Ids are integers. Vectors that are null, empty, zero or hold
    null or non-finite components, and rows without a label or an id, link
    with nothing (component: their own id); so do vectors of different
    lengths. Rows that repeat an id count each. An empty table gives an empty
    result; other columns are ignored.
    """
    ready(vectors.sparkSession, 4096)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    able = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    # Equal vectors of a label are one class, named by its smallest id.
    keyed = able.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), F.col("v")))
    classes = written(keyed.groupBy("label", "h1", "h2").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v"))
        .withColumn("key", F.xxhash64("label", "h1", "h2")), "vector-classes")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    planes, tables = plan_tables(most, threshold, miss)
    coded = written(classes.select("key", "rep", "copies", "label", "v").mapInArrow(
        _code_rows(seed, planes, tables),
        "key long, rep long, copies long, label string, dim int, vector binary, codes binary, code array<long>"), "vector-codes")
    shelf = coded.select("key", "rep", "label", "dim", F.posexplode("code").alias("t", "code"))
    place = ["label", "dim", "t", "code"]
    # Codes with more vectors than a block are met block by block. Vectors come
    # last: only the exchange by spot carries them.
    dealt = in_blocks(shelf, place, "key", BLOCK).select("spot", "t", "block", "cross", "key", "rep") \
        .join(coded.select("key", "rep", "copies", "vector", "codes"), ["key", "rep"]) \
        .select("spot", "t", "block", "cross", "key", "rep", "copies", "vector", "codes") \
        .repartition("spot").sortWithinPartitions("spot", "key")
    found = written(dealt.mapInArrow(_compare_rows(threshold), "key long, links long, a long, b long"), "vector-links")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    graph = components(found.where("a > b").select("a", "b"), "vector-components")
    named = classes.join(links, "key", "left").join(graph, classes["rep"] == graph["node"], "left") \
        .select("label", "h1", "h2", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("component"))
    key = [F.when(usable(F.col("v")) & F.col("id").isNotNull(), F.col("label")).alias("label"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), F.col("v")).alias("h2")]
    out = rows.select("id", *key).join(named, ["label", "h1", "h2"], "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))


def _code_rows(seed: int, planes: int, tables: int):
    """Adds to (key, rep, copies, label, v) the length, the packed vector and
    its codes, packed and as an array."""
    def run(batches):
        coder = _coder(seed, planes, tables)
        for batch in batches:
            lists = batch.column(4)
            flat, offs = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            size, offs = np.diff(offs), offs - offs[0]
            codes = np.zeros((batch.num_rows, tables), dtype="<i8")
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                codes[at] = coder(flat[offs[at][:, None] + np.arange(d)])
            packed = [flat[a:a + n].astype("<f8").tobytes() for a, n in zip(offs.tolist(), size.tolist())]
            array = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, tables, dtype=np.int32), pa.array(codes.ravel()))
            yield pa.record_batch([*(batch.column(i) for i in range(4)), pa.array(size, pa.int32()), pa.array(packed, pa.binary()),
                                   pa.array([c.astype("<u4").tobytes() for c in codes], pa.binary()), array],
                                  names=["key", "rep", "copies", "label", "dim", "vector", "codes", "code"])

    return run


def _compare_rows(threshold: float):
    """From rows (spot, t, block, cross, key, rep, copies, vector, codes)
    sorted by spot: per vector and spot the copies it links with for the first
    time and the smallest name in its linked group of the spot."""
    def compare(rows: list[np.ndarray]):
        spot, t, block, cross, key, rep, copies, vector, codes = rows
        n, width = len(spot), max(map(len, vector)) // 8
        x = np.zeros((n, width))
        for i, v in enumerate(vector):
            x[i, :len(v) // 8] = np.frombuffer(v, "<f8")
        big = np.abs(x).max(axis=1, keepdims=True)
        u = x / big
        u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
        code = np.frombuffer(b"".join(codes), "<u4").reshape(n, -1)
        near_i, near_j, new = [], [], []
        for d in range(1, n):
            at = np.flatnonzero(spot[d:] == spot[:-d])
            if not len(at):
                break
            at = at[~cross[at] | (block[at] != block[at + d])]
            for lo in range(0, len(at), 4096):
                i = at[lo:lo + 4096]
                j = i + d
                cos = np.einsum("ij,ij->i", u[i], u[j])
                hit = cos >= threshold - 1e-9
                close = np.flatnonzero(hit & (cos < threshold + 1e-9))
                if len(close):
                    a, b = x[i[close]], x[j[close]]
                    exact = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
                    hit[close] = exact >= threshold
                i, j = i[hit], j[hit]
                if len(i):
                    met = ((code[i] == code[j]) & (np.arange(code.shape[1]) < t[i][:, None])).any(axis=1)
                    near_i.append(i)
                    near_j.append(j)
                    new.append(~met)
        if not near_i:
            return
        i, j, new = np.concatenate(near_i), np.concatenate(near_j), np.concatenate(new)
        links, label = np.zeros(n, dtype=np.int64), rep.copy()
        np.add.at(links, i[new], copies[j[new]])
        np.add.at(links, j[new], copies[i[new]])
        while True:
            was = label.copy()
            np.minimum.at(label, i, label[j])
            np.minimum.at(label, j, label[i])
            if (was == label).all():
                break
        out = np.unique(np.concatenate([i, j]))
        out = out[(links[out] > 0) | (label[out] < rep[out])]
        if len(out):
            yield pa.record_batch([pa.array(c[out]) for c in (key, links, rep, label)], names=["key", "links", "a", "b"])

    return by_spot(compare)
