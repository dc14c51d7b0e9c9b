"""Mixing sources to target weights by balanced (cube-method) sampling.

Every document of a source has the same expected number of copies, the
source's target divided by its size. The whole part is taken for certain; the
fraction is an inclusion probability that the cube method rounds: a flight
moves the probabilities of a few documents at a time along the null space of
the balancing constraints (words and documents) until each is 0 or 1, so both
totals stay where they are. Flights run in bounded blocks; what stays
undecided (at most two documents a block) meets in blocks of the next level,
until one small landing problem per source is left.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.graph import written
from basketflow.llm.words import ready, word_count

#: Mean documents in a block of the flight.
BLOCK = 2048
#: Blocks whose undecided documents meet in one block of the next level.
FAN_IN = 512
#: Open documents of a source that the landing rounds by enumeration.
LANDING = 10
EDGE = 1e-9


def source_targets(totals: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, n, target) from (source, source_size, n).

    Sources in code-point order (null last) weigh ``weights`` in turn and share
    ``share`` times all words; a target stops at ``cap`` times its source's
    words and the excess is shared again by weight until none is above. That
    fixed point is a water level: with sources sorted by cap per weight, the
    level is the rest over the remaining weights at the first source that stays
    below its cap. The windows hold one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("w", w).withColumn("top", F.col("source_size") * F.lit(float(cap)))
    t = t.withColumn("ratio", F.col("top") / F.col("w"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    t = t.withColumn("level", (F.sum("source_size").over(all_rows) * F.lit(float(share))
                               - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / F.sum("w").over(after))
    t = t.withColumn("water", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(all_rows))
    target = F.coalesce(F.least(F.col("top"), F.col("water") * F.col("w")), F.col("top"))
    return t.select("source", "source_size", "n", target.cast("double").alias("target"))


def flight(sizes: list[int], chances: list[float], rng: random.Random, land: bool = False) -> list[float]:
    """Cube flight over one block: returns the chances, all but at most two of
    them 0 or 1, with the sums of chance and of chance * size kept.

    Each step moves along the direction of the largest open document, projected
    onto the null space of both constraints (weighted by chance * (1 - chance),
    so the others share the counterweight), up or down at random such that
    every chance keeps its mean, until a chance reaches 0 or 1. Large documents
    settle first and what stays open is small. With ``land`` the flight stops
    at LANDING open documents, and of all their roundings the one nearest to
    the word total (then to the document total) is taken.
    """
    out = np.asarray(chances, dtype=float)
    out = np.where(out <= EDGE, 0.0, np.where(out >= 1 - EDGE, 1.0, out))
    size = np.asarray(sizes, dtype=float)
    size = size / max(1.0, size.max(initial=1.0))
    held = np.flatnonzero((out > 0) & (out < 1))
    held = held[np.argsort(-size[held], kind="stable")]

    def direction(p: np.ndarray, s: np.ndarray) -> np.ndarray | None:
        w = p * (1 - p)
        n, t, q = w.sum(), (w * s).sum(), (w * s * s).sum()
        det = n * q - t * t
        for c in range(len(p)):
            if det > 1e-12 * n * q:
                x, y = (q - t * s[c]) / det, (n * s[c] - t) / det
            else:
                x, y = 1 / n, 0.0
            u = -w * (x + y * s)
            u[c] += 1
            if np.abs(u).max() > 1e-7:
                return u
        return None

    while len(held) > (LANDING if land else 2):
        p, s = out[held], size[held]
        u = direction(p, s)
        if u is None:
            break
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - p) / u, np.where(u < 0, p / -u, np.inf)).min()
            down = np.where(u > 0, p / u, np.where(u < 0, (1 - p) / -u, np.inf)).min()
        p = p + (up if rng.random() * (up + down) < down else -down) * u
        out[held] = np.where(p <= EDGE, 0.0, np.where(p >= 1 - EDGE, 1.0, p))
        held = held[(out[held] > 0) & (out[held] < 1)]
    while land and len(held):
        near = held[-LANDING:]
        choice = (np.arange(1 << len(near))[:, None] >> np.arange(len(near))) & 1
        off = choice - out[near]
        cost = np.abs(off @ size[near]) + 1e-6 * np.abs(off.sum(axis=1))
        out[near] = choice[cost.argmin()]
        held = held[:-LANDING]
    return out.tolist()


def mix_sources(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 7,
                id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                block: int = BLOCK) -> DataFrame:
    """Copies of each document so that every source's words meet its target.

    Returns per input row ``(id_col, source, text_hash, size, source_size,
    target, copies long, taken long)``: ``copies`` is the whole part of target
    / source size, plus 0 or 1 from the balanced sampling, and ``taken`` is
    copies * size. Sizes count words of the whole text (null text: 0, never
    taken words). The same input gives the same result: blocks and random
    numbers come from the ids and the seed. Rows without an id are dealt to
    blocks by their place; repeated rows are sampled each for itself; a null
    source is a source of its own; an empty table gives an empty result; other
    columns are ignored.
    """
    ready(docs.sparkSession, 10_000)
    sized = written(docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("source"),
                                F.xxhash64(text_col).alias("text_hash"),
                                word_count(F.col(text_col)).alias("size")), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    goal = written(source_targets(totals, weights, share, cap), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place = F.when(F.col("_id").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("_id", F.lit(seed)))
    g = goal.withColumnRenamed("source", "_source")
    units = sized.join(g, sized["source"].eqNullSafe(g["_source"])).drop("_source") \
        .withColumn("rate", rate) \
        .withColumn("sure", F.floor(F.col("rate") + F.lit(EDGE))) \
        .withColumn("chance", F.greatest(F.lit(0.0), F.col("rate") - F.col("sure"))) \
        .withColumn("block", F.pmod(F.xxhash64(place), F.ceil(F.col("n") / F.lit(block))))
    keep = ["_id", "source", "text_hash", "size", "source_size", "target", "n", "sure", "chance", "block"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in units.select(*keep).schema)
    blocks = max(1, math.ceil((goal.agg(F.max("n")).first()[0] or 0) / block))
    done, level = None, 0
    state = units.select(*keep)
    while True:
        last = blocks <= 1
        state = written(state.groupBy("source", "block").applyInArrow(_flight_of(level, seed, last), schema),
                        f"mix-level{level}")
        if last:
            break
        settled = state.where("chance = 0 or chance = 1")
        done = settled if done is None else done.union(settled)
        state = state.where("chance > 0 and chance < 1").withColumn("block", F.floor(F.col("block") / FAN_IN))
        blocks, level = math.ceil(blocks / FAN_IN), level + 1
    out = state if done is None else done.union(state)
    copies = (F.col("sure") + F.col("chance")).cast("long")
    return out.select(F.col("_id").alias(id_col), "source", "text_hash", "size", "source_size", "target",
                      copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def _flight_of(level: int, seed: int, land: bool):
    def run(table: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        table = table.take(pc.sort_indices(table, [("size", "descending"), ("_id", "ascending"),
                                                   ("text_hash", "ascending")]))
        first = [table.column(c)[0].as_py() for c in ("source", "block")]
        rng = random.Random(f"{seed}/{level}/{first[0]!r}/{first[1]}")
        got = flight(table.column("size").to_pylist(), table.column("chance").to_pylist(), rng, land)
        return table.set_column(table.schema.get_field_index("chance"), "chance", pa.array(got, pa.float64()))

    return run


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix_sources` takes it
    (rows of no copies go), with the columns of ``docs``. Rows with equal id
    and text count as one document that is taken as often as all of them: the
    one whose columns come first as JSON, so that reruns agree.
    Documents without words have no weight in any target: they stay once."""
    id_col, text_col = params.get("id_col", "doc_id"), params.get("text_col", "text")
    taken = mix_sources(docs, **params).groupBy(F.col(id_col).alias("_k"), F.col("text_hash").alias("_h")) \
        .agg(F.sum(F.when(F.col("size") > 0, F.col("copies")).otherwise(1)).cast("int").alias("_n"))
    # Keys without nulls, the same for window and join: one exchange serves both,
    # and the JSON is made after it.
    key = lambda c: [F.coalesce(F.col(c).cast("string"), F.lit("")).alias("_key"), F.col(c).isNull().alias("_none")]
    keys = ["_key", "_none", "_hash"]
    keyed = docs.select(*key(id_col), F.xxhash64(text_col).alias("_hash"), F.struct("*").alias("_row")).repartition(*keys)
    rows = keyed.withColumn("_m", F.row_number().over(Window.partitionBy(*keys).orderBy(F.to_json("_row")))) \
        .where("_m = 1").drop("_m")
    hit = rows.join(taken.select(*key("_k"), F.col("_h").alias("_hash"), "_n"), keys)
    return hit.where("_n > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_row.*")
