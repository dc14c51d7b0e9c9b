"""Conversation prefix trie by splitter skeleton.

A conversation's *path* is its turns in order, each as a fixed-length key
(128 bits of the digest of role and text, then the number of words), so equal
prefixes are equal bytes and the byte order of paths puts every trie node's
members side by side.

1. Equal paths become one row with their number, smallest id and a digest of
   their ids.
2. The distinct paths are dealt into ranges by *splitters*, taken from a
   bounded sample and cut to what tells them from their neighbour. Only a node
   that is a prefix of a splitter can have members in two ranges: these nodes
   are the **skeleton**, a trie that is broadcast. Its size is bounded by
   ``skeleton_bytes``; beyond it every second splitter goes.
3. Each range is read in path order and finishes all its other nodes by itself
   with a stack of the open ones. For skeleton nodes it gives partial
   aggregates.
4. The partial aggregates are reduced, and rolled up over the skeleton.

A range holds open nodes, and the closed ones whose parent is still open and
not of the skeleton: a range at most, and ranges shrink as partitions grow.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.graph import written
from basketflow.llm.words import ready, word_count

#: Bytes of a turn's key: digest, then words.
KEY, DIGEST = 20, 16
#: Sampled paths per range, and turns of a sampled path that a splitter may use.
SAMPLE, SPLIT_TURNS = 16, 256
#: Ids that one piece of an id list may hold.
PIECE_BITS = 12
EMPTY = hashlib.sha256(b"").hexdigest()

NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")
_SHARD = NODES + ", sid int, parent_sid int"


def turn_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, keys) of (conv_id, turn, role, text) rows: the hex keys of a
    conversation's turns, ordered by turn (null first; equal turn numbers by
    their key).

    A null role or text is empty; rows without a conv_id are ignored; repeated
    rows are turns of their own; other columns are ignored. A conversation is
    one row of 40 characters a turn, whatever its texts' lengths.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256)
    key = F.concat(F.substring(digest, 1, 2 * DIGEST), F.lpad(F.hex(word_count(text)), 2 * (KEY - DIGEST), "0"))
    return turns.where("conv_id is not null") \
        .select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", F.lower(key).alias("key")).alias("t")) \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t"))["key"].alias("keys"))


def _distinct_paths(batches):
    """One row per path from its id pieces, which come in order: the digest
    runs over the pieces, nothing is gathered."""
    path, n, low, sha = None, 0, 0, None

    def row():
        return {"path": path, "n": n, "conv_id": low, "ends": sha.hexdigest()}

    schema = pa.schema([("path", pa.binary()), ("n", pa.int64()), ("conv_id", pa.int64()), ("ends", pa.string())])
    for batch in batches:
        out = []
        for p, m, least, ids in zip(*(batch.column(c).to_pylist() for c in ("path", "n", "conv_id", "ids"))):
            if p != path:
                if path is not None:
                    out.append(row())
                path, n, low, sha = p, m, least, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
                n, low = n + m, min(low, least)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if path is not None:
        yield pa.RecordBatch.from_pylist([row()], schema=schema)


def distinct_paths(paths: DataFrame) -> DataFrame:
    """(path, n, conv_id, ends) of (conv_id, keys) rows: per distinct path its
    conversations, their smallest id, and the SHA-256 of all their ids in
    decimal, ascending, joined by commas.

    Ids of a path are gathered in pieces of neighbouring ids, 4,096 at most;
    a task then passes over a path's pieces in order. A digest is sequential, so
    the pieces of one path meet in one task, one at a time.
    """
    # Ids are distinct, so a piece of 2^12 neighbouring values is bounded.
    piece = F.shiftright("conv_id", PIECE_BITS)
    rows = paths.select("conv_id", F.unhex(F.array_join("keys", "")).alias("path"), piece.alias("piece")) \
        .groupBy("path", "piece").agg(
            F.count("*").alias("n"), F.min("conv_id").alias("conv_id"),
            F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"))
    return rows.repartition("path").sortWithinPartitions("path", "piece") \
        .mapInArrow(_distinct_paths, "path binary, n long, conv_id long, ends string")


def common(a: bytes, b: bytes) -> int:
    """Turns that two paths share at their beginning."""
    n = min(len(a), len(b)) // KEY
    if a[:n * KEY] == b[:n * KEY]:
        return n
    lo, hi = 0, n - 1
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid * KEY] == b[:mid * KEY] else (lo, mid - 1)
    return lo


def words_of(path: bytes, depth: int) -> int:
    """Words of a path's turn at a depth (the root has none)."""
    return int.from_bytes(path[depth * KEY - KEY + DIGEST:depth * KEY], "big") if depth else 0


def choose_splitters(sample: list[bytes], ranges: int, skeleton_bytes: int) -> list[bytes]:
    """At most ``ranges - 1`` splitters at even steps of a sample, each cut to
    the turns that tell it from the sampled path before it."""
    sample = sorted(set(sample))
    at = sorted({len(sample) * i // ranges for i in range(1, ranges)} - {0})
    found = sorted({sample[i][:(common(sample[i - 1], sample[i]) + 1) * KEY] for i in at if i < len(sample)})
    while len(found) > 1 and sum(len(s) for s in found) > skeleton_bytes:
        found = found[::2]
    return found


class Skeleton:
    """The trie of the splitters' paths: all their prefixes, the root too."""

    def __init__(self, splitters: list[bytes]):
        prefixes = {b""} | {s[:d * KEY] for s in splitters for d in range(1, len(s) // KEY + 1)}
        self.paths = sorted(prefixes)
        self.number = {p: i for i, p in enumerate(self.paths)}

    def parent(self, sid: int) -> int | None:
        path = self.paths[sid]
        return self.number[path[:-KEY]] if path else None


def shard_nodes(rows, skeleton: Skeleton):
    """Rows of one range's nodes (see ``_SHARD``) from its distinct paths in
    order: finished ones, and with ``sid`` partial ones of the skeleton. A
    partial row's ``n_children`` and ``n_leaves`` leave skeleton nodes out, its
    ``saved_tokens`` is n_convs x words, summed (what the roll-up takes off is
    the words once per node)."""
    last, stack = b"", []

    def open_node(path, depth, least):
        sid = skeleton.number.get(path[:depth * KEY]) if not stack or stack[-1]["sid"] is not None else None
        stack.append({"depth": depth, "words": words_of(path, depth), "sid": sid, "least": least, "n": 0,
                      "children": 0, "leaves": 0, "saved": 0, "ends": EMPTY, "ready": []})

    def close_node():
        node, up = stack.pop(), stack[-1] if stack else None
        sid, leaf = node["sid"], not node["children"] and node["sid"] is None
        saved = node["saved"] + (node["n"] - (sid is None)) * node["words"]
        leaves = node["leaves"] + leaf
        row = [node["least"], node["depth"], None, node["n"], node["children"], leaves, saved, node["ends"], sid, None]
        if sid is None:
            # Its children know their parent now.
            for child in node["ready"]:
                child[2] = node["least"]
            done = node["ready"]
        else:
            done = [row]
        if up is not None:
            up["least"] = min(up["least"], node["least"])
            up["n"] += node["n"]
            up["children"] += sid is None
            up["leaves"] += leaves
            up["saved"] += saved
            if sid is None:
                if up["sid"] is None:
                    up["ready"].append(row)
                else:
                    row[9] = up["sid"]
                    done.append(row)
        return done

    for path, n, least, ends in rows:
        depth, keep = len(path) // KEY, common(last, path) if stack else 0
        while stack and stack[-1]["depth"] > keep:
            yield from close_node()
        for d in range(len(stack), depth + 1):
            open_node(path, d, least)
        top = stack[-1]
        top["n"] += n
        top["least"] = min(top["least"], least)
        top["ends"] = ends
        last = path
    while stack:
        yield from close_node()


def _shards(skeleton: Skeleton):
    names = [c.split()[0] for c in _SHARD.split(", ")]
    types = [pa.string() if c.endswith("string") else pa.int32() if c.endswith("int") else pa.int64()
             for c in _SHARD.split(", ")]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches):
        def ranges():
            """(range, rows) of a task, in order."""
            for b in batches:
                yield from zip(*(b.column(c).to_pylist() for c in ("shard", "path", "n", "conv_id", "ends")))

        source, out = ranges(), []
        row = next(source, None)
        while row is not None:
            shard = row[0]

            def own():
                nonlocal row
                while row is not None and row[0] == shard:
                    yield row[1:]
                    row = next(source, None)

            for node in shard_nodes(own(), skeleton):
                out.append(node)
                if len(out) >= 10_000:
                    yield batch(out)
                    out = []
        if out:
            yield batch(out)

    return run


def roll_up(skeleton: Skeleton, rows: dict[int, dict]) -> list[tuple]:
    """Finished rows of the skeleton's nodes from their reduced partial ones,
    deepest first."""
    out = {}
    extra_children = dict.fromkeys(rows, 0)
    extra_leaves = dict.fromkeys(rows, 0)
    extra_words = dict.fromkeys(rows, 0)
    for sid in sorted(rows, key=lambda s: -len(skeleton.paths[s])):
        r, up = rows[sid], skeleton.parent(sid)
        children = r["n_children"] + extra_children[sid]
        leaf = not children
        leaves = extra_leaves[sid] + leaf
        off = extra_words[sid] + words_of(skeleton.paths[sid], len(skeleton.paths[sid]) // KEY)
        out[sid] = (r["conv_id"], r["depth"], None if up is None else rows[up]["conv_id"], r["n_convs"], children,
                    r["n_leaves"] + leaves, r["saved_tokens"] - off, r["ends_sha256"], sid)
        if up is not None:
            extra_children[up] += 1
            extra_leaves[up] += leaves
            extra_words[up] += off
    return list(out.values())


def prefix_trie(paths: DataFrame, ranges: int | None = None, skeleton_bytes: int = 8 << 20) -> DataFrame:
    """One row per node of the prefix trie of conversations, from (conv_id,
    keys) rows with distinct ids (:func:`turn_paths`).

    Columns: conv_id (smallest member), depth, parent_conv_id (null: root),
    n_convs, n_children, n_leaves, saved_tokens (over the subtree, words of a
    node's last turn that members beyond the first repeat), ends_sha256 (digest
    of the ids that end there; none: of nothing). A conversation without turns
    is a member of the root only; an empty table has no nodes. Rows without an
    id must be gone (``turn_paths`` drops them); other columns are ignored.
    ``ranges`` defaults to the shuffle partitions.
    """
    spark: SparkSession = paths.sparkSession
    ready(spark, 10_000)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(distinct_paths(paths), "trie-paths")
    # A bounded sample, of the smallest hashes: reruns choose the same.
    sample = rows.select(F.substring("path", 1, SPLIT_TURNS * KEY).alias("path")) \
        .orderBy(F.xxhash64("path"), "path").limit(SAMPLE * ranges)
    splitters = choose_splitters([bytes(r.path) for r in sample.collect()], ranges, skeleton_bytes)
    skeleton = Skeleton(splitters)

    @F.arrow_udf("int")
    def shard(path: pa.Array) -> pa.Array:
        return pa.array([bisect_right(splitters, p) for p in path.to_pylist()], pa.int32())

    dealt = rows.withColumn("shard", shard("path")).repartition("shard").sortWithinPartitions("shard", "path")
    nodes = written(dealt.mapInArrow(_shards(skeleton), _SHARD), "trie-nodes")
    parts = nodes.where("sid is not null").groupBy("sid").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.coalesce(F.max(F.when(F.col("ends_sha256") != EMPTY, F.col("ends_sha256"))), F.lit(EMPTY)).alias("ends_sha256"))
    # As many rows as the skeleton has nodes at most.
    whole = roll_up(skeleton, {r.sid: r.asDict() for r in parts.collect()})
    top = spark.createDataFrame(whole, NODES + ", sid int")
    ups = F.broadcast(top.select(F.col("sid").alias("parent_sid"), F.col("conv_id").alias("_up")))
    own = nodes.where("sid is null").join(ups, "parent_sid", "left") \
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_up"))
    names = [c.split()[0] for c in NODES.split(", ")]
    return own.select(names).union(top.select(names))
