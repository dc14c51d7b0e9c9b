"""The prefix trie against a plain one."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from basketflow.llm import trie
from basketflow.llm.queries import with_shared_heads
from basketflow.llm.trie import choose_splitters, common, prefix_trie, turn_paths
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(convs):
    """Node rows of {conv_id: [(role, text)]}."""
    members, out = {}, []
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for path, ids in members.items():
        below = [p for p in members if p[:len(path)] == path]
        ends = sorted(c for c in ids if len(convs[c]) == len(path))
        parents = {p[:-1] for p in members if p}
        saved = sum((len(members[p]) - 1) * len(brute.words(p[-1][1])) for p in below if p)
        out.append((min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids),
                    sum(len(p) == len(path) + 1 for p in below), sum(p not in parents for p in below), saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def some_conversations(rng, n):
    """Conversations over few turns, so prefixes, copies and branches abound;
    the same path for a third of them."""
    hot = [("user", "how are you"), ("assistant", "fine  thanks")] * 2
    made = [[(rng.choice(["user", "bot", ""]), rng.choice(["a", "b b", "c c c", ""])) for _ in range(rng.randrange(1, 6))]
            for _ in range(n)]
    return {i * 7 - 50: hot if i % 3 == 0 else hot[:rng.randrange(1, 4)] + m if i % 3 == 1 else m
            for i, m in enumerate(made)}


def turns_of(spark, convs, rng):
    rows = [(c, t, r, x) for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def test_trie_of_any_number_of_ranges(spark):
    rng = random.Random(3)
    convs = some_conversations(rng, 240)
    paths = turn_paths(turns_of(spark, convs, rng).withColumn("n", F.lit("x")).withColumn("path", F.lit(1)))
    want = plain_trie(convs)
    for ranges in (1, 2, 5, 40):
        got = prefix_trie(paths, ranges)
        assert got.columns == [c.split()[0] for c in trie.NODES.split(", ")]
        assert rows_of(got) == want
    # A skeleton that may hold next to nothing leaves one splitter.
    assert rows_of(prefix_trie(paths, 40, skeleton_bytes=1)) == want


def test_ids_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE_BITS", 2)
    rng = random.Random(4)
    convs = some_conversations(rng, 60)
    assert rows_of(prefix_trie(turn_paths(turns_of(spark, convs, rng)), 7)) == plain_trie(convs)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (None, 1, "user", "lost"), (2, 5, "", ""),
            (2, 9, "user", "x"), (3, 1, "u", "a" * 50_000), (4, 1, "ua", "a" * 49_999), (-5, None, "", None)]
    convs = {1: [("", ""), ("user", "x"), ("user", "x")], 2: [("", ""), ("user", "x")], 3: [("u", "a" * 50_000)],
             4: [("ua", "a" * 49_999)], -5: [("", "")]}
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(prefix_trie(turn_paths(df), 3)) == plain_trie(convs)
    assert prefix_trie(turn_paths(df.limit(0)), 3).count() == 0
    # Equal turn numbers: an order that does not follow the rows'.
    tied = [(1, 0, "user", t) for t in "abcd"] + [(2, 0, "user", t) for t in "dcba"]
    assert prefix_trie(turn_paths(spark.createDataFrame(tied, SCHEMA)), 2).where("n_convs = 2").count() == 5


def test_splitters():
    path = lambda *turns: b"".join(bytes([t]) * trie.KEY for t in turns)
    assert common(path(1, 2, 3), path(1, 2, 4, 5)) == 2 and common(b"", path(1)) == 0 and common(path(1), path(1, 2)) == 1
    sample = [path(a, b, 7, 7, 7) for a in range(9) for b in range(9)]
    found = choose_splitters(sample, 9, 1 << 20)
    assert len(found) == 8 and all(len(s) <= 2 * trie.KEY for s in found)
    assert choose_splitters([path(1)], 9, 1 << 20) == [] and choose_splitters([], 9, 9) == []


def test_long_conversation(spark):
    convs = {1: [("u", "w w")] * 3000, 2: [("u", "w w")] * 2999 + [("u", "v")]}
    got = prefix_trie(turn_paths(turns_of(spark, convs, random.Random(1))), 4)
    r = got.agg(F.count("*"), F.max("depth"), F.sum("n_children"), F.max("saved_tokens")).first()
    assert tuple(r) == (3002, 3000, 3001, 2 * 2999)


def test_registered_query(spark):
    from basketflow.llm.queries import op11_prefix_trie
    from basketflow.plans.tables import table
    sf = "/root/testdata/sf0.001"
    own = {}
    for c, _, r, x in sorted(table(spark, sf, "conversations").collect(), key=lambda r: (r.conv_id, r.turn)):
        own.setdefault(c, []).append((r, x))
    convs = {c: own.get(c - c % 20, [])[:zlib.crc32(str(c).encode()) % 4] + t[zlib.crc32(str(c).encode()) % 4:]
             for c, t in own.items()}
    assert rows_of(op11_prefix_trie(spark, sf)) == plain_trie(convs)


def test_shared_heads(spark):
    paths = spark.createDataFrame([(20, ["a", "b"]), (21, ["c"]), (24, ["d", "e", "f", "g"]), (47, ["x", "y"])],
                                  "conv_id long, keys array<string>")
    got = {r.conv_id: r["keys"] for r in with_shared_heads(paths).collect()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in got}
    own = {20: ["a", "b"], 21: ["c"], 24: ["d", "e", "f", "g"], 47: ["x", "y"]}
    assert got == {c: own.get(c - c % 20, [])[:h[c]] + w[h[c]:] for c, w in own.items()}
