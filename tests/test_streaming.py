"""Streaming: batch-scoped baskets, running lists, restarts, warm start."""

import itertools
import os
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from basketflow.functions.parse import parse_view_line
from basketflow.operators.recommender import recommendations_flat
from basketflow.sinks.writers import BatchTableWriter, read_batches
from basketflow.streaming.counts import running_word_counts, start_counts
from basketflow.streaming.harness import SlicedFileStream, slice_ids
from basketflow.session import scratch_dir
from basketflow.streaming.recommend import (
    DELTA_SCHEMA, LIST_SCHEMA, SALTS, STATE_NAME, BatchScopedPairs, RunningRecommender,
)
from basketflow.streaming.windows import closing_row, start_windowed_pairs

SCHEMA = "value string"
WINDOW_SCHEMA = "ts timestamp_ntz, user string, item string"


def lines(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], SCHEMA)


def run_pairs(spark, batches):
    stream = SlicedFileStream(spark, lines(spark, []).schema)
    sink = BatchTableWriter(stream.output_dir)

    def start(df, ckpt):
        return (parse_view_line(df).writeStream.option("checkpointLocation", ckpt)
                .foreachBatch(BatchScopedPairs(sink)).trigger(availableNow=True).start())

    stream.run_slices([lines(spark, b) for b in batches], start)
    out = read_batches(spark, stream.output_dir, "a string, b string, cnt bigint, batch_id int")
    return sorted((r.batch_id, r.a, r.b, r.cnt) for r in out.collect())


def test_batch_scope(spark):
    # same user's views in different batches never pair up
    assert run_pairs(spark, [["u 1"], ["u 2"]]) == []
    # in one batch they do; a repeat in a later batch counts again
    got = run_pairs(spark, [["u 1", "u 2"], ["x 9"], ["u 1", "u 2"]])
    assert got == [(0, "1", "2", 1), (2, "1", "2", 1)]


def run_running(spark, batches, initial=None, salts=3, root=None, first=0, out=None):
    """Rows (batch, item, other, cnt) that the recommender emits; every batch is
    a restart of both queries, and only the first start is given the seed."""
    stream = SlicedFileStream(spark, lines(spark, []).schema, root=root)
    stream.slices = first
    sink = BatchTableWriter(stream.output_dir)
    for i, b in enumerate(batches):
        stream.stage(lines(spark, b))
        reco = RunningRecommender(spark, os.path.join(stream.root, "reco"), sink, salts=salts,
                                  initial_state=None if i else initial)
        reco.drain(parse_view_line(stream.read_stream()))
    out = spark.read.schema(LIST_SCHEMA).parquet(stream.output_dir)
    return sorted((r.batch, r.item, r.other, r.cnt) for r in out.collect()), reco, stream


def expected_lists(batches, state=()):
    """The same by brute force."""
    state, out = Counter(dict(state)), []
    for n, batch in enumerate(batches):
        bask = {}
        for x in batch:
            u, i = x.split(" ")
            bask.setdefault(u, set()).add(i)
        delta = Counter(p for items in bask.values() for p in itertools.permutations(items, 2))
        state.update(delta)
        touched = {a for a, _ in delta}
        out += [(n, a, b, c) for (a, b), c in state.items() if a in touched]
    return sorted(out), state


def some_batches(n, seed=3):
    rnd = random.Random(seed)
    return [[f"u{rnd.randrange(6)} {rnd.randrange(8)}" for _ in range(25)] for _ in range(n)]


def test_running_full_list(spark):
    batches = [["a 4", "a 5", "b 4", "b 2"], ["c 4", "c 2"]]
    got, _, _ = run_running(spark, batches)
    b1 = [r for r in got if r[0] == 1]
    # item 4 is touched only through (4,2) in batch 1 but re-emits 5 as well
    assert (1, "4", "5", 1) in b1 and (1, "4", "2", 2) in b1
    # item 5 is untouched in batch 1
    assert not [r for r in b1 if r[1] == "5"]
    assert got == expected_lists(batches)[0]


def test_running_equals_brute_force_and_state_can_be_read(spark):
    batches = some_batches(4) + [["lonely 1"]] + some_batches(1, 9)
    got, reco, _ = run_running(spark, batches)
    want, state = expected_lists(batches)
    assert got == want
    rows = reco.state().collect()
    assert {(r.item, r.other): r.cnt for r in rows} == dict(state) and len(rows) == len(state)


def test_a_hot_item_is_spread_over_salts(spark):
    """A third of the baskets hold item 0 and one of 300 others: its map lies
    in several keys and state partitions, and its list is emitted whole."""
    batch = [f"u{i} {x}" for i in range(300) for x in ("0", f"n{i}")] + [f"v{i} {x}" for i in range(600) for x in ("p", f"q{i % 7}")]
    got, reco, _ = run_running(spark, [batch, ["w 0", "w p"]], salts=8)
    assert sum(r[:2] == (1, "0") for r in got) == 301
    state = spark.read.format("statestore").option("stateVarName", STATE_NAME).load(reco.lists_checkpoint)
    parts = state.where("key.item = '0'").groupBy("key.salt").agg(F.count("*").alias("n"), F.min("partition_id").alias("p"))
    rows = parts.collect()
    assert len(rows) == 8 and max(r.n for r in rows) < 80 and len({r.p for r in rows}) > 1


def test_warm_start_and_restart_without_seed(spark):
    seed = [("4", "9", 5), ("9", "4", 5), ("7", "8", 2)]
    init = spark.createDataFrame(seed, "item string, other string, cnt bigint")
    batches = [["a 4", "a 5"], ["b 7", "b 4"]]
    got, reco, stream = run_running(spark, batches, initial=init)
    assert (0, "4", "9", 5) in got and (0, "4", "5", 1) in got and (1, "7", "8", 2) in got
    want, state = expected_lists(batches, {(a, b): n for a, b, n in seed})
    assert got == want and {(r.item, r.other): r.cnt for r in reco.state().collect()} == dict(state)
    root = os.path.join(stream.root, "reco")
    RunningRecommender(spark, root, None, initial_state=init)
    with pytest.raises(ValueError, match="initial state"):
        RunningRecommender(spark, root, None, initial_state=init.withColumn("cnt", F.col("cnt") + 1))


def test_running_lists_in_a_session_without_rocksdb(spark):
    """The queries bring their own state store; the session keeps its own."""
    key = "spark.sql.streaming.stateStore.providerClass"
    own = spark.conf.get(key)
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    batches = some_batches(2, 5)
    spark.conf.set(key, plain)
    try:
        got, reco, _ = run_running(spark, batches)
        want, state = expected_lists(batches)
        assert got == want and {(r.item, r.other): r.cnt for r in reco.state().collect()} == dict(state)
        assert spark.conf.get(key) == plain
    finally:
        spark.conf.set(key, own)


def test_lists_that_fall_behind_emit_every_batch(spark):
    """Two batches of pairs before the lists run: each batch's lists come, and
    a batch that is replayed changes nothing."""
    batches = some_batches(3, 4)
    root = scratch_dir(spark, "behind")
    stream = SlicedFileStream(spark, lines(spark, []).schema, root=root)
    reco = RunningRecommender(spark, os.path.join(root, "reco"), BatchTableWriter(stream.output_dir), salts=5)
    for b in batches[:2]:
        stream.stage(lines(spark, b))
        reco.start_pairs(parse_view_line(stream.read_stream())).awaitTermination()
    replayed = parse_view_line(lines(spark, batches[1]))
    files = spark.read.parquet(os.path.join(reco.deltas.folder, "batch_id=1/pairs")).inputFiles()
    reco.deltas(replayed, 1)
    assert spark.read.parquet(os.path.join(reco.deltas.folder, "batch_id=1/pairs")).inputFiles() == files
    reco.start_lists().awaitTermination()
    stream.stage(lines(spark, batches[2]))
    again = RunningRecommender(spark, os.path.join(root, "reco"), BatchTableWriter(stream.output_dir), salts=2)
    assert again.salts == 5
    again.drain(parse_view_line(stream.read_stream()))
    got = spark.read.schema(LIST_SCHEMA).parquet(stream.output_dir).collect()
    assert sorted((r.batch, r.item, r.other, r.cnt) for r in got) == expected_lists(batches)[0]


def test_a_half_written_batch_is_published_anew(spark):
    """A failure before the rename leaves nothing that the lists could see."""
    root = scratch_dir(spark, "half")
    reco = RunningRecommender(spark, root, None)
    spark.createDataFrame([(0, "x", 0, "y", 7)], DELTA_SCHEMA).write.parquet(
        os.path.join(reco.deltas.staging, "batch_id=0", "pairs"))
    reco.deltas(parse_view_line(lines(spark, ["a 1", "a 2"])), 0)
    rows = spark.read.schema(DELTA_SCHEMA).option("recursiveFileLookup", "true").parquet(reco.deltas.folder).collect()
    assert sorted((r.item, r.other, r.cnt) for r in rows if r.other) == [("1", "2", 1), ("2", "1", 1)]
    assert sum(r.other is None for r in rows) == 2 * SALTS


def test_update_counts_restart(spark):
    stream = SlicedFileStream(spark, lines(spark, []).schema)
    sink = BatchTableWriter(stream.output_dir)

    def start(df, ckpt):
        return start_counts(running_word_counts(df, "value", "drop_trailing"), ckpt, sink)

    stream.run_slices([lines(spark, ["a b", "a"]), lines(spark, ["b  ", "c"])], start)
    out = read_batches(spark, stream.output_dir, "word string, cnt bigint, batch_id int")
    got = sorted((r.batch_id, r.word, r.cnt) for r in out.collect())
    # "b  " drops its trailing empty tokens
    assert got == [(0, "a", 2), (0, "b", 1), (1, "b", 2), (1, "c", 1)]


def test_stream_equals_batch(spark):
    from tests.conftest import SF
    ev = spark.read.parquet(f"{SF}/events.parquet")
    views = ev.select(F.concat_ws(" ", F.col("user_id").cast("string"),
                                  F.col("event_type")).alias("value"))
    got, _, _ = run_running(spark, [[r.value for r in views.collect()]])
    batch = recommendations_flat(parse_view_line(views), min_support=1).collect()
    assert sorted((0, r.item, r.other, r.cnt) for r in batch) == got


def run_windows(spark, batches, **kw):
    """{batch: rows} of the windowed pairs; every batch is a restart."""
    out, sink = _collect_sink()
    stream = SlicedFileStream(spark, spark.createDataFrame([], WINDOW_SCHEMA).schema)
    stream.run_slices([spark.createDataFrame(b, WINDOW_SCHEMA) for b in batches],
                      lambda df, ckpt: start_windowed_pairs(df, ckpt, sink, **kw))
    return sorted((r[0].day, r[2], r[3], r[4]) for rows in out.values() for r in rows), stream


def test_windowed_pairs_cross_batch_and_late(spark):
    d = lambda day, h: datetime(2024, 1, day, h)
    batches = [
        [(d(1, 10), "u", "1"), (d(1, 11), "u", "2"), (None, "u", "7")],
        [(d(1, 23), "u", "3"), (d(2, 5), "v", "1")],      # closes day 1
        [(d(1, 12), "u", "4"), (d(2, 6), "v", "2"), (d(2, 7), "v", "2")],      # u/4 is late: dropped
        [(d(4, 0), "z", "9")],                            # closes day 2
    ]
    got, stream = run_windows(spark, batches)
    assert got == [(1, "1", "2", 1), (1, "1", "3", 1), (1, "2", "3", 1), (2, "1", "2", 1)]
    # What has been emitted is gone from the state.
    left = spark.read.format("statestore").load(stream.checkpoint_dir).collect()
    assert [(r.key.user, r.key.item) for r in left] == [("z", "9")]


def test_windows_within_the_delay_and_the_closing_row(spark):
    t = lambda d, h: datetime(2024, 1, d, h)
    batches = [[(t(5, 1), "u", "1")], [(t(1, 1), "u", "2"), (t(1, 2), "u", "3"), (t(5, 2), "u", "2")]]
    assert run_windows(spark, batches, delay="10 days")[0] == []
    close = [tuple(r) for r in closing_row(spark, t(5, 2), 12).collect()]
    assert run_windows(spark, [*batches, close], delay="10 days")[0] == [(1, "2", "3", 1), (5, "1", "2", 1)]


def _collect_sink():
    out = {}

    def sink(df, batch_id):
        out[batch_id] = sorted(tuple(r) for r in df.collect())
    return out, sink


def test_seeded_counts_update_and_complete(spark):
    seed = spark.createDataFrame([("a", 10), ("z", 5)], "word string, cnt bigint")
    got = {}
    for mode in ("update", "complete"):
        stream = SlicedFileStream(spark, lines(spark, []).schema)
        sink = BatchTableWriter(stream.output_dir)

        def start(df, ckpt, mode=mode, sink=sink):
            return start_counts(running_word_counts(df, "value", "drop_trailing"), ckpt,
                                sink, mode, initial_state=seed)

        stream.run_slices([lines(spark, ["a b"])], start)
        out = read_batches(spark, stream.output_dir, "word string, cnt bigint, batch_id int")
        got[mode] = sorted((r.word, r.cnt) for r in out.collect())
    assert got["update"] == [("a", 11), ("b", 1)]
    assert got["complete"] == [("a", 11), ("b", 1), ("z", 5)]


def test_count_seed_survives_a_restart(spark):
    seed = spark.createDataFrame([("a", 10)], "word string, cnt bigint")
    stream = SlicedFileStream(spark, lines(spark, []).schema)
    sink = BatchTableWriter(stream.output_dir)
    for batch, given in ((["a"], seed), (["a a"], None)):
        stream.stage(lines(spark, batch))
        stream.run_once(lambda df, ckpt, given=given: start_counts(
            running_word_counts(df, "value", "drop_trailing"), ckpt, sink, initial_state=given))
    out = read_batches(spark, stream.output_dir, "word string, cnt bigint, batch_id int")
    assert sorted((r.batch_id, r.cnt) for r in out.collect()) == [(0, 11), (1, 13)]


def test_running_counts_state_is_the_batch_count(spark):
    stream = SlicedFileStream(spark, lines(spark, []).schema)
    sink = BatchTableWriter(stream.output_dir)
    stream.run_slices([lines(spark, ["a b", "a"]), lines(spark, ["b c"])], lambda df, ckpt: start_counts(
        running_word_counts(df, "value", "drop_trailing"), ckpt, sink))
    state = spark.read.format("statestore").load(stream.checkpoint_dir).select("key.word", "value.count").collect()
    assert sorted(map(tuple, state)) == [("a", 2), ("b", 2), ("c", 1)]


def test_slices_with_a_null_one(spark):
    """Null is a slice of its own, the last one."""
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("a", 4)], "slice string, n int")
    assert slice_ids(df, "slice") == ["a", "b", None]
    assert slice_ids(df.where("n = 2"), "slice") == [None]
    sizes = [df.where(F.col("slice").eqNullSafe(F.lit(s))).count() for s in slice_ids(df, "slice")]
    assert sizes == [2, 1, 1]
