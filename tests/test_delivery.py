"""Per-partition delivery and the batch log."""

import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketflow.functions.payload import word_count_payload
from basketflow.session import scratch_dir
from basketflow.sinks.delivery import FileDelivery, PartitionWriter, read_delivered, start_delivery
from basketflow.streaming.counts import running_word_counts
from basketflow.streaming.harness import SlicedFileStream
from basketflow.streaming.observed import BatchLog, observed
from basketflow.streaming.triggers import RECOMMENDER_INTERVAL, STRUCTURED_WORD_COUNT_INTERVAL, with_trigger


def failing_once(root, marker):
    """A delivery that breaks down in the middle of one partition, the first
    time. (A local class: workers get it by value, not from this module.)"""
    class FailsOnce(FileDelivery):
        def send(self, value):
            super().send(value)
            if value == "(w7,1)" and not os.path.exists(marker):
                open(marker, "w").close()
                raise OSError("connection lost")

    return FailsOnce(root)


def folder(spark, name):
    path = scratch_dir(spark, name).removeprefix("file://").removeprefix("file:")
    os.makedirs(path)
    return path


def test_a_failed_partition_is_sent_once(spark):
    lines = spark.createDataFrame([(f"w{i % 40}",) for i in range(40)], "value string")
    more = spark.createDataFrame([("w1 w2",)], "value string")
    root = folder(spark, "sent")
    delivery = failing_once(root, os.path.join(folder(spark, "marks"), "failed"))
    stream = SlicedFileStream(spark, lines.schema)

    def start(partitions):
        return lambda df, ckpt: start_delivery(running_word_counts(df, "value", "drop_trailing"), word_count_payload("word", "cnt"),
                                               "word", ckpt, delivery, partitions)

    stream.stage(lines)
    with pytest.raises(Exception):  # noqa: B017 - the task's failure, as Spark wraps it
        stream.run_once(start(5))
    sent = read_delivered(spark, root).count() if os.path.isdir(os.path.join(root, "epoch=0")) and os.listdir(os.path.join(root, "epoch=0")) else 0
    assert sent < 40
    # Run again, with another number given: the first start's holds.
    stream.run_once(start(3))
    assert Counter(r.value for r in read_delivered(spark, root).collect()) == Counter(f"(w{i},1)" for i in range(40))
    stream.stage(more)
    stream.run_once(start(7))
    got = read_delivered(spark, root).where("epoch = 1").collect()
    assert sorted(r.value for r in got) == ["(w1,2)", "(w2,2)"]
    assert os.listdir(os.path.join(root, "_attempts")) == []


def test_second_attempt_sends_nothing(tmp_path):
    class Row:
        value = "x"

    for attempt in range(3):
        w = PartitionWriter(FileDelivery(f"file://{tmp_path}"))
        assert w.open(4, 2) is (attempt == 0)
        if attempt == 0:
            w.process(Row)
        w.close(None)
    # Two attempts at a time: the later commit changes nothing.
    a, b = (PartitionWriter(FileDelivery(str(tmp_path))) for _ in range(2))
    assert a.open(5, 2) and b.open(5, 2)
    a.process(Row)
    b.process(Row)
    a.close(None)
    b.close(None)
    failed = PartitionWriter(FileDelivery(str(tmp_path)))
    assert failed.open(6, 2)
    failed.close(ValueError())
    assert sorted(os.listdir(tmp_path / "epoch=2")) == ["part-00004.json", "part-00005.json"]
    assert all(len(open(tmp_path / "epoch=2" / f).readlines()) == 1 for f in os.listdir(tmp_path / "epoch=2"))
    assert os.listdir(tmp_path / "_attempts") == []
    with pytest.raises(ValueError, match="mounted"):
        FileDelivery("hdfs://x/y")


@pytest.mark.parametrize("interval", [STRUCTURED_WORD_COUNT_INTERVAL, RECOMMENDER_INTERVAL])
def test_triggers_as_observed(spark, interval):
    """Batches start at multiples of the interval; rows in and out are those of
    the stream and of its filter."""
    seconds = int(interval.split()[0])
    log, told = BatchLog(), []
    log.tell = told.append
    spark.streams.addListener(log)
    name = f"every_{seconds}_s"
    try:
        rows = spark.readStream.format("rate").option("rowsPerSecond", 4).load()
        out = observed(rows.where("value % 2 = 0"))
        query = with_trigger(out.writeStream.format("noop").queryName(name), interval).start()
        end = time.time() + 3 * seconds + 20
        while time.time() < end and len([b for b in log.batches(name) if b.rows_in]) < 2:
            time.sleep(0.3)
        query.stop()
    finally:
        spark.streams.removeListener(log)
    late = log.batches(name)[1:]
    assert late and all(b.started.timestamp() % seconds < 1.5 for b in late)
    assert all(round(gap) % seconds == 0 for gap in log.intervals(name)[1:])
    full = [b for b in late if b.rows_in]
    assert len(full) >= 1 and all(abs(b.rows_in - 2 * b.rows_out) <= 1 for b in full)
    assert any(f"{full[0].rows_in} rows in, {full[0].rows_out} rows out" in line for line in told)


def test_failures_are_kept(spark):
    log = BatchLog()
    spark.streams.addListener(log)
    try:
        bad = spark.readStream.format("rate").option("rowsPerSecond", 100).load().select(F.raise_error(F.lit("boom")))
        query = bad.writeStream.format("noop").start()
        with pytest.raises(Exception, match="boom"):
            query.awaitTermination(60)
        for _ in range(50):
            if log.failures:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    assert "boom" in log.failures[str(query.id)]
