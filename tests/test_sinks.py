"""Per-batch table sink: a replayed batch replaces its own output."""

from basketflow.session import scratch_dir
from basketflow.sinks.writers import BatchTableWriter, read_batches


def test_batch_table_writer_overwrites_per_batch(spark):
    path = scratch_dir(spark, "sink")
    w = BatchTableWriter(path)
    w(spark.createDataFrame([("a", 1)], "word string, cnt bigint"), 0)
    w(spark.createDataFrame([("b", 2)], "word string, cnt bigint"), 1)
    w(spark.createDataFrame([("b", 3), ("c", 1)], "word string, cnt bigint"), 1)  # replay
    got = sorted(tuple(r) for r in read_batches(
        spark, path, "word string, cnt bigint, batch_id int").collect())
    assert got == [("a", 1, 0), ("b", 3, 1), ("c", 1, 1)]
