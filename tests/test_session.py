"""Scratch data lives under the session's shared checkpoint folder."""

import pytest

from basketflow.session import cut_lineage, ensure_checkpoint_dir, scratch_dir


def test_scratch_under_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(base) and b.startswith(base) and a != b


def test_cut_lineage_is_reliable_checkpoint(spark):
    df = spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count()
    cut = cut_lineage(df)
    assert sorted(r.k for r in cut.collect()) == list(range(7))
    assert "LogicalRDD" in cut._jdf.queryExecution().analyzed().toString()


class _FakeContext:
    """A session's context on a cluster without a checkpoint folder."""

    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return {}


class _FakeSession:
    def __init__(self, master):
        self.sparkContext, self.conf = _FakeContext(master), {}


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"])
def test_no_machine_local_scratch_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_FakeSession(master))
