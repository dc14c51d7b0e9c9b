"""Session construction and shared-storage helpers.

Every operator in the package is ``DataFrame -> DataFrame`` and never builds a
session itself; jobs, tests and the bench call :func:`get_session`.

Scratch data (staged stream inputs, delta logs, saved models, lineage cuts)
always lives under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), never under a machine-local temp folder. Only when
that setting is absent in local mode (tests) do we pick a folder of our own;
on a cluster its absence is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Streaming state (running counts, the recommender's maps) off the JVM heap,
# with incremental (changelog) checkpoints: large vocabularies do not pressure
# executor memory and commits do not rewrite the whole state.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Settings that make the plans hold at scale: AQE re-plans joins from runtime
# sizes (size-checked broadcast, partition coalescing, skew splitting),
# sessions run in UTC so timestamp_ntz casts are stable, RocksDB holds
# streaming state, and no UI server.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
    **STATE_STORE_CONF,
}


def get_session(master: str | None = None, app_name: str = "basketflow",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is only set when given, so ``spark-submit`` on a cluster keeps
    its own master. ``shuffle_partitions`` should be sized so one partition
    holds roughly 128-256 MB of shuffle data at the target scale; AQE
    coalesces it down for small inputs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executor are one process (``local``, ``local[n]``)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used as is; if it is unset there, this raises. In local mode (tests)
    a folder under the system temp dir is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            configured = None
    if not configured:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share")
        configured = tempfile.mkdtemp(prefix="basketflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "basketflow", f"{name}-{uuid.uuid4().hex[:12]}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: a small
    or reused table that joins then see as a plain scan."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists in the store that its URI names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Make a finished folder visible under its final name, by one rename. A
    folder that is already there stays as it is."""
    src, dst = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, target))
    fs = dst.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(dst.getParent())
    if not fs.exists(dst) and not fs.rename(src, dst):
        raise OSError(f"can not rename {staged} to {target}")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers look for this package where the driver has it. Where
    executors have other disks, ship it with ``--py-files``."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (shared storage) to cut a long lineage.

    Survives executor loss, unlike a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
