"""Session helpers: configuration for tests/bench and shared scratch folders.

Scratch output always goes under the cluster's shared ``spark.checkpoint.dir``
(read from the session).  Only when that is unset — local tests — do we
create one ourselves.
"""
from __future__ import annotations

import gc
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "tidewatch", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for the data volume (apply before a streaming
    query's first run: its checkpoint fixes the shuffle partition count).

    * scans split at ``partition_bytes`` (``maxPartitionBytes``);
    * the initial shuffle partition count is sized so that a full-row shuffle
      (the fingerprint dedup) lands near ``partition_bytes`` per partition,
      at least two waves of tasks; AQE then
      coalesces small partitions to the advisory size and splits skewed ones
      (the aggregates shuffle far less thanks to partial aggregation).

    Example: 100 TB over 8,000 cores -> about 400,000 shuffle partitions and
    scan splits of 256 MB."""
    parts = max(2 * total_cores, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    else:  # local runs / tests only: nothing shared is configured
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidewatch-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir (never reused)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidewatch/{name}-{uuid.uuid4().hex[:12]}"


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished jobs now: it acts when
    the driver's garbage is collected, and the last query that a listener has seen
    keeps its plan, hence the small one.  Off with ``spark.tidewatch.releaseShuffles=false``."""
    if spark.conf.get("spark.tidewatch.releaseShuffles", "true").lower() != "true":
        return
    spark.sql("SELECT 1").collect()
    gc.collect()
    try:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    except Py4JJavaError:  # a slow listener: its plans go later
        pass
    spark.sparkContext._jvm.System.gc()


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for local filesystem checks in tests)."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["build_session", "scale_conf", "ensure_checkpoint_dir", "scratch_path", "release_shuffles", "local_path"]
