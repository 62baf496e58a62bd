"""Last-write-wins merge by key (G4) for keyed stores kept as files.

A keyed store is a folder of per-batch files; the current view is the newest
version of every key.  ``max_by`` over ``(batch_id, order...)`` is one
aggregate (sort-based, as its buffers hold structs) with a partial step before
the shuffle, so re-writing a batch or reading batches in any order yields the
same view."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.operators.topk import latest_per_key


def latest_by_key(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    return latest_per_key(df, key, order_cols)


def upsert(current: DataFrame, updates: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """Merge ``updates`` into ``current`` (same columns): newest version wins."""
    return latest_per_key(current.unionByName(updates), key, order_cols)


def compact(spark: SparkSession, src: str, dst: str, key: str, order_cols: list[str],
            batch_col: str = "batch_id", base: str | None = None) -> int:
    """Periodic compaction of a per-batch keyed folder: write the latest
    version of every key to a *new* folder ``dst`` as one batch (keeping the
    newest batch id), so that readers switch paths atomically and later reads
    scan one version per key instead of every batch.  Returns that batch id."""
    raw = spark.read.parquet(src)
    top = raw.agg(F.max(batch_col).alias("b")).first()["b"]
    latest = latest_since_snapshot(spark, src, base, key, order_cols, batch_col).withColumn(batch_col, F.lit(top).cast("long"))
    # overwrite: a micro-batch replayed after a crash recomputes the same snapshot
    latest.sortWithinPartitions(key).write.mode("overwrite").partitionBy(batch_col).parquet(dst)
    return int(top)


def snapshot_path(path: str, upto: int) -> str:
    return f"{path.rstrip('/')}_snapshots/upto={int(upto)}"


def newest_snapshot(spark: SparkSession, path: str, below: int | None = None) -> str | None:
    """The newest complete ``compact`` snapshot of a keyed folder (of a batch
    before ``below``), or None.  A snapshot counts once the writer's
    ``_SUCCESS`` marker is there; one that is being written, or was left by a
    failed job, is passed over."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}_snapshots")
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return None
    found = []
    for f in files.listStatus(root):
        name = f.getPath().getName()
        if name.startswith("upto=") and files.exists(jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")):
            found.append(int(name[5:]))
    found = [n for n in found if below is None or n < below]
    return snapshot_path(path, max(found)) if found else None


def latest_since_snapshot(spark: SparkSession, path: str, snapshot: str | None, key: str,
                          order_cols: list[str], batch_col: str = "batch_id") -> DataFrame:
    """Current view of a per-batch keyed folder read through its newest
    compaction ``snapshot`` (written by ``compact``): the snapshot plus only
    the batch partitions written after it (``batch_id > N`` prunes the
    rest), so read cost stays bounded as the stream ages."""
    raw = spark.read.parquet(path)
    if snapshot is None:
        return latest_per_key(raw, key, order_cols)
    snap = spark.read.parquet(snapshot)
    upto = snap.agg(F.max(batch_col).alias("b")).first()["b"]
    newer = raw.filter(F.col(batch_col) > F.lit(upto))
    return latest_per_key(snap.unionByName(newer), key, order_cols)
