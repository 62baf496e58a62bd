"""Keyed device store.

Record: ``row_key`` (``device#time#hash``), family ``cf`` as a struct of
identity fields (NULL text -> ''), family ``features`` as a map of doubles
(numbers stay numbers).  Stored in batches and snapshots under a manifest
(``store``, idempotent per batch); the current view is the newest version
of every row key (last write wins).  External key-value stores are written
from executors (``put_partitions``, ``external``) — never via the driver.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import chain

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.functions.keys import row_key
from tidewatch.operators.merge import latest_by_key
from tidewatch.sinks import store


def keyed_records(classified: DataFrame, feature_cols: list[str], hash_len: int | None = None,
                  legacy: bool = False, time_col: str = "kafka_timestamp") -> DataFrame:
    cf = F.struct(
        F.col("device_name").alias("device_name"),
        F.coalesce(F.col("attack"), F.lit("")).alias("attack"),
        F.coalesce(F.col("attack_subtype"), F.lit("")).alias("attack_subtype"),
        F.col("label").alias("original_label"),
        F.col(time_col).alias("event_time"),
        F.col("prediction_binary").alias("prediction"),
    )
    feats = F.create_map(*chain.from_iterable((F.lit(c), F.col(c).cast("double")) for c in feature_cols))
    # a record without a device or a time has no key: it belongs to the rejects, not to a shared NULL key
    classified = classified.filter(F.col("device_name").isNotNull() & F.col(time_col).isNotNull())
    return classified.select(row_key("device_name", time_col, "row_hash", hash_len, legacy).alias("row_key"),
                             "device_name", cf.alias("cf"), feats.alias("features"))


KEYED_ORDER = [store.BATCH, "cf"]


def write_keyed(records: DataFrame, path: str, batch_id: int) -> None:
    """One batch of the stored records, each file sorted by row key inside its
    task (no shuffle), named in the manifest once it is complete."""
    store.write_batch(records, path, batch_id, sort_by=["row_key"])


def latest_keyed(spark: SparkSession, path: str) -> DataFrame:
    """Current keyed view: newest batch per row key (ties by record)."""
    columns = ["row_key", "device_name", "cf", "features", store.BATCH]
    return latest_by_key(store.read(spark, path).select(*columns), "row_key", KEYED_ORDER)


def compact_keyed(spark: SparkSession, path: str, files: int | None = None) -> store.Manifest:
    """Snapshot in row-key order over ranges, with each file's key range and a
    bloom filter on the device."""
    return store.compact(spark, path, "row_key", KEYED_ORDER, layout=["row_key"], bloom=["device_name"], files=files)


def prefix_scan(spark: SparkSession, path: str, devices: list[str]) -> DataFrame:
    """Current records of some devices, looked up in the stored folder: only
    snapshot files whose key range meets a device's prefix are opened, and the
    filters go down to Parquet there and in the later batches.  The filter can
    come before the merge because a key never changes its device."""
    m = store.current(spark, path)
    if not devices:
        return store.latest(spark, path, "row_key", KEYED_ORDER).limit(0)
    # all keys of a device lie from "device#" up to, not including, "device$"
    meets = reduce(lambda a, b: a | b, [(F.col("most_row_key") >= f"{d}#") & (F.col("least_row_key") < f"{d}$") for d in devices])
    files = store.pick_files(spark, path, m, zones=meets)
    parts = [store.read_snapshot(spark, path, m, files), store.read_batches(spark, path, m)]
    parts = [device_history(p, devices) for p in parts if p is not None]
    if not parts:  # no file can hold the devices, and there is no later batch
        return store.read_snapshot(spark, path, m).limit(0)
    return latest_by_key(reduce(lambda a, b: a.unionByName(b), parts), "row_key", KEYED_ORDER)


def device_history(records: DataFrame, devices: list[str]) -> DataFrame:
    """Prefix scan by device: equality on ``device_name`` (pushed down to
    Parquet) plus the row-key prefix."""
    cond = F.col("device_name").isin(list(devices))
    prefix = None
    for d in devices:
        p = F.col("row_key").startswith(f"{d}#")
        prefix = p if prefix is None else (prefix | p)
    return records.filter(cond & prefix)


def put_partitions(records: DataFrame, put_batch: Callable[[list[dict]], None],
                   batch_size: int = 500) -> None:
    """Send records to an external key-value store from the executors, in
    batches of ``batch_size`` puts per call (the reference used 500), one
    client per partition inside ``put_batch``.  Nothing passes through the
    driver; a retried task re-puts the same keys, which a keyed store absorbs."""
    def run(rows):
        buf = []
        for r in rows:
            buf.append(r.asDict(recursive=True))
            if len(buf) >= batch_size:
                put_batch(buf)
                buf = []
        if buf:
            put_batch(buf)

    records.foreachPartition(run)
