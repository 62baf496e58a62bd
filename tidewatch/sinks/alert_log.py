"""Append-only alert log (U1, G3): a store of batches, read in arrival order.

A batch that is committed is never rewritten, so a stream may read the folder
while another one writes it and replays batches."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.sinks import store


def append_alerts(log: DataFrame, new: DataFrame) -> DataFrame:
    return log.unionByName(new)


def write_alerts(alerts: DataFrame, path: str, batch_id: int) -> None:
    store.write_batch(alerts, path, batch_id)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return store.read(spark, path)
