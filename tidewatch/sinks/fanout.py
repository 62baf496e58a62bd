"""Micro-batch fan-out (K2): persist once, skip empty batches, write every
sink, always unpersist.  Each sink is idempotent for a batch id, so a batch
replayed after a crash between sinks converges to the same state."""
from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame

Sink = Callable[[DataFrame, int], None]


def fanout(batch_df: DataFrame, batch_id: int, sinks: list[Sink]) -> bool:
    """Return True when the batch had rows and all sinks were written."""
    batch_df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if batch_df.isEmpty():
            return False
        for sink in sinks:
            sink(batch_df, batch_id)
        return True
    finally:
        batch_df.unpersist()
