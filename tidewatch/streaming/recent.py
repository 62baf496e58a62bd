"""The newest buckets of a traffic series as a stream.

Two chained stateful steps.  Tumbling buckets with a watermark (partial sums in
each task before the shuffle) come out once they are closed; a processor per
series then keeps the newest ``keep`` of them in list state and gives the whole
view whenever it changes.  What reaches it is one row per bucket, not per flow,
and its state is bounded by ``keep``.  A series that has been silent for
``idle`` is dropped from the state by a timer, after one last view that is empty.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators.series import SERIES_COLS, traffic_buckets
from tidewatch.schema import BUCKET_LENGTH, DEDUP_DELAY

_NUMBERS = [f"v{i}" for i in range(len(SERIES_COLS))]  # state columns: names without blanks
STATE = T.StructType([T.StructField("at", T.LongType())] + [T.StructField(c, T.DoubleType()) for c in _NUMBERS])
VIEW = T.StructType([T.StructField("series", T.StringType()), *STATE.fields])


class NewestBuckets(StatefulProcessor):
    """List state of the newest buckets; each change gives them all, oldest first."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buckets = handle.getListState("buckets", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {r[0]: tuple(r) for r in self.buckets.get()}
        for df in rows:
            for r in df[["at", *_NUMBERS]].itertuples(index=False):
                held[int(r[0])] = (int(r[0]), *map(float, r[1:]))
        newest = [held[k] for k in sorted(held)[-self.keep:]]
        self.buckets.put(newest)
        yield pd.DataFrame([(key[0], *r) for r in newest], columns=VIEW.names)

    def close(self) -> None:
        pass


def newest_buckets(flows: DataFrame, volume_col: str, is_attack, type_col: str, keep: int = 100,
                   series: str = "all", length: str = BUCKET_LENGTH, delay: str = DEDUP_DELAY) -> DataFrame:
    """Streaming frame (series, at, sums): the newest ``keep`` closed buckets, in full at each change."""
    b = traffic_buckets(flows.withWatermark("kafka_timestamp", delay), "kafka_timestamp", volume_col, is_attack,
                        type_col, length)
    d = b.select(F.lit(series).alias("series"), F.unix_micros("bucket_start").alias("at"),
                 *[F.col(f"`{c}`").alias(n) for c, n in zip(SERIES_COLS, _NUMBERS)])
    return d.groupBy("series").transformWithStateInPandas(
        NewestBuckets(keep), outputStructType=VIEW, outputMode="Append", timeMode="None")


def named(view: DataFrame) -> DataFrame:
    """A view's rows with their bucket's start and the series' column names."""
    return view.where("at is not null").select(
        "series", F.timestamp_micros("at").alias("bucket_start"), *[F.col(n).alias(c) for c, n in zip(SERIES_COLS, _NUMBERS)])
