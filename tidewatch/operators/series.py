"""Traffic time series (T0d, T0e, A8, W5).

Tumbling buckets are ``groupBy(window(ts, length))`` with conditional sums —
the same expression works on a stream (with a watermark) and in batch.  The
gap-filled series is generated by ``spark.range`` over the bucket count
(distributed generation, no single-row ``explode``) and joined back."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.functions.formats import clock_text
from tidewatch.operators.reports import type_sums
from tidewatch.schema import ATTACK_TYPES, BUCKET_LENGTH

SERIES_COLS = ["normal", "attack"] + ATTACK_TYPES


def traffic_buckets(df: DataFrame, time_col: str, volume_col: str, is_attack,
                    type_col: str = "attack", length: str = BUCKET_LENGTH) -> DataFrame:
    """Per bucket: start, end, clock text, normal and attack volume and the
    volume of each fixed attack type."""
    v = F.coalesce(F.col(volume_col).cast("double"), F.lit(0.0))
    g = df.groupBy(F.window(F.col(time_col), length).alias("w")).agg(
        F.sum(F.when(~is_attack, v).otherwise(0.0)).alias("normal"),
        F.sum(F.when(is_attack, v).otherwise(0.0)).alias("attack"),
        *type_sums(v, type_col, is_attack),
    )
    return g.select(F.col("w.start").alias("bucket_start"), F.col("w.end").alias("bucket_end"),
                    clock_text(F.col("w.start")).alias("t"), *SERIES_COLS)


def _seconds(length: str) -> int:
    n, unit = length.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600}
    return int(n) * mult[unit]


def gap_filled(spark: SparkSession, buckets: DataFrame, length: str = BUCKET_LENGTH) -> DataFrame:
    """Every bucket between the first and the last, idle ones zero-filled."""
    step = _seconds(length)
    buckets = buckets.checkpoint()  # aggregated once: the bounds and the join read the same few rows
    b = buckets.select(F.unix_seconds("bucket_start").alias("s"), *SERIES_COLS)
    lo_hi = b.agg(F.min("s").alias("lo"), F.max("s").alias("hi")).first()  # two scalars
    if lo_hi["lo"] is None:
        return buckets.limit(0)
    lo, hi = int(lo_hi["lo"]), int(lo_hi["hi"])
    n = (hi - lo) // step + 1
    parts = n // 200_000 + 1
    grid = spark.range(0, n, 1, parts).select((F.lit(lo) + F.col("id") * step).alias("s"))
    j = grid.join(b, "s", "left")
    start = F.timestamp_seconds("s")
    return j.select(start.alias("bucket_start"),
                    F.timestamp_seconds(F.col("s") + step).alias("bucket_end"),
                    clock_text(start).alias("t"),
                    *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in SERIES_COLS])


def recent_buckets(buckets: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` buckets (top-k by time, per-task), oldest first."""
    return buckets.orderBy(F.desc("bucket_start")).limit(n).orderBy("bucket_start")


def valid_buckets(buckets: DataFrame, window: int) -> DataFrame:
    """The newest ``window`` buckets whose two series are both numbers (P5)."""
    number = [F.col(c).isNotNull() & ~F.isnan(c) for c in ("normal", "attack")]
    return recent_buckets(buckets.filter(number[0] & number[1]), window)
