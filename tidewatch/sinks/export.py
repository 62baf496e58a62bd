"""CSV export of the traffic series and of the alert log (K7).

Two fixed layouts (overview; per-type breakdown), fixed headers, missing
values as 0.  Written as many part files by default (no ``coalesce(1)``,
which would funnel the whole export through one task)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.schema import ATTACK_TYPES, EXPORT_BREAKDOWN_HEADER, EXPORT_OVERVIEW_HEADER


def export_frame(series: DataFrame, breakdown: bool = False) -> DataFrame:
    src = ["t", "normal"] + (ATTACK_TYPES if breakdown else ["attack"])
    hdr = EXPORT_BREAKDOWN_HEADER if breakdown else EXPORT_OVERVIEW_HEADER
    cols = [F.col("t").alias(hdr[0])]
    cols += [F.coalesce(F.col(f"`{s}`").cast("double"), F.lit(0.0)).alias(h) for s, h in zip(src[1:], hdr[1:])]
    if "bucket_start" in series.columns:  # the clock alone does not order a series of several days
        series = series.orderBy("bucket_start")  # by ranges: part files follow each other in time
    return series.select(*cols)


def write_csv(df: DataFrame, path: str) -> str:
    """Headered CSV part files (each part carries the header)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
