"""Durable archive of classified flows.

Partitioned by ``event_date`` (pruning for time-range reports) and
``batch_id``; each write replaces only the partitions of its own batch
(dynamic partition overwrite), so replaying a micro-batch after a crash
leaves the archive unchanged instead of appending duplicates.  Rows are
rebalanced by date first: a date's rows of a batch land in few files of the
advisory size, and a large date is split over tasks.

``create_archive_table`` puts a catalog table over the folder whose partitions
the catalog knows; a batch adds its own (``add_batch_partitions``), so queries
prune by date from the catalog and nobody lists the whole folder again.
``read_archive`` goes by path, for readers without a catalog.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.functions.keys import utc_ntz
from tidewatch.operators.topk import last_n
from tidewatch.sinks import store

PUBLISHED_COLUMNS = ["kafka_timestamp", "row_hash", "device_name", "pred_label",
                     "pred_confidence", "attack_type"]
PARTITIONS = ["event_date", "batch_id"]


def _dated(df: DataFrame, batch_id: int, time_col: str) -> DataFrame:
    return (df.withColumn("event_date", utc_ntz(time_col).cast("date"))
              .withColumn("batch_id", F.lit(int(batch_id)).cast("long")))


def write_archive(df: DataFrame, path: str, batch_id: int, time_col: str = "kafka_timestamp",
                  table: str | None = None) -> None:
    """Write one batch; with ``table``, make its partitions known to the catalog."""
    (_dated(df, batch_id, time_col).hint("rebalance", F.col("event_date"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*PARTITIONS).parquet(path))
    if table:
        add_batch_partitions(_dated(df, batch_id, time_col), table)


def create_archive_table(spark: SparkSession, name: str, path: str, df: DataFrame,
                         time_col: str = "kafka_timestamp") -> None:
    """Partitioned catalog table over the archive folder, with the columns of
    the frames that are written (idempotent)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _dated(df, 0, time_col).schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"PARTITIONED BY ({', '.join(PARTITIONS)}) LOCATION '{path}'")


def add_batch_partitions(dated: DataFrame, table: str) -> None:
    """The batch's partitions: as many as it has days, whatever the archive holds."""
    days = dated.select(*PARTITIONS).distinct().collect()
    specs = " ".join("PARTITION (event_date = {}, batch_id = {})".format(
        "DATE '%s'" % r.event_date if r.event_date else "NULL", r.batch_id) for r in days)
    if specs:
        dated.sparkSession.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    dated.sparkSession.catalog.refreshTable(table)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def newest_rows(spark: SparkSession, path: str, n: int, time_col: str = "kafka_timestamp",
                tiebreak: str = "row_hash") -> DataFrame:
    """The newest ``n`` rows of the archive (W3, W4), newest first: dates are taken
    from the newest on, twice as many each time, until they hold ``n`` rows, so
    older partitions are never opened.  Rows without a date come after all others."""
    days = sorted((c[len("event_date="):] for c in store.children(spark, path)
                   if c.startswith("event_date=") and not c.endswith("__HIVE_DEFAULT_PARTITION__")), reverse=True)
    archive, take = read_archive(spark, path), 1
    while take < len(days):
        part = archive.where(F.col("event_date") >= F.lit(days[take - 1]).cast("date"))
        if part.limit(n).count() >= n:
            return last_n(part, n, time_col, tiebreak)
        take *= 2
    return last_n(archive, n, time_col, tiebreak)


def register_archive_view(spark: SparkSession, path: str, name: str) -> None:
    """SQL name over the archive path; re-listed on every query."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING parquet OPTIONS (path '{path}')")
    spark.catalog.refreshByPath(path)


def published_view(archive: DataFrame) -> DataFrame:
    """The six published columns; ``attack_type`` is the decoded prediction."""
    return archive.select(*PUBLISHED_COLUMNS)
