"""Table sources: delimited flow tables (S3, S4), the demo table (S5),
create-if-absent (K6), the class map (S8)."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def layout_schema(layout) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in layout])


def read_flow_csv(spark: SparkSession, path: str, layout, header: bool = True) -> DataFrame:
    """Delimited flow table with a header line to skip; explicit schema, no
    inference, malformed values become NULL (PERMISSIVE)."""
    return (spark.read.schema(layout_schema(layout)).option("header", header)
            .option("mode", "PERMISSIVE").csv(path))


def register_csv_view(spark: SparkSession, name: str, path: str, layout, header: bool = True) -> None:
    """SQL form: ``CREATE TEMPORARY VIEW ... USING csv`` with the schema."""
    cols = ", ".join(f"`{n}` {t.simpleString()}" for n, t in layout)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} ({cols}) USING csv "
              f"OPTIONS (path '{path}', header '{str(header).lower()}')")


def write_flow_csv(df: DataFrame, path: str, layout, header: bool = True) -> None:
    """Write flows as a headered delimited table in layout order."""
    df.select(*[F.col(n) for n, _ in layout]).write.mode("overwrite").option("header", header).csv(path)


LOAD_ID = "load_id"


def create_table_at(spark: SparkSession, name: str, path: str, layout, by_load: bool = False) -> None:
    """External Parquet table at a shared path (idempotent, K6); ``by_load``:
    partitioned by the load that wrote the rows."""
    cols = ", ".join(f"`{n}` {t.simpleString()}" for n, t in layout)
    part = f", {LOAD_ID} string) USING parquet PARTITIONED BY ({LOAD_ID}" if by_load else ") USING parquet"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}{part + ')' if by_load else part} LOCATION '{path}'")


def append_into(df: DataFrame, table: str) -> None:
    """Append rows into a catalog table, by column name; a retried append repeats its rows."""
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.mode("append").insertInto(table)


def load_into(df: DataFrame, table: str, load_id: str) -> None:
    """Bulk load (S4): the rows of one load replace that load's partition, so a
    load that is retried, or repeated with a corrected file, leaves one copy."""
    spark, view = df.sparkSession, f"load_{uuid.uuid4().hex[:12]}"
    cols = ", ".join(f"`{c}`" for c in spark.table(table).columns if c != LOAD_ID)
    df.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD_ID} = '{load_id}') SELECT {cols} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def create_if_absent(spark: SparkSession, database: str, tables: dict[str, str], location: str | None = None) -> None:
    """Idempotent setup (K6): database (at ``location``) and tables (``name -> DDL columns``)."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    for name, cols in tables.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet")


DEMO_ROWS = [
    ("device_01", "2026-08-14 10:00:00", 0.45, 1, "Normal"),
    ("device_02", "2026-08-14 10:00:10", 0.92, 0, "Attack"),
    ("device_03", "2026-08-14 10:00:20", 0.31, 1, "Normal"),
    ("device_01", "2026-08-14 10:00:30", 0.88, 0, "Attack"),
]


def demo_table(spark: SparkSession) -> DataFrame:
    """The four-row smoke table."""
    df = spark.createDataFrame(DEMO_ROWS, "device_id string, event_time string, feature_sample double, "
                                          "prediction int, label string")
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def load_class_map(spark: SparkSession, path: str) -> dict[int, str]:
    """Class map JSON object ``{"0": "Normal", ...}`` -> ``{0: 'Normal'}``.
    The document is tiny (one entry per class)."""
    row = spark.read.option("multiLine", True).json(path).first()
    return {int(k): str(v) for k, v in row.asDict().items() if v is not None}
