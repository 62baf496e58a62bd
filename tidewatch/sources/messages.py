"""Message sources (S1, S2) and the message publisher (K8).

A message is ``(timestamp, value bytes)``, one flow record per message.  The
broker source is Kafka; the same envelope read from Parquet files stands in
for it (the Kafka connector jar is not part of this environment), and the
replay helper turns any message frame into such files so that a stream can
be driven at a chosen rate (rows per file x files per trigger)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.schema import MESSAGE_SCHEMA


def read_kafka_stream(spark: SparkSession, servers: str, topic: str,
                      starting_offsets: str = "earliest") -> DataFrame:
    """Broker stream (needs the spark-sql-kafka connector on the classpath)."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("startingOffsets", starting_offsets).load()
            .select("timestamp", "value"))


def publish_kafka(msgs: DataFrame, servers: str, topic: str) -> None:
    """Send ``value`` rows to a topic from the executors (batch write)."""
    (msgs.select(F.col("value").cast("binary").alias("value"))
         .write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).save())


def write_replay_files(msgs: DataFrame, path: str, rows_per_file: int = 1000,
                       ranges: int | None = None) -> None:
    """Lay ``msgs`` out as time-ordered Parquet files of at most
    ``rows_per_file`` rows: range partitioning by timestamp into ``ranges``
    tasks (default: the shuffle partition count), a sort inside each range,
    and ``maxRecordsPerFile`` to cut the files — no counting pass and no
    single task."""
    n_ranges = ranges or int(msgs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (msgs.repartitionByRange(n_ranges, "timestamp").sortWithinPartitions("timestamp")
         .write.mode("overwrite").option("maxRecordsPerFile", int(rows_per_file)).parquet(path))


def read_message_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the message files of ``path`` (new files are picked up as they land)."""
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)


def read_text_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream raw text lines (one message per line) as message envelopes;
    the file's arrival time stands in for the broker timestamp."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(path).select(F.current_timestamp().alias("timestamp"),
                               F.col("value").cast("binary").alias("value"))
