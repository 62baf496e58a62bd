"""The newest buckets on a stream: a bounded view, restarts, several series."""
import datetime as dt

from pyspark.sql import functions as F

from tidewatch.operators.series import SERIES_COLS
from tidewatch.streaming import jobs as J


def test_newest_closed_buckets_over_restarts(spark, scratch):
    base, start = scratch("recent"), dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(seconds=30 * i), float(i), "Port Scan" if i % 3 == 0 else "Normal", 0 if i % 3 == 0 else 1)
            for i in range(300)]
    schema = "kafka_timestamp timestamp, v double, attack string, label int"

    def run(part):
        spark.createDataFrame(part, schema).write.mode("append").parquet(f"{base}/in")
        src = spark.readStream.schema(schema).parquet(f"{base}/in")
        J.run(J.recent_stream(src, "v", F.col("label") == 0, "attack", f"{base}/out", f"{base}/ck", keep=15, state_partitions=2))
        return sorted((r.bucket_start, r.normal, r.attack, r["Port Scan"]) for r in J.read_recent(spark, f"{base}/out").collect())

    def want(seen):
        closed = seen[-1][0] - dt.timedelta(minutes=10)
        return sorted((t, v if y else 0.0, 0.0 if y else v, 0.0 if y else v) for t, v, _, y in seen
                      if t + dt.timedelta(seconds=2) <= closed)[-15:]

    assert run(rows[:100]) == want(rows[:100])
    assert run(rows[100:120]) == want(rows[:120])
    assert run(rows[120:]) == want(rows)
    assert J.read_recent(spark, f"{base}/out").columns == ["series", "bucket_start", *SERIES_COLS]


def test_newest_buckets_in_a_session_with_the_default_state_store(spark, scratch):
    """The stream brings its own state store, whatever the session is set to, and leaves the setting as it was."""
    key = "spark.sql.streaming.stateStore.providerClass"
    base, start, old = scratch("recent"), dt.datetime(2024, 1, 1), spark.conf.get(key)
    hdfs = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    schema = "kafka_timestamp timestamp, v double, attack string, label int"
    rows = [(start + dt.timedelta(seconds=30 * i), float(i), "Normal", 1) for i in range(60)]
    spark.conf.set(key, hdfs)
    try:
        for part in (rows[:40], rows[40:]):
            spark.createDataFrame(part, schema).write.mode("append").parquet(f"{base}/in")
            src = spark.readStream.schema(schema).parquet(f"{base}/in")
            J.run(J.recent_stream(src, "v", F.col("label") == 0, "attack", f"{base}/out", f"{base}/ck", keep=5, state_partitions=2))
            assert spark.conf.get(key) == hdfs
    finally:
        spark.conf.set(key, old)
    got = sorted((r.bucket_start, r.normal) for r in J.read_recent(spark, f"{base}/out").collect())
    closed = rows[-1][0] - dt.timedelta(minutes=10)
    assert got == [r[:2] for r in rows if r[0] + dt.timedelta(seconds=2) <= closed][-5:]
