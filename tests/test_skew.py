"""A device holding a third of all flows: results stay exact (checked
against pandas) and the heavy aggregates still pre-aggregate per task."""
from pyspark.sql import functions as F

from tidewatch import fixtures as X
from tidewatch.operators import dedup, devices as D, reports
from tidewatch.operators.parse import parse_messages

SF = "/root/testdata/sf0.01"


def skewed_flows(spark):
    ev = X.table(spark, SF, "events")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    return parse_messages(X.messages(spark, SF, ev), X.FIXTURE_LAYOUT)


def test_hot_device_counts_exact(spark):
    flows = skewed_flows(spark)
    pdf = flows.select("device_name", "label").toPandas()
    assert (pdf.device_name == "device_0").mean() > 1 / 3 - 0.01
    exp = pdf.groupby("device_name").label.agg(total="count", attack=lambda s: int((s == 0).sum()))
    got = reports.device_attack_normal(dedup.dedup_by_key(flows)).toPandas().set_index("device_name")
    assert (got.total_records.sort_index() == exp.total.sort_index()).all()
    assert (got.attack_count.sort_index() == exp.attack.sort_index()).all()


def test_hot_device_state_exact(spark):
    flows = skewed_flows(spark)
    alerts = flows.filter(F.col("label") == 0).select(
        "device_name", F.col("kafka_timestamp").alias("event_time"), "row_hash",
        F.col("attack").alias("attack_type"))
    cmds = spark.createDataFrame([], "device_name string, event_time timestamp, command string, seq long")
    got = {r.device_name: r.last_attack_type for r in D.containment_state(alerts, cmds).collect()}
    pdf = alerts.toPandas().sort_values(["event_time", "row_hash"])
    exp = pdf.groupby("device_name").attack_type.last().to_dict()
    assert got == exp
