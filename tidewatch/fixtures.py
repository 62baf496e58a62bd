"""Flow-shaped inputs derived from the driver tables (see FIXTURES.md).

``events`` stands in for the flow stream: every event becomes one message
``(timestamp, value)`` whose payload is a comma-separated flow record in
``FIXTURE_LAYOUT`` order.  Parsing that message with the ordinary parser gives
the ``flows`` frame the operators work on.  Everything is derived lazily from
the given tables, so work grows with them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.schema import ATTACK_TYPES, FLOW_LAYOUT, REFERENCE_FEATURES, layout

# Flow record layout of the fixture messages (reference records carry 23
# features; the fixture carries two: a skewed one and an unskewed one).
FIXTURE_LAYOUT = layout([
    ("event_id", "bigint"),
    ("f_value", "double"),
    ("f_k", "double"),
    ("device_name", "string"),
    ("attack", "string"),
    ("attack_subtype", "string"),
    ("label", "int"),
])
FIXTURE_FEATURES = ["f_value", "f_k"]
# Two fixed devices form the held-out test set of the device split.
FIXTURE_TEST_DEVICES = ["device_3", "device_7"]
# Two-class map of the fixture scorer: index -> class name.
FIXTURE_CLASS_MAP = {0: "Attack", 1: "Normal"}
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_fields(ev: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int")
    is_attack = F.col("event_type") == "error"
    attack_types = F.array(*[F.lit(a) for a in ATTACK_TYPES])
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value", k.alias("k"),
        F.concat(F.lit("device_"), F.col("user_id").cast("string")).alias("device_name"),
        F.when(is_attack, F.lit(0)).otherwise(F.lit(1)).alias("label"),
        F.when(is_attack, F.get(attack_types, (k % 5).cast("int")))
         .otherwise(F.lit("Normal")).alias("attack"),
    )


def messages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """``(timestamp, value)`` message envelopes, one per event."""
    ev = _event_fields(events if events is not None else table(spark, sf_dir, "events"))
    payload = F.concat_ws(",", F.col("event_id").cast("string"), F.col("value").cast("string"),
                          F.col("k").cast("string"), "device_name", "attack", "event_type",
                          F.col("label").cast("string"))
    return ev.select(F.col("ts").cast("timestamp").alias("timestamp"),
                     payload.cast("binary").alias("value"))


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed flows: kafka_timestamp, row_hash, event_id, f_value, f_k,
    device_name, attack, attack_subtype, label."""
    from tidewatch.operators.parse import parse_messages
    return parse_messages(messages(spark, sf_dir), FIXTURE_LAYOUT)


def duplicated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages plus an exact re-sent copy of every tenth event."""
    m = messages(spark, sf_dir)
    ev = table(spark, sf_dir, "events")
    return m.unionByName(messages(spark, sf_dir, ev.filter(F.col("event_id") % 10 == 0)))


def corrupted_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages where some payloads lost a field (event_id % 97 = 0) or carry
    a non-numeric value (event_id % 101 = 0); used for the reject side output."""
    ev = _event_fields(table(spark, sf_dir, "events"))
    value_txt = (F.when(F.col("event_id") % 101 == 0, F.lit("n/a"))
                 .otherwise(F.col("value").cast("string")))
    parts = [F.col("event_id").cast("string"), value_txt, F.col("k").cast("string"),
             F.col("device_name"), F.col("attack"), F.col("event_type"),
             F.col("label").cast("string")]
    full = F.concat_ws(",", *parts)
    short = F.concat_ws(",", *(parts[:2] + parts[3:]))
    payload = F.when(F.col("event_id") % 97 == 0, short).otherwise(full)
    return ev.select(F.col("ts").cast("timestamp").alias("timestamp"),
                     payload.cast("binary").alias("value"))


def device_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per device seen in events: name, ip, type, location."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    i = (F.col("user_id") % 8).cast("int")
    return users.select(
        F.concat(F.lit("device_"), F.col("user_id").cast("string")).alias("device_name"),
        F.concat(F.lit("192.168.1."), F.col("user_id").cast("string")).alias("ip"),
        F.concat(F.lit("type "), i.cast("string")).alias("type"),
        F.concat(F.lit("room "), (i / 2).cast("int").cast("string")).alias("location"),
    )


def wide_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as flows of the whole 27-field record: timestamp and
    ``FLOW_LAYOUT``.  Feature i mixes two of quantity, price, discount and tax
    (FIXTURES.md §3); each fifth one is a product and thus skewed."""
    li = table(spark, sf_dir, "lineitem")
    base = [F.col("l_quantity"), F.col("l_extendedprice") / 1000, F.col("l_discount") * 10, F.col("l_tax") * 10]
    feats = []
    for i, name in enumerate(REFERENCE_FEATURES):
        a, b = base[i % 4], base[i // 4 % 4]
        feats.append((F.floor(a * a * b).cast("double") if i % 5 == 0 else a * float(i + 1) + b * 0.5).alias(name))
    attack = F.col("l_returnflag") == "R"
    types = F.array(*[F.lit(a) for a in ATTACK_TYPES])
    return li.select(
        F.col("l_shipdate").cast("timestamp").alias("timestamp"), *feats,
        F.concat(F.lit("cam_"), (F.col("l_suppkey") % 9).cast("string")).alias("device_name"),
        F.when(attack, F.get(types, (F.col("l_linenumber") % 5).cast("int"))).otherwise(F.lit("Normal")).alias("attack"),
        F.col("l_linestatus").alias("attack_subtype"), F.when(attack, 0).otherwise(1).alias("label"))


def wide_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``wide_flows`` as ``(timestamp, value)`` messages of 27 fields."""
    payload = F.concat_ws(",", *[F.col(n).cast("string") for n, _ in FLOW_LAYOUT])
    return wide_flows(spark, sf_dir).select("timestamp", payload.cast("binary").alias("value"))


def hot_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages plus many later copies, within five minutes, of one event's
    payload: a third of all rows."""
    m = messages(spark, sf_dir)
    ev = table(spark, sf_dir, "events")
    one = ev.agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("first_id"))
    first = messages(spark, sf_dir, ev.join(one, F.col("event_id") == F.col("first_id")).drop("first_id"))
    copies = ev.where(F.col("event_id") % 2 == 0).select((F.col("event_id") % 300 + 1).alias("late"))
    # one row on the right: the earliest event's message
    c = copies.withColumn("one", F.lit(1)).join(first.withColumn("one", F.lit(1)), "one")
    return m.unionByName(c.select((F.col("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("late"))).alias("timestamp"), "value"))


def containment_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator commands: isolate at the last event of devices with
    user_id % 10 = 3; reconnect those with user_id % 20 = 3 a minute later."""
    ev = table(spark, sf_dir, "events")
    last = ev.filter(F.col("user_id") % 10 == 3).groupBy("user_id").agg(
        F.max(F.col("ts").cast("timestamp")).alias("ts"), F.max("event_id").alias("event_id"))
    dev = F.concat(F.lit("device_"), F.col("user_id").cast("string"))
    iso = last.select(dev.alias("device_name"), F.col("ts").alias("event_time"),
                      F.lit("isolate").alias("command"),
                      (F.col("event_id") * 2 + 1).alias("seq"))
    rec = last.filter(F.col("user_id") % 20 == 3).select(
        dev.alias("device_name"), (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("event_time"),
        F.lit("reconnect").alias("command"), (F.col("event_id") * 2 + 1).alias("seq"))
    return iso.unionByName(rec)


def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-probability arrays (``embeddings.embedding``) with truth ``label``."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").alias("proba"), "label")


# Class map used with the ``embeddings`` score arrays (64 scores per row):
# six named classes, every other index decodes to 'Unknown'.
EMBED_CLASS_MAP = {0: "Normal", 1: "DDoS Flood", 2: "Port Scan", 3: "Botnet Activity",
                   4: "Unauthorized Access Attempt", 5: "Data Interception"}
