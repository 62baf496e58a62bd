"""Device state (G1, G2), alerts (F15, G3) and device joins.

Both state machines are decomposed into per-field *last values*:

* status          last of alert -> 'Under Attack', isolate -> 'ISOLATED',
                  reconnect -> 'Normal'                (default 'Normal')
* is_connected    last of isolate -> false, reconnect -> true   (default true)
* last_attack_type last of alert -> its type, reconnect -> NULL

Each is a ``max_by(value, order)`` with the order set to NULL for events that
do not touch the field, so the whole machine is **one** aggregate by
device (sort-based, as its buffers hold strings) — partial aggregation before the shuffle (a device holding a third of
all events costs one row per task), and the same expression works as a
streaming aggregation in update mode.  An alert on an isolated device turns
its status to 'Under Attack' but leaves it disconnected, as the reference does.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.classes import status_display
from tidewatch.functions.formats import timestamp_text
from tidewatch.operators.joins import join_dimension
from tidewatch.schema import (ALERT_SEVERITY, DEFAULT_ALERT_CONFIDENCE, STATUS_ISOLATED,
                              STATUS_NORMAL, STATUS_UNDER_ATTACK)


def alerts_from_classified(classified: DataFrame, registry: DataFrame | None = None,
                           time_col: str = "kafka_timestamp",
                           type_col: str = "attack") -> DataFrame:
    """One alert per flow predicted as attack (prediction_binary = 0).

    A flow that could not be scored raises no alert.  The id is the flow's
    whole fingerprint (stable across replays) instead of a random number.  The
    type is ``type_col``, or the decoded prediction where that is absent."""
    scored = F.col("pred_label").isNotNull() if "pred_label" in classified.columns else F.lit(True)
    kind = [F.when(F.col(c) != "", F.col(c)) for c in (type_col, "attack_type") if c in classified.columns]
    a = classified.filter((F.col("prediction_binary") == 0) & scored).select(
        F.concat(F.lit("ALT-"), F.upper("row_hash")).alias("id"),
        "device_name",
        F.coalesce(*kind).alias("attack_type"),
        F.col("attack_subtype").alias("subtype"),
        F.coalesce(F.col("pred_confidence"), F.lit(DEFAULT_ALERT_CONFIDENCE)).alias("confidence"),
        timestamp_text(time_col).alias("timestamp"),
        F.lit(ALERT_SEVERITY).alias("severity"),
        F.col(time_col).alias("event_time"),
        "row_hash",
    )
    if registry is not None:
        a = join_dimension(a, registry.select("device_name", F.col("ip").alias("device_ip")),
                           "device_name", "left")
    else:
        a = a.withColumn("device_ip", F.lit(None).cast("string"))
    return a.select("id", "device_name", "device_ip", "attack_type", "subtype", "confidence",
                    "timestamp", "severity", "event_time", "row_hash")


def device_status(alerts: DataFrame) -> DataFrame:
    """G1: devices with at least one alert are 'Under Attack' (sticky) with the
    type of their latest alert."""
    order = F.struct("event_time", "row_hash")
    return alerts.groupBy("device_name").agg(
        F.lit(STATUS_UNDER_ATTACK).alias("status"),
        F.max_by("attack_type", order).alias("last_attack_type"),
        F.max("event_time").alias("last_alert_time"),
        F.count(F.lit(1)).alias("alert_count"),
    )


def state_events(alerts: DataFrame, commands: DataFrame) -> DataFrame:
    """Union of alerts and operator commands as one ordered event log:
    device_name, event_time, rank (alerts before commands at one instant),
    tiebreak, kind, attack_type."""
    a = alerts.select("device_name", "event_time", F.lit(0).alias("rank"),
                      F.col("row_hash").alias("tiebreak"), F.lit("alert").alias("kind"),
                      "attack_type")
    c = commands.select("device_name", "event_time", F.lit(1).alias("rank"),
                        F.lpad(F.col("seq").cast("string"), 20, "0").alias("tiebreak"),
                        F.col("command").alias("kind"),
                        F.lit(None).cast("string").alias("attack_type"))
    return a.unionByName(c)


def state_aggregates() -> list:
    """The three last-value aggregates of the containment state machine."""
    kind = F.col("kind")
    order = F.struct("event_time", "rank", "tiebreak")
    status_val = (F.when(kind == "alert", F.lit(STATUS_UNDER_ATTACK))
                  .when(kind == "isolate", F.lit(STATUS_ISOLATED))
                  .when(kind == "reconnect", F.lit(STATUS_NORMAL)))
    conn_val = F.when(kind == "isolate", F.lit(False)).when(kind == "reconnect", F.lit(True))
    type_val = F.when(kind == "alert", F.col("attack_type"))
    touches_conn = kind.isin("isolate", "reconnect")
    touches_type = kind.isin("alert", "reconnect")
    return [
        F.max_by(status_val, F.when(status_val.isNotNull(), order)).alias("status"),
        F.max_by(conn_val, F.when(touches_conn, order)).alias("is_connected"),
        F.max_by(type_val, F.when(touches_type, order)).alias("last_attack_type"),
        F.max("event_time").alias("last_event_time"),
    ]


def finish_state(agg: DataFrame) -> DataFrame:
    return agg.select("device_name",
                      F.coalesce("status", F.lit(STATUS_NORMAL)).alias("status"),
                      F.coalesce("is_connected", F.lit(True)).alias("is_connected"),
                      "last_attack_type", "last_event_time")


def containment_state(alerts: DataFrame, commands: DataFrame) -> DataFrame:
    """G2 in batch: current status, is_connected, last_attack_type per device."""
    return finish_state(state_events(alerts, commands).groupBy("device_name")
                        .agg(*state_aggregates()))


def device_list(registry: DataFrame, state: DataFrame) -> DataFrame:
    """Every registered device with its state; no events -> Normal, connected."""
    j = registry.join(state.select("device_name", "status", "is_connected", "last_attack_type"),
                      "device_name", "left")
    status = F.coalesce("status", F.lit(STATUS_NORMAL))
    return j.select("device_name", "ip", "type", "location", status.alias("status"),
                    status_display(status).alias("status_label"),
                    F.coalesce("is_connected", F.lit(True)).alias("is_connected"),
                    "last_attack_type")


def enrich_device(flows: DataFrame, registry: DataFrame) -> DataFrame:
    """Flows with registry fields (left join)."""
    return join_dimension(flows, registry, "device_name", "left")


def exclude_isolated(flows: DataFrame, state: DataFrame) -> DataFrame:
    """Drop flows of currently isolated (disconnected) devices."""
    isolated = state.filter(~F.col("is_connected")).select("device_name")
    return join_dimension(flows, isolated, "device_name", "left_anti")


def known_device_split(alerts: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(alerts of registered devices, alerts of unknown devices)."""
    keys = registry.select("device_name")
    return (join_dimension(alerts, keys, "device_name", "left_semi"),
            join_dimension(alerts, keys, "device_name", "left_anti"))
