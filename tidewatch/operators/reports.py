"""Warehouse and dashboard reports.

All are plain aggregates: partial aggregation on the map side, one exchange
on the grouping key, so a hot device or type costs one pre-aggregated row per
task, not its raw rows.  Orderings always carry a tiebreak so results are
stable.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.formats import one_decimal_rate
from tidewatch.functions.transform import label_text
from tidewatch.schema import (ATTACK_LABEL, ATTACK_TYPES, NORMAL_CLASS, NORMAL_LABEL,
                              STATUS_UNDER_ATTACK, SYSTEM_STATUS)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def count_by_label(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("total"))


def attacks_per_device(df: DataFrame, device_col: str = "device_name",
                       is_attack=None) -> DataFrame:
    cond = is_attack if is_attack is not None else (F.col("label") == ATTACK_LABEL)
    return (df.filter(cond).groupBy(device_col).agg(F.count(F.lit(1)).alias("attack_count"))
              .orderBy(F.desc("attack_count"), F.asc(device_col)))


def device_attack_normal(df: DataFrame, device_col: str = "device_name",
                         label_col: str = "label") -> DataFrame:
    lab = F.col(label_col)
    return df.groupBy(device_col).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum(F.when(lab == ATTACK_LABEL, 1).otherwise(0)).cast("long").alias("attack_count"),
        F.sum(F.when(lab == NORMAL_LABEL, 1).otherwise(0)).cast("long").alias("normal_count"),
    )


def count_by_attack_type(df: DataFrame, type_col: str = "attack_type") -> DataFrame:
    return (df.groupBy(type_col).agg(F.count(F.lit(1)).alias("total"))
              .orderBy(F.desc("total"), F.asc(type_col)))


def alerts_per_device(df: DataFrame, device_col: str = "device_name",
                      type_col: str = "attack_type") -> DataFrame:
    # `!=` drops NULL types, as in SQL
    return (df.filter(F.col(type_col) != NORMAL_CLASS).groupBy(device_col)
              .agg(F.count(F.lit(1)).alias("alert_count"))
              .orderBy(F.desc("alert_count"), F.asc(device_col)))


def demo_rows(flows: DataFrame, feature: str = "f_value") -> DataFrame:
    """Flows in the warehouse demo-table shape: device_id, event_time,
    feature_sample, prediction (0 attack / 1 normal), label text."""
    return flows.select(F.col("device_name").alias("device_id"),
                        F.col("kafka_timestamp").alias("event_time"),
                        F.col(feature).alias("feature_sample"),
                        F.col("label").alias("prediction"),
                        label_text("label").alias("label"))


def traffic_totals(df: DataFrame, volume_col: str, is_attack) -> DataFrame:
    """Volume-weighted totals and detection rate (one decimal, 0.0 if empty)."""
    v = F.coalesce(F.col(volume_col).cast("double"), F.lit(0.0))
    out = df.agg(F.sum(v).alias("total"),
                 F.sum(F.when(~is_attack, v).otherwise(0.0)).alias("normal"),
                 F.sum(F.when(is_attack, v).otherwise(0.0)).alias("attack"))
    out = out.select(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("total", "normal", "attack")])
    return out.withColumn("detection_rate", one_decimal_rate("attack", "total"))


def type_sums(volume, type_col: str, is_attack, types=ATTACK_TYPES) -> list:
    """Five conditional sums (one per fixed attack type); works on streams,
    where ``pivot`` is not allowed."""
    return [F.sum(F.when(is_attack & (F.col(type_col) == t), volume).otherwise(0.0)).alias(t)
            for t in types]


def attack_breakdown(df: DataFrame, volume_col: str, type_col: str, is_attack) -> DataFrame:
    """Total volume per fixed attack type (one row, five columns)."""
    v = F.coalesce(F.col(volume_col).cast("double"), F.lit(0.0))
    return df.agg(*type_sums(v, type_col, is_attack))


def system_stats(device_state: DataFrame, alerts: DataFrame) -> DataFrame:
    """Devices, connected devices under attack, alerts so far, status text.

    One aggregate over the union of both inputs (no join)."""
    threat = (F.col("status") == STATUS_UNDER_ATTACK) & F.col("is_connected")
    s = device_state.select(F.lit(1).alias("d"),
                            F.when(threat, 1).otherwise(0).alias("t"), F.lit(0).alias("a"))
    a = alerts.select(F.lit(0).alias("d"), F.lit(0).alias("t"), F.lit(1).alias("a"))
    return s.unionByName(a).agg(
        F.sum("d").cast("long").alias("total_monitored_devices"),
        F.sum("t").cast("long").alias("active_threats"),
        F.sum("a").cast("long").alias("total_alerts_detected"),
    ).select(*[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in
               ("total_monitored_devices", "active_threats", "total_alerts_detected")],
             F.lit(SYSTEM_STATUS).alias("system_status"))


def attacked_devices(state: DataFrame) -> DataFrame:
    """Devices currently under attack, one row each (never collected)."""
    return state.filter(F.col("status") == STATUS_UNDER_ATTACK).select("device_name", "last_attack_type")


def attacked_device_count(state: DataFrame) -> DataFrame:
    return state.filter(F.col("status") == STATUS_UNDER_ATTACK).agg(
        F.count(F.lit(1)).alias("attacked_devices"))
