"""Schemas and fixed values of the flow data model.

Fixed values below must equal the ones the reference data uses; they are
stated as plain text in their natural order.
"""
from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the reference's data; do not reorder)
# ---------------------------------------------------------------------------
# The 23 per-flow statistics of the flow dataset, in message order.
REFERENCE_FEATURES = [
    "MI_dir_L0_1_weight", "MI_dir_L0_1_mean", "MI_dir_L0_1_variance",
    "H_L0_1_weight", "H_L0_1_mean", "H_L0_1_variance",
    "HH_L0_1_weight", "HH_L0_1_mean", "HH_L0_1_std", "HH_L0_1_magnitude",
    "HH_L0_1_radius", "HH_L0_1_covariance", "HH_L0_1_pcc",
    "HH_jit_L0_1_weight", "HH_jit_L0_1_mean", "HH_jit_L0_1_variance",
    "HpHp_L0_1_weight", "HpHp_L0_1_mean", "HpHp_L0_1_std", "HpHp_L0_1_magnitude",
    "HpHp_L0_1_radius", "HpHp_L0_1_covariance", "HpHp_L0_1_pcc",
]
# The five attack categories shown on the traffic breakdown, in display order.
ATTACK_TYPES = [
    "DDoS Flood", "Port Scan", "Botnet Activity",
    "Unauthorized Access Attempt", "Data Interception",
]
# Binary label convention: 0 = attack, 1 = normal.
ATTACK_LABEL = 0
NORMAL_LABEL = 1
NORMAL_CLASS = "Normal"
UNKNOWN_CLASS = "Unknown"
# Device status values and their display labels.
STATUS_NORMAL = "Normal"
STATUS_UNDER_ATTACK = "Under Attack"
STATUS_ISOLATED = "ISOLATED"
STATUS_DISPLAY = {
    STATUS_NORMAL: "Protected",
    STATUS_UNDER_ATTACK: "Under Attack",
    STATUS_ISOLATED: "Disconnected",
}
# Alert defaults.
DEFAULT_ALERT_CONFIDENCE = 0.95
ALERT_SEVERITY = "HIGH"
SYSTEM_STATUS = "MONITORING_ACTIVE"
# Export headers of the traffic series.
EXPORT_OVERVIEW_HEADER = ["Time", "Safe Traffic", "Attack Traffic"]
EXPORT_BREAKDOWN_HEADER = [
    "Time", "Safe Traffic", "DDoS Flood", "Port Scan", "Botnet Activity",
    "Unauthorized Access", "Data Interception",
]
# Dedup watermark delay and traffic bucket length.
DEDUP_DELAY = "10 minutes"
BUCKET_LENGTH = "2 seconds"
# Dashboard sizes: alerts kept, live feed rows, series buckets kept, alerts in one answer.
ALERTS_SHOWN = 8
FEED_ROWS = 14
BUCKETS_KEPT = 100
API_ALERT_LIMIT = 10
# ---------------------------------------------------------------------------

ID_FIELDS = ["device_name", "attack", "attack_subtype", "label"]


_TYPES = {
    "double": T.DoubleType(), "float": T.FloatType(), "int": T.IntegerType(),
    "bigint": T.LongType(), "long": T.LongType(), "string": T.StringType(),
    "timestamp": T.TimestampType(), "boolean": T.BooleanType(),
}


def layout(fields: list[tuple[str, str]]) -> list[tuple[str, T.DataType]]:
    """Turn ``[(name, 'double'), ...]`` into ``[(name, DataType), ...]``."""
    return [(n, _TYPES[t] if isinstance(t, str) else t) for n, t in fields]


# Positional layout of one flow message: 23 doubles, device, attack,
# subtype, int label (27 fields, no header, no quoting).
FLOW_LAYOUT = layout(
    [(c, "double") for c in REFERENCE_FEATURES]
    + [("device_name", "string"), ("attack", "string"),
       ("attack_subtype", "string"), ("label", "int")]
)

MESSAGE_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("value", T.BinaryType(), True),
])
