"""Message -> flow parsing (F1-F3) and the reject side output."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.parse import parse_fields, payload_hash, reject_reason


def parse_messages(msgs: DataFrame, layout, sep: str = ",", normalize: bool = False,
                   time_col: str = "timestamp", value_col: str = "value") -> DataFrame:
    """``(timestamp, value)`` -> ``kafka_timestamp, row_hash, <layout fields>``.

    One projection: the hash covers the raw payload, fields are split by
    position and typed with ``try_cast`` (bad values become NULL)."""
    return msgs.select(
        F.col(time_col).alias("kafka_timestamp"),
        payload_hash(value_col, normalize).alias("row_hash"),
        *parse_fields(value_col, layout, sep, normalize),
    )


def tag_rejects(msgs: DataFrame, layout, sep: str = ",", normalize: bool = False,
                time_col: str = "timestamp", value_col: str = "value",
                device_field: str = "device_name") -> DataFrame:
    """Every message parsed, with its raw payload and why it is rejected (NULL: it is valid)."""
    reason = reject_reason(value_col, layout, sep, device_field, normalize)
    return msgs.select(
        F.col(time_col).alias("kafka_timestamp"),
        payload_hash(value_col, normalize).alias("row_hash"),
        F.col(value_col).cast("string").alias("payload"),
        reason.alias("reject_reason"),
        *parse_fields(value_col, layout, sep, normalize),
    )


def split_rejects(msgs: DataFrame, layout, sep: str = ",", normalize: bool = False,
                  time_col: str = "timestamp", value_col: str = "value",
                  device_field: str = "device_name") -> tuple[DataFrame, DataFrame]:
    """Return ``(valid_flows, rejects)``.  Both are filters over one tagged
    projection, so persisting the tagged frame (or a streaming foreachBatch)
    reads the input once.  Rejects keep the raw payload and a reason."""
    tagged = tag_rejects(msgs, layout, sep, normalize, time_col, value_col, device_field)
    names = [n for n, _ in layout]
    valid = tagged.filter(F.col("reject_reason").isNull()).select(
        "kafka_timestamp", "row_hash", *names)
    rejects = tagged.filter(F.col("reject_reason").isNotNull()).select(
        "kafka_timestamp", "row_hash", "payload", "reject_reason")
    return valid, rejects


def underscore_names(df: DataFrame) -> DataFrame:
    """Rename dotted dataset columns (``MI_dir_L0.1_weight``) to underscores
    so that statistics can be looked up by name (F14).  One projection."""
    return df.select(*[F.col(f"`{c}`").alias(c.replace(".", "_")) for c in df.columns])
