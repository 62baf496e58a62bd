"""

Every query reads the driver tables (``events`` as the flow stream, see
FIXTURES.md) in full; computed columns carry the same alias on both sides.
Double columns are rounded to 6 places and timestamps returned without time
zone on both sides, so the value hashes compare like for like.
"""
from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracle_sql_base as S  # noqa: E402
from tidewatch import fixtures as X  # noqa: E402
from tidewatch.functions import classes as FC, formats as FF, keys as FK  # noqa: E402
from tidewatch.functions.parse import payload_hash  # noqa: E402
from tidewatch.operators import (dedup, devices as D, fit, metrics as M, parse as P,  # noqa: E402
                                 reports, score as SC, series as SE, topk, train as TR, tree)
from tidewatch.plans import classify as C  # noqa: E402
from tidewatch.schema import API_ALERT_LIMIT, BUCKETS_KEPT, FEED_ROWS, FLOW_LAYOUT, REFERENCE_FEATURES  # noqa: E402
from tidewatch.session import ensure_checkpoint_dir  # noqa: E402

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _out(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places, return timestamps without time zone."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return _out(fn(spark, sf_dir))
        run.__name__ = name
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _classified(spark, sf, stats=None):
    return C.fixture_classified(spark, sf, stats)


def _classified_once(spark, sf):
    """The classified flows as a table, for queries that read them several times."""
    path = _scratch(spark, "classified")
    _classified(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


# --------------------------------------------------------------------------
# Step 1: flows -> parse -> hash -> dedup -> per-device attack/normal counts
# --------------------------------------------------------------------------
@query("device_attack_normal", S.with_flows("""
SELECT device_name, count(*) AS total_records,
       CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS attack_count,
       CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS normal_count
FROM flows GROUP BY device_name"""))
def q_device_attack_normal(spark, sf):
    return reports.device_attack_normal(dedup.dedup_by_key(X.flows(spark, sf)))


@query("parse_payload", S.with_flows("SELECT * FROM flows"))
def q_parse_payload(spark, sf):
    return X.flows(spark, sf)


@query("row_count", S.with_flows("SELECT count(*) AS row_count FROM flows"))
def q_row_count(spark, sf):
    return reports.row_count(X.flows(spark, sf))


@query("batch_dedup", S.with_flows("""
SELECT DISTINCT device_name, attack, attack_subtype, label FROM flows"""))
def q_batch_dedup(spark, sf):
    return dedup.distinct_rows(X.flows(spark, sf).select("device_name", "attack", "attack_subtype", "label"))


@query("attacks_per_device", S.with_flows("""
SELECT device_name, count(*) AS attack_count FROM flows WHERE label = 0
GROUP BY device_name ORDER BY attack_count DESC, device_name"""))
def q_attacks_per_device(spark, sf):
    return reports.attacks_per_device(X.flows(spark, sf))



# --------------------------------------------------------------------------
# Projections and scalar functions
# --------------------------------------------------------------------------
@query("payload_hash", S.with_flows("""
SELECT event_id, sha256(p) AS row_hash, sha256(p || chr(10)) AS newline_hash,
       sha256(p) AS normalized_hash
FROM (SELECT event_id, """ + S.PAYLOAD + """ AS p FROM ev2)"""))
def q_payload_hash(spark, sf):
    m = X.messages(spark, sf)
    nl = F.concat(F.col("value").cast("string"), F.lit("\n"))
    return m.select(F.get(F.split(F.col("value").cast("string"), ","), 0).cast("long").alias("event_id"),
                    payload_hash("value").alias("row_hash"),
                    payload_hash(nl).alias("newline_hash"),
                    payload_hash(nl, normalize=True).alias("normalized_hash"))


def _stats_and_flows(spark, sf):
    return C.fixture_stats(spark, sf), dedup.dedup_by_key(X.flows(spark, sf))


def _stats_and_flows_once(spark, sf):
    """The same, deduplicated once, for queries that train: they read the flows many times."""
    flows = dedup.dedup_by_key(X.flows(spark, sf)).checkpoint()
    return fit.fit_stats(flows, X.FIXTURE_FEATURES), flows


@query("log_shift", S.with_flows("""
SELECT event_id, f_value,
       CASE WHEN abs(s_v) > 1.0 THEN ln(1 + (f_value + greatest(0.0, -m_v))) ELSE f_value END AS log_value
FROM flows, sk""", S.STATS.split("lg AS")[0].rstrip().rstrip(",")))
def q_log_shift(spark, sf):
    stats, flows = _stats_and_flows(spark, sf)
    logged = fit.prepare(flows.withColumn("raw", F.col("f_value")), fit.PrepStats(
        stats.feature_cols, stats.high_skew_cols, stats.log_shifts))  # the log step alone, no caps
    return logged.select("event_id", F.col("raw").alias("f_value"), F.col("f_value").alias("log_value"))


@query("iqr_cap", S.with_classified("SELECT event_id, f_value, f_k FROM prep"))
def q_iqr_cap(spark, sf):
    stats, flows = _stats_and_flows(spark, sf)
    return fit.prepare(flows, stats).select("event_id", "f_value", "f_k")


_SKEW_SQL = """
SELECT '{c}' AS feature, count({c}) AS n,
       skewness({c}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1)) AS skewness,
       min({c}) AS min_value,
       coalesce(abs(skewness({c}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1))) > 1.0, false) AS high_skew,
       greatest(0.0, coalesce(-min({c}), 0.0)) + 0.0 AS shift
FROM {t}"""


@query("fit_skew", S.with_flows("\nUNION ALL".join(_SKEW_SQL.format(c=c, t="flows")
                                                  for c in ["f_value", "f_k"])))
def q_fit_skew(spark, sf):
    return fit.skew_frame(dedup.dedup_by_key(X.flows(spark, sf)), X.FIXTURE_FEATURES)


_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("fit_skew_lineitem", "\nUNION ALL".join(_SKEW_SQL.format(c=c, t="lineitem") for c in _LI))
def q_fit_skew_lineitem(spark, sf):
    return fit.skew_frame(X.table(spark, sf, "lineitem"), _LI)


@query("fit_iqr_bounds", S.with_classified("""
SELECT 'f_value' AS feature, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM qv
UNION ALL
SELECT 'f_k', q1, q3, q3 - q1, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1) FROM qk"""))
def q_fit_iqr_bounds(spark, sf):
    flows = dedup.dedup_by_key(X.flows(spark, sf))
    return fit.bounds_frame(flows, X.FIXTURE_FEATURES)


_EMB = """
emb AS (
  SELECT vec_id, label, list_position(embedding, list_max(embedding)) - 1 AS pred_label,
         CAST(list_max(embedding) AS DOUBLE) AS pred_confidence
  FROM embeddings)"""


@query("argmax_confidence", f"WITH {_EMB}\nSELECT vec_id, CAST(pred_label AS INTEGER) AS pred_label, pred_confidence FROM emb")
def q_argmax_confidence(spark, sf):
    s = X.class_scores(spark, sf)
    return s.select("vec_id", FC.argmax_index("proba").alias("pred_label"),
                    FC.max_probability("proba").alias("pred_confidence"))


_EMB_NAMES = ("CASE pred_label WHEN 0 THEN 'Normal' WHEN 1 THEN 'DDoS Flood' WHEN 2 THEN 'Port Scan' "
              "WHEN 3 THEN 'Botnet Activity' WHEN 4 THEN 'Unauthorized Access Attempt' "
              "WHEN 5 THEN 'Data Interception' ELSE 'Unknown' END")


@query("decode_class", f"WITH {_EMB}\nSELECT vec_id, CAST(pred_label AS INTEGER) AS pred_label, {_EMB_NAMES} AS class_name FROM emb")
def q_decode_class(spark, sf):
    s = X.class_scores(spark, sf).select("vec_id", FC.argmax_index("proba").alias("pred_label"))
    return s.select("vec_id", "pred_label", FC.decode_class("pred_label", X.EMBED_CLASS_MAP).alias("class_name"))


@query("binary_prediction", f"""WITH {_EMB}
SELECT vec_id, label, CASE WHEN pred_label = 0 THEN 1 ELSE 0 END AS prediction_binary FROM emb""")
def q_binary_prediction(spark, sf):
    s = X.class_scores(spark, sf)
    return s.select("vec_id", "label",
                    FC.binary_prediction(FC.argmax_index("proba"), X.EMBED_CLASS_MAP).alias("prediction_binary"))


_TS_ISO = ("strftime(kafka_timestamp, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(kafka_timestamp) % 1000000 <> 0 "
           "THEN '.' || strftime(kafka_timestamp, '%f') ELSE '' END")
_TS_LEGACY = _TS_ISO.replace("%dT%H", "%d %H")


@query("row_key", S.with_flows(f"""
SELECT event_id, device_name || '#' || {_TS_ISO} || '#' || row_hash AS row_key,
       device_name || '#' || {_TS_LEGACY} || '#' || substr(row_hash, 1, 8) AS legacy_row_key
FROM flows"""))
def q_row_key(spark, sf):
    f = X.flows(spark, sf)
    return f.select("event_id", FK.row_key("device_name", "kafka_timestamp", "row_hash").alias("row_key"),
                    FK.row_key("device_name", "kafka_timestamp", "row_hash", legacy=True).alias("legacy_row_key"))


_KEYED_SQL = f"""
SELECT device_name || '#' || {_TS_ISO} || '#' || row_hash AS row_key,
       device_name, coalesce(attack, '') AS attack, coalesce(attack_subtype, '') AS attack_subtype,
       label AS original_label, kafka_timestamp AS event_time, prediction_binary AS prediction,
       f_value AS feature_f_value, f_k AS feature_f_k
FROM classified"""


def _keyed_flat(keyed):
    return keyed.select("row_key", *[F.col(f"cf.{c}").alias(c) for c in
                                     ["device_name", "attack", "attack_subtype", "original_label",
                                      "event_time", "prediction"]],
                        *[F.col("features")[c].alias(f"feature_{c}") for c in X.FIXTURE_FEATURES])


@query("keyed_record", S.with_classified(_KEYED_SQL))
def q_keyed_record(spark, sf):
    from tidewatch.sinks.keyed import keyed_records
    return _keyed_flat(keyed_records(_classified(spark, sf), X.FIXTURE_FEATURES))


_INDEX_SQL = """
SELECT device_name || '_' || row_hash AS doc_id, device_name, attack, attack_subtype,
       prediction_binary AS prediction, pred_confidence AS confidence, kafka_timestamp AS event_time
FROM classified"""


@query("index_document", S.with_classified(_INDEX_SQL))
def q_index_document(spark, sf):
    from tidewatch.sinks.index import index_documents
    return index_documents(_classified(spark, sf))


_ALERT_COLS = "id, device_name, device_ip, attack_type, subtype, confidence, timestamp, severity"


def _alerts(spark, sf):
    return D.alerts_from_classified(_classified(spark, sf), X.device_registry(spark, sf))


@query("alerts", S.with_alerts(f"SELECT {_ALERT_COLS} FROM alerts"))
def q_alerts(spark, sf):
    return _alerts(spark, sf).select(*_ALERT_COLS.split(", "))


@query("format_clock", S.with_flows("""
SELECT event_id, strftime(kafka_timestamp, '%H:%M:%S') AS clock,
       strftime(kafka_timestamp, '%Y-%m-%d %H:%M:%S') AS ts_text, '00:00:00' AS bad_clock
FROM flows"""))
def q_format_clock(spark, sf):
    f = X.flows(spark, sf)
    return f.select("event_id", FF.clock_text(F.col("kafka_timestamp").cast("string")).alias("clock"),
                    FF.timestamp_text("kafka_timestamp").alias("ts_text"),
                    FF.clock_text(F.col("attack_subtype")).alias("bad_clock"))


@query("demo_table", S.with_flows("""
SELECT device_name AS device_id, kafka_timestamp AS event_time, f_value AS feature_sample,
       label AS prediction, CASE WHEN label = 0 THEN 'Attack' ELSE 'Normal' END AS label
FROM flows"""))
def q_demo_table(spark, sf):
    return reports.demo_rows(X.flows(spark, sf))


@query("count_by_label", S.with_flows("""
SELECT CASE WHEN label = 0 THEN 'Attack' ELSE 'Normal' END AS label, count(*) AS total
FROM flows GROUP BY 1"""))
def q_count_by_label(spark, sf):
    return reports.count_by_label(reports.demo_rows(X.flows(spark, sf)))


# --------------------------------------------------------------------------
# Reports over classified flows (A5-A9), ordered ops (W2-W6), union
# --------------------------------------------------------------------------
@query("count_by_attack_type", S.with_classified("""
SELECT attack_type, count(*) AS total FROM classified GROUP BY attack_type ORDER BY total DESC, attack_type"""))
def q_count_by_attack_type(spark, sf):
    return reports.count_by_attack_type(_classified(spark, sf))


@query("alerts_per_device", S.with_classified("""
SELECT device_name, count(*) AS alert_count FROM classified WHERE attack_type != 'Normal'
GROUP BY device_name ORDER BY alert_count DESC, device_name"""))
def q_alerts_per_device(spark, sf):
    return reports.alerts_per_device(_classified(spark, sf))


@query("traffic_totals", S.with_flows("""
SELECT sum(f_value) AS total, sum(CASE WHEN label <> 0 THEN f_value ELSE 0.0 END) AS normal,
       sum(CASE WHEN label = 0 THEN f_value ELSE 0.0 END) AS attack,
       coalesce(round(100.0 * sum(CASE WHEN label = 0 THEN f_value ELSE 0.0 END) / nullif(sum(f_value), 0), 1), 0.0) AS detection_rate
FROM flows"""))
def q_traffic_totals(spark, sf):
    return reports.traffic_totals(X.flows(spark, sf), "f_value", F.col("label") == 0)


_TYPE_SUMS = ",\n".join(
    f"sum(CASE WHEN label = 0 AND attack = '{t}' THEN f_value ELSE 0.0 END) AS \"{t}\""
    for t in ["DDoS Flood", "Port Scan", "Botnet Activity", "Unauthorized Access Attempt", "Data Interception"])


@query("attack_breakdown", S.with_flows(f"SELECT {_TYPE_SUMS} FROM flows"))
def q_attack_breakdown(spark, sf):
    return reports.attack_breakdown(X.flows(spark, sf), "f_value", "attack", F.col("label") == 0)


_BUCKETS = f"""
bk AS (
  SELECT TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(floor(epoch_us(kafka_timestamp) / 2000000) AS BIGINT) * 2) AS bucket_start,
         * FROM flows),
buckets AS (
  SELECT bucket_start, bucket_start + INTERVAL 2 SECOND AS bucket_end, strftime(bucket_start, '%H:%M:%S') AS t,
         sum(CASE WHEN label <> 0 THEN f_value ELSE 0.0 END) AS normal,
         sum(CASE WHEN label = 0 THEN f_value ELSE 0.0 END) AS attack,
         {_TYPE_SUMS}
  FROM bk GROUP BY bucket_start)"""
_SERIES = ('normal, attack, "DDoS Flood", "Port Scan", "Botnet Activity", '
           '"Unauthorized Access Attempt", "Data Interception"')


def _buckets(spark, sf):
    return SE.traffic_buckets(X.flows(spark, sf), "kafka_timestamp", "f_value", F.col("label") == 0, "attack")


@query("traffic_buckets", S.with_flows("SELECT * FROM buckets", _BUCKETS))
def q_traffic_buckets(spark, sf):
    return _buckets(spark, sf)


@query("gap_filled_buckets", S.with_flows(f"""
SELECT g.bucket_start, g.bucket_start + INTERVAL 2 SECOND AS bucket_end, strftime(g.bucket_start, '%H:%M:%S') AS t,
       {', '.join(f'coalesce({c}, 0.0) AS {c}' for c in _SERIES.split(', '))}
FROM (SELECT unnest(generate_series((SELECT min(bucket_start) FROM buckets), (SELECT max(bucket_start) FROM buckets),
                                    INTERVAL 2 SECOND)) AS bucket_start) g
LEFT JOIN buckets b ON g.bucket_start = b.bucket_start""", _BUCKETS))
def q_gap_filled_buckets(spark, sf):
    return SE.gap_filled(spark, _buckets(spark, sf))


@query("recent_buckets", S.with_flows("SELECT * FROM buckets ORDER BY bucket_start DESC LIMIT 100", _BUCKETS))
def q_recent_buckets(spark, sf):
    return SE.recent_buckets(_buckets(spark, sf), BUCKETS_KEPT)


@query("sample_rows", S.with_flows("SELECT event_id, device_name, attack, label FROM flows ORDER BY event_id LIMIT 5"))
def q_sample_rows(spark, sf):
    return topk.sample_rows(X.flows(spark, sf).select("event_id", "device_name", "attack", "label"), 5, ["event_id"])


@query("recent_alerts", S.with_alerts(f"SELECT {_ALERT_COLS} FROM alerts ORDER BY event_time DESC, row_hash DESC LIMIT 10"))
def q_recent_alerts(spark, sf):
    return topk.last_n(_alerts(spark, sf), API_ALERT_LIMIT, "event_time", "row_hash").select(*_ALERT_COLS.split(", "))


_FEED = "kafka_timestamp, device_name, attack, attack_type, pred_confidence"


@query("recent_feed", S.with_classified(f"SELECT {_FEED} FROM classified ORDER BY kafka_timestamp DESC, row_hash DESC LIMIT 14"))
def q_recent_feed(spark, sf):
    return topk.last_n(_classified(spark, sf), FEED_ROWS, "kafka_timestamp", "row_hash").select(*_FEED.split(", "))


@query("latest_per_device", S.with_classified("""
SELECT device_name, kafka_timestamp, row_hash, attack_type, prediction_binary, pred_confidence FROM (
  SELECT *, row_number() OVER (PARTITION BY device_name ORDER BY kafka_timestamp DESC, row_hash DESC) AS rn
  FROM classified) WHERE rn = 1"""))
def q_latest_per_device(spark, sf):
    c = _classified(spark, sf).select("device_name", "kafka_timestamp", "row_hash", "attack_type",
                                      "prediction_binary", "pred_confidence")
    return topk.latest_per_key(c, "device_name", ["kafka_timestamp", "row_hash"])


@query("append_alerts", S.with_alerts(f"""
SELECT {_ALERT_COLS} FROM alerts
UNION ALL SELECT {_ALERT_COLS} FROM alerts JOIN classified USING (row_hash) WHERE event_id % 97 <> 0 AND event_id % 101 <> 0""")
       .replace("SELECT id, device_name, device_ip, attack_type, subtype, confidence, timestamp, severity FROM alerts JOIN",
                "SELECT id, alerts.device_name, device_ip, alerts.attack_type, subtype, confidence, timestamp, severity FROM alerts JOIN"))
def q_append_alerts(spark, sf):
    """Two logs that share most of their alerts, written as two batches, the
    second one twice (a replay): an append keeps both copies, a replay adds none."""
    from tidewatch.sinks import alert_log
    path = _scratch(spark, "alert-log")
    alert_log.write_alerts(_alerts(spark, sf), path, 0)
    again = q_alerts_corrupted(spark, sf)
    for _ in range(2):
        alert_log.write_alerts(again, path, 1)
    return alert_log.read_alerts(spark, path).select(*_ALERT_COLS.split(", "))


# --------------------------------------------------------------------------
# Device state, joins, system stats
# --------------------------------------------------------------------------
_REGISTRY = """
registry AS (
  SELECT 'device_' || CAST(user_id AS VARCHAR) AS device_name, '192.168.1.' || CAST(user_id AS VARCHAR) AS ip,
         'type ' || CAST(user_id % 8 AS VARCHAR) AS type, 'room ' || CAST(user_id % 8 // 2 AS VARCHAR) AS location
  FROM (SELECT DISTINCT user_id FROM events))"""

_STATE = _REGISTRY + """,
lastev AS (SELECT user_id, max(ts) AS ts, max(event_id) AS event_id FROM ev WHERE user_id % 10 = 3 GROUP BY user_id),
commands AS (
  SELECT 'device_' || CAST(user_id AS VARCHAR) AS device_name, ts AS event_time, 'isolate' AS command, event_id * 2 + 1 AS seq FROM lastev
  UNION ALL
  SELECT 'device_' || CAST(user_id AS VARCHAR), ts + INTERVAL 1 MINUTE, 'reconnect', event_id * 2 + 1 FROM lastev WHERE user_id % 20 = 3),
sev AS (
  SELECT device_name, event_time, 0 AS rnk, row_hash AS tiebreak, 'alert' AS kind, attack_type FROM alerts
  UNION ALL
  SELECT device_name, event_time, 1, lpad(CAST(seq AS VARCHAR), 20, '0'), command, NULL FROM commands),
s1 AS (SELECT device_name, CASE kind WHEN 'alert' THEN 'Under Attack' WHEN 'isolate' THEN 'ISOLATED' ELSE 'Normal' END AS v,
              row_number() OVER (PARTITION BY device_name ORDER BY event_time DESC, rnk DESC, tiebreak DESC) AS rn FROM sev),
s2 AS (SELECT device_name, kind = 'reconnect' AS v,
              row_number() OVER (PARTITION BY device_name ORDER BY event_time DESC, rnk DESC, tiebreak DESC) AS rn
       FROM sev WHERE kind IN ('isolate', 'reconnect')),
s3 AS (SELECT device_name, attack_type AS v,
              row_number() OVER (PARTITION BY device_name ORDER BY event_time DESC, rnk DESC, tiebreak DESC) AS rn
       FROM sev WHERE kind IN ('alert', 'reconnect')),
state AS (
  SELECT d.device_name, coalesce(s1.v, 'Normal') AS status, coalesce(s2.v, true) AS is_connected,
         s3.v AS last_attack_type, d.last_event_time
  FROM (SELECT device_name, max(event_time) AS last_event_time FROM sev GROUP BY device_name) d
  LEFT JOIN s1 ON s1.device_name = d.device_name AND s1.rn = 1
  LEFT JOIN s2 ON s2.device_name = d.device_name AND s2.rn = 1
  LEFT JOIN s3 ON s3.device_name = d.device_name AND s3.rn = 1)"""


def _state(spark, sf, alerts=None):
    alerts = alerts if alerts is not None else _alerts(spark, sf)
    return D.containment_state(alerts, X.containment_commands(spark, sf))


@query("device_status", S.with_alerts("""
SELECT device_name, 'Under Attack' AS status, last_attack_type, last_alert_time, alert_count FROM (
  SELECT device_name, attack_type AS last_attack_type,
         max(event_time) OVER (PARTITION BY device_name) AS last_alert_time,
         count(*) OVER (PARTITION BY device_name) AS alert_count,
         row_number() OVER (PARTITION BY device_name ORDER BY event_time DESC, row_hash DESC) AS rn
  FROM alerts) WHERE rn = 1"""))
def q_device_status(spark, sf):
    return D.device_status(_alerts(spark, sf))


@query("containment_state", S.with_alerts("SELECT * FROM state", _STATE))
def q_containment_state(spark, sf):
    return _state(spark, sf)


@query("device_list", S.with_alerts("""
SELECT r.device_name, r.ip, r.type, r.location, coalesce(s.status, 'Normal') AS status,
       CASE coalesce(s.status, 'Normal') WHEN 'Normal' THEN 'Protected' WHEN 'Under Attack' THEN 'Under Attack'
            WHEN 'ISOLATED' THEN 'Disconnected' END AS status_label,
       coalesce(s.is_connected, true) AS is_connected, s.last_attack_type
FROM registry r LEFT JOIN state s ON r.device_name = s.device_name""", _STATE))
def q_device_list(spark, sf):
    return D.device_list(X.device_registry(spark, sf), _state(spark, sf))


@query("system_stats", S.with_alerts("""
SELECT (SELECT count(*) FROM registry) AS total_monitored_devices,
       (SELECT count(*) FROM registry r JOIN state s ON r.device_name = s.device_name
        WHERE s.status = 'Under Attack' AND s.is_connected) AS active_threats,
       (SELECT count(*) FROM alerts) AS total_alerts_detected, 'MONITORING_ACTIVE' AS system_status""", _STATE))
def q_system_stats(spark, sf):
    a = D.alerts_from_classified(_classified_once(spark, sf), X.device_registry(spark, sf))
    devs = D.device_list(X.device_registry(spark, sf), _state(spark, sf, a))
    return reports.system_stats(devs, a)


@query("attacked_devices", S.with_alerts("""
SELECT device_name, last_attack_type FROM state WHERE status = 'Under Attack'""", _STATE))
def q_attacked_devices(spark, sf):
    return reports.attacked_devices(_state(spark, sf))


@query("attacked_device_count", S.with_alerts("""
SELECT count(*) AS attacked_devices FROM state WHERE status = 'Under Attack'""", _STATE))
def q_attacked_device_count(spark, sf):
    return reports.attacked_device_count(_state(spark, sf))


@query("enrich_device", S.with_flows("""
SELECT f.event_id, f.device_name, f.label, r.ip, r.type, r.location
FROM flows f LEFT JOIN registry r ON f.device_name = r.device_name""", _REGISTRY))
def q_enrich_device(spark, sf):
    f = X.flows(spark, sf).select("event_id", "device_name", "label")
    return D.enrich_device(f, X.device_registry(spark, sf))


@query("exclude_isolated", S.with_alerts("""
SELECT event_id, device_name, label FROM classified
WHERE device_name NOT IN (SELECT device_name FROM state WHERE NOT is_connected)""", _STATE))
def q_exclude_isolated(spark, sf):
    c = _classified_once(spark, sf)
    a = D.alerts_from_classified(c, X.device_registry(spark, sf))
    return D.exclude_isolated(c.select("event_id", "device_name", "label"), _state(spark, sf, a))


@query("known_device_alerts", S.with_alerts(f"""
SELECT {_ALERT_COLS}, device_name IN (SELECT device_name FROM registry WHERE type <> 'type 5') AS known FROM alerts""", _REGISTRY))
def q_known_device_alerts(spark, sf):
    """Devices of one type are not registered: their alerts go to the other side."""
    registry = X.device_registry(spark, sf).where("type <> 'type 5'")
    known, unknown = D.known_device_split(_alerts(spark, sf), registry)
    cols = _ALERT_COLS.split(", ")
    return (known.select(*cols, F.lit(True).alias("known"))
            .unionByName(unknown.select(*cols, F.lit(False).alias("known"))))


@query("rejects", S.with_flows("""
SELECT ts AS kafka_timestamp, sha256(p) AS row_hash, p AS payload,
       CASE WHEN event_id % 97 = 0 THEN 'arity' ELSE 'bad_number' END AS reject_reason
FROM (
  SELECT event_id, ts,
         CASE WHEN event_id % 97 = 0
              THEN concat_ws(',', CAST(event_id AS VARCHAR), CASE WHEN event_id % 101 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END,
                             device_name, attack, event_type, CAST(label AS VARCHAR))
              ELSE concat_ws(',', CAST(event_id AS VARCHAR), CASE WHEN event_id % 101 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END,
                             CAST(k AS VARCHAR), device_name, attack, event_type, CAST(label AS VARCHAR)) END AS p
  FROM ev2 WHERE event_id % 97 = 0 OR event_id % 101 = 0)"""))
def q_rejects(spark, sf):
    _valid, rej = P.split_rejects(X.corrupted_messages(spark, sf), X.FIXTURE_LAYOUT)
    return rej


@query("device_history", S.with_classified(f"""
SELECT * FROM ({_KEYED_SQL}) WHERE device_name IN ('device_3', 'device_7')"""))
def q_device_history(spark, sf):
    from tidewatch.sinks.keyed import device_history, keyed_records
    k = keyed_records(_classified(spark, sf), X.FIXTURE_FEATURES)
    return _keyed_flat(device_history(k, X.FIXTURE_TEST_DEVICES))


@query("alert_search", S.with_classified(f"""
SELECT * FROM ({_INDEX_SQL}) WHERE attack = 'DDoS Flood' AND confidence >= 0.6
  AND event_time >= TIMESTAMP '2024-01-05 00:00:00' AND event_time < TIMESTAMP '2024-01-20 00:00:00'"""))
def q_alert_search(spark, sf):
    from tidewatch.sinks.index import index_documents, search
    return search(index_documents(_classified(spark, sf)), attack="DDoS Flood", min_confidence=0.6,
                  start="2024-01-05 00:00:00", end="2024-01-20 00:00:00")


# --------------------------------------------------------------------------
# Evaluation and training
# --------------------------------------------------------------------------
@query("eval_confusion", S.with_classified("""
SELECT tp, fp, tn, fn, (tp + tn) / (tp + fp + tn + fn) AS accuracy, tp / (tp + fp) AS precision,
       tp / (tp + fn) AS recall, 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) AS f1
FROM (SELECT CAST(count_if(label = 0 AND prediction_binary = 0) AS BIGINT) AS tp,
             CAST(count_if(label <> 0 AND prediction_binary = 0) AS BIGINT) AS fp,
             CAST(count_if(label <> 0 AND prediction_binary <> 0) AS BIGINT) AS tn,
             CAST(count_if(label = 0 AND prediction_binary <> 0) AS BIGINT) AS fn
      FROM classified)"""))
def q_eval_confusion(spark, sf):
    return M.confusion(_classified(spark, sf), "label", "prediction_binary", positive=0)


@query("eval_auc", S.with_flows("""
SELECT CAST(sum(pos * (cum_neg - neg + 0.5 * neg)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc
FROM (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
      FROM (SELECT f_value AS score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM flows GROUP BY f_value))"""))
def q_eval_auc(spark, sf):
    return M.binary_metrics(X.flows(spark, sf), "f_value", "label", positive=1).select("roc_auc")


_AP = """
SELECT '{name}' AS positive_class, sum(pos * cp / (cp + cn)) / sum(pos) AS average_precision
FROM (SELECT *, sum(pos) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
             sum(neg) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn
      FROM (SELECT {d} AS d, CAST(count_if(label = {p}) AS DOUBLE) AS pos, CAST(count_if(label <> {p}) AS DOUBLE) AS neg
            FROM flows GROUP BY 1))"""


@query("eval_ap", S.with_flows(_AP.format(name="attack", d="f_value", p=0) + "\nUNION ALL"
                               + _AP.format(name="normal", d="-f_value", p=1)))
def q_eval_ap(spark, sf):
    # both classes from one pass: attack AP is the AP of the other class under the negated score
    m = M.binary_metrics(X.flows(spark, sf), "f_value", "label", positive=1)
    rows = F.explode(F.array(
        F.struct(F.lit("attack").alias("positive_class"), F.col("ap_negative").alias("average_precision")),
        F.struct(F.lit("normal").alias("positive_class"), F.col("ap_positive").alias("average_precision"))))
    return m.select(rows.alias("r")).select("r.*")


@query("eval_binary_metrics", S.with_flows("""
SELECT CAST(sum(pos * (cn - 0.5 * neg)) AS DOUBLE) / (sum(pos) * sum(neg)) AS roc_auc,
       sum(pos * (tp - cp + pos) / ((tp - cp + pos) + (tn - cn + neg))) / sum(pos) AS ap_normal,
       sum(neg * cn / (cn + cp)) / sum(neg) AS ap_attack
FROM (SELECT *, sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
             sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
             sum(pos) OVER () AS tp, sum(neg) OVER () AS tn
      FROM (SELECT f_value AS score, CAST(count_if(label = 1) AS DOUBLE) AS pos,
                   CAST(count_if(label <> 1) AS DOUBLE) AS neg FROM flows GROUP BY f_value))"""))
def q_eval_binary_metrics(spark, sf):
    m = M.binary_metrics(X.flows(spark, sf), "f_value", "label", positive=1)
    return m.select("roc_auc", F.col("ap_positive").alias("ap_normal"), F.col("ap_negative").alias("ap_attack"))


@query("device_split", S.with_flows("""
SELECT event_id, device_name, label,
       CASE WHEN device_name IN ('device_3', 'device_7') THEN 'test' ELSE 'train' END AS split FROM flows"""))
def q_device_split(spark, sf):
    f = X.flows(spark, sf).select("event_id", "device_name", "label")
    tr, te = TR.device_split(f, X.FIXTURE_TEST_DEVICES)
    return tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test")))


@query("class_downsample", S.with_flows("""
SELECT event_id, device_name, label FROM (
  SELECT t.*, CAST(('0x' || substr(sha256('42:' || row_hash), 1, 8)) AS UBIGINT) / 4294967296.0 AS u,
         CASE WHEN n > 0 AND a > 2.0 * n THEN 2.0 * n / a ELSE 1.0 END AS ka,
         CASE WHEN NOT (n > 0 AND a > 2.0 * n) AND a > 0 AND n > a / 2.0 THEN a / (2.0 * n) ELSE 1.0 END AS kn
  FROM (SELECT * FROM flows WHERE device_name NOT IN ('device_3', 'device_7')) t,
       (SELECT CAST(count_if(label = 0) AS DOUBLE) AS a, CAST(count_if(label = 1) AS DOUBLE) AS n
        FROM flows WHERE device_name NOT IN ('device_3', 'device_7')) c)
WHERE (label = 0 AND u < ka) OR (label = 1 AND u < kn)"""))
def q_class_downsample(spark, sf):
    tr, _ = TR.device_split(X.flows(spark, sf), X.FIXTURE_TEST_DEVICES)
    return TR.class_downsample(tr, ratio=2.0, seed=42).select("event_id", "device_name", "label")


@query("class_ratio", S.with_flows("""
SELECT attack_rows, normal_rows, CAST(attack_rows AS DOUBLE) / normal_rows AS attack_to_normal FROM (
  SELECT CAST(count_if(label = 0) AS BIGINT) AS attack_rows, CAST(count_if(label = 1) AS BIGINT) AS normal_rows FROM (
    SELECT t.*, CAST(('0x' || substr(sha256('42:' || row_hash), 1, 8)) AS UBIGINT) / 4294967296.0 AS u,
           CASE WHEN n > 0 AND a > 2.0 * n THEN 2.0 * n / a ELSE 1.0 END AS ka,
           CASE WHEN NOT (n > 0 AND a > 2.0 * n) AND a > 0 AND n > a / 2.0 THEN a / (2.0 * n) ELSE 1.0 END AS kn
    FROM (SELECT * FROM flows WHERE device_name NOT IN ('device_3', 'device_7')) t,
         (SELECT CAST(count_if(label = 0) AS DOUBLE) AS a, CAST(count_if(label = 1) AS DOUBLE) AS n
          FROM flows WHERE device_name NOT IN ('device_3', 'device_7')) c)
  WHERE (label = 0 AND u < ka) OR (label = 1 AND u < kn))"""))
def q_class_ratio(spark, sf):
    tr, _ = TR.device_split(X.flows(spark, sf), X.FIXTURE_TEST_DEVICES)
    return TR.class_ratio(TR.class_downsample(tr, ratio=2.0, seed=42))


@query("udf_score", S.with_classified("""
SELECT event_id, pred_label, pred_confidence, prediction_binary, attack_type FROM classified"""))
def q_udf_score(spark, sf):
    from tidewatch.operators.fit import prepare
    stats, flows = _stats_and_flows(spark, sf)
    out = SC.score_pandas(prepare(flows, stats), C.FixtureLogisticModel, X.FIXTURE_FEATURES,
                          X.FIXTURE_CLASS_MAP)
    return out.select("event_id", "pred_label", "pred_confidence", "prediction_binary", "attack_type")


@query("rf_train_score")
def q_rf_train_score(spark, sf):
    """Train a seeded random forest on the down-sampled training devices and
    score the held-out devices (no SQL oracle: rows-only check)."""
    stats, flows = _stats_and_flows_once(spark, sf)
    prepared = fit.prepare(flows, stats)
    tr, te = TR.device_split(prepared, X.FIXTURE_TEST_DEVICES)
    model = TR.train_random_forest(TR.class_downsample(tr), X.FIXTURE_FEATURES)
    scored = SC.score_ml(te, model, X.FIXTURE_FEATURES).withColumn("p_normal", F.get("proba", 1))
    scored = SC.apply_prediction(scored, X.FIXTURE_CLASS_MAP)
    return scored.select("event_id", "device_name", "label", "pred_label", "pred_confidence",
                         "prediction_binary", "p_normal")


@query("model_card")
def q_model_card(spark, sf):
    """Card of the random forest: fixed facts + held-out metrics (rows-only)."""
    scored = q_rf_train_score(spark, sf)
    conf = M.confusion(scored, "label", "prediction_binary", positive=0).select(
        "accuracy", "precision", "recall", "f1")
    ranks = M.binary_metrics(scored, "p_normal", "label", positive=1).select(
        F.col("ap_negative").alias("ap_attack"), F.col("ap_positive").alias("ap_normal"), "roc_auc")
    return TR.model_card(X.FIXTURE_FEATURES, X.FIXTURE_TEST_DEVICES, 2.0, 42, TR.combine_metrics([conf, ranks]))


# --------------------------------------------------------------------------
# Sources, sinks and Structured Streaming (S2, S3, S6, K1-K5, K7, T0b, T0d, G1-G2)
# Streams run with availableNow over message files derived from `events`;
# outputs land under the shared checkpoint folder and are read back.
# --------------------------------------------------------------------------
def _state_parts(spark):
    """State/shuffle partitions for the fixture streams: one per core (the
    default 200 would mostly be per-partition state-store overhead here)."""
    return spark.sparkContext.defaultParallelism


def _scratch(spark, name):
    from tidewatch.session import scratch_path
    return scratch_path(spark, name)


REPLAY_FILES = 200  # a larger input is replayed in larger files, so listings and micro-batches do not multiply


def _message_files(spark, sf, base, msgs=None, rows_per_file=1000):
    from tidewatch.sources.messages import write_replay_files
    msgs = msgs if msgs is not None else X.messages(spark, sf)
    events = X.table(spark, sf, "events").count()  # from the files' footers
    write_replay_files(msgs, f"{base}/in", max(rows_per_file, -(-events // REPLAY_FILES)))
    return f"{base}/in"


@query("replay_stream", S.with_flows("SELECT * FROM flows"))
def q_replay_stream(spark, sf):
    from tidewatch.sources.messages import read_message_files
    from tidewatch.streaming import jobs as J
    base = _scratch(spark, "replay")
    src = read_message_files(spark, _message_files(spark, sf, base), max_files_per_trigger=10)
    J.run(J.parse_stream(src, X.FIXTURE_LAYOUT, f"{base}/out", f"{base}/ck", state_partitions=_state_parts(spark)))
    return spark.read.parquet(f"{base}/out")


@query("stream_dedup", S.with_flows("SELECT * FROM flows"))
def q_stream_dedup(spark, sf):
    from tidewatch.sources.messages import read_message_files
    from tidewatch.streaming import jobs as J
    base = _scratch(spark, "dedup")
    src = read_message_files(spark, _message_files(spark, sf, base, X.duplicated_messages(spark, sf)))
    J.run(J.dedup_stream(src, X.FIXTURE_LAYOUT, f"{base}/out", f"{base}/ck", state_partitions=_state_parts(spark)))
    return spark.read.parquet(f"{base}/out")


@query("training_stream", S.with_classified("""
SELECT kafka_timestamp, event_id, f_value, f_k, device_name, label FROM prep"""))
def q_training_stream(spark, sf):
    from tidewatch.sources.messages import read_message_files
    from tidewatch.streaming import jobs as J
    base = _scratch(spark, "training")
    stats = C.fixture_stats(spark, sf)
    src = read_message_files(spark, _message_files(spark, sf, base))
    J.run(J.training_stream(src, X.FIXTURE_LAYOUT, stats, f"{base}/out", f"{base}/ck",
                            state_partitions=_state_parts(spark)))
    return spark.read.parquet(f"{base}/out")


def _fanout_run(spark, sf, stats=None):
    """Run the classification stream with all four sinks; return the paths."""
    from tidewatch.sources.messages import read_message_files
    from tidewatch.streaming import jobs as J
    base = _scratch(spark, "fanout")
    paths = {k: f"{base}/{k}" for k in ("archive", "keyed", "index", "alerts")}
    stats = stats or C.fixture_stats(spark, sf)
    src = read_message_files(spark, _message_files(spark, sf, base))
    J.run(J.classification_stream(src, X.FIXTURE_LAYOUT, stats, C.fixture_scorer, X.FIXTURE_CLASS_MAP,
                                  X.FIXTURE_FEATURES, paths, f"{base}/ck", X.device_registry(spark, sf),
                                  state_partitions=_state_parts(spark)))
    return base, paths


@query("fanout_batch", S.with_alerts("""
SELECT 'archive' AS sink, (SELECT count(*) FROM classified) AS rows_written
UNION ALL SELECT 'keyed', (SELECT count(*) FROM classified)
UNION ALL SELECT 'index', (SELECT count(*) FROM classified)
UNION ALL SELECT 'alerts', (SELECT count(*) FROM alerts)"""))
def q_fanout_batch(spark, sf):
    from tidewatch.sinks import index, keyed
    _, p = _fanout_run(spark, sf)
    parts = [("archive", spark.read.parquet(p["archive"])), ("keyed", keyed.latest_keyed(spark, p["keyed"])),
             ("index", index.latest_index(spark, p["index"])), ("alerts", spark.read.parquet(p["alerts"]))]
    out = None
    for name, df in parts:
        c = df.agg(F.count(F.lit(1)).alias("rows_written")).select(F.lit(name).alias("sink"), "rows_written")
        out = c if out is None else out.unionByName(c)
    return out


@query("archive_scan", S.with_classified("""
SELECT kafka_timestamp, row_hash, device_name, pred_label, pred_confidence, attack_type FROM classified"""))
def q_archive_scan(spark, sf):
    from tidewatch.sinks import archive
    base, p = _fanout_run(spark, sf)
    name = "archive_" + base.rsplit("-", 1)[-1]
    archive.register_archive_view(spark, p["archive"], name)
    return archive.published_view(spark.table(name))


_SECOND = "event_id % 5 = 0"  # flows that get a second version in a later batch
_KEYED_SECOND_SQL = _KEYED_SQL.replace("prediction_binary AS prediction", f"""
       CASE WHEN {_SECOND} THEN 1 - prediction_binary ELSE prediction_binary END AS prediction""").replace(
    "coalesce(attack, '') AS attack,", f"CASE WHEN {_SECOND} THEN 'Reviewed' ELSE coalesce(attack, '') END AS attack,")
_INDEX_SECOND_SQL = _INDEX_SQL.replace("prediction_binary AS prediction", f"""
       CASE WHEN {_SECOND} THEN 1 - prediction_binary ELSE prediction_binary END AS prediction""").replace(
    " attack, attack_subtype", f" CASE WHEN {_SECOND} THEN 'Reviewed' ELSE attack END AS attack, attack_subtype")


def _reviewed(classified):
    """Second versions: the flows looked at again, with another verdict."""
    return (classified.where(_SECOND).withColumn("attack", F.lit("Reviewed"))
            .withColumn("prediction_binary", 1 - F.col("prediction_binary")))


@query("keyed_upsert", S.with_classified(_KEYED_SECOND_SQL))
def q_keyed_upsert(spark, sf):
    """The stream's records and a later batch that rewrites some: last write wins."""
    from tidewatch.sinks import keyed
    stats = C.fixture_stats(spark, sf)
    _, p = _fanout_run(spark, sf, stats)
    again = keyed.keyed_records(_reviewed(_classified(spark, sf, stats)), X.FIXTURE_FEATURES)
    keyed.write_keyed(again, p["keyed"], 10**6)
    return _keyed_flat(keyed.latest_keyed(spark, p["keyed"]))


@query("index_upsert", S.with_classified(_INDEX_SECOND_SQL))
def q_index_upsert(spark, sf):
    from tidewatch.sinks import index
    stats = C.fixture_stats(spark, sf)
    _, p = _fanout_run(spark, sf, stats)
    index.write_index(index.index_documents(_reviewed(_classified(spark, sf, stats))), p["index"], 10**6)
    return index.latest_index(spark, p["index"])


def _stored(spark, sf, write, compact, frame):
    """A stored folder with three batches, a snapshot and a later batch of second versions."""
    path, c = _scratch(spark, "store"), _classified_once(spark, sf)
    for b in range(3):
        write(frame(c.where(F.col("event_id") % 3 == b)), path, b)
    compact(spark, path, files=_state_parts(spark))
    write(frame(_reviewed(c)), path, 3)
    return path


@query("keyed_prefix_scan", S.with_classified(f"""
SELECT * FROM ({_KEYED_SECOND_SQL}) WHERE device_name IN ('device_3', 'device_7')"""))
def q_keyed_prefix_scan(spark, sf):
    """Device lookup in the stored keyed folder: snapshot files by key range, then the later batch."""
    from tidewatch.sinks import keyed
    path = _stored(spark, sf, keyed.write_keyed, keyed.compact_keyed,
                   lambda c: keyed.keyed_records(c, X.FIXTURE_FEATURES))
    return _keyed_flat(keyed.prefix_scan(spark, path, X.FIXTURE_TEST_DEVICES))


@query("index_search_stored", S.with_classified(f"""
SELECT * FROM ({_INDEX_SECOND_SQL}) WHERE (attack = 'DDoS Flood' AND confidence >= 0.6
  AND event_time >= TIMESTAMP '2024-01-05 00:00:00' AND event_time < TIMESTAMP '2024-01-20 00:00:00')
  OR (attack = 'Reviewed' AND prediction = 0)"""))
def q_index_search_stored(spark, sf):
    """Search in the stored index: files by postings and ranges; superseded versions do not count."""
    from tidewatch.sinks import index
    path = _stored(spark, sf, index.write_index, index.compact_index, index.index_documents)
    found = index.search_stored(spark, path, attack="DDoS Flood", min_confidence=0.6,
                                start="2024-01-05 00:00:00", end="2024-01-20 00:00:00")
    return found.unionByName(index.search_stored(spark, path, attack="Reviewed", prediction=0))


@query("archive_table", S.with_classified("""
SELECT kafka_timestamp, row_hash, device_name, pred_label, pred_confidence, attack_type FROM classified
WHERE CAST(kafka_timestamp AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'"""))
def q_archive_table(spark, sf):
    """Partitioned catalog table over the archive; the second batch is seen through its partitions."""
    from tidewatch.sinks import archive
    path, c = _scratch(spark, "archive"), _classified_once(spark, sf)
    name = "archive_t_" + path.rsplit("-", 1)[-1]
    archive.create_archive_table(spark, name, path, c)
    for b in range(2):
        archive.write_archive(c.where(F.col("event_id") % 2 == b), path, b, table=name)
    return archive.published_view(spark.table(name).where("event_date BETWEEN DATE'2024-01-05' AND DATE'2024-01-12'"))


@query("recent_feed_stored", S.with_classified(f"SELECT {_FEED} FROM classified ORDER BY kafka_timestamp DESC, row_hash DESC LIMIT 14"))
def q_recent_feed_stored(spark, sf):
    """The live feed from the archive: only the newest dates are read."""
    from tidewatch.sinks import archive
    path = _scratch(spark, "feed")
    archive.write_archive(_classified(spark, sf), path, 0)
    return archive.newest_rows(spark, path, FEED_ROWS).select(*_FEED.split(", "))


@query("sink_commit", S.with_classified("""
SELECT device_name || '_' || row_hash AS key, device_name, attack, prediction_binary AS prediction FROM classified"""))
def q_sink_commit(spark, sf):
    """A stream into the external store's two-phase writer, restarted once; read back by its lines."""
    from tidewatch.session import local_path
    from tidewatch.sinks import external, index
    base = _scratch(spark, "external")
    docs = index.index_documents(_classified(spark, sf))
    docs.select(F.col("doc_id").alias("key"), F.to_json(F.struct("device_name", "attack", "prediction")).alias("value")) \
        .write.option("maxRecordsPerFile", 20_000).parquet(f"{base}/in")
    external.register(spark)
    for _ in range(2):
        src = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 4).parquet(f"{base}/in")
        (src.writeStream.format("keyed_put").option("path", local_path(f"{base}/out"))
         .option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start().awaitTermination())
    return external.read_puts(spark, f"{base}/out").select(
        "key", F.from_json("value", "device_name string, attack string, prediction int").alias("v")).select("key", "v.*")


_OVERVIEW_SCHEMA = "`Time` string, `Safe Traffic` double, `Attack Traffic` double"
_BREAKDOWN_SCHEMA = ("`Time` string, `Safe Traffic` double, `DDoS Flood` double, `Port Scan` double, "
                     "`Botnet Activity` double, `Unauthorized Access` double, `Data Interception` double")


@query("export_overview", S.with_flows("""
SELECT t AS "Time", normal AS "Safe Traffic", attack AS "Attack Traffic" FROM buckets""", _BUCKETS))
def q_export_overview(spark, sf):
    from tidewatch.sinks import export
    path = export.write_csv(export.export_frame(_buckets(spark, sf)), _scratch(spark, "export"))
    return export.read_csv(spark, path, _OVERVIEW_SCHEMA)


@query("export_breakdown", S.with_flows("""
SELECT t AS "Time", normal AS "Safe Traffic", "DDoS Flood", "Port Scan", "Botnet Activity",
       "Unauthorized Access Attempt" AS "Unauthorized Access", "Data Interception" FROM buckets""", _BUCKETS))
def q_export_breakdown(spark, sf):
    from tidewatch.sinks import export
    path = export.write_csv(export.export_frame(_buckets(spark, sf), breakdown=True), _scratch(spark, "export"))
    return export.read_csv(spark, path, _BREAKDOWN_SCHEMA)


@query("export_alerts", S.with_alerts(f"SELECT {_ALERT_COLS} FROM alerts"))
def q_export_alerts(spark, sf):
    from tidewatch.sinks import export
    a = _alerts(spark, sf).select(*_ALERT_COLS.split(", "))
    path = export.write_csv(a, _scratch(spark, "export"))
    return export.read_csv(spark, path, a.schema)


@query("raw_csv_scan", S.with_flows("""
SELECT event_id, f_value, f_k, device_name, attack, attack_subtype, label FROM flows"""))
def q_raw_csv_scan(spark, sf):
    from tidewatch.sources import tables
    path = _scratch(spark, "rawcsv")
    tables.write_flow_csv(X.flows(spark, sf), path, X.FIXTURE_LAYOUT)
    name = "raw_" + path.rsplit("-", 1)[-1]
    tables.register_csv_view(spark, name, path, X.FIXTURE_LAYOUT)
    return spark.table(name)


@query("bulk_load", S.with_flows("SELECT count(*) AS row_count FROM flows"))
def q_bulk_load(spark, sf):
    """Create-if-absent table at a shared path, bulk-load the headered CSV into it,
    retry the load, and verify the row count (= CSV lines minus header)."""
    from tidewatch.sources import tables
    base = _scratch(spark, "bulk")
    tables.write_flow_csv(X.flows(spark, sf), f"{base}/csv", X.FIXTURE_LAYOUT)
    name = "flows_" + base.rsplit("-", 1)[-1]
    for _ in range(2):  # set up and loaded twice: the second run changes nothing
        tables.create_table_at(spark, name, f"{base}/table", X.FIXTURE_LAYOUT, by_load=True)
        tables.load_into(tables.read_flow_csv(spark, f"{base}/csv", X.FIXTURE_LAYOUT), name, "first")
    spark.sql(f"REFRESH TABLE {name}")
    return reports.row_count(spark.table(name))


@query("containment_state_stream", S.with_alerts("""
SELECT device_name, status, is_connected, last_attack_type, last_event_time FROM state""", _STATE))
def q_containment_state_stream(spark, sf):
    from tidewatch.streaming import jobs as J
    base, p = _fanout_run(spark, sf)
    X.containment_commands(spark, sf).write.parquet(f"{base}/commands")
    alert_schema = spark.read.parquet(p["alerts"]).schema
    cmd_schema = spark.read.parquet(f"{base}/commands").schema
    alerts = spark.readStream.schema(alert_schema).parquet(p["alerts"])
    cmds = spark.readStream.schema(cmd_schema).parquet(f"{base}/commands")
    J.run(J.device_state_stream(alerts, cmds, f"{base}/state", f"{base}/ck_state",
                                state_partitions=_state_parts(spark)))
    return J.read_device_state(spark, f"{base}/state")


@query("traffic_buckets_stream", S.with_flows("SELECT * FROM buckets", _BUCKETS))
def q_traffic_buckets_stream(spark, sf):
    from tidewatch.operators.parse import parse_messages
    from tidewatch.sources.messages import read_message_files
    from tidewatch.streaming import jobs as J
    base = _scratch(spark, "traffic")
    flows = parse_messages(read_message_files(spark, _message_files(spark, sf, base)), X.FIXTURE_LAYOUT)
    J.run(J.traffic_stream(flows, "f_value", F.col("label") == 0, "attack", f"{base}/out", f"{base}/ck",
                           state_partitions=_state_parts(spark)))
    return J.read_buckets(spark, f"{base}/out")


# The training-data operators live in a folder of their own that may be absent.
_HAS_LLM = (importlib.util.find_spec("tidewatch.llm") is not None
            and importlib.util.find_spec("tidewatch.llm.queries") is not None)
if _HAS_LLM:
    from tidewatch.llm import queries as _llm  # noqa: E402
    _QUERIES.update(_llm.QUERIES)
    _SQL.update(_llm.SQL)
if _HAS_LLM and importlib.util.find_spec("corpus_pipeline") is not None:
    import corpus_pipeline as _cp  # noqa: E402

    def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return _cp.run(spark, sf_dir)

    _QUERIES["pipeline"] = _pipeline
    if _cp.ORACLE_SQL is not None:
        _SQL["pipeline"] = _cp.ORACLE_SQL


@query("alerts_corrupted", S.with_classified("""
SELECT 'ALT-' || upper(row_hash) AS id, device_name, '192.168.1.' || substr(device_name, 8) AS device_ip,
       attack AS attack_type, attack_subtype AS subtype, pred_confidence AS confidence,
       strftime(kafka_timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, 'HIGH' AS severity
FROM classified WHERE prediction_binary = 0 AND event_id % 97 <> 0 AND event_id % 101 <> 0"""))
def q_alerts_corrupted(spark, sf):
    """Malformed lines raise no alert: they are rejected before dedup and scoring."""
    prepared = C.prepared_flows(X.corrupted_messages(spark, sf), X.FIXTURE_LAYOUT, C.fixture_stats(spark, sf))
    c = C.classify(prepared, C.fixture_scorer, X.FIXTURE_CLASS_MAP)
    return D.alerts_from_classified(c, X.device_registry(spark, sf)).select(*_ALERT_COLS.split(", "))


@query("rejects_stream", _SQL["rejects"])
def q_rejects_stream(spark, sf):
    from tidewatch.sources.messages import read_message_files, write_replay_files
    from tidewatch.streaming import jobs as J
    base = _scratch(spark, "rejects")
    write_replay_files(X.corrupted_messages(spark, sf), f"{base}/in", 20_000)
    msgs = read_message_files(spark, f"{base}/in", max_files_per_trigger=2)
    J.run(J.rejects_stream(msgs, X.FIXTURE_LAYOUT, f"{base}/out", f"{base}/ck", state_partitions=_state_parts(spark)))
    return spark.read.parquet(f"{base}/out")


@query("valid_buckets", S.with_flows("""
SELECT bucket_start, t, normal, attack FROM buckets
WHERE normal IS NOT NULL AND attack IS NOT NULL AND NOT isnan(normal) AND NOT isnan(attack)
ORDER BY bucket_start DESC LIMIT 40""", _BUCKETS))
def q_valid_buckets(spark, sf):
    b = SE.valid_buckets(_buckets(spark, sf), 40)
    return b.select("bucket_start", "t", "normal", "attack")


@query("eval_edge_scores", S.with_flows("""
SELECT 'edge' AS case_name,
       CAST(sum(pos * (cum_neg - neg + 0.5 * neg)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc
FROM (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
      FROM (SELECT CASE WHEN event_id % 5 = 0 THEN CAST('inf' AS DOUBLE) WHEN event_id % 7 = 0 THEN CAST('-inf' AS DOUBLE)
                        WHEN event_id % 11 = 0 THEN CAST('nan' AS DOUBLE) ELSE f_value END AS score,
                   count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM flows GROUP BY 1))
UNION ALL SELECT 'equal', 0.5 FROM (SELECT count(DISTINCT label) AS c FROM flows) WHERE c = 2
UNION ALL SELECT 'none', CAST(NULL AS DOUBLE)"""))
def q_eval_edge_scores(spark, sf):
    """Infinite, NaN and equal scores, and no rows at all."""
    f = X.flows(spark, sf)
    i = F.col("event_id")
    score = (F.when(i % 5 == 0, F.lit(float("inf"))).when(i % 7 == 0, F.lit(float("-inf")))
             .when(i % 11 == 0, F.lit(float("nan"))).otherwise(F.col("f_value")))
    cases = {"edge": f.withColumn("s", score), "equal": f.withColumn("s", F.lit(1.0)),
             "none": f.withColumn("s", score).where(F.lit(False))}
    out = None
    for name, d in cases.items():
        r = M.binary_metrics(d, "s", "label", positive=1).select(F.lit(name).alias("case_name"), "roc_auc")
        out = r if out is None else out.unionByName(r)
    return out


# --------------------------------------------------------------------------
# The whole 27-field record (S3, A10, F4-F9 over 23 features)
# --------------------------------------------------------------------------
_WIDE = REFERENCE_FEATURES
_WIDE_ALL = ", ".join(n for n, _ in FLOW_LAYOUT)
#: a fixed two-class model over the 23 prepared features: signs alternate, weights fall
_WIDE_WEIGHTS = {c: (-1.0) ** i * 0.5 / (i + 1) for i, c in enumerate(_WIDE)}


@query("wide_raw_csv_scan", f"WITH {S.wide_flows(_WIDE)}\nSELECT {_WIDE_ALL} FROM wide")
def q_wide_raw_csv_scan(spark, sf):
    """The 27-column delimited table: written with a header, read through its SQL view."""
    from tidewatch.sources import tables
    path = _scratch(spark, "widecsv")
    tables.write_flow_csv(X.wide_flows(spark, sf), path, FLOW_LAYOUT)
    name = "wide_" + path.rsplit("-", 1)[-1]
    tables.register_csv_view(spark, name, path, FLOW_LAYOUT)
    return spark.table(name)


@query("wide_fit", f"""WITH {S.wide_flows(_WIDE)}, {S.wide_stats(_WIDE, 'wide')}
SELECT feature, n, skewness, min_value, high_skew, shift, q1, q3, iqr, lower, upper FROM wst""")
def q_wide_fit(spark, sf):
    return fit.fit_frame(P.parse_messages(X.wide_messages(spark, sf), FLOW_LAYOUT), _WIDE, accuracy=10_000_000)


_WIDE_JOINS = " ".join(f"CROSS JOIN (SELECT * FROM wst WHERE feature = '{c}') s_{c}" for c in _WIDE)
_WIDE_Z = " + ".join(f"CAST({w!r} AS DOUBLE) * {S.wide_prepared(c)}" for c, w in _WIDE_WEIGHTS.items())


@query("wide_classified", f"""WITH {S.wide_flows(_WIDE)},
once AS (SELECT DISTINCT * FROM wide), {S.wide_stats(_WIDE, 'once')},
z AS (SELECT device_name, label, {S.wide_prepared(_WIDE[0])} AS first_feature, {S.wide_prepared(_WIDE[1])} AS second_feature,
             1.0 / (1.0 + exp(-({_WIDE_Z}))) AS p1 FROM once {_WIDE_JOINS})
SELECT device_name, label, first_feature, second_feature, greatest(1.0 - p1, p1) AS pred_confidence,
       CASE WHEN 1.0 - p1 >= p1 THEN 0 ELSE 1 END AS prediction_binary,
       CASE WHEN 1.0 - p1 >= p1 THEN 'Attack' ELSE 'Normal' END AS attack_type FROM z""")
def q_wide_classified(spark, sf):
    """27-field messages: parse, dedup, fit and prepare 23 features, score, decode."""
    flows = C.store_flows(X.wide_messages(spark, sf), FLOW_LAYOUT, _scratch(spark, "wide"), columns=[*_WIDE, "device_name", "label"])
    stats = fit.fit_stats(flows, _WIDE, accuracy=10_000_000)
    c = C.classify(C.prepared_stored(flows, stats), lambda d: SC.score_linear(d, _WIDE_WEIGHTS), X.FIXTURE_CLASS_MAP)
    return c.select("device_name", "label", F.col(_WIDE[0]).alias("first_feature"), F.col(_WIDE[1]).alias("second_feature"),
                    "pred_confidence", "prediction_binary", "attack_type")


# --------------------------------------------------------------------------
# Incremental fit, a tree with an oracle, counted and enriched streams
# --------------------------------------------------------------------------
@query("fit_incremental", S.with_flows("\nUNION ALL".join(
    _SKEW_SQL.replace("AS shift", "AS shift, true AS q1_in_bound, true AS q3_in_bound").format(c=c, t="flows") for c in ["f_value", "f_k"])))
def q_fit_incremental(spark, sf):
    """Daily states written in two runs, the second one repeated, and merged; the
    quartiles' ranks are checked against all flows."""
    path, flows = _scratch(spark, "daily"), dedup.dedup_by_key(X.flows(spark, sf))
    cut = F.to_date("kafka_timestamp") < F.lit("2024-01-12").cast("date")
    for part in (cut, ~cut, ~cut):
        fit.update_sketches(flows.where(part), X.FIXTURE_FEATURES, path)
    m = fit.merged_frame(spark.read.parquet(path))
    ranks = []
    for r in m.collect():  # a row per feature
        for name, q in (("q1", 0.25), ("q3", 0.75)):
            raw = F.lit(r[name]) if not r.high_skew else F.expm1(F.lit(r[name])) - F.lit(r.shift)
            x, tol = F.col(r.feature), 1e-9 * (1 + abs(r[name]))
            below, upto = F.avg((x < raw - tol).cast("int")), F.avg((x <= raw + tol).cast("int"))
            ranks.append(((below <= q + fit.SKETCH_RANK_ERROR) & (upto >= q - fit.SKETCH_RANK_ERROR)).alias(f"{r.feature}.{name}"))
    ok = flows.agg(*ranks)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.col(f"`{c}.q1`").alias("q1_in_bound"), F.col(f"`{c}.q3`").alias("q3_in_bound"))
                               for c in X.FIXTURE_FEATURES])).alias("r")
    ok = ok.select(each).select("r.*")
    return m.join(ok, F.col("f") == F.col("feature")).select(
        "feature", "n", "skewness", "min_value", "high_skew", "shift", "q1_in_bound", "q3_in_bound")


_TREE = dict(depth=3, bins=32, least_rows=20)
_TREE_SQL = f"""
ttr AS (SELECT f_k, f_value, label FROM prep WHERE device_name NOT IN ('device_3', 'device_7')),
tte AS (SELECT event_id, device_name, label, f_k, f_value FROM prep WHERE device_name IN ('device_3', 'device_7')),
{S.tree_levels(["f_k", "f_value"], _TREE["depth"], _TREE["bins"], _TREE["least_rows"], "ttr")},
{S.tree_apply(["f_k", "f_value"], _TREE["depth"], "tte")},
shares AS (SELECT node, avg(CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END) AS attack_share FROM tr{_TREE["depth"]} GROUP BY node),
tree_scored AS (SELECT event_id, device_name, label, te.node AS leaf, attack_share,
                       CASE WHEN attack_share >= 0.5 THEN 0 ELSE 1 END AS prediction_binary
                FROM te{_TREE["depth"]} te LEFT JOIN shares USING (node))"""


def _tree_scored(spark, sf):
    stats, flows = _stats_and_flows_once(spark, sf)
    train, test = TR.device_split(fit.prepare(flows, stats), X.FIXTURE_TEST_DEVICES)
    return tree.score(test, tree.grow(train, X.FIXTURE_FEATURES, **_TREE))


@query("tree_train_score", S.with_classified("SELECT event_id, device_name, label, leaf, attack_share, prediction_binary FROM tree_scored", _TREE_SQL))
def q_tree_train_score(spark, sf):
    """A tree grown on the training devices, scoring the held-out ones."""
    return _tree_scored(spark, sf).select("event_id", "device_name", "label", "leaf", "attack_share", "prediction_binary")


@query("tree_model_card", S.with_classified("""
SELECT tp, fp, tn, fn, (tp + tn) / (tp + fp + tn + fn) AS accuracy,
       CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, tp / (tp + fn) AS recall
FROM (SELECT CAST(count_if(label = 0 AND prediction_binary = 0) AS BIGINT) AS tp,
             CAST(count_if(label <> 0 AND prediction_binary = 0) AS BIGINT) AS fp,
             CAST(count_if(label <> 0 AND prediction_binary <> 0) AS BIGINT) AS tn,
             CAST(count_if(label = 0 AND prediction_binary <> 0) AS BIGINT) AS fn FROM tree_scored)""", _TREE_SQL))
def q_tree_model_card(spark, sf):
    """The tree's held-out metrics (T3), by the same operators as the forest's card."""
    return M.confusion(_tree_scored(spark, sf), "label", "prediction_binary", positive=0).select(
        "tp", "fp", "tn", "fn", "accuracy", F.coalesce("precision", F.lit(0.0)).alias("precision"), "recall")


@query("stream_dedup_hot", S.with_flows("SELECT row_hash, event_id, f_value, f_k, device_name, attack, attack_subtype, label FROM flows"))
def q_stream_dedup_hot(spark, sf):
    """A third of all messages is one payload: deduplicated in salted parts, then once more."""
    from tidewatch.sources.messages import read_message_files
    from tidewatch.streaming import jobs as J
    base = _scratch(spark, "hot")
    src = read_message_files(spark, _message_files(spark, sf, base, X.hot_messages(spark, sf), 20_000))
    J.run(J.dedup_stream(src, X.FIXTURE_LAYOUT, f"{base}/out", f"{base}/ck", state_partitions=_state_parts(spark), salts=16))
    return spark.read.parquet(f"{base}/out").drop("kafka_timestamp")


_CUTS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00"]  # borders of the three batches
_QUALITY_SQL = f"""
part AS (SELECT ts, event_id, CASE WHEN ts < TIMESTAMP '{_CUTS[0]}' THEN 0 WHEN ts < TIMESTAMP '{_CUTS[1]}' THEN 1 ELSE 2 END AS k,
                event_id % 97 = 0 OR event_id % 101 = 0 AS bad FROM ev2),
mark AS (SELECT k, date_trunc('millisecond', max(ts) FILTER (NOT bad)) - INTERVAL 10 MINUTE AS w FROM part GROUP BY k),
sent AS (SELECT k AS batch, bad, false AS late, false AS twice FROM part
         UNION ALL SELECT p.k + 1, bad, NOT bad AND ts <= w, NOT bad AND ts > w FROM part p JOIN mark m ON p.k = m.k
         WHERE p.k < 2 AND (event_id % 10 = 0 OR ts > w))"""


@query("stream_quality", S.with_flows("""
SELECT CAST(batch AS INTEGER) AS batch, count(*) AS rows, CAST(count_if(bad) AS BIGINT) AS rejected,
       CAST(count_if(late) AS BIGINT) AS late, CAST(count_if(twice) AS BIGINT) AS duplicates FROM sent GROUP BY batch""", _QUALITY_SQL))
def q_stream_quality(spark, sf):
    """Rows, rejects, late rows and duplicates of a stream of three batches, with a
    restart before each.  A later batch holds a part of the one before again: each
    tenth message (late by then) and the last ten minutes (duplicates)."""
    from tidewatch.sources.messages import read_message_files
    from tidewatch.streaming import jobs as J
    base = _scratch(spark, "quality")
    msgs = X.corrupted_messages(spark, sf).withColumn("id", F.split(F.col("value").cast("string"), ",")[0].cast("long"))
    cuts = [F.lit(c).cast("timestamp") for c in _CUTS]
    t = F.col("timestamp")
    parts = [msgs.where(t < cuts[0]), msgs.where((t >= cuts[0]) & (t < cuts[1])), msgs.where(t >= cuts[1])]
    out, again = [], None
    for k, part in enumerate(parts):
        batch = part if again is None else part.unionByName(again)
        batch.drop("id").write.mode("append").parquet(f"{base}/in")
        q = J.counted_stream(read_message_files(spark, f"{base}/in"), X.FIXTURE_LAYOUT, f"{base}/out", f"{base}/ck",
                             state_partitions=_state_parts(spark))
        J.run(q)
        out += [(k, *r[1:]) for r in J.quality_counts(q)]
        good = (F.col("id") % 97 != 0) & (F.col("id") % 101 != 0)
        top = part.where(good).agg(F.date_trunc("millisecond", F.max("timestamp")).alias("m")).first().m
        again = part.where((F.col("id") % 10 == 0) | (t > F.lit(top) - F.expr("INTERVAL 10 MINUTES")))
    return spark.createDataFrame(out, "batch int, rows long, rejected long, late long, duplicates long")


_HALF = "2024-01-16 00:00:00"


@query("enrich_stream", S.with_flows(f"""
SELECT f.event_id, f.device_name, f.label, r.ip,
       CASE WHEN f.kafka_timestamp >= TIMESTAMP '{_HALF}' AND r.type = 'type 5' THEN 'moved' ELSE r.location END AS location
FROM flows f LEFT JOIN registry r ON f.device_name = r.device_name
  AND (f.kafka_timestamp >= TIMESTAMP '{_HALF}' OR r.type <> 'type 7')""", _REGISTRY))
def q_enrich_stream(spark, sf):
    """Flows joined with a registry that changes between two batches: devices are added and moved."""
    from tidewatch.operators.parse import parse_messages
    from tidewatch.sinks import store
    from tidewatch.sources.messages import read_message_files
    from tidewatch.streaming import jobs as J
    base, reg, msgs = _scratch(spark, "enrich"), X.device_registry(spark, sf), X.messages(spark, sf)
    half = F.col("timestamp") < F.lit(_HALF).cast("timestamp")
    later = reg.where("type IN ('type 5', 'type 7')").withColumn(
        "location", F.when(F.col("type") == "type 5", "moved").otherwise(F.col("location")))
    for k, (part, known) in enumerate(((msgs.where(half), reg.where("type <> 'type 7'")), (msgs.where(~half), later))):
        store.write_batch(known, f"{base}/registry", k)
        part.write.mode("append").parquet(f"{base}/in")
        src = parse_messages(read_message_files(spark, f"{base}/in"), X.FIXTURE_LAYOUT).select("event_id", "device_name", "label", "kafka_timestamp")
        J.run(J.enrich_stream(src, f"{base}/registry", f"{base}/out", f"{base}/ck"))
    return store.read(spark, f"{base}/out").select("event_id", "device_name", "label", "ip", "location")


@query("recent_buckets_stream", S.with_flows(f"""
SELECT bucket_start, {_SERIES} FROM buckets
WHERE bucket_end <= (SELECT date_trunc('millisecond', max(kafka_timestamp)) - INTERVAL 10 MINUTE FROM flows)
ORDER BY bucket_start DESC LIMIT 100""", _BUCKETS))
def q_recent_buckets_stream(spark, sf):
    """The newest 100 closed buckets, kept in list state over three batches and two restarts."""
    from tidewatch.operators.parse import parse_messages
    from tidewatch.sources.messages import read_message_files
    from tidewatch.streaming import jobs as J
    base, msgs = _scratch(spark, "recent"), X.messages(spark, sf)
    cuts = [F.lit(c).cast("timestamp") for c in _CUTS]
    t = F.col("timestamp")
    for part in (t < cuts[0], (t >= cuts[0]) & (t < cuts[1]), t >= cuts[1]):
        msgs.where(part).write.mode("append").parquet(f"{base}/in")
        flows = parse_messages(read_message_files(spark, f"{base}/in"), X.FIXTURE_LAYOUT)
        J.run(J.recent_stream(flows, "f_value", F.col("label") == 0, "attack", f"{base}/out", f"{base}/ck",
                              state_partitions=_state_parts(spark)))
    return J.read_recent(spark, f"{base}/out").drop("series")


def entry(spark: SparkSession) -> DataFrame:
    """
    parsed, fingerprinted, deduplicated flows."""
    return _QUERIES["device_attack_normal"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
