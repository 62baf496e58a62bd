"""Structured Streaming jobs (T0a-T0d, K1, K2, G1, G2).

All jobs take a streaming message frame, reuse the batch operators (they
switch to watermark forms on streams) and write with a checkpoint, so a
restart resumes from the last committed batch.  ``trigger`` defaults to
``availableNow`` (process what is there, then stop), which tests and replays
use; pass ``{"processingTime": "1 second"}`` for a long-running job.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.operators import devices as D
from tidewatch.operators.fit import PrepStats
from tidewatch.operators.series import traffic_buckets
from tidewatch.plans.classify import classify, prepared_flows
from tidewatch.schema import DEDUP_DELAY
from tidewatch.sinks import alert_log, archive, index, keyed, store
from tidewatch.sinks.fanout import fanout

AVAILABLE_NOW = {"availableNow": True}


#: the state store that list state asks for; Spark's default one holds single values only
LIST_STATE = {"spark.sql.streaming.stateStore.providerClass":
              "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _start(writer, checkpoint: str, trigger: dict | None, state_partitions: int | None = None,
           settings: dict[str, str] | None = None):
    """Start with a checkpoint.  ``state_partitions`` sets the shuffle/state
    partition count of a *new* stream (a checkpoint fixes it afterwards) and
    ``settings`` whatever else the stream needs; the stream clones the session
    when it starts, so the caller's settings are put back right after ``start()``."""
    w = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW))
    wanted = dict(settings or {})
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(int(state_partitions))
    conf = _active_conf()
    old = {k: conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            conf.set(k, v)
        return w.start()
    finally:
        for k, v in old.items():
            conf.unset(k) if v is None else conf.set(k, v)


def _active_conf():
    from pyspark.sql import SparkSession
    return (SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()).conf


def run(query, wait: bool = True):
    if wait:
        query.awaitTermination()
    return query


def training_stream(msgs: DataFrame, layout, stats: PrepStats, out_path: str, checkpoint: str,
                    trigger: dict | None = None,
                state_partitions: int | None = None, drop=("attack", "attack_subtype", "row_hash")):
    """K1: parse -> watermark dedup -> log/cap -> Parquet append (exactly once
    through the sink's metadata log)."""
    df = prepared_flows(msgs, layout, stats).drop(*drop)
    w = df.writeStream.format("parquet").option("path", out_path).outputMode("append")
    return _start(w, checkpoint, trigger, state_partitions)


def dedup_stream(msgs: DataFrame, layout, out_path: str, checkpoint: str, trigger: dict | None = None,
                state_partitions: int | None = None, salts: int = 0):
    """Parsed flows deduplicated by fingerprint within the watermark."""
    from tidewatch.operators.dedup import dedup_by_key
    from tidewatch.operators.parse import parse_messages
    df = dedup_by_key(parse_messages(msgs, layout), salts=salts)
    w = df.writeStream.format("parquet").option("path", out_path).outputMode("append")
    return _start(w, checkpoint, trigger, state_partitions)


#: what ``counted_stream`` reports for each batch
QUALITY_COLUMNS = ["batch_id", "rows", "rejected", "late", "duplicates"]


def counted_stream(msgs: DataFrame, layout, out_path: str, checkpoint: str, trigger: dict | None = None,
                   state_partitions: int | None = None):
    """T0a-T0c, S9 with counts: rejects are observed before the dedup, late and
    duplicate rows are counted by its state operator; read them with
    ``quality_counts``.  Late rows have an event time below the watermark."""
    from tidewatch.functions.parse import reject_reason
    from tidewatch.operators.dedup import dedup_by_key
    from tidewatch.operators.parse import parse_messages
    seen = msgs.withColumn("_reason", reject_reason("value", layout)).observe(
        "quality", F.count(F.lit(1)).alias("rows"), F.count("_reason").alias("rejected"))
    df = dedup_by_key(parse_messages(seen.where("_reason is null").drop("_reason"), layout))
    w = df.writeStream.format("parquet").option("path", out_path).outputMode("append")
    return _start(w, checkpoint, trigger, state_partitions)


def quality_counts(query) -> list[tuple]:
    """A row of ``QUALITY_COLUMNS`` for each batch of a ``counted_stream`` that read rows."""
    out = []
    for p in query.recentProgress:
        seen = p.observedMetrics.get("quality") if p.observedMetrics else None
        if seen is None or not p.numInputRows:
            continue
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        twice = sum(s.customMetrics.get("numDroppedDuplicateRows", 0) for s in p.stateOperators)
        out.append((p.batchId, seen.rows, seen.rejected, late, twice))
    return out


def enrich_stream(flows: DataFrame, registry_path: str, out_path: str, checkpoint: str, trigger: dict | None = None,
                  state_partitions: int | None = None):
    """J1 on a stream: every batch joins the registry as it stands when the batch
    runs (the newest state of a store keyed by device), so changes made between
    batches count; a batch that is committed is not joined again on replay."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        registry = store.latest(batch_df.sparkSession, registry_path, "device_name", [store.BATCH]).drop(store.BATCH)
        store.write_batch(D.enrich_device(without_event_time_marks(batch_df), registry), out_path, batch_id)

    return _start(flows.writeStream.foreachBatch(write), checkpoint, trigger, state_partitions)


def parse_stream(msgs: DataFrame, layout, out_path: str, checkpoint: str, trigger: dict | None = None,
                state_partitions: int | None = None):
    from tidewatch.operators.parse import parse_messages
    w = parse_messages(msgs, layout).writeStream.format("parquet").option("path", out_path)
    return _start(w.outputMode("append"), checkpoint, trigger, state_partitions)


def rejects_stream(msgs: DataFrame, layout, out_path: str, checkpoint: str, trigger: dict | None = None,
                   state_partitions: int | None = None):
    """Messages that do not parse, with the reason, as Parquet (the side output
    of the classifying and training streams, which leave them out)."""
    from tidewatch.operators.parse import split_rejects
    w = split_rejects(msgs, layout)[1].writeStream.format("parquet").option("path", out_path)
    return _start(w.outputMode("append"), checkpoint, trigger, state_partitions)


def classification_stream(msgs: DataFrame, layout, stats: PrepStats, scorer, class_map: dict,
                          feature_cols: list[str], paths: dict[str, str], checkpoint: str,
                          registry: DataFrame | None = None, trigger: dict | None = None,
                state_partitions: int | None = None, compact_every: int | None = None):
    """K2-K5: classify and fan every micro-batch out to the archive, the keyed
    store, the index and the alert log — all written from executors and
    idempotent per batch id (nothing is collected to the driver).  With
    ``compact_every`` the keyed store and the index get a compaction snapshot
    every that many batches, and folders that no manifest names any more go."""
    classified = classify(prepared_flows(msgs, layout, stats), scorer, class_map)

    sinks = []
    if "archive" in paths:
        sinks.append(lambda df, b: archive.write_archive(df, paths["archive"], b))
    if "keyed" in paths:
        sinks.append(lambda df, b: keyed.write_keyed(keyed.keyed_records(df, feature_cols), paths["keyed"], b))
    if "index" in paths:
        sinks.append(lambda df, b: index.write_index(index.index_documents(df), paths["index"], b))
    if "alerts" in paths:
        sinks.append(lambda df, b: alert_log.write_alerts(
            D.alerts_from_classified(df, registry), paths["alerts"], b))

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        wrote = fanout(without_event_time_marks(batch_df), batch_id, sinks)
        if wrote and compact_every and batch_id > 0 and batch_id % compact_every == 0:
            spark = batch_df.sparkSession
            for name, fold in (("keyed", keyed.compact_keyed), ("index", index.compact_index)):
                if name in paths:
                    fold(spark, paths[name])
                    store.clean(spark, paths[name])

    return _start(classified.writeStream.foreachBatch(write_batch), checkpoint, trigger, state_partitions)


def without_event_time_marks(df: DataFrame) -> DataFrame:
    """Drop the watermark marker that Spark keeps in column metadata, so the
    files a stream writes do not make later readers inherit an event-time
    column (and its late-row filter) they never declared."""
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={}) for c in df.columns])


def _upsert_sink(path: str, key: str, compact_every: int | None = None):
    """Each batch's rows as a batch of the store, compacted every ``compact_every`` batches."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        store.write_batch(without_event_time_marks(batch_df), path, batch_id)
        if compact_every and batch_id > 0 and batch_id % compact_every == 0:
            store.compact(batch_df.sparkSession, path, key, [store.BATCH])
            store.clean(batch_df.sparkSession, path)
    return write


def device_state_stream(alerts: DataFrame, commands: DataFrame, state_path: str, checkpoint: str,
                        trigger: dict | None = None,
                state_partitions: int | None = None, compact_every: int | None = None):
    """G1/G2 on streams: the last-value aggregates by device as a streaming
    aggregation (update mode, partial aggregation before the state store);
    each batch's updated devices are upserted into ``state_path``."""
    agg = D.state_events(alerts, commands).groupBy("device_name").agg(*D.state_aggregates())
    w = agg.writeStream.outputMode("update").foreachBatch(
        _upsert_sink(state_path, "device_name", compact_every))
    return _start(w, checkpoint, trigger, state_partitions)


def read_device_state(spark, state_path: str) -> DataFrame:
    """Current device state: newest compaction snapshot (if any) plus the
    batches after it, newest update per device."""
    return D.finish_state(store.latest(spark, state_path, "device_name", [store.BATCH]).drop(store.BATCH))


def traffic_stream(flows: DataFrame, volume_col: str, is_attack, type_col: str, out_path: str,
                   checkpoint: str, length: str = "2 seconds", delay: str = DEDUP_DELAY,
                   trigger: dict | None = None,
                state_partitions: int | None = None, compact_every: int | None = None):
    """T0d on streams: tumbling buckets with a watermark; update mode upserts
    every changed bucket (append mode would hold back the open bucket)."""
    b = traffic_buckets(flows.withWatermark("kafka_timestamp", delay), "kafka_timestamp",
                        volume_col, is_attack, type_col, length)
    w = b.writeStream.outputMode("update").foreachBatch(_upsert_sink(out_path, "bucket_start", compact_every))
    return _start(w, checkpoint, trigger, state_partitions)


def read_buckets(spark, out_path: str) -> DataFrame:
    return store.latest(spark, out_path, "bucket_start", [store.BATCH]).drop(store.BATCH)


def recent_stream(flows: DataFrame, volume_col: str, is_attack, type_col: str, out_path: str, checkpoint: str,
                  keep: int = 100, trigger: dict | None = None, state_partitions: int | None = None):
    """W5 on a stream: each batch that closes buckets stores the newest ``keep`` of them."""
    from tidewatch.streaming.recent import newest_buckets

    def write(batch_df: DataFrame, batch_id: int) -> None:
        if not batch_df.isEmpty():
            store.write_batch(without_event_time_marks(batch_df), out_path, batch_id)

    view = newest_buckets(flows, volume_col, is_attack, type_col, keep)
    return _start(view.writeStream.outputMode("append").foreachBatch(write), checkpoint, trigger, state_partitions, LIST_STATE)


def read_recent(spark, out_path: str) -> DataFrame:
    """The newest view of each series."""
    from pyspark.sql import Window
    from tidewatch.streaming.recent import named
    d = store.read(spark, out_path)
    top = F.max(store.BATCH).over(Window.partitionBy("series"))  # a few views of ``keep`` rows
    return named(d.withColumn("_top", top).where(F.col(store.BATCH) == F.col("_top")))
