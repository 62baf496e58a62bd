"""Searchable event index (F13, K5, S11): one document per flow, id
``device_hash``, typed fields; stored like the keyed store (batches and
snapshots under a manifest, last write wins by ``doc_id``).  Search is typed
equality/range filters that Catalyst pushes into the Parquet scan; over the
stored folder, a posting table first picks the files."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.functions.keys import index_doc_id
from tidewatch.operators.merge import latest_by_key
from tidewatch.sinks import store

INDEX_COLUMNS = ["doc_id", "device_name", "attack", "attack_subtype", "prediction", "confidence", "event_time"]


def index_documents(classified: DataFrame, time_col: str = "kafka_timestamp") -> DataFrame:
    return classified.select(index_doc_id("device_name", "row_hash").alias("doc_id"), "device_name",
                             "attack", "attack_subtype", F.col("prediction_binary").alias("prediction"),
                             F.col("pred_confidence").alias("confidence"),
                             F.col(time_col).alias("event_time"))


INDEX_ORDER = [store.BATCH, "event_time"]
KEYWORDS = ["device_name", "attack", "attack_subtype", "prediction"]


def write_index(docs: DataFrame, path: str, batch_id: int) -> None:
    store.write_batch(docs, path, batch_id, sort_by=["doc_id"])


def latest_index(spark: SparkSession, path: str) -> DataFrame:
    df = store.read(spark, path).select(*INDEX_COLUMNS, store.BATCH)
    return latest_by_key(df, "doc_id", INDEX_ORDER).select(*INDEX_COLUMNS)


def compact_index(spark: SparkSession, path: str, files: int | None = None) -> store.Manifest:
    """Snapshot in the order that searches ask for (attack, then time), with a
    posting table of the keyword fields and each file's time and confidence range."""
    return store.compact(spark, path, "doc_id", INDEX_ORDER, layout=["attack", "event_time", "doc_id"],
                         zones=["event_time", "confidence"], keywords=KEYWORDS, files=files)


def _wanted(start, end, min_confidence):
    c = F.lit(True)
    if start is not None:
        c = c & (F.col("most_event_time") >= F.lit(start).cast("timestamp"))
    if end is not None:
        c = c & (F.col("least_event_time") < F.lit(end).cast("timestamp"))
    if min_confidence is not None:
        c = c & (F.col("most_confidence") >= float(min_confidence))
    return c


def search_stored(spark: SparkSession, path: str, **wanted) -> DataFrame:
    """``search`` over the stored folder: postings and ranges pick the snapshot
    files.  A snapshot document with a later version counts no longer, whether
    that version matches or not; later versions are merged, then searched."""
    m = store.current(spark, path)
    words = {f: [v] for f, v in zip(KEYWORDS, (wanted.get(k) for k in ("device", "attack", "subtype", "prediction")))
             if v is not None}
    ranges = _wanted(wanted.get("start"), wanted.get("end"), wanted.get("min_confidence"))
    files = store.pick_files(spark, path, m, ranges, words)
    old, new = store.read_snapshot(spark, path, m, files), store.read_batches(spark, path, m)
    parts = []
    if old is not None:
        old = search(old, **wanted)
        parts.append((old.join(new.select("doc_id"), "doc_id", "anti") if new is not None else old).select(*INDEX_COLUMNS))
    if new is not None:
        merged = latest_by_key(new.select(*INDEX_COLUMNS, store.BATCH), "doc_id", INDEX_ORDER)
        parts.append(search(merged, **wanted).select(*INDEX_COLUMNS))
    if not parts:
        return store.read_snapshot(spark, path, m).select(*INDEX_COLUMNS).limit(0)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def search(docs: DataFrame, attack: str | None = None, device: str | None = None,
           subtype: str | None = None, prediction: int | None = None,
           min_confidence: float | None = None, start: str | None = None,
           end: str | None = None) -> DataFrame:
    cond = F.lit(True)
    if attack is not None:
        cond = cond & (F.col("attack") == attack)
    if device is not None:
        cond = cond & (F.col("device_name") == device)
    if subtype is not None:
        cond = cond & (F.col("attack_subtype") == subtype)
    if prediction is not None:
        cond = cond & (F.col("prediction") == prediction)
    if min_confidence is not None:
        cond = cond & (F.col("confidence") >= float(min_confidence))
    if start is not None:
        cond = cond & (F.col("event_time") >= F.lit(start).cast("timestamp"))
    if end is not None:
        cond = cond & (F.col("event_time") < F.lit(end).cast("timestamp"))
    return docs.filter(cond)
