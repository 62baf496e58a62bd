"""Structured Streaming behaviour: multi-batch watermark dedup, restart from
a checkpoint, stream = batch, idempotent per-batch sinks."""
import datetime as dt
import time

from pyspark.sql import functions as F

from tidewatch import fixtures as X
from tidewatch.operators.parse import parse_messages
from tidewatch.plans import classify as C
from tidewatch.schema import layout
from tidewatch.sinks import archive
from tidewatch.sinks.fanout import fanout
from tidewatch.sources.messages import read_message_files
from tidewatch.streaming import jobs as J

KEY_LAYOUT = layout([("key", "string")])


def _write_file(spark, path, rows):
    base = dt.datetime(2024, 1, 1)
    data = [(base + dt.timedelta(minutes=m), k.encode()) for k, m in rows]
    spark.createDataFrame(data, "timestamp timestamp, value binary").coalesce(1) \
        .write.mode("append").parquet(path)
    time.sleep(1.1)  # distinct modification times -> files are taken in order


def test_watermark_dedup_three_files(spark, scratch):
    base = scratch("wm")
    for rows in ([("a", 0), ("a", 30)], [("a", 31), ("b", 21), ("c", 5), ("z", 60)], [("a", 59), ("d", 10)]):
        _write_file(spark, f"{base}/in", rows)
    src = read_message_files(spark, f"{base}/in", max_files_per_trigger=1)
    J.run(J.dedup_stream(src, KEY_LAYOUT, f"{base}/out", f"{base}/ck"))
    got = sorted((r.key, r.kafka_timestamp.strftime("%H:%M")) for r in spark.read.parquet(f"{base}/out").collect())
    assert got == sorted([("a", "00:00"), ("b", "00:21"), ("c", "00:05"), ("z", "01:00"), ("a", "00:59")])


def test_restart_from_checkpoint_appends_only_new(spark, scratch):
    base = scratch("restart")
    _write_file(spark, f"{base}/in", [("a", 0), ("b", 1)])
    J.run(J.parse_stream(read_message_files(spark, f"{base}/in"), KEY_LAYOUT, f"{base}/out", f"{base}/ck"))
    _write_file(spark, f"{base}/in", [("c", 2)])
    J.run(J.parse_stream(read_message_files(spark, f"{base}/in"), KEY_LAYOUT, f"{base}/out", f"{base}/ck"))
    assert sorted(r.key for r in spark.read.parquet(f"{base}/out").collect()) == ["a", "b", "c"]


def test_training_stream_equals_batch(spark, scratch):
    sf = "/root/testdata/sf0.001"
    base = scratch("sb")
    stats = C.fixture_stats(spark, sf)
    X.messages(spark, sf).write.parquet(f"{base}/in")
    J.run(J.training_stream(read_message_files(spark, f"{base}/in"), X.FIXTURE_LAYOUT, stats,
                            f"{base}/out", f"{base}/ck"))
    stream = spark.read.parquet(f"{base}/out")
    batch = C.prepared_flows(X.messages(spark, sf), X.FIXTURE_LAYOUT, stats).drop(
        "attack", "attack_subtype", "row_hash")
    assert stream.exceptAll(batch.select(*stream.columns)).count() == 0
    assert stream.count() == batch.count()


def test_archive_replay_is_idempotent(spark, scratch):
    path = scratch("arch")
    df = parse_messages(X.messages(spark, "/root/testdata/sf0.001"), X.FIXTURE_LAYOUT)
    archive.write_archive(df, path, 7)
    archive.write_archive(df, path, 7)   # replay of the same batch
    archive.write_archive(df.limit(3), path, 8)
    a = archive.read_archive(spark, path)
    assert a.count() == df.count() + 3
    assert a.filter(F.col("batch_id") == 7).count() == df.count()


def test_fanout_skips_empty_and_calls_each_sink(spark):
    calls = []
    empty = spark.createDataFrame([], "x int")
    assert fanout(empty, 0, [lambda d, b: calls.append(b)]) is False and calls == []
    one = spark.createDataFrame([(1,)], "x int")
    assert fanout(one, 3, [lambda d, b: calls.append(b), lambda d, b: calls.append(-b)]) is True
    assert calls == [3, -3]


def test_multibatch_fanout_restart_and_replay(spark, scratch):
    from tidewatch.operators import devices as D
    from tidewatch.sinks import alert_log
    sf = "/root/testdata/sf0.001"
    base = scratch("multi")
    msgs = X.messages(spark, sf).cache()
    ts = F.unix_seconds("timestamp")
    lo, hi = msgs.select(F.percentile_approx(ts, [1 / 3, 2 / 3], 10000).alias("q")).first()["q"]
    for cond in (ts < lo, (ts >= lo) & (ts < hi), ts >= hi):   # three time-ordered files
        msgs.filter(cond).coalesce(1).write.mode("append").parquet(f"{base}/in")
        time.sleep(1.1)
    stats = C.fixture_stats(spark, sf)
    paths = {k: f"{base}/{k}" for k in ("archive", "alerts")}
    reg = X.device_registry(spark, sf)

    def run():
        src = read_message_files(spark, f"{base}/in", max_files_per_trigger=1)
        return J.run(J.classification_stream(src, X.FIXTURE_LAYOUT, stats, C.fixture_scorer,
                                             X.FIXTURE_CLASS_MAP, X.FIXTURE_FEATURES, paths,
                                             f"{base}/ck", reg))

    q = run()
    n = msgs.count()
    arch = archive.read_archive(spark, paths["archive"])
    assert arch.select("batch_id").distinct().count() == 3 and arch.count() == n
    run()                                   # restart: nothing new, nothing duplicated
    assert archive.read_archive(spark, paths["archive"]).count() == n
    again = arch.filter(F.col("batch_id") == 1).drop("batch_id", "event_date").checkpoint()
    archive.write_archive(again, paths["archive"], 1)   # replay of batch 1 after a crash
    assert archive.read_archive(spark, paths["archive"]).count() == n
    assert q.lastProgress is not None

    # streaming device state over the alert log == batch state
    cmds = X.containment_commands(spark, sf)
    cmds.write.parquet(f"{base}/commands")
    a_schema = alert_log.read_alerts(spark, paths["alerts"]).schema
    s_alerts = spark.readStream.schema(a_schema).option("maxFilesPerTrigger", 2).parquet(paths["alerts"])
    s_cmds = spark.readStream.schema(cmds.schema).parquet(f"{base}/commands")
    J.run(J.device_state_stream(s_alerts, s_cmds, f"{base}/state", f"{base}/ck_state", compact_every=1))
    stream_state = J.read_device_state(spark, f"{base}/state")
    batch_state = D.containment_state(alert_log.read_alerts(spark, paths["alerts"]), cmds)
    cols = ["device_name", "status", "is_connected", "last_attack_type"]
    assert stream_state.select(*cols).exceptAll(batch_state.select(*cols)).count() == 0
    assert stream_state.count() == batch_state.count()
    msgs.unpersist()


def test_text_line_source_parses_like_messages(spark, scratch):
    from tidewatch.sources.messages import read_text_lines
    sf = "/root/testdata/sf0.001"
    base = scratch("text")
    lines = X.messages(spark, sf).select(F.col("value").cast("string").alias("value"))
    lines.write.text(f"{base}/in")
    src = read_text_lines(spark, f"{base}/in", max_files_per_trigger=1)
    J.run(J.parse_stream(src, X.FIXTURE_LAYOUT, f"{base}/out", f"{base}/ck"))
    got = spark.read.parquet(f"{base}/out").drop("kafka_timestamp")
    exp = parse_messages(X.messages(spark, sf), X.FIXTURE_LAYOUT).drop("kafka_timestamp")
    assert got.count() == exp.count() and got.exceptAll(exp).count() == 0


def test_stream_compaction_snapshots(spark, scratch):
    from tidewatch.operators.merge import latest_since_snapshot, newest_snapshot
    from tidewatch.sinks import keyed
    sf = "/root/testdata/sf0.001"
    base = scratch("compact")
    msgs = X.messages(spark, sf).cache()
    ts = F.unix_seconds("timestamp")
    lo, hi = msgs.select(F.percentile_approx(ts, [1 / 3, 2 / 3], 10000).alias("q")).first()["q"]
    for cond in (ts < lo, (ts >= lo) & (ts < hi), ts >= hi):
        msgs.filter(cond).coalesce(1).write.mode("append").parquet(f"{base}/in")
        time.sleep(1.1)
    paths = {"keyed": f"{base}/keyed"}
    src = read_message_files(spark, f"{base}/in", max_files_per_trigger=1)
    J.run(J.classification_stream(src, X.FIXTURE_LAYOUT, C.fixture_stats(spark, sf), C.fixture_scorer,
                                  X.FIXTURE_CLASS_MAP, X.FIXTURE_FEATURES, paths, f"{base}/ck",
                                  compact_every=2))
    snap = newest_snapshot(spark, paths["keyed"])
    assert snap is not None and snap.endswith("upto=2")
    via_snap = latest_since_snapshot(spark, paths["keyed"], snap, "row_key", ["batch_id", "cf"])
    full = keyed.latest_keyed(spark, paths["keyed"])
    cols = ["row_key", "cf"]   # a snapshot stamps every key with its own batch id
    assert via_snap.count() == full.count() == msgs.count()
    assert via_snap.select(*cols).exceptAll(full.select(*cols)).count() == 0
    msgs.unpersist()
