"""Properties from the test plan: upsert order-independence, dedup
idempotence, replayed keyed batches, ML scoring paths."""
import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidewatch import fixtures as X
from tidewatch.operators import dedup, merge
from tidewatch.operators import score as SC
from tidewatch.sinks import keyed

SF = "/root/testdata/sf0.001"

rows = st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.integers(0, 5), st.integers(0, 100)),
                min_size=1, max_size=20)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows, st.randoms())
def test_upsert_order_independent(spark, data, rnd):
    schema = "k string, batch_id int, v int"
    shuffled = list(data)
    rnd.shuffle(shuffled)
    half = len(shuffled) // 2
    a = merge.latest_by_key(spark.createDataFrame(data, schema), "k", ["batch_id", "v"])
    b = merge.upsert(spark.createDataFrame(shuffled[:half], schema),
                     spark.createDataFrame(shuffled[half:], schema), "k", ["batch_id", "v"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_dedup_idempotent_and_earliest(spark):
    msgs = X.duplicated_messages(spark, SF).withColumn(
        "timestamp", F.col("timestamp") + F.expr("INTERVAL 1 SECOND") * (F.rand(3) > 0.5).cast("int"))
    from tidewatch.operators.parse import parse_messages
    flows = parse_messages(msgs, X.FIXTURE_LAYOUT)
    once = dedup.dedup_by_key(flows).cache()
    twice = dedup.dedup_by_key(once)
    assert once.count() == flows.select("row_hash").distinct().count()
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    earliest = flows.groupBy("row_hash").agg(F.min("kafka_timestamp").alias("t"))
    assert once.join(earliest, "row_hash").filter(F.col("t") != F.col("kafka_timestamp")).count() == 0
    once.unpersist()


def test_keyed_replay_keeps_latest_view(spark, scratch):
    from tidewatch.plans import classify as C
    path = scratch("keyed")
    recs = keyed.keyed_records(C.fixture_classified(spark, SF), X.FIXTURE_FEATURES).cache()
    keyed.write_keyed(recs, path, 0)
    first = keyed.latest_keyed(spark, path).drop("batch_id")
    n = first.count()
    keyed.write_keyed(recs, path, 0)      # replay of batch 0
    keyed.write_keyed(recs.limit(5), path, 1)  # later batch re-writes five keys
    again = keyed.latest_keyed(spark, path)
    assert again.count() == n == recs.select("row_key").distinct().count()
    assert again.filter(F.col("batch_id") == 1).count() == 5
    recs.unpersist()


def test_score_ml_bare_classifier(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    flows = X.flows(spark, SF)
    va = VectorAssembler(inputCols=X.FIXTURE_FEATURES, outputCol="features")
    model = LogisticRegression(labelCol="label", maxIter=5).fit(va.transform(flows))
    scored = SC.apply_prediction(SC.score_ml(flows, model, X.FIXTURE_FEATURES), X.FIXTURE_CLASS_MAP)
    r = scored.agg(F.count("*").alias("n"), F.min("pred_confidence").alias("c")).first()
    assert r.n == flows.count() and r.c >= 0.5


def test_pandas_scorer_equals_jvm_scorer(spark):
    from tidewatch.operators.fit import prepare
    from tidewatch.plans import classify as C
    stats = C.fixture_stats(spark, SF)
    prepared = prepare(dedup.dedup_by_key(X.flows(spark, SF)), stats)
    a = SC.apply_prediction(C.fixture_scorer(prepared), X.FIXTURE_CLASS_MAP)
    b = SC.score_pandas(prepared, C.FixtureLogisticModel, X.FIXTURE_FEATURES, X.FIXTURE_CLASS_MAP)
    cols = ["row_hash", "pred_label", "prediction_binary"]
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    diff = a.select("row_hash", F.col("pred_confidence").alias("x")).join(
        b.select("row_hash", F.col("pred_confidence").alias("y")), "row_hash")
    assert diff.filter(F.abs(F.col("x") - F.col("y")) > 1e-12).count() == 0
    random.seed(0)


def test_keyed_record_null_text_becomes_empty(spark):
    import datetime as dt
    df = spark.createDataFrame(
        [("dev", None, None, None, dt.datetime(2024, 1, 1), "ab" * 32, 0, 1.5)],
        "device_name string, attack string, attack_subtype string, label int, kafka_timestamp timestamp, "
        "row_hash string, prediction_binary int, f_value double")
    r = keyed.keyed_records(df, ["f_value"]).first()
    assert (r.cf.attack, r.cf.attack_subtype, r.cf.original_label) == ("", "", None)
    assert r.features == {"f_value": 1.5} and r.row_key == "dev#2024-01-01T00:00:00#" + "ab" * 32


def test_archive_view_sees_new_batches(spark, scratch):
    from tidewatch.operators.parse import parse_messages
    from tidewatch.sinks import archive
    path = scratch("view")
    df = parse_messages(X.messages(spark, SF), X.FIXTURE_LAYOUT)
    archive.write_archive(df.limit(10), path, 0)
    archive.register_archive_view(spark, path, "arch_view_test")
    assert spark.table("arch_view_test").count() == 10
    archive.write_archive(df.limit(4), path, 1)
    archive.register_archive_view(spark, path, "arch_view_test")
    assert spark.sql("SELECT count(*) AS n FROM arch_view_test").first().n == 14
    assert archive.read_archive(spark, path).count() == 14


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(0, 1e6), min_size=2, max_size=30), st.floats(0, 100))
def test_log_shift_monotone(spark, xs, shift):
    from tidewatch.functions.transform import log_shift
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = sorted((r.x, r.y) for r in df.select("x", log_shift("x", shift).alias("y")).collect())
    ys = [y for _, y in got]
    assert ys == sorted(ys)


def test_compaction_keeps_latest_view(spark, scratch):
    from tidewatch.operators.merge import compact
    src, dst = scratch("src"), scratch("dst")
    keyed_rows = [("k1", 1, "a"), ("k2", 1, "b")]
    spark.createDataFrame(keyed_rows, "k string, batch_id long, v string").write.partitionBy("batch_id").parquet(src)
    spark.createDataFrame([("k1", 2, "c")], "k string, batch_id long, v string").write.mode("append") \
        .partitionBy("batch_id").parquet(src)
    assert compact(spark, src, dst, "k", ["batch_id"]) == 2
    got = sorted((r.k, r.v) for r in spark.read.parquet(dst).collect())
    assert got == [("k1", "c"), ("k2", "b")]
    from tidewatch.operators.merge import latest_since_snapshot
    spark.createDataFrame([("k2", 3, "d"), ("k3", 3, "e")], "k string, batch_id long, v string") \
        .write.mode("append").partitionBy("batch_id").parquet(src)
    view = latest_since_snapshot(spark, src, dst, "k", ["batch_id"])
    assert sorted((r.k, r.v) for r in view.collect()) == [("k1", "c"), ("k2", "d"), ("k3", "e")]
    full = latest_since_snapshot(spark, src, None, "k", ["batch_id"])
    assert sorted((r.k, r.v) for r in full.collect()) == [("k1", "c"), ("k2", "d"), ("k3", "e")]


def test_pandas_scorer_ties_lowest_index(spark):
    class _TieModel:  # local class: shipped to the Python workers by value
        def predict_proba(self, x):
            import numpy as np
            return np.tile([0.2, 0.4, 0.4], (len(x), 1))

    df = spark.createDataFrame([(1.0,), (2.0,)], "a double")
    r = SC.score_pandas(df, _TieModel, ["a"], {0: "Normal", 1: "Port Scan"}).collect()
    assert {(x.pred_label, x.pred_confidence, x.prediction_binary, x.attack_type) for x in r} == \
        {(1, 0.4, 0, "Port Scan")}


def test_put_partitions_batches_on_executors(spark, scratch):
    import json
    import os
    import uuid
    from tidewatch.session import local_path
    out = local_path(scratch("puts"))
    os.makedirs(out, exist_ok=True)

    def put_batch(rows):   # stands in for a key-value client
        with open(os.path.join(out, uuid.uuid4().hex), "w") as fh:
            for r in rows:
                fh.write(json.dumps({"k": r["row_key"]}) + "\n")

    from tidewatch.plans import classify as C
    recs = keyed.keyed_records(C.fixture_classified(spark, SF), X.FIXTURE_FEATURES)
    keyed.put_partitions(recs.select("row_key"), put_batch, batch_size=100)
    sizes = [sum(1 for _ in open(os.path.join(out, f))) for f in os.listdir(out)]
    assert sum(sizes) == recs.count() and max(sizes) <= 100


def test_torn_snapshot_is_passed_over(spark, scratch):
    from tidewatch.operators.merge import compact, latest_since_snapshot, newest_snapshot, snapshot_path
    path = scratch("torn")
    for b, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2), ("c", 2)], [("b", 3)]]):
        (spark.createDataFrame(rows, "k string, v int").withColumn("batch_id", F.lit(b).cast("long"))
         .write.mode("append").partitionBy("batch_id").parquet(path))
    assert newest_snapshot(spark, path) is None
    compact(spark, path, snapshot_path(path, 1), "k", ["batch_id"])
    # a half-written snapshot of a later batch: files, no marker
    (spark.createDataFrame([("a", 2)], "k string, v int").withColumn("batch_id", F.lit(2).cast("long"))
     .write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("batch_id")
     .parquet(snapshot_path(path, 2)))
    snap = newest_snapshot(spark, path)
    assert snap == snapshot_path(path, 1) and newest_snapshot(spark, path, below=1) is None
    view = {r.k: r.v for r in latest_since_snapshot(spark, path, snap, "k", ["batch_id"]).collect()}
    assert view == {"a": 2, "b": 3, "c": 2}
