"""Stored folders: manifest, snapshots, clean-up, lookups; the archive's table; the external writer."""
import io
import os
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tidewatch import fixtures as X
from tidewatch.plans import classify as C
from tidewatch.session import local_path
from tidewatch.sinks import archive, external, index, keyed, store

SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


def view(spark, path):
    return {r.k: r.v for r in store.latest(spark, path, "k", [store.BATCH]).collect()}


def test_manifest_names_batches_and_replays(spark, scratch):
    p = scratch("store")
    assert store.current(spark, p) is None
    assert store.write_batch(frame(spark, [("a", 1), ("b", 1)]), p, 0)
    assert store.write_batch(frame(spark, [("b", 2), ("c", 2)]), p, 1)
    assert not store.write_batch(frame(spark, [("b", 99)]), p, 1)  # committed: a replay changes nothing
    frame(spark, [("a", 99)]).write.parquet(f"{p}/batch_id=2")     # in writing, or left by a crash
    assert view(spark, p) == {"a": 1, "b": 2, "c": 2}
    assert store.write_batch(frame(spark, [("a", 3)]), p, 2)       # the crashed batch written anew
    assert view(spark, p) == {"a": 3, "b": 2, "c": 2}
    m = store.current(spark, p)
    assert (m.version, m.upto, m.batches) == (3, None, (0, 1, 2))
    with pytest.raises(Exception, match="exist"):
        store.commit(spark, p, store.Manifest(3, None, ()))        # the other writer was first
    assert store.current(spark, p) == m


def test_compaction_and_clean_up_with_crashes(spark, scratch, monkeypatch):
    p = scratch("clean")
    for b, rows in enumerate(([("a", 1), ("b", 1)], [("b", 2)], [("c", 3)])):
        store.write_batch(frame(spark, rows), p, b)
    want = {"a": 1, "b": 2, "c": 3}

    with monkeypatch.context() as m:  # the snapshot is written, the manifest is not
        m.setattr(store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.compact(spark, p, "k", [store.BATCH])
    assert store.current(spark, p).upto is None and view(spark, p) == want
    assert store.compact(spark, p, "k", [store.BATCH]).upto == 2
    assert view(spark, p) == want
    assert not store.write_batch(frame(spark, [("a", 99)]), p, 1)  # folded in already
    store.write_batch(frame(spark, [("a", 4)]), p, 3)
    store.compact(spark, p, "k", [store.BATCH])
    want["a"] = 4
    frame(spark, [("z", 9)]).write.parquet(f"{p}/batch_id=4")      # in writing: stays
    real, left = store._delete, [2]

    def dies(spark, path):
        left[0] -= 1
        if left[0] < 0:
            raise RuntimeError("lost")
        real(spark, path)

    with monkeypatch.context() as m:
        m.setattr(store, "_delete", dies)
        with pytest.raises(RuntimeError):
            store.clean(spark, p, keep=1)
    assert view(spark, p) == want
    store.clean(spark, p, keep=1)
    assert view(spark, p) == want
    assert sorted(n for n in os.listdir(local_path(p)) if n.startswith("batch")) == ["batch_id=4"]
    assert os.listdir(local_path(p) + "_snapshots") == ["upto=3"] == os.listdir(local_path(p) + "_files")
    assert store.clean(spark, p, keep=1) == []


def plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_prefix_scan_opens_the_files_of_a_device(spark, scratch):
    p = scratch("keyed")
    c = C.fixture_classified(spark, SF).checkpoint()
    first = keyed.keyed_records(c, X.FIXTURE_FEATURES)
    for b in range(2):
        keyed.write_keyed(first.where(F.crc32("row_key") % 2 == b), p, b)
    keyed.compact_keyed(spark, p, files=16)
    m = store.current(spark, p)
    total = len(store.read_snapshot(spark, p, m).inputFiles())
    got = keyed.prefix_scan(spark, p, ["device_3"])
    assert total >= 8 and 1 <= len(got.inputFiles()) <= 3 < total
    text = plan(got)
    pushed = [x for x in text.split("\n") if "PushedFilters" in x]
    assert pushed and all("StringStartsWith(row_key,device_3#)" in x and "device_name" in x for x in pushed), text
    want = keyed.device_history(first, ["device_3"])
    key = lambda d: sorted((r.row_key, r.cf.prediction) for r in d.collect())
    assert key(got) == key(want) and want.count() > 5
    # a later version of some of the device's records, in a batch after the snapshot
    changed = want.limit(4).withColumn("cf", F.col("cf").withField("prediction", 1 - F.col("cf.prediction"))).checkpoint()
    keyed.write_keyed(changed, p, 2)
    expect = dict(key(want)) | dict(key(changed))
    assert dict(key(keyed.prefix_scan(spark, p, ["device_3"]))) == expect
    assert keyed.prefix_scan(spark, p, ["device_99999"]).count() == 0 == keyed.prefix_scan(spark, p, []).count()


def test_search_picks_files_by_postings(spark, scratch):
    p = scratch("index")
    docs = index.index_documents(C.fixture_classified(spark, SF)).checkpoint()
    for b in range(2):
        index.write_index(docs.where(F.crc32("doc_id") % 2 == b), p, b)
    index.compact_index(spark, p, files=16)
    total = len(store.read_snapshot(spark, p, store.current(spark, p)).inputFiles())
    wanted = dict(attack="Port Scan", min_confidence=0.5)
    got = index.search_stored(spark, p, **wanted)
    assert total >= 8 and 1 <= len(got.inputFiles()) < total / 2
    key = lambda d: sorted(tuple(r) for r in d.collect())
    assert key(got) == key(index.search(docs, **wanted)) and got.count() > 0
    # second versions: some matches stop matching, some others start to
    out = docs.where("attack = 'Port Scan'").limit(3).withColumn("attack", F.lit("Normal"))
    into = docs.where("attack = 'Normal'").limit(2).withColumn("attack", F.lit("Port Scan")).withColumn("confidence", F.lit(0.9))
    later = out.unionByName(into).checkpoint()
    index.write_index(later, p, 2)
    now = docs.join(later.select("doc_id"), "doc_id", "anti").unionByName(later)
    assert key(index.search_stored(spark, p, **wanted)) == key(index.search(now, **wanted))
    index.compact_index(spark, p, files=16)
    assert key(index.search_stored(spark, p, **wanted)) == key(index.search(now, **wanted))
    assert index.search_stored(spark, p, attack="no such").count() == 0
    some = dict(device="device_3", start="2024-01-05 00:00:00", end="2024-01-20 00:00:00", prediction=0)
    assert key(index.search_stored(spark, p, **some)) == key(index.search(now, **some))


def test_archive_table_prunes_and_sees_new_batches(spark, scratch):
    p, name = scratch("arch"), "archive_table_test"
    c = C.fixture_classified(spark, SF).checkpoint()
    archive.create_archive_table(spark, name, p, c)
    archive.create_archive_table(spark, name, p, c)
    archive.write_archive(c.where("event_id % 2 = 0"), p, 0, table=name)
    archive.write_archive(c.where("event_id % 2 = 0"), p, 0, table=name)  # replay
    assert spark.table(name).count() == c.where("event_id % 2 = 0").count()
    archive.write_archive(c.where("event_id % 2 = 1"), p, 1, table=name)
    assert spark.table(name).count() == c.count()
    day = spark.table(name).where("event_date = DATE'2024-01-05'")
    assert day.count() == c.where("to_date(kafka_timestamp) = DATE'2024-01-05'").count() > 0
    assert all("event_date=2024-01-05" in f for f in day.inputFiles())
    assert "PartitionFilters: [isnotnull(event_date" in plan(day), plan(day)
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == c.select(F.to_date("kafka_timestamp"), F.col("event_id") % 2).distinct().count()
    spark.sql(f"DROP TABLE {name}")


def test_newest_rows_open_the_newest_dates(spark, scratch):
    p = scratch("newest")
    c = C.fixture_classified(spark, SF).checkpoint()
    archive.write_archive(c, p, 0)
    for n in (5, 200, 10**6):
        got = archive.newest_rows(spark, p, n)
        want = c.orderBy(F.desc("kafka_timestamp"), F.desc("row_hash")).limit(n)
        assert [r.row_hash for r in got.collect()] == [r.row_hash for r in want.collect()]
    text = plan(archive.newest_rows(spark, p, 5))
    assert "PartitionFilters: [isnotnull(event_date" in text and ">= 2024-01-3" in text, text
    assert archive.newest_rows(spark, p, 0).count() == 0


def stored(path):
    return {r["key"]: (b, r["value"]) for b, r in external.FileClient({"path": path}).rows()}


def test_external_writer_commits_whole_batches(spark, scratch):
    p = local_path(scratch("puts"))
    external.register(spark)
    rows = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").cast("string").alias("value"))

    def put(df, batch, **more):
        df.write.format("keyed_put").option("path", p).option("batch", batch).options(**more).mode("append").save()

    put(rows.repartition(4), 0, batch_size="100")
    assert len(stored(p)) == 2000
    # a task that dies half way through: no half batch, nothing staged is read
    bad = rows.repartition(4).withColumn("value", F.when(F.col("key") == "k1700", F.raise_error(F.lit("killed"))).otherwise("new"))
    with pytest.raises(Exception, match="killed"):
        put(bad, 1, batch_size="10")
    assert {b for b, _ in stored(p).values()} == {0}
    put(rows.where("key = 'k7'").withColumn("value", F.lit("new")), 1)
    put(rows.where("key = 'k7'").withColumn("value", F.lit("twice")), 1)  # batch 1 is there: a replay
    assert stored(p)["k7"] == (1, "new") and len(stored(p)) == 2000


def test_external_stream_writer_restarts(spark, scratch):
    base = scratch("putstream")
    external.register(spark)
    rows = spark.range(300).select(F.col("id").cast("string").alias("key"), F.lit("x").alias("value"))
    rows.where("key < 5").write.parquet(f"{base}/in")

    def run():
        q = (spark.readStream.schema(rows.schema).parquet(f"{base}/in").writeStream.format("keyed_put")
             .option("path", local_path(f"{base}/out")).option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    run()  # restart without news
    rows.where("key >= 5").write.mode("append").parquet(f"{base}/in")
    run()
    got = stored(local_path(f"{base}/out"))
    assert len(got) == 300 and {b for b, _ in got.values()} == {0, 1}


def test_archive_table_with_rows_without_a_date(spark, scratch):
    p, name = scratch("undated"), "archive_undated_test"
    rows = [("2024-01-05 00:00:00", 1), (None, 2)]
    c = spark.createDataFrame(rows, "t string, v int").select(F.col("t").cast("timestamp").alias("kafka_timestamp"), "v")
    archive.create_archive_table(spark, name, p, c)
    archive.write_archive(c, p, 0, table=name)
    assert sorted(r.v for r in spark.table(name).collect()) == [1, 2]
    assert [r.v for r in spark.table(name).where("event_date is null").collect()] == [2]
    spark.sql(f"DROP TABLE {name}")
