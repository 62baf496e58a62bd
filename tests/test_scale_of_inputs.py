"""What grows with the input: replay files and micro-batches, passes over the flows, fits."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from tidewatch.plans import classify as C
from tidewatch.session import scratch_path
from tidewatch.streaming import jobs as J


@pytest.fixture()
def events(spark, scratch):
    """A folder with an events table of 1,500 rows."""
    folder, i = scratch("events"), F.col("id")
    (spark.range(0, 1500, 1, 2).select(
        i.alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + i * 60).alias("ts"), (i % 9).alias("user_id"),
        F.when(i % 4 == 0, "error").otherwise("view").alias("event_type"), (i * i % 1013 / 7).alias("value"),
        F.concat(F.lit('{"k": '), (i % 100).cast("string"), F.lit("}")).alias("props"))
     .write.parquet(f"{folder}/events.parquet"))
    return folder


def test_replay_files_grow_with_the_input_not_their_number(spark, events, monkeypatch):
    monkeypatch.setattr(e, "REPLAY_FILES", 10)
    at = e._message_files(spark, events, scratch_path(spark, "many"), rows_per_file=5)
    d = spark.read.parquet(at)
    assert d.count() == 1500 and d.select(F.input_file_name()).distinct().count() <= 10 + 8  # and one per range
    small = e._message_files(spark, events, scratch_path(spark, "few"), rows_per_file=400)
    assert spark.read.parquet(small).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 400


def test_replay_stream_runs_a_bounded_number_of_batches(spark, events, monkeypatch):
    seen, real = [], J.run
    monkeypatch.setattr(J, "run", lambda q: seen.append(real(q)) or q)
    monkeypatch.setattr(e, "REPLAY_FILES", 10)
    real_files = e._message_files
    monkeypatch.setattr(e, "_message_files", lambda s, sf, base: real_files(s, sf, base, rows_per_file=5))
    assert e.queries()["replay_stream"](spark, events).count() == 1500
    assert len([p for p in seen[0].recentProgress if p.numInputRows]) <= 2  # 18 files at most, ten to a batch


@pytest.mark.parametrize("name", ["keyed_upsert", "index_upsert"])
def test_upserts_fit_once(spark, events, monkeypatch, name):
    fits, real = [], C.fixture_stats
    monkeypatch.setattr(C, "fixture_stats", lambda *a: fits.append(1) or real(*a))
    assert e.queries()[name](spark, events).count() == 1500 and fits == [1]


def test_training_reads_flows_deduplicated_once(spark, events):
    """The scored frame reads the kept flows, not the events again."""
    plan = e.queries()["rf_train_score"](spark, events)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan and "Aggregate" not in plan
