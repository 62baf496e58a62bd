"""Trees, daily sketches, salted dedup, changing registries, idempotent loads."""
import random

from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewatch.operators import fit, tree

SF = "/root/testdata/sf0.001"


def rows_of(spark, n=3000, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.random() * 10, rng.choice([1.0, 2.0, 3.0])
        attack = (a > 5) != (b > 2.5) if rng.random() < 0.95 else rng.random() < 0.5
        out.append((i, a if i % 50 else None, b, None if i % 97 == 0 else 0 if attack else 1))
    return spark.createDataFrame(out, "id int, a double, b double, label int")


def test_tree_finds_the_planted_rule(spark):
    df = rows_of(spark)
    t = tree.grow(df, ["b", "a"], depth=2)
    assert t.splits[1][0] in ("a", "b") and {f for f, _ in t.splits.values()} == {"a", "b"}
    s = tree.score(df.where("label is not null and a is not null"), t)
    right = s.where((F.col("prediction_binary") == 0) == (F.col("label") == 0)).count()
    assert right > 0.93 * s.count()
    again = tree.grow(df.repartition(7), ["a", "b"], depth=2)
    assert again.splits == t.splits and again.shares == t.shares
    assert tree.score(df, t).where("attack_share is null").count() == 0


def test_tree_edge_cases(spark):
    none = spark.createDataFrame([], "a double, label int")
    t = tree.grow(none, ["a"])
    assert t.splits == {} and tree.score(none, t).count() == 0
    same = spark.createDataFrame([(1.0, 0), (1.0, 1)] * 30, "a double, label int")
    assert tree.grow(same, ["a"]).splits == {}  # nothing to cut


def test_histogram_is_summed_before_the_shuffle(spark):
    t = tree.grow(rows_of(spark), ["a", "b"], depth=1)
    assert len(t.splits) == 1
    d = rows_of(spark).groupBy(t.node().alias("n")).count()
    assert "partial_count" in d._jdf.queryExecution().executedPlan().toString()


def test_daily_states_merge_to_the_whole(spark, scratch):
    rng = random.Random(1)
    rows = [(f"2024-01-{1 + i % 9:02d} 10:00:00", rng.lognormvariate(0, 1) * (1 + i % 9), float(i % 9) if i % 11 else None) for i in range(4000)]
    df = spark.createDataFrame(rows, "t string, x double, y double").withColumn("kafka_timestamp", F.col("t").cast("timestamp"))
    path = scratch("daily")
    fit.update_sketches(df.where("t < '2024-01-05'"), ["x", "y"], path)
    fit.update_sketches(df.where("t >= '2024-01-05'"), ["x", "y"], path)
    fit.update_sketches(df.where("t >= '2024-01-08'"), ["x", "y"], path)  # two days again: replaced, not added
    got = {r.feature: r for r in fit.merged_frame(spark.read.parquet(path)).collect()}
    want = {r.feature: r for r in fit.fit_frame(df, ["x", "y"], accuracy=1_000_000).collect()}
    for f in ("x", "y"):
        assert got[f].n == want[f].n and got[f].min_value == want[f].min_value and got[f].high_skew == want[f].high_skew
        assert abs(got[f].skewness - want[f].skewness) < 1e-9 * max(1, abs(want[f].skewness)) * 100
    xs = sorted(r[1] for r in rows)
    import math
    raw = [math.expm1(q) - got["x"].shift if got["x"].high_skew else q for q in (got["x"].q1, got["x"].q3)]
    for q, p in zip(raw, (0.25, 0.75)):
        rank = sum(x <= q + 1e-9 for x in xs) / len(xs)
        assert abs(rank - p) <= fit.SKETCH_RANK_ERROR
    stats = fit.stats_of(fit.merged_frame(spark.read.parquet(path)), ["x", "y"])
    fit.save_stats(spark, stats, scratch("stats"))
    assert stats.high_skew_cols == ["x"]


def test_new_queries_at_small_scale(spark):
    qs = E.queries()
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    assert qs["stream_dedup_hot"](spark, SF).count() == n
    counted = {r.batch: r for r in qs["stream_quality"](spark, SF).collect()}
    assert len(counted) == 3 and counted[0].late == 0 and counted[1].late > 0 and counted[2].late > 0
    assert qs["enrich_stream"](spark, SF).count() == n


def test_salted_dedup_uses_two_state_operators(spark, scratch):
    from tidewatch import fixtures as X
    from tidewatch.sources.messages import read_message_files, write_replay_files
    from tidewatch.streaming import jobs as J
    base = scratch("salted")
    msgs = X.hot_messages(spark, SF)
    hot = msgs.groupBy("value").count().agg(F.max("count")).first()[0]
    assert hot > 0.3 * msgs.count()
    write_replay_files(msgs, f"{base}/in", 100_000, ranges=2)
    q = J.run(J.dedup_stream(read_message_files(spark, f"{base}/in"), X.FIXTURE_LAYOUT, f"{base}/out", f"{base}/ck",
                             state_partitions=8, salts=16))
    ops = [p for p in q.recentProgress if p.numInputRows][0].stateOperators
    assert len(ops) == 2
    # stateOperators[0] is the last one: what reaches it has at most a row for each salt and payload
    dropped = sorted(o.customMetrics["numDroppedDuplicateRows"] for o in ops)
    assert dropped[0] <= 16 and sum(dropped) == msgs.count() - msgs.select("value").distinct().count()


def test_load_is_repeatable_and_set_up_idempotent(spark, scratch):
    from tidewatch.schema import layout
    from tidewatch.sources import tables
    base, columns = scratch("load"), layout([("a", "int"), ("b", "string")])
    name = "load_test_" + base.rsplit("-", 1)[-1]
    tables.create_table_at(spark, name, f"{base}/t", columns, by_load=True)
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    tables.load_into(df, name, "monday")
    tables.load_into(df, name, "monday")  # retried
    tables.load_into(df.limit(1), name, "tuesday")
    assert spark.table(name).count() == 3
    db = "db_" + base.rsplit("-", 1)[-1]
    for _ in range(2):
        tables.create_if_absent(spark, db, {"one": "a int", "two": "b string"}, f"{base}/db")
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()} >= {"one", "two"}
    tables.append_into(df.select("a"), f"{db}.one")
    assert spark.table(f"{db}.one").count() == 2
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"DROP DATABASE {db} CASCADE")
