"""Fit/apply of preprocessing statistics: properties and persistence."""
import datetime as dt
import math

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidewatch import fixtures as X
from tidewatch.functions.transform import cap
from tidewatch.operators import fit
from tidewatch.operators.dedup import dedup_by_key
from tidewatch.operators.parse import parse_messages


def test_fixture_fit_picks_skewed_column(spark):
    flows = X.flows(spark, "/root/testdata/sf0.01")
    stats = fit.fit_stats(flows, X.FIXTURE_FEATURES)
    assert stats.high_skew_cols == ["f_value"] and stats.log_shifts == {"f_value": 0.0}
    assert set(stats.iqr_bounds) == {"f_value", "f_k"}
    prepared = fit.prepare(flows, stats)
    b = stats.iqr_bounds["f_value"]
    r = prepared.agg(F.min("f_value").alias("lo"), F.max("f_value").alias("hi")).first()
    assert b["lower"] <= r.lo and r.hi <= b["upper"]


def test_lineitem_not_skewed(spark):
    li = X.table(spark, "/root/testdata/sf0.01", "lineitem")
    rows = fit.skew_frame(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).collect()
    assert not any(r.high_skew for r in rows)


def test_zero_iqr_column_is_left_uncapped(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(20)], "c double, v double")
    stats = fit.fit_stats(df, ["c", "v"])
    assert "c" not in stats.iqr_bounds and "v" in stats.iqr_bounds


def test_stats_round_trip(spark, scratch):
    stats = fit.PrepStats(feature_cols=["a", "b"], high_skew_cols=["a"], log_shifts={"a": 1.5},
                          iqr_bounds={"b": {"lower": -1.0, "upper": 2.0}})
    p = scratch("stats")
    fit.save_stats(spark, stats, p)
    assert fit.load_stats(spark, p) == stats


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=30),
       st.floats(-100, 0), st.floats(0, 100))
def test_cap_idempotent_and_bounded(spark, xs, lo, hi):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    once = df.select(cap("x", lo, hi).alias("x"))
    twice = once.select(cap("x", lo, hi).alias("x"))
    a, b = [r.x for r in once.collect()], [r.x for r in twice.collect()]
    assert a == b
    assert all(v is None or lo <= v <= hi for v in a)
    assert [v is None for v in a] == [x is None for x in xs]


def _rank_rows(spark):
    """Ties, a constant, signs, NaN and infinities, nulls, a column without values."""
    i = F.col("id")
    return spark.range(0, 20_011, 1, 5).select(
        (i * 7919 % 20_011 * 1.5).alias("distinct"), (i % 3).cast("double").alias("ties"), F.lit(4.0).alias("same"),
        F.when(i % 11 != 0, (i * 31 % 997 - 500) / 3.0).alias("nulls"),
        F.when(i % 2 == 0, float("nan")).when(i % 5 == 0, float("-inf")).otherwise(i.cast("double")).alias("odd"),
        F.lit(None).cast("double").alias("none"))


def _by_sorting(df, c):
    v = sorted((r[0] for r in df.select(c).collect() if r[0] is not None), key=lambda x: (math.isnan(x), x))
    return [repr(v[-(-len(v) * p // 4) - 1]) if v else "None" for p in (1, 3)]


def test_exact_quartiles_from_small_sketches(spark, monkeypatch):
    """Great accuracy: exact ranks, while no sketch is larger than the bracketing one."""
    df = _rank_rows(spark)
    asked, real = [], F.percentile_approx
    monkeypatch.setattr(fit.F, "percentile_approx", lambda c, p, a: asked.append(a) or real(c, p, a))
    for accuracy in (10_000, 100):  # as it is; brackets wide enough to rank values between their ends
        monkeypatch.setattr(fit, "BRACKET_ACCURACY", accuracy)
        monkeypatch.setattr(fit, "BRACKET_MARGIN", 2.5 / accuracy)
        rows = {r.feature: r for r in fit._exact_rows(df, df.columns).collect()}
        assert {c: [repr(rows[c].q1_raw), repr(rows[c].q3_raw)] for c in df.columns} == {c: _by_sorting(df, c) for c in df.columns}
    assert rows["none"].n == 0 and rows["same"].n == 20_011 and max(asked) == 10_000
    fit.fit_frame(df.select("distinct"), ["distinct"], accuracy=10_000_000).collect()
    assert max(asked) == 10_000


def test_exact_quartiles_when_a_bracket_misses(spark, monkeypatch):
    """A sketch that is off costs another scan, not a wrong value."""
    df = _rank_rows(spark).select("distinct", "nulls", "odd")
    real = F.percentile_approx
    monkeypatch.setattr(fit.F, "percentile_approx", lambda c, p, a: real(c, F.array(*[F.lit(0.9)] * 4), a))
    rows = {r.feature: r for r in fit._exact_rows(df, df.columns).collect()}
    assert {c: [repr(rows[c].q1_raw), repr(rows[c].q3_raw)] for c in df.columns} == {c: _by_sorting(df, c) for c in df.columns}
    empty = fit.fit_frame(df.limit(0), df.columns, accuracy=10_000_000).collect()
    assert [(r.feature, r.n, r.q1) for r in empty] == [(c, 0, None) for c in df.columns]


def test_stored_flows_are_prepared_like_messages(spark, scratch):
    """Rejects take part in the fit, not in the classification; messages are read once for both."""
    from tidewatch.plans import classify as C
    lines = [f"{i},{i * i / 7},{i % 9},device_{i % 4},Normal,view,1" for i in range(300)]
    lines += lines[:50] + ["1,x,3,device_1,Normal,view,1", "7,1.5,2", "9,2.5,4,,Normal,view,1", None]
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), v if v is None else bytearray(v.encode())) for i, v in enumerate(lines)]
    msgs = spark.createDataFrame(rows, "timestamp timestamp, value binary")
    flows = C.store_flows(msgs, X.FIXTURE_LAYOUT, scratch("stored"))
    assert flows.count() == 304 and flows.where("reject_reason is null").count() == 300
    parsed = dedup_by_key(parse_messages(msgs, X.FIXTURE_LAYOUT))
    stats = fit.fit_stats(flows, X.FIXTURE_FEATURES, accuracy=10_000_000)
    assert stats == fit.fit_stats(parsed, X.FIXTURE_FEATURES, accuracy=10_000_000)
    rows = lambda d: sorted(map(repr, d.select("row_hash", "event_id", *X.FIXTURE_FEATURES, "device_name", "kafka_timestamp").collect()))
    assert rows(C.prepared_stored(flows, stats)) == rows(C.prepared_flows(msgs, X.FIXTURE_LAYOUT, stats))


def test_wide_classified_reads_its_table_once(spark, monkeypatch):
    import __spark_entry__ as e
    calls, real = [], X.wide_messages
    monkeypatch.setattr(X, "wide_messages", lambda *a: calls.append(1) or real(*a))
    out = e.queries()["wide_classified"](spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert calls == [1] and "lineitem" not in plan and "l_quantity" not in plan


def _same_rows(a, b):
    assert sorted(map(repr, a.select(sorted(a.columns)).collect())) == sorted(map(repr, b.select(sorted(b.columns)).collect()))


def _small_messages(spark, path):
    """Five files with copies in one and in several of them, rejects, null payloads and times."""
    i = F.col("id")
    value = F.when(i % 97 != 0, F.concat_ws(",", i % 601, i % 601 / 7.0, i % 9, F.lit("device_1"), F.lit("Normal"), F.lit("view"), F.when(i % 5 != 0, "1")))
    d = spark.range(0, 3000, 1, 5).select(
        F.when(i % 4 != 0, F.timestamp_seconds(1_700_000_000 + i * 7919 % 3000)).alias("timestamp"), value.cast("binary").alias("value"))
    d.write.parquet(path)
    return spark.read.parquet(path)


def test_first_copies_by_place_equal_a_dedup_of_rows(spark, scratch, monkeypatch):
    """One file or several a round, bitmaps of few rows, one scan or a frame that must be written first."""
    from tidewatch.operators import dedup
    from tidewatch.operators.parse import tag_rejects
    from tidewatch.plans import classify as C
    msgs = _small_messages(spark, scratch("all the messages"))
    whole = lambda m: dedup_by_key(tag_rejects(m, X.FIXTURE_LAYOUT).drop("payload"), payload_determined=True)
    late = msgs.where("timestamp > timestamp '2023-11-14 22:40:00'")
    for m, bits, at_once in ((msgs, 15, 1 << 30), (msgs, 3, 1000), (late, 5, 1), (msgs.where("value = 'none'"), 15, 10),
                             (msgs.union(msgs), 15, 1 << 30), (msgs.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))), 4, 700)):
        monkeypatch.setattr(dedup, "BITMAP_BITS", bits)
        monkeypatch.setattr(dedup, "ROWS_AT_ONCE", at_once)
        _same_rows(C.store_flows(m.select("timestamp", "value"), X.FIXTURE_LAYOUT, scratch("stored")), whole(m))
    some = C.store_flows(msgs, X.FIXTURE_LAYOUT, scratch("some"), columns=["f_value", "label"])
    _same_rows(some, whole(msgs).select("f_value", "label", "reject_reason"))


def test_wide_flows_are_stored_without_shuffling_them(spark, scratch, monkeypatch):
    """Of a record of 27 fields only its fingerprint and place are shuffled; the table takes it from its file."""
    from pyspark.sql import DataFrameWriter
    from tidewatch.plans import classify as C
    from tidewatch.schema import FLOW_LAYOUT
    value = F.concat_ws(",", *[F.rand(i) * 1000 for i in range(23)], F.lit("cam_1"), F.lit("Normal"), F.lit("F"), F.lit("1"))
    path, n, plans, real = scratch("wide-messages"), 600, [], DataFrameWriter.parquet
    spark.range(0, n, 1, 3).select(F.timestamp_seconds("id").alias("timestamp"), value.cast("binary").alias("value")).write.parquet(path)
    explained = lambda w: w._df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: plans.append(explained(self)) or real(self, *a, **b))
    stored = C.store_flows(spark.read.parquet(path), FLOW_LAYOUT, scratch("wide-stored"))
    shuffles = [x for p in plans for x in p.splitlines() if "Exchange hashpartitioning" in x]
    assert shuffles and not any(name in x for x in shuffles for name, _ in FLOW_LAYOUT)
    assert "Exchange hashpartitioning" not in plans[-1]  # the one that parses
    assert stored.where("reject_reason IS NULL").count() == n
