"""Semantics of the scalar building blocks."""
import math

from pyspark.sql import functions as F

from tidewatch.functions import classes as FC, formats as FF, keys as FK, parse as FP
from tidewatch.functions.transform import cap, label_text, log_shift
from tidewatch.schema import layout


def test_parse_short_rows_and_bad_numbers_become_null(spark):
    lay = layout([("a", "double"), ("b", "double"), ("c", "int")])
    df = spark.createDataFrame([("1.5,x, 7\n",), ("2",), (None,)], "value string")
    got = [tuple(r) for r in df.select(*FP.parse_fields("value", lay)).collect()]
    assert got == [(1.5, None, 7), (2.0, None, None), (None, None, None)]


def test_parse_ignores_extra_fields_and_no_quoting(spark):
    lay = layout([("a", "string"), ("b", "string")])
    df = spark.createDataFrame([('"x,y",z,extra',)], "value string")
    assert tuple(df.select(*FP.parse_fields("value", lay)).first()) == ('"x', 'y"')


def test_hash_raw_vs_normalized(spark):
    df = spark.createDataFrame([("a,b",), ("a,b\n",), ("a,b\r\n",), (None,)], "value string")
    raw = [r[0] for r in df.select(FP.payload_hash("value")).collect()]
    norm = [r[0] for r in df.select(FP.payload_hash("value", normalize=True)).collect()]
    assert raw[0] != raw[1] and raw[3] is None
    assert norm[0] == norm[1] == norm[2] and norm[3] is None


def test_reject_reasons(spark):
    lay = layout([("x", "double"), ("device_name", "string"), ("label", "int")])
    df = spark.createDataFrame([("1.0,d,1",), ("1.0,d",), ("zz,d,1",), ("1.0,,1",), (None,)], "value string")
    got = [r[0] for r in df.select(FP.reject_reason("value", lay)).collect()]
    assert got == [None, "arity", "bad_number", "null_device", "null_payload"]


def test_log1p_shift_zero(spark):
    df = spark.createDataFrame([(-1.0,), (-2.0,), (float("nan"),), (None,), (0.5,)], "x double")
    got = [r[0] for r in df.select(log_shift("x", 0.0)).collect()]
    assert got[0] is None and got[1] is None and math.isnan(got[2]) and got[3] is None
    assert got[4] == 0.4054651081081644


def test_cap_keeps_null_and_caps_nan_to_upper(spark):
    df = spark.createDataFrame([(-1.0,), (-2.0,), (float("nan"),), (None,), (0.5,)], "x double")
    got = [r[0] for r in df.select(cap("x", -1.5, 1.0)).collect()]
    assert got == [-1.0, -1.5, 1.0, None, 0.5]


def test_argmax_ties_lowest_index(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],)], "p array<double>")
    r = df.select(FC.argmax_index("p").alias("i"), FC.max_probability("p").alias("c")).first()
    assert (r.i, r.c) == (1, 0.4)


def test_decode_and_binary(spark):
    cmap = {0: "Normal", 1: "Port Scan"}
    df = spark.createDataFrame([(0,), (1,), (7,), (None,)], "i int")
    got = [tuple(r) for r in df.select(FC.decode_class("i", cmap), FC.binary_prediction("i", cmap)).collect()]
    assert got == [("Normal", 1), ("Port Scan", 0), ("Unknown", 0), ("Unknown", 0)]


def test_label_text_and_status_display(spark):
    df = spark.createDataFrame([(0, "Normal"), (1, "Under Attack"), (5, "ISOLATED")], "c int, s string")
    got = [tuple(r) for r in df.select(label_text("c"), FC.status_display("s")).collect()]
    assert got == [("Attack", "Protected"), ("Normal", "Under Attack"), (None, "Disconnected")]


def test_row_key_forms(spark):
    df = spark.createDataFrame([("dev", "2026-08-20 07:00:00", "a8f4c2e1ffff"),
                                ("dev", "2026-08-20 07:00:00.250000", "0123456789"),
                                (None, "2026-08-20 07:00:00", "ab")], "d string, t string, h string")
    df = df.withColumn("t", F.col("t").cast("timestamp"))
    iso = [r[0] for r in df.select(FK.row_key("d", "t", "h")).collect()]
    legacy = [r[0] for r in df.select(FK.row_key("d", "t", "h", legacy=True)).collect()]
    assert iso == ["dev#2026-08-20T07:00:00#a8f4c2e1ffff", "dev#2026-08-20T07:00:00.250000#0123456789", None]
    assert legacy[0] == "dev#2026-08-20 07:00:00#a8f4c2e1"


def test_row_key_keeps_flows_with_one_prefix_and_ignores_the_zone(spark):
    df = spark.createDataFrame([("d", 1704069000, "12345678aa"), ("d", 1704069000, "12345678bb")], "d string, s long, h string")
    df = df.withColumn("t", F.timestamp_seconds("s"))
    utc = [r[0] for r in df.select(FK.row_key("d", "t", "h")).collect()]
    assert len(set(utc)) == 2
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert [r[0] for r in df.select(FK.row_key("d", "t", "h")).collect()] == utc
        assert df.select(FK.utc_ntz("t").cast("date").cast("string")).first()[0] == "2024-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_clock_and_rate(spark):
    df = spark.createDataFrame([("2024-01-01 13:04:05", 1.0, 3.0), ("not a date", 0.0, 0.0),
                                (None, 1.0, None), ("2024-01-01 00:00:00", 0.25, 100.0)],
                               "t string, a double, n double")
    got = [tuple(r) for r in df.select(FF.clock_text("t"), FF.one_decimal_rate("a", "n")).collect()]
    assert got == [("13:04:05", 33.3), ("00:00:00", 0.0), ("00:00:00", 0.0), ("00:00:00", 0.3)]


def test_underscore_names(spark):
    from tidewatch.operators.parse import underscore_names
    df = spark.createDataFrame([(1.0, 2.0)], "`MI_dir_L0.1_weight` double, `H_L0.1_mean` double")
    assert underscore_names(df).columns == ["MI_dir_L0_1_weight", "H_L0_1_mean"]


def test_class_map_and_stats_sources(spark, scratch):
    from tidewatch.sources.tables import load_class_map
    p = scratch("cmap")
    spark.createDataFrame([('{"0": "Normal", "1": "Port Scan"}',)], "j string").coalesce(1).write.text(p)
    assert load_class_map(spark, p) == {0: "Normal", 1: "Port Scan"}


def test_split_rejects_partition_input(spark):
    from tidewatch import fixtures as X
    from tidewatch.operators.parse import split_rejects
    msgs = X.corrupted_messages(spark, "/root/testdata/sf0.001")
    ok, bad = split_rejects(msgs, X.FIXTURE_LAYOUT)
    assert ok.count() + bad.count() == msgs.count() and bad.count() > 0
