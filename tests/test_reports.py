"""Warehouse checks on the four-row demo table and ordered operations."""
from pyspark.sql import functions as F

from tidewatch.operators import reports, topk
from tidewatch.sources.tables import demo_table


def test_demo_table_known_answers(spark):
    d = demo_table(spark)
    assert {r.label: r.total for r in reports.count_by_label(d).collect()} == {"Normal": 2, "Attack": 2}
    got = [tuple(r) for r in reports.attacks_per_device(d, "device_id", F.col("label") == "Attack").collect()]
    assert got == [("device_01", 1), ("device_02", 1)]
    assert reports.row_count(d).first().row_count == 4


def test_device_attack_normal(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("a", 1), ("b", 0), ("b", None)], "device_name string, label int")
    got = {r.device_name: tuple(r)[1:] for r in reports.device_attack_normal(df).collect()}
    assert got == {"a": (3, 1, 2), "b": (2, 1, 0)}


def test_alerts_per_device_drops_null_type(spark):
    df = spark.createDataFrame([("a", "Normal"), ("a", "Port Scan"), ("b", None)], "device_name string, attack_type string")
    assert [tuple(r) for r in reports.alerts_per_device(df).collect()] == [("a", 1)]


def test_last_n_newest_first_and_limit_zero(spark):
    df = spark.createDataFrame([(1, "x"), (3, "y"), (2, "z")], "t int, id string")
    assert [r.id for r in topk.last_n(df, 2, "t", "id").collect()] == ["y", "z"]
    assert topk.last_n(df, 0, "t", "id").count() == 0


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), ("b", 5, "r"), ("a", 2, "a")],
                               "k string, t int, v string")
    got = {r.k: r.v for r in topk.latest_per_key(df, "k", ["t", "v"]).collect()}
    assert got == {"a": "q", "b": "r"}


def test_traffic_totals_empty_is_zero(spark):
    df = spark.createDataFrame([], "f double, label int")
    r = reports.traffic_totals(df, "f", F.col("label") == 0).first()
    assert (r.total, r.attack, r.detection_rate) == (0.0, 0.0, 0.0)


def test_system_stats(spark):
    st = spark.createDataFrame([("a", "Under Attack", True), ("b", "Under Attack", False), ("c", "Normal", True)],
                               "device_name string, status string, is_connected boolean")
    al = spark.createDataFrame([("x",), ("y",), ("z",)], "id string")
    r = reports.system_stats(st, al).first()
    assert tuple(r) == (3, 1, 3, "MONITORING_ACTIVE")


def test_scale_conf():
    from tidewatch.session import scale_conf
    c = scale_conf(100 * 10**12, 8000)
    assert c["spark.sql.shuffle.partitions"] == "372530"  # 256 MB each, however many
    assert scale_conf(10**6, 8)["spark.sql.shuffle.partitions"] == "16"
