"""Device state machine: the per-field last-value decomposition equals a
sequential state machine over the ordered event log (property test)."""
import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st

from tidewatch.operators import devices as D

T0 = dt.datetime(2024, 1, 1)


def sequential(events):
    """Reference semantics: apply events in (time, rank, tiebreak) order."""
    state = {}
    for dev, t, rank, tb, kind, typ in sorted(events, key=lambda e: (e[1], e[2], e[3])):
        s = state.setdefault(dev, {"status": "Normal", "is_connected": True, "last_attack_type": None})
        if kind == "alert":
            s["status"], s["last_attack_type"] = "Under Attack", typ
        elif kind == "isolate":
            s["status"], s["is_connected"] = "ISOLATED", False
        elif kind == "reconnect":
            s["status"], s["is_connected"], s["last_attack_type"] = "Normal", True, None
    return state


def _frames(spark, events):
    alerts = [(d, T0 + dt.timedelta(seconds=t), tb, typ) for d, t, r, tb, k, typ in events if k == "alert"]
    cmds = [(d, T0 + dt.timedelta(seconds=t), k, int(tb)) for d, t, r, tb, k, typ in events if k != "alert"]
    a = spark.createDataFrame(alerts, "device_name string, event_time timestamp, row_hash string, attack_type string")
    c = spark.createDataFrame(cmds, "device_name string, event_time timestamp, command string, seq long")
    return a, c


def test_isolated_device_alert_keeps_disconnected(spark):
    ev = [("d1", 0, 0, "h1", "alert", "DDoS Flood"), ("d1", 5, 1, "1", "isolate", None),
          ("d1", 9, 0, "h2", "alert", "Port Scan"), ("d2", 1, 0, "h3", "alert", "Botnet Activity"),
          ("d2", 2, 1, "2", "isolate", None), ("d2", 3, 1, "3", "reconnect", None)]
    a, c = _frames(spark, ev)
    got = {r.device_name: (r.status, r.is_connected, r.last_attack_type)
           for r in D.containment_state(a, c).collect()}
    assert got == {"d1": ("Under Attack", False, "Port Scan"), "d2": ("Normal", True, None)}


event = st.tuples(st.sampled_from(["d1", "d2", "d3"]), st.integers(0, 20),
                  st.sampled_from(["alert", "isolate", "reconnect"]),
                  st.sampled_from(["DDoS Flood", "Port Scan", "Data Interception"]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=25))
def test_decomposition_equals_sequential(spark, raw):
    events = []
    for i, (d, t, k, typ) in enumerate(raw):
        rank = 0 if k == "alert" else 1
        tb = f"h{i:04d}" if k == "alert" else str(i).zfill(20)
        events.append((d, t, rank, tb, k, typ if k == "alert" else None))
    a, c = _frames(spark, events)
    got = {r.device_name: {"status": r.status, "is_connected": r.is_connected,
                           "last_attack_type": r.last_attack_type}
           for r in D.containment_state(a, c).collect()}
    assert got == sequential(events)


def test_device_list_defaults(spark):
    reg = spark.createDataFrame([("a", "1", "t", "l"), ("b", "2", "t", "l")], "device_name string, ip string, type string, location string")
    st_ = spark.createDataFrame([("a", "ISOLATED", False, None)], "device_name string, status string, is_connected boolean, last_attack_type string")
    got = {r.device_name: (r.status, r.is_connected) for r in D.device_list(reg, st_).collect()}
    assert got == {"a": ("ISOLATED", False), "b": ("Normal", True)}


def test_known_device_split(spark):
    al = spark.createDataFrame([("a", 1), ("zz", 2)], "device_name string, id int")
    reg = spark.createDataFrame([("a",)], "device_name string")
    k, u = D.known_device_split(al, reg)
    assert [r.id for r in k.collect()] == [1] and [r.id for r in u.collect()] == [2]


def test_unscored_flows_raise_no_alert(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("a", "DDoS Flood", "x", t, "01", 0, 0.9, 0, "Attack"), ("b", "", "x", t, "02", 0, 0.9, 0, "Attack"),
         ("c", None, None, t, "03", None, None, 0, "Unknown")],
        "device_name string, attack string, attack_subtype string, kafka_timestamp timestamp, row_hash string, "
        "pred_label int, pred_confidence double, prediction_binary int, attack_type string")
    got = {(r.device_name, r.attack_type, r.id) for r in D.alerts_from_classified(df).collect()}
    assert got == {("a", "DDoS Flood", "ALT-01"), ("b", "Attack", "ALT-02")}
