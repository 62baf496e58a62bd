"""DuckDB SQL building blocks for the oracle queries of ``__spark_entry__``.

Each oracle is self-contained: it re-derives the fixture flows from the base
tables with the same rules as ``tidewatch.fixtures`` (FIXTURES.md §3), written
independently in SQL.
"""

ATTACK_TYPES_SQL = ("['DDoS Flood', 'Port Scan', 'Botnet Activity', "
                    "'Unauthorized Access Attempt', 'Data Interception']")

EV = f"""
ev AS (
  SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
ev2 AS (
  SELECT *, 'device_' || CAST(user_id AS VARCHAR) AS device_name,
         CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS label,
         CASE WHEN event_type = 'error' THEN ({ATTACK_TYPES_SQL})[k % 5 + 1]
              ELSE 'Normal' END AS attack
  FROM ev)"""

PAYLOAD = ("concat_ws(',', CAST(event_id AS VARCHAR), CAST(value AS VARCHAR), CAST(k AS VARCHAR), "
           "device_name, attack, event_type, CAST(label AS VARCHAR))")

FLOWS = EV + f""",
flows AS (
  SELECT ts AS kafka_timestamp, sha256({PAYLOAD}) AS row_hash, event_id,
         value AS f_value, CAST(k AS DOUBLE) AS f_k, device_name, attack,
         event_type AS attack_subtype, label
  FROM ev2)"""


def with_flows(body: str, extra: str = "") -> str:
    return f"WITH {FLOWS}{',' if extra else ''}{extra}\n{body}"


# Fitted statistics (population skewness from DuckDB's sample form; quartiles
# at rank ceil(q*n)), the prepared features and the fixture scorer.
STATS = """
sk AS (
  SELECT skewness(f_value) * (count(f_value) - 2) / sqrt(count(f_value) * (count(f_value) - 1)) AS s_v,
         min(f_value) AS m_v,
         skewness(f_k) * (count(f_k) - 2) / sqrt(count(f_k) * (count(f_k) - 1)) AS s_k,
         min(f_k) AS m_k
  FROM flows),
lg AS (
  SELECT f.*,
         CASE WHEN abs(s_v) > 1.0 THEN ln(1 + (f_value + greatest(0.0, -m_v))) ELSE f_value END AS x_v,
         CASE WHEN abs(s_k) > 1.0 THEN ln(1 + (f_k + greatest(0.0, -m_k))) ELSE f_k END AS x_k
  FROM flows f, sk),
rv AS (SELECT x_v AS x, row_number() OVER (ORDER BY x_v) AS rn, count(*) OVER () AS n FROM lg WHERE x_v IS NOT NULL),
rk AS (SELECT x_k AS x, row_number() OVER (ORDER BY x_k) AS rn, count(*) OVER () AS n FROM lg WHERE x_k IS NOT NULL),
qv AS (SELECT max(CASE WHEN rn = ceil(0.25 * n) THEN x END) AS q1, max(CASE WHEN rn = ceil(0.75 * n) THEN x END) AS q3 FROM rv),
qk AS (SELECT max(CASE WHEN rn = ceil(0.25 * n) THEN x END) AS q1, max(CASE WHEN rn = ceil(0.75 * n) THEN x END) AS q3 FROM rk),
bd AS (
  SELECT qv.q1 - 1.5 * (qv.q3 - qv.q1) AS lo_v, qv.q3 + 1.5 * (qv.q3 - qv.q1) AS hi_v, qv.q3 - qv.q1 AS iqr_v,
         qk.q1 - 1.5 * (qk.q3 - qk.q1) AS lo_k, qk.q3 + 1.5 * (qk.q3 - qk.q1) AS hi_k, qk.q3 - qk.q1 AS iqr_k
  FROM qv, qk),
prep AS (
  SELECT kafka_timestamp, row_hash, event_id, device_name, attack, attack_subtype, label,
         CASE WHEN iqr_v = 0 THEN x_v WHEN x_v < lo_v THEN lo_v WHEN x_v > hi_v THEN hi_v ELSE x_v END AS f_value,
         CASE WHEN iqr_k = 0 THEN x_k WHEN x_k < lo_k THEN lo_k WHEN x_k > hi_k THEN hi_k ELSE x_k END AS f_k
  FROM lg, bd),
sc AS (
  SELECT *, 1.0 / (1.0 + exp(-(0.0 + 1.5 * (f_value - 3.0) + 0.02 * (f_k - 50.0)))) AS p1 FROM prep),
classified AS (
  SELECT kafka_timestamp, row_hash, event_id, f_value, f_k, device_name, attack, attack_subtype, label,
         CASE WHEN 1.0 - p1 >= p1 THEN 0 ELSE 1 END AS pred_label,
         greatest(1.0 - p1, p1) AS pred_confidence,
         CASE WHEN 1.0 - p1 >= p1 THEN 0 ELSE 1 END AS prediction_binary,
         CASE WHEN 1.0 - p1 >= p1 THEN 'Attack' ELSE 'Normal' END AS attack_type
  FROM sc)"""


def with_classified(body: str, extra: str = "") -> str:
    return with_flows(body, STATS + ("," + extra if extra else ""))


ALERTS = """
alerts AS (
  SELECT 'ALT-' || upper(row_hash) AS id, device_name,
         '192.168.1.' || substr(device_name, 8) AS device_ip,
         attack AS attack_type, attack_subtype AS subtype, pred_confidence AS confidence,
         strftime(kafka_timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, 'HIGH' AS severity,
         kafka_timestamp AS event_time, row_hash
  FROM classified WHERE prediction_binary = 0)"""


def with_alerts(body: str, extra: str = "") -> str:
    return with_classified(body, ALERTS + ("," + extra if extra else ""))


# --- the 27-field record, derived from lineitem ---------------------------------------
def _wide_features(names: list[str]) -> list[str]:
    base = ["l_quantity", "(l_extendedprice / 1000)", "(l_discount * 10)", "(l_tax * 10)"]
    out = []
    for i, name in enumerate(names):
        a, b = base[i % 4], base[i // 4 % 4]
        out.append(f"floor({a} * {a} * {b}) AS {name}" if i % 5 == 0 else f"{a} * CAST({i + 1}.0 AS DOUBLE) + {b} * CAST(0.5 AS DOUBLE) AS {name}")
    return out


def wide_flows(names: list[str]) -> str:
    return f"""
wide AS (
  SELECT {', '.join(_wide_features(names))}, 'cam_' || CAST(l_suppkey % 9 AS VARCHAR) AS device_name,
         CASE WHEN l_returnflag = 'R' THEN ({ATTACK_TYPES_SQL})[l_linenumber % 5 + 1] ELSE 'Normal' END AS attack,
         l_linestatus AS attack_subtype, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS label
  FROM lineitem)"""


def wide_stats(names: list[str], table: str) -> str:
    """``wst``: a row per feature as ``fit_frame`` gives it, by SQL over ``table``."""
    rows = "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS x FROM {table}" for c in names)
    return f"""
wlong AS ({rows}),
wskew AS (
  SELECT feature, count(*) AS n, skewness(x) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0)) AS skewness, min(x) AS min_value
  FROM wlong GROUP BY feature),
wrank AS (SELECT feature, x, row_number() OVER (PARTITION BY feature ORDER BY x) AS rn, count(*) OVER (PARTITION BY feature) AS n FROM wlong),
wq AS (SELECT feature, max(CASE WHEN rn = ceil(0.25 * n) THEN x END) AS r1, max(CASE WHEN rn = ceil(0.75 * n) THEN x END) AS r3
       FROM wrank GROUP BY feature),
wst AS (
  SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (
    SELECT feature, n, skewness, min_value, coalesce(abs(skewness) > 1.0, false) AS high_skew, greatest(0.0, -min_value) + 0.0 AS shift,
           CASE WHEN abs(skewness) > 1.0 THEN ln(1 + (r1 + greatest(0.0, -min_value))) ELSE r1 END AS q1,
           CASE WHEN abs(skewness) > 1.0 THEN ln(1 + (r3 + greatest(0.0, -min_value))) ELSE r3 END AS q3
    FROM wskew JOIN wq USING (feature)))"""


def wide_prepared(name: str) -> str:
    """Log step and cap of one feature, its statistics in the columns of ``s_<name>``."""
    x = f"(CASE WHEN s_{name}.high_skew THEN ln(1 + ({name} + s_{name}.shift)) ELSE {name} END)"
    return f"(CASE WHEN s_{name}.iqr = 0 THEN {x} ELSE least(greatest({x}, s_{name}.lower), s_{name}.upper) END)"


# --- a tree grown level by level --------------------------------------------------------
def tree_levels(features: list[str], depth: int, bins: int, least_rows: int, source: str) -> str:
    """CTEs: ``tr<l>`` are the training rows after l levels, ``b<l>`` the splits of level l."""
    cols = ", ".join(features)
    ends = ", ".join(f"min({f}) AS lo_{f}, (max({f}) - min({f})) / {bins} AS st_{f}" for f in features)
    names = "[" + ", ".join(f"'{f}'" for f in features) + "]"
    bin_ = "[" + ", ".join(
        f"CAST(coalesce(least(floor(({f} - lo_{f}) / st_{f}), {bins - 1}), 0) AS INTEGER)" for f in features) + "]"
    lo = "CASE feature " + " ".join(f"WHEN '{f}' THEN lo_{f} + bin * st_{f}" for f in features) + " END"
    val = "CASE b.feature " + " ".join(f"WHEN '{f}' THEN t.{f}" for f in features) + " END"
    out = [f"ends AS (SELECT {ends} FROM {source})", f"tr0 AS (SELECT *, 1 AS node FROM {source})"]
    for lv in range(depth):
        out.append(f"""
h{lv} AS (SELECT node, c.f AS feature, c.b AS bin, count(*) AS n, sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS pos
  FROM (SELECT node, label, unnest(list_transform(list_zip({names}, {bin_}), lambda z: {{'f': z[1], 'b': z[2]}})) AS c FROM tr{lv}, ends)
  WHERE node >= {2 ** lv} GROUP BY ALL),
c{lv} AS (SELECT node, feature, bin, CAST(sum(n) OVER w AS BIGINT) AS ln, CAST(sum(pos) OVER w AS BIGINT) AS lp,
                 CAST(sum(n) OVER a AS BIGINT) AS tn, CAST(sum(pos) OVER a AS BIGINT) AS tp FROM h{lv}
  WINDOW w AS (PARTITION BY node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY node, feature)),
b{lv} AS (SELECT node, feature, {lo} AS cut FROM (
    SELECT *, lp * (ln - lp) / ln + (tp - lp) * ((tn - ln) - (tp - lp)) / (tn - ln) AS cost FROM c{lv} WHERE ln IS NOT NULL), ends
  WHERE ln >= {least_rows} AND tn - ln >= {least_rows} AND cost < tp * (tn - tp) / tn
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY cost, feature, bin) = 1)""")
        out.append(tree_step(f"tr{lv}", lv, val).replace("STEP", f"tr{lv + 1}"))
    return ",\n".join(out)


def tree_step(rows: str, lv: int, val: str) -> str:
    return f"""STEP AS (SELECT t.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN t.node
    WHEN coalesce({val} >= b.cut, false) THEN 2 * t.node + 1 ELSE 2 * t.node END AS node
  FROM {rows} t LEFT JOIN b{lv} b ON t.node = b.node)"""


def tree_apply(features: list[str], depth: int, source: str) -> str:
    """CTEs ``te<l>``: other rows sent down the same splits."""
    val = "CASE b.feature " + " ".join(f"WHEN '{f}' THEN t.{f}" for f in features) + " END"
    out = [f"te0 AS (SELECT *, 1 AS node FROM {source})"]
    for lv in range(depth):
        out.append(tree_step(f"te{lv}", lv, val).replace("STEP", f"te{lv + 1}"))
    return ",\n".join(out)
