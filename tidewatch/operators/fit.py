"""Fit and apply preprocessing statistics.

``fit_stats`` scans the data once whatever the number of columns: one global
aggregate of ``count``, ``skewness``, ``min`` and ``percentile_approx`` (a
mergeable sketch) for every column.  It is a partial aggregate, so no task
ever sees more than its own split plus small sketches; only the O(#columns)
result reaches the driver, where it becomes literals in the plan.  A sketch
holds about ``accuracy`` values, so a greater accuracy than ``SKETCH_ACCURACY``
is met by a small sketch and a second scan that counts around the ranks it found
(exact quartiles, whatever the number of rows).

Parameters the reference does not state, chosen here: skew threshold 1.0 on
``|skewness|`` (population form), whisker factor 1.5, shift ``max(0, -min)``,
quartiles at ranks ``ceil(q * n)``.
"""
from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidewatch.functions.keys import utc_ntz
from tidewatch.functions.transform import cap, log_shift


@dataclass
class PrepStats:
    feature_cols: list[str]
    high_skew_cols: list[str] = field(default_factory=list)
    log_shifts: dict[str, float] = field(default_factory=dict)
    iqr_bounds: dict[str, dict[str, float]] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"high_skew_cols": self.high_skew_cols, "log_shifts": self.log_shifts,
                           "feature_cols": self.feature_cols, "iqr_bounds": self.iqr_bounds})

    @staticmethod
    def from_dict(d: dict) -> "PrepStats":
        return PrepStats(feature_cols=list(d["feature_cols"]),
                         high_skew_cols=list(d.get("high_skew_cols") or []),
                         log_shifts={k: float(v) for k, v in (d.get("log_shifts") or {}).items()},
                         iqr_bounds={k: {"lower": float(v["lower"]), "upper": float(v["upper"])}
                                     for k, v in (d.get("iqr_bounds") or {}).items()})


def _idx(cols):
    return [(i, c) for i, c in enumerate(cols)]


#: the greatest accuracy for which a sketch alone is used; above it, quartiles are exact
SKETCH_ACCURACY = 100_000
#: accuracy of the sketch that brackets exact quartiles, and how far around a rank the bracket goes
BRACKET_ACCURACY = 10_000
BRACKET_MARGIN = 2.5 / BRACKET_ACCURACY
QUARTILES = (0.25, 0.75)


def fit_frame(df: DataFrame, cols: list[str], threshold: float = 1.0, whisker: float = 1.5,
              accuracy: int = 100000, quantiles: bool = True) -> DataFrame:
    """All statistics in ONE pass: a single wide aggregate of ``count``,
    ``skewness``, ``min`` and ``percentile_approx`` per column (above
    ``SKETCH_ACCURACY``: that pass and one for exact quartiles).

    The log step ``log1p(x + shift)`` is strictly increasing and
    ``percentile_approx`` returns actual data values, so the quartiles of the
    transformed column are exactly ``log1p(q + shift)`` of the raw quartiles —
    no second pass over transformed values is needed.

    One row per column: feature, n, skewness, min_value, high_skew, shift,
    q1, q3, iqr, lower, upper (quartiles and bounds in log space for
    high-skew columns)."""
    if quantiles and accuracy > SKETCH_ACCURACY:
        return _bounds(_exact_rows(df, cols), threshold, whisker)
    qs = F.array(*map(F.lit, QUARTILES))
    aggs = []
    for i, c in _idx(cols):
        x = F.col(c).cast("double")
        q = F.percentile_approx(x, qs, accuracy) if quantiles else F.lit(None).cast("array<double>")
        aggs += [F.count(x).alias(f"n{i}"), F.skewness(x).alias(f"s{i}"), F.min(x).alias(f"m{i}"),
                 q.alias(f"q{i}")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("skewness"),
                 F.col(f"m{i}").alias("min_value"), F.get(F.col(f"q{i}"), 0).alias("q1_raw"),
                 F.get(F.col(f"q{i}"), 1).alias("q3_raw"))
        for i, c in _idx(cols)])).alias("r")
    return _bounds(wide.select(rows).select("r.*"), threshold, whisker)


def _exact_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """A column's count, skewness, least value and exact raw quartiles (rank
    ``ceil(q * n)``) in two scans: a sketch of ``BRACKET_ACCURACY`` gives two values
    around each rank, then rows are counted up to and between them."""
    ends = F.array(*[F.lit(min(max(q + d, 0.0), 1.0)) for q in QUARTILES for d in (-BRACKET_MARGIN, BRACKET_MARGIN)])
    aggs = []
    for i, c in _idx(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.skewness(x).alias(f"s{i}"), F.min(x).alias(f"m{i}"),
                 F.percentile_approx(x, ends, BRACKET_ACCURACY).alias(f"q{i}")]
    w = df.agg(*aggs).first()
    wanted, brackets = {}, {}
    for i, c in _idx(cols):
        for j, q in enumerate(QUARTILES):
            if w[f"n{i}"]:
                k = i * len(QUARTILES) + j
                wanted[k] = (c, math.ceil(q * w[f"n{i}"]))
                brackets[k] = tuple(w[f"q{i}"][2 * j:2 * j + 2])
    found = _at_ranks(df, wanted, brackets)
    if missed := {k: r for k, r in wanted.items() if k not in found}:  # the sketch was off: all values
        found |= _at_ranks(df, missed, {k: (float("-inf"), float("nan")) for k in missed})  # NaN is the greatest
    fields = ("skewness", "min_value", "q1_raw", "q3_raw")
    rows = []
    for i, c in _idx(cols):
        values = (w[f"s{i}"], w[f"m{i}"], *[found.get(i * len(QUARTILES) + j) for j in range(len(QUARTILES))])
        rows.append(F.struct(F.lit(c).alias("feature"), F.lit(w[f"n{i}"]).cast("long").alias("n"),
                             *[F.lit(v).cast("double").alias(f) for f, v in zip(fields, values)]))
    return df.sparkSession.range(0, 1, 1, 1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _at_ranks(df: DataFrame, wanted: dict[int, tuple[str, int]], brackets: dict[int, tuple[float, float]]) -> dict[int, float]:
    """The value at each wanted ``(column, rank)`` that lies in its bracket.

    Rows below a bracket and at its ends only count (summed in each task); of the
    values between its ends, a few per ``BRACKET_ACCURACY`` rows, one row per
    distinct value is ranked."""
    if not wanted:
        return {}
    of: dict[str, list] = {}
    for k, (c, _) in wanted.items():
        of.setdefault(c, []).append(F.struct(F.lit(k).alias("k"), F.lit(brackets[k][0]).alias("lo"), F.lit(brackets[k][1]).alias("hi")))
    # a row per value and bracket: an expression per column would make the generated method too long to be compiled
    d = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in of])).alias("i", "x")).where("x is not null")
    d = d.select("x", F.explode(F.get(F.array(*[F.array(*b) for b in of.values()]), F.col("i"))).alias("b")).select("x", "b.*")
    place = F.expr("CASE WHEN x < lo THEN 0 WHEN x = lo THEN 1 WHEN x < hi THEN 2 ELSE 3 END")
    counts = (d.where("x <= hi").select("k", place.alias("place"), F.expr("CASE WHEN x > lo AND x < hi THEN x END").alias("x"))
              .groupBy("k", "place", "x").agg(F.count(F.lit(1)).alias("rows")))
    ranks = F.create_map(*[F.lit(v) for k, (_, r) in wanted.items() for v in (k, r)])
    upto = F.sum("rows").over(Window.partitionBy("k").orderBy("place", "x"))
    at = (counts.withColumn("upto", upto).where(F.col("upto") >= ranks[F.col("k")])
          .groupBy("k").agg(F.min_by(F.struct("place", "x"), "upto").alias("r")).select("k", "r.*").collect())
    return {r.k: r.x if r.place == 2 else brackets[r.k][0 if r.place == 1 else 1] for r in at if r.place}


def _bounds(r: DataFrame, threshold: float, whisker: float) -> DataFrame:
    """Log step, shift and bounds from a column's skewness, least value and raw quartiles."""
    high = F.coalesce(F.abs(F.col("skewness")) > F.lit(threshold), F.lit(False))
    # "+ 0.0" turns a -0.0 shift into 0.0
    shift = F.greatest(F.lit(0.0), F.coalesce(-F.col("min_value"), F.lit(0.0))) + F.lit(0.0)
    r = r.select("feature", "n", "skewness", "min_value", high.alias("high_skew"), shift.alias("shift"),
                 "q1_raw", "q3_raw")
    q1 = F.when(F.col("high_skew"), F.log1p(F.col("q1_raw") + F.col("shift"))).otherwise(F.col("q1_raw"))
    q3 = F.when(F.col("high_skew"), F.log1p(F.col("q3_raw") + F.col("shift"))).otherwise(F.col("q3_raw"))
    r = r.select("feature", "n", "skewness", "min_value", "high_skew", "shift", q1.alias("q1"), q3.alias("q3"))
    w = F.lit(float(whisker))
    iqr = F.col("q3") - F.col("q1")
    return r.select("*", iqr.alias("iqr"), (F.col("q1") - w * iqr).alias("lower"),
                    (F.col("q3") + w * iqr).alias("upper"))


#: accuracy of the stored sketches: ranks are right to within SKETCH_RANK_ERROR (99 % of the time better by far)
SKETCH_K = 2000
SKETCH_RANK_ERROR = 0.005


def sketch_frame(df: DataFrame, cols: list[str], time_col: str = "kafka_timestamp") -> DataFrame:
    """Mergeable state per UTC day and column: counts, central moments, least
    value and a quantile sketch.  One pass over the new days only; summed in
    each task before the shuffle, a few KB for a day and column."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in cols]))
    d = df.select(utc_ntz(time_col).cast("date").alias("day"), cells.alias("c")).select("day", "c.feature", "c.x")
    n, var = F.count("x"), F.var_pop("x")
    return (d.where("x is not null").groupBy("day", "feature").agg(
        n.alias("n"), F.avg("x").alias("mean"), (var * n).alias("m2"),
        F.coalesce(F.skewness("x") * F.pow(var, 1.5) * n, F.lit(0.0)).alias("m3"),
        F.min("x").alias("least"), F.kll_sketch_agg_double("x", SKETCH_K).alias("sketch")))


def update_sketches(df: DataFrame, cols: list[str], path: str, time_col: str = "kafka_timestamp") -> None:
    """Replace the stored state of the days in ``df`` (whole days; a repeated run changes nothing)."""
    (sketch_frame(df, cols, time_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def merged_frame(daily: DataFrame, threshold: float = 1.0, whisker: float = 1.5) -> DataFrame:
    """``fit_frame``'s row per column from stored daily states, without reading flows again.

    Counts, skewness and least values are exact (central moments are shifted to
    the common mean); quartiles have a rank within ``SKETCH_RANK_ERROR``."""
    mean = daily.groupBy("feature").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mu"))
    off = F.col("mean") - F.col("mu")
    r = daily.join(mean, "feature").groupBy("feature").agg(
        F.sum("n").alias("n"), F.min("least").alias("min_value"),
        F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"),
        F.sum(F.col("m3") + 3 * off * F.col("m2") + F.col("n") * off * off * off).alias("m3"),
        F.kll_merge_agg_double("sketch").alias("sketch"))
    skewness = F.when(F.col("m2") > 0, F.sqrt("n") * F.col("m3") / F.pow("m2", 1.5))
    q = [F.kll_sketch_get_quantile_double("sketch", F.lit(p)) for p in (0.25, 0.75)]
    return _bounds(r.select("feature", "n", skewness.alias("skewness"), "min_value",
                            q[0].alias("q1_raw"), q[1].alias("q3_raw")), threshold, whisker)


def skew_frame(df: DataFrame, cols: list[str], threshold: float = 1.0) -> DataFrame:
    """One row per column: feature, n, skewness, min_value, high_skew, shift."""
    return fit_frame(df, cols, threshold, quantiles=False).select(
        "feature", "n", "skewness", "min_value", "high_skew", "shift")


def bounds_frame(df: DataFrame, cols: list[str], threshold: float = 1.0, whisker: float = 1.5,
                 accuracy: int = 100000) -> DataFrame:
    """One row per column: feature, q1, q3, iqr, lower, upper (log space for
    high-skew columns)."""
    return fit_frame(df, cols, threshold, whisker, accuracy).select("feature", "q1", "q3", "iqr", "lower", "upper")


def fit_stats(df: DataFrame, cols: list[str], threshold: float = 1.0, whisker: float = 1.5,
              accuracy: int = 100000) -> PrepStats:
    """Fit the high-skew list, log shifts and IQR bounds in one pass (zero-IQR
    columns are left out of the bounds, so they stay uncapped).  Only the
    O(#columns) result reaches the driver."""
    return stats_of(fit_frame(df.select(*cols), cols, threshold, whisker, accuracy), cols)


def stats_of(frame: DataFrame, cols: list[str]) -> PrepStats:
    """``PrepStats`` from the rows of ``fit_frame`` or ``merged_frame``."""
    rows = frame.collect()
    high = [r["feature"] for r in rows if r["high_skew"]]
    shifts = {r["feature"]: float(r["shift"]) for r in rows if r["high_skew"]}
    bounds = {r["feature"]: {"lower": float(r["lower"]), "upper": float(r["upper"])}
              for r in rows if r["iqr"] is not None and r["iqr"] != 0}
    return PrepStats(feature_cols=list(cols), high_skew_cols=high, log_shifts=shifts, iqr_bounds=bounds)


def prepare(df: DataFrame, stats: PrepStats) -> DataFrame:
    """Log step on the high-skew columns, then capping to the bounds, in one
    projection (not a chain of ``withColumn``); other columns pass through."""
    out = []
    for c in df.columns:
        x = F.col(c)
        touched = False
        if c in stats.high_skew_cols:
            x, touched = log_shift(x, stats.log_shifts.get(c, 0.0)), True
        if c in stats.iqr_bounds:
            b = stats.iqr_bounds[c]
            x, touched = cap(x, b["lower"], b["upper"]), True
        out.append(x.alias(c) if touched else x)
    return df.select(*out)


def save_stats(spark: SparkSession, stats: PrepStats, path: str) -> None:
    """Write the stats as one JSON document (one row; tiny by construction)."""
    spark.createDataFrame([(stats.to_json(),)], "j string").coalesce(1) \
        .write.mode("overwrite").text(path)


def load_stats(spark: SparkSession, path: str) -> PrepStats:
    """Read stats JSON (S7).  The document is O(#features); one row."""
    row = spark.read.option("multiLine", True).json(path).first()
    return PrepStats.from_dict(row.asDict(recursive=True))
