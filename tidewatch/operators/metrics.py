"""Evaluation metrics (A11): confusion counts, exact ROC-AUC, average precision.

AUC and AP need running sums over the score order.  A global
``Window.orderBy(score)`` would pull every row into one task, so instead:

1. one row per distinct score with its positive/negative counts (hash
   aggregate: a score shared by a third of the rows is one row);
2. split points from ``percentile_approx`` over those scores (``n_buckets``
   numbers reach the driver) and a ``Bucketizer`` (binary search, JVM);
3. per-bucket totals (``n_buckets`` rows, bounded) -> exclusive offsets;
4. running sums inside each bucket with a window partitioned by bucket, plus
   the bucket's offset (broadcast of ``n_buckets`` rows).

AUC counts ties as one half (Mann-Whitney); AP is the step-wise sum
``sum((R_n - R_{n-1}) * P_n)`` over distinct thresholds.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F


#: distinct scores in a bucket, so that their number and the tasks grow with the data
SCORES_PER_BUCKET = 100_000


def confusion(df: DataFrame, label_col: str, pred_col: str, positive: int = 0) -> DataFrame:
    y = F.col(label_col) == positive
    p = F.col(pred_col) == positive
    c = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
               F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    prec = F.try_divide(tp, tp + fp)
    rec = F.try_divide(tp, tp + fn)
    return c.select("tp", "fp", "tn", "fn",
                    F.try_divide(tp + tn, tp + fp + tn + fn).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    F.try_divide(2 * prec * rec, prec + rec).alias("f1"))


def score_counts(df: DataFrame, score_col: str, label_col: str, positive: int) -> DataFrame:
    y = F.col(label_col) == positive
    return (df.filter(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(score_col).cast("double").alias("score"))
              .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))


def running_sums(counts: DataFrame, order_col: str, value_cols: list[str],
                 n_buckets: int | None = None, totals: bool = False) -> DataFrame:
    """Adds ``cum_<v>`` = sum of ``v`` over rows with ``order_col`` <= this
    row's (one row per distinct ``order_col``); with ``totals`` also
    ``tot_<v>``, the grand total (taken from the bucket table, no extra pass)."""
    from pyspark.ml.feature import Bucketizer
    counts = counts.checkpoint()  # read several times below
    if n_buckets is None:
        n_buckets = max(64, counts.count() // SCORES_PER_BUCKET + 1)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = counts.agg(F.percentile_approx(order_col, probs, 10000).alias("q")).first()["q"] or []
    # infinite and NaN scores keep their place: first and last bucket, NaN behind them
    finite = sorted({float(q) for q in qs if math.isfinite(q)}) or [0.0]
    splits = [float("-inf"), *finite, float("inf")]
    bz = Bucketizer(splits=splits, inputCol=order_col, outputCol="_b", handleInvalid="keep")
    b = bz.transform(counts)
    bucket_totals = b.groupBy("_b").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    wt = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # <= n_buckets rows
    wall = Window.partitionBy(F.lit(0))  # over the bucket table only (<= n_buckets rows)
    offsets = bucket_totals.select(
        "_b", *[F.coalesce(F.sum(f"_t_{v}").over(wt), F.lit(0)).alias(f"_o_{v}") for v in value_cols],
        *[F.sum(f"_t_{v}").over(wall).alias(f"tot_{v}") for v in value_cols])
    b = b.join(F.broadcast(offsets), "_b")
    w = Window.partitionBy("_b").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    extra = [F.col(f"tot_{v}") for v in value_cols] if totals else []
    return b.select(*counts.columns,
                    *[(F.sum(v).over(w) + F.col(f"_o_{v}")).alias(f"cum_{v}") for v in value_cols], *extra)


def roc_auc(df: DataFrame, score_col: str, label_col: str, positive: int = 1,
            n_buckets: int | None = None) -> DataFrame:
    c = running_sums(score_counts(df, score_col, label_col, positive), "score", ["neg"], n_buckets)
    below = F.col("cum_neg") - F.col("neg")
    agg = c.agg(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))).alias("u"),
                F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return agg.select(F.try_divide(F.col("u"), F.col("p").cast("double") * F.col("n")).alias("roc_auc"))


def average_precision(df: DataFrame, score_col: str, label_col: str, positive: int = 1,
                      n_buckets: int | None = None) -> DataFrame:
    c = score_counts(df, score_col, label_col, positive).withColumn("desc", -F.col("score"))
    c = running_sums(c, "desc", ["pos", "neg"], n_buckets)
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    agg = c.agg(F.sum(F.col("pos") * prec).alias("s"), F.sum("pos").alias("p"))
    return agg.select(F.try_divide(F.col("s"), F.col("p").cast("double")).alias("average_precision"))


def binary_metrics(df: DataFrame, score_col: str, label_col: str, positive: int = 1,
                   n_buckets: int | None = None) -> DataFrame:
    """ROC-AUC and the average precision of both classes from ONE pass of
    running sums in ascending score order (higher score = more ``positive``).

    With P/N the class totals and cum_* the counts at scores <= s:
    AUC = sum pos * (cum_neg - neg/2) / (P*N);
    AP(positive) thresholds from the top: TP = P - cum_pos + pos, FP = N - cum_neg + neg;
    AP(other class, score negated) thresholds from the bottom: TP = cum_neg, FP = cum_pos."""
    c = running_sums(score_counts(df, score_col, label_col, positive), "score", ["pos", "neg"],
                     n_buckets, totals=True)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    cp, cn = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    tp_hi = F.col("tot_pos") - cp + pos
    fp_hi = F.col("tot_neg") - cn + neg
    agg = c.agg(F.sum(pos * (cn - 0.5 * neg)).alias("u"),
                F.sum(pos * tp_hi / (tp_hi + fp_hi)).alias("ap_p"),
                F.sum(neg * cn / (cn + cp)).alias("ap_n"),
                F.sum(pos).alias("p"), F.sum(neg).alias("n"))
    return agg.select(F.try_divide(F.col("u"), F.col("p") * F.col("n")).alias("roc_auc"),
                      F.try_divide(F.col("ap_p"), F.col("p")).alias("ap_positive"),
                      F.try_divide(F.col("ap_n"), F.col("n")).alias("ap_negative"))
