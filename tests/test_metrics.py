"""AUC / AP / confusion against brute-force Python on small inputs with ties;
the bucketed running sums are exercised with several buckets."""
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import metrics as M


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    u = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return u / (len(pos) * len(neg))


def brute_ap(rows):
    thresholds = sorted({s for s, _ in rows}, reverse=True)
    total = sum(y for _, y in rows)
    ap, prev_r = 0.0, 0.0
    for t in thresholds:
        tp = sum(1 for s, y in rows if s >= t and y == 1)
        fp = sum(1 for s, y in rows if s >= t and y == 0)
        r = tp / total
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_auc_ap_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [(float(rnd.randint(0, 30)), rnd.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "s double, y int")
    auc = M.roc_auc(df, "s", "y", positive=1, n_buckets=5).first().roc_auc
    ap = M.average_precision(df, "s", "y", positive=1, n_buckets=4).first().average_precision
    assert auc == pytest.approx(brute_auc(rows), abs=1e-12)
    assert ap == pytest.approx(brute_ap(rows), abs=1e-12)


def test_auc_invariant_under_monotone_change(spark):
    rnd = random.Random(7)
    rows = [(rnd.random(), rnd.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "s double, y int")
    a = M.roc_auc(df, "s", "y", n_buckets=3).first().roc_auc
    b = M.roc_auc(df.withColumn("s", F.exp(F.col("s") * 3) + 1), "s", "y", n_buckets=7).first().roc_auc
    assert a == pytest.approx(b, abs=1e-12)


def test_confusion(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 1), (1, 1), (1, 0)], "y int, p int")
    r = M.confusion(df, "y", "p", positive=0).first()
    assert (r.tp, r.fp, r.tn, r.fn) == (2, 1, 1, 1)
    assert r.precision == pytest.approx(2 / 3) and r.recall == pytest.approx(2 / 3)


def test_fixture_auc_value(spark):
    from tidewatch import fixtures as X
    auc = M.roc_auc(X.flows(spark, "/root/testdata/sf0.01"), "f_value", "label", positive=1).first().roc_auc
    assert auc == pytest.approx(0.5018318427655547, abs=1e-12)


def brute_ap_negative(rows):
    return brute_ap([(-s, 1 - y) for s, y in rows])


@pytest.mark.parametrize("seed", [4, 5])
def test_binary_metrics_one_pass(spark, seed):
    rnd = random.Random(seed)
    rows = [(float(rnd.randint(0, 40)) / 4, rnd.randint(0, 1)) for _ in range(250)]
    df = spark.createDataFrame(rows, "s double, y int")
    r = M.binary_metrics(df, "s", "y", positive=1, n_buckets=6).first()
    assert r.roc_auc == pytest.approx(brute_auc(rows), abs=1e-12)
    assert r.ap_positive == pytest.approx(brute_ap(rows), abs=1e-12)
    assert r.ap_negative == pytest.approx(brute_ap_negative(rows), abs=1e-12)
