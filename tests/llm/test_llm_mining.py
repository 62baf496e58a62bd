"""Mixing, periodic runs and hard negatives against plain versions."""
import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from odd import no_docs, odd_docs
from tidewatch.llm import mixing, negatives, periodic
from tidewatch.llm.common import word_hashes


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


# --- mixing ----------------------------------------------------------------------
def shares(size):
    """Targets by resharing the excess round by round, exactly."""
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, cap = sum(size.values()), {s: 3 * n for s, n in size.items()}
    target, fixed = {}, {}
    while True:
        left = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        target = fixed | {s: Fraction(rest * weight[s], sum(weight[x] for x in left)) for s in left}
        over = [s for s in left if target[s] > cap[s]]
        if not over:
            return target
        fixed |= {s: Fraction(cap[s]) for s in over}


def mixed_docs(spark):
    random.seed(5)
    names = ["b", "a", None, "Z", "é", "z", "\U0001f600", "empty", "tiny"]
    extra = []
    for i in range(900):
        s = names[0] if i % 3 == 0 else random.choice(names[:7]) if i % 50 else "tiny"
        extra.append((100 + i, " ".join(["w"] * (random.choice([0, 1, 5, 40]) if s != "tiny" else 1)), "en", s, 0))
    extra += [(5000, "", "en", "empty", 0), (5001, None, "en", "empty", 0)]
    rows = [(i, t, la, s, n, 0.5, 7, True, 1) for i, t, la, s, n in extra]
    return odd_docs(spark).unionByName(spark.createDataFrame(rows, odd_docs(spark).schema)).withColumn("size", F.lit("mine"))


def test_mixing(spark):
    docs = mixed_docs(spark)
    plan = mixing.plan(docs, mixing.rates(docs))
    assert plan.columns.count("size") == 1
    rows = plan.collect()
    size, took, of = defaultdict(int), defaultdict(int), {}
    assert len(rows) == docs.count()
    for r in rows:
        assert r.size == len(words(r.text)) and 0 <= r.copies <= 3
        size[r.source] += r.size
        took[r.source] += r.size * r.copies
        of[r.source] = (r.source_size, r.target)
    want = shares(size)
    for s, (n, target) in of.items():
        assert n == size[s] and abs(target - float(want[s])) < 1e-6 and target <= 3 * n
    assert of["empty"] == (0, 0.0) and any(3 * n == t for n, t in of.values() if n) and any(3 * n > t for n, t in of.values() if n)
    for s in ("a", "b", "Z", "z", "é"):
        assert abs(took[s] - of[s][1]) <= 0.02 * of[s][1] + 40, (s, took[s], of[s])
    again = mixing.plan(docs.repartition(7), mixing.rates(docs.repartition(3))).collect()
    key = lambda r: (r.doc_id or -1, r.text or "", r.copies)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    out = mixing.mix(docs).collect()
    assert len(out) == sum(r.copies for r in rows) and sum(r.size for r in out) == sum(took.values())
    assert mixing.mix(no_docs(spark)).count() == 0


def test_mixing_ranks_by_code_point_over_partitions(spark):
    names = [f"s{i}" for i in range(500)] + ["S", "ß", "\U00010000", "￮", None]
    random.shuffle(names)
    s = spark.createDataFrame([(n, 10) for n in names], "src string, words long")
    got = {r.src: r.weight for r in mixing._weighed(s).collect()}
    order = sorted((n for n in names if n is not None), key=str.encode) + [None]
    assert got == {n: (5, 2, 1)[i % 3] for i, n in enumerate(order)}


# --- periodic runs ---------------------------------------------------------------
def runs_of(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            if i > s and size >= max(6, 4 * q) and not any(
                    all(w[x] == w[x + p] for x in range(s, s + size - p)) for p in range(1, q)):
                out.append((s, size, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def looped(rng):
    w = []
    for _ in range(rng.randint(0, 6)):
        unit = [rng.choice(["a", "b", "c"]) for _ in range(rng.randint(1, 9))]
        w += (unit * 8)[:rng.randint(1, 7 * len(unit))] if rng.random() < 0.6 else [rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))]
    return w


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        texts = [looped(rng) for _ in range(rng.randint(1, 8))]
        got = periodic.find(*word_hashes([" ".join(t).encode() for t in texts], lower=False))
        for i, t in enumerate(texts):
            assert [tuple(map(int, r[1:])) for r in got[got[:, 0] == i]] == runs_of(t), t


def test_run_rows(spark):
    rng = random.Random(4)
    extra = [(100 + i, "\n ".join(looped(rng)) + " ") for i in range(60)] + [(200, "go " * 40), (201, "Go go " * 3), (202, "x y z " * 4)]
    extra += [(203, "a b c d e " * 40_000), (204, " ".join(f"u{i}" for i in range(3000)) + " " + " ".join(f"v{i % 700}" for i in range(2900)))]
    docs = odd_docs(spark, extra).withColumn("runs", F.lit(1))
    out = periodic.find_runs(docs)
    assert out.columns.count("runs") == 1
    n = 0
    for r in out.collect():
        w = words(r.text)
        have = [(x.start, x.length, x.period) for x in r.runs]
        if r.doc_id == 203:
            want = [(0, 200_000, 5)]
        elif r.doc_id == 204:
            want = [(3000, 2900, 700)]
        else:
            want = runs_of(w) if len(w) < 2000 else []
        if r.doc_id != 5:
            assert have == want, r.doc_id
            n += len(want)
        assert r.collapsed == collapsed(w, have)
    assert n > 60 and periodic.find_runs(no_docs(spark)).count() == 0


# --- hard negatives --------------------------------------------------------------
def hard(rows, every=5, k=5, m=3):
    best = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        best[i] = min(best.get(i, (label, v)), (label, v))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for a, (la, va) in best.items():
        if a % every:
            continue
        scored = sorted((-dot(va, v), i, label) for i, (label, v) in best.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == la][:k]:
            fit = [x for x in scored if x[2] != la and -50 * s <= -100 * x[0] <= -95 * s][:m]
            out += [(a, p, j + 1, i, -s, -x) for j, (x, i, _) in enumerate(fit)]
    return sorted(out)


SCHEMA = "vec_id long, label int, embedding array<float>, code string, z long"


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((4, dim)).astype(np.float32)
    rows = []
    for i in range(n):
        v = centre[rng.integers(4)] + rng.standard_normal(dim).astype(np.float32) * rng.choice([0.1, 0.6, 2.0])
        rows.append((i, int(rng.integers(3)), [float(x) for x in v.astype(np.float32) * np.float32(0.2)]))
    return rows


def test_hard_negatives_equal_brute_force(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(260, 20, 1)
    same = rows[3][2]
    rows += [(1000 + i, i % 3, same) for i in range(130)]  # a third of all rows is one vector
    rows += [(None, 1, same), (2000, None, same), (2001, 1, None), (2005, 1, [0.1, None]), (2010, 1, [nan] * 20), (2015, 1, [0.1, -inf]),
             (5, 2, rows[7][2]), (5, 2, rows[7][2]), (2020, 1, []), (2025, 0, [0.0] * 20), (2030, 2, [0.5, 0.25]), (-5, 1, rows[9][2])]
    df = spark.createDataFrame([r + ("x", 1) for r in rows], SCHEMA)
    want = hard(rows)
    assert len(want) > 200
    for blocks in ((4096, 8192), (64, 16)):
        got = negatives.mine(df, F.col("id") % 5 == 0, row_block=blocks[0], anchor_block=blocks[1])
        assert sorted(tuple(r) for r in got.collect()) == want
    assert negatives.mine(df.limit(0), F.col("id") % 5 == 0).count() == 0
    assert negatives.mine(df, F.lit(False)).count() == 0


def test_intervals_hold_and_filter():
    rng = np.random.default_rng(2)
    v = np.floor(256 * rng.standard_normal((400, 128)) * rng.choice([0.01, 1, 50], (400, 1))).astype(np.int64)
    v[7] = 0
    q = np.concatenate([v[:20], np.floor(v[20:40] * 1.1).astype(np.int64)])
    low, high = negatives.Query(q).intervals(np.arange(40), *negatives.codes(v))
    exact = v @ q.T
    assert (low <= exact).all() and (exact <= high).all()
    # unrelated rows fall under a near copy's lower bound
    assert (high < low.max(0)).mean() > 0.05
