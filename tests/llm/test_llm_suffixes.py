"""Suffix-array dedup against brute force."""
import hashlib
import random

import numpy as np
import pytest

from tidewatch.llm import suffixes as S

L = 50


def brute(rows, length=L):
    first = {}
    for k, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            key = S._NULL if k is None else k
            first[w] = min(first.get(w, key), key)
    out = []
    for k, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] < (S._NULL if k is None else k):
                gone[s:s + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((k, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def ours(df, **kw):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest())
                   for r in S.dedup(df, **kw).collect()), key=str)


def test_suffix_array_and_prefixes():
    random.seed(3)
    for _ in range(150):
        n = random.randint(1, 60)
        a = bytes(random.choice([0, 0, 1, 97, 97, 98]) for _ in range(n))
        x = np.frombuffer(a, np.uint8)
        sa = S.suffix_array(x)
        assert sa.tolist() == sorted(range(n), key=lambda i: a[i:])
        lcp = S.common_prefixes(x, sa, np.array([0]), np.array([n]), 50)
        for i, j in zip(sa, sa[1:]):
            m = 0
            while i + m < n and j + m < n and a[i + m] == a[j + m]:
                m += 1
            assert lcp[j] == min(50, m)


def fixture():
    random.seed(11)
    word = lambda: "".join(random.choice("abcdeé") for _ in range(random.randint(2, 7)))
    passages = [" ".join(word() for _ in range(30)) for _ in range(4)]
    rows = [(0, None), (1, ""), (2, "short"), (3, "x" * 400), (4, "x" * 300 + "y" * 60), (5, "x" * 49)]
    for d in range(6, 70):
        parts = [" ".join(word() for _ in range(random.randint(0, 20))) for _ in range(3)]
        parts.insert(1, random.choice(passages)[random.randint(0, 30):])
        if d % 3 == 0:
            parts.append(passages[0])
        rows.append((d, " ".join(parts)))
    rows += [(100 + i, rows[20][1]) for i in range(3)] + [(101, rows[20][1]), (None, rows[21][1]), (40, passages[1])]
    return rows


@pytest.mark.parametrize("hot", [20_000, 5])
def test_removed_bytes(spark, hot):
    """``hot`` 5: grams in more than five runs are spread over shards and merged."""
    rows = fixture()
    df = spark.createDataFrame([(k, t, "n") for k, t in rows], "doc_id long, text string, spans string")
    assert ours(df, hot_runs=hot, shard_bytes=2_000) == brute(rows)


def test_empty_table(spark):
    assert ours(spark.createDataFrame([], "doc_id long, text string")) == []


def test_groups_sorted_no_further_than_needed():
    """Refinement stopped at 50 bytes gives the same neighbours' prefixes as whole sorting, over several stretches."""
    rng = random.Random(7)
    for _ in range(12):
        unit = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 120)))
        parts = [(unit * 30)[:rng.randint(50, 1500)] + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 40))) for _ in range(4)]
        x = np.frombuffer(b"".join(parts), np.uint8)
        size = np.array([len(p) for p in parts])
        start = np.cumsum(size) - size
        sa, rank = S.refined(x, 50)
        lcp = S.common_prefixes(x, sa, start, size, 50, rank)
        a = x.tobytes()
        for i, j in zip(sa, sa[1:]):
            m = 0
            while m < 50 and i + m < len(a) and j + m < len(a) and a[i + m] == a[j + m]:
                m += 1
            assert lcp[j] == m
            assert a[i:i + 50] <= a[j:j + 50]


def test_text_of_megabytes(spark):
    rng = random.Random(9)
    long = " ".join(f"{rng.randrange(1 << 40):x}" for _ in range(300_000))
    passage = long[1_500_000:1_505_000]
    rows = [(1, long), (2, "@" * 30 + passage + "~" * 30), (3, "~" * 20 + long + "@" * 20), (4, passage[10:59])]
    got = {r.doc_id: r for r in S.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(long) > 3_000_000 and got[1].n_removed == got[4].n_removed == 0
    assert [tuple(x) for x in got[2].spans] == [(30, 5_030)] and got[2].kept == b"@" * 30 + b"~" * 30
    assert [tuple(x) for x in got[3].spans] == [(20, 20 + len(long))]


def letters(rng, n):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))


@pytest.mark.parametrize("length", [50, 51, 33])
def test_runs_of_many_texts_at_once(length):
    """Runs of texts side by side are those of each text alone; all whole windows are in one; the place is the gram's first."""
    rng = random.Random(length)
    texts = [letters(rng, rng.choice([0, 3, length - 1, length, length + 1, 300])).encode() for _ in range(40)]
    texts += [b"x" * 200, b"", b"ab" * 90, letters(rng, 100).encode() * 3, letters(rng, 20).encode() * 9]
    ends = np.cumsum([len(t) for t in texts])
    got = list(zip(*(x.tolist() for x in S.window_runs(np.frombuffer(b"".join(texts), np.uint8), ends, length))))
    want, at = [], 0
    for t in texts:
        g, first, last, place = S.window_runs(np.frombuffer(t, np.uint8), np.array([len(t)]), length)
        assert [w for a, b in zip(first, last) for w in range(a, b + 1)] == list(range(len(t) - length + 1))
        for a, b, q in zip(first.tolist(), last.tolist(), place.tolist()):
            assert q < 0 or all(a2 <= q <= a2 + length - S.GRAM and t.find(t[q:q + S.GRAM], a2) == q for a2 in range(a, b + 1))
        want += [(x, a + at, b + at, q + at if q >= 0 else -1) for x, a, b, q in zip(g.tolist(), first.tolist(), last.tolist(), place.tolist())]
        at += len(t)
    assert got == want


def test_grams_shared_without_windows_are_not_sorted(spark):
    """A phrase shorter than a window, in texts that differ around it, sends nothing to the suffix arrays."""
    rng = random.Random(5)
    phrases = [letters(rng, 32) for _ in range(4)]
    rows = [(d, "".join(letters(rng, 60) + p for p in phrases) + letters(rng, 60)) for d in range(60)]
    df = spark.createDataFrame(rows, "k long, t string").selectExpr("k", "xxhash64(t) tag", "cast(t as binary) t")
    assert S._runs(df, L, 4, 20_000).count() == 0
    rows.append((99, "+" * 60 + rows[7][1][70:130] + "-" * 60))
    df = spark.createDataFrame(rows, "k long, t string").selectExpr("k", "xxhash64(t) tag", "cast(t as binary) t")
    assert {r.k for r in S._runs(df, L, 4, 20_000).where("z > 0").collect()} == {7, 99}


@pytest.mark.parametrize("length", [50, 51])
def test_windows_that_stand_anywhere_about_their_gram(spark, length):
    """Passages of just a window or a byte less, at borders, amid other bytes, with grams that come twice."""
    rng = random.Random(length)
    rows, d = [], 0
    for i in range(60):
        unit = letters(rng, rng.choice([1, 7, 20, 40]))
        p = letters(rng, length) if i % 3 else (unit * length)[:length]
        for n in (length, length - 1, length + 3):
            q = (p + letters(rng, 3))[:n] if n != length + 3 else letters(rng, 3) + p
            rows.append((d, rng.choice(["", letters(rng, rng.randint(1, 60))]) + q + rng.choice(["", letters(rng, rng.randint(1, 60))])))
            d += 1
    rng.shuffle(rows)
    got = ours(spark.createDataFrame(rows, "doc_id long, text string"), length=length)
    assert got == brute(rows, length) and sum(r[2] > 0 for r in got) > 50


def test_wanted_suffixes_sorted_alone():
    """Sorting only the suffixes that start windows leaves these in order, with the same ties and prefixes."""
    rng = random.Random(3)
    for _ in range(20):
        a = (bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 30))) * 40)[:rng.randint(120, 700)] + bytes(rng.choice(b"ab") for _ in range(60))
        wanted = np.array([rng.random() < 0.4 for _ in a]) & (np.arange(len(a)) + L <= len(a))
        x = np.frombuffer(a, np.uint8)
        sa, rank = S.refined(x, L, wanted)
        assert sorted(sa.tolist()) == np.flatnonzero(wanted).tolist()
        lcp = S.common_prefixes(x, sa, np.array([0]), np.array([len(a)]), L, rank)
        for i, j in zip(sa, sa[1:]):
            u, v = a[i:i + L], a[j:j + L]
            assert u <= v and lcp[j] == next((m for m in range(L) if u[m] != v[m]), L)
