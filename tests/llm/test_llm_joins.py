"""Operators on pairs, lines, groups and files, against brute force."""
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from odd import no_docs, odd_docs
from tidewatch.llm import common, decontam, jaccard, lines, sharding, warc
from tidewatch.session import scratch_path


def shingles(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_copies(n=160):
    random.seed(9)
    base = [[random.choice("abcdefgh") * random.randint(1, 3) + str(random.randint(0, 60)) for _ in range(random.randint(3, 80))]
            for _ in range(12)]
    common = [f"c{i}" for i in range(30)]  # a passage that most documents share
    out = []
    for d in range(100, 100 + n):
        w = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 1, 2, 3])):
            w[random.randrange(len(w))] = f"z{random.randint(0, 5)}"
        out.append((d, " ".join(w + (common if random.random() < 0.5 else []))))
    return out + [(d + 1000, t.upper()) for d, t in out[:25]]


def test_jaccard_components(spark):
    rows = odd_docs(spark, near_copies())
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id or -1) for r in jaccard.link(rows).collect())
    docs = [(r.doc_id, shingles(r.text)) for r in rows.collect()]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(docs)), 2):
        a, b = docs[i][1], docs[j][1]
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            parent[find(j)] = find(i)
    low = {}
    for i, (k, _) in enumerate(docs):
        if k is not None:
            low[find(i)] = min(low.get(find(i), 1 << 60), k)
    want = sorted(((k or -1), len(s), low.get(find(i), -1) if s else (k or -1)) for i, (k, s) in enumerate(docs))
    assert got == want
    assert jaccard.link(no_docs(spark)).count() == 0


def test_jaccard_blocks(spark, monkeypatch):
    """Groups over many blocks give the components that one block gives."""
    rows = odd_docs(spark, near_copies(60))
    one = {r.doc_id: r.component_id for r in jaccard.link(rows).collect()}
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    assert {r.doc_id: r.component_id for r in jaccard.link(rows).collect()} == one


def test_jaccard_limited_round_without_pairs(spark, monkeypatch):
    """If pairs verified earlier take all places under the limit, the round without limit still runs."""
    random.seed(3)
    common = [f"c{i}" for i in range(30)]
    docs = [(d, " ".join(random.sample(common, 30))) for d in range(20)]
    start = [f"r{i}" for i in range(4)] + random.sample(common, 4)
    body = random.sample(common, 21)
    docs.append((30, " ".join(start + random.sample(common, 10))))  # the hub, linked to neither
    docs += [(d, " ".join(start + body + [f"u{d}{i}" for i in range(4)])) for d in (31, 32)]  # near copies, 25 of 33
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    left = jaccard._left
    monkeypatch.setattr(jaccard, "_left", lambda *a, few=None, cut=None: left(*a, few=1 if few else None, cut=cut))
    assert {r.doc_id: r.component_id for r in jaccard.link(rows).collect()} == {d: min(d, 31) for d, _ in docs}


@pytest.mark.parametrize("block", [512, 3])
def test_jaccard_cut_lists_come_again_whole(spark, monkeypatch, block):
    """Members that are near each other, not their hub: the first round's limit cuts lists, the second one has them all."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = np.random.default_rng(4)
    body = rng.integers(0, 1 << 58, 60).astype(np.uint64)
    of = {i: np.sort(np.concatenate([body, rng.integers(0, 1 << 58, 4).astype(np.uint64)])) for i in range(1, 13)}
    of |= {i: np.sort(rng.integers(0, 1 << 58, 64 + 40 * (i % 2)).astype(np.uint64)) for i in (20, 21, 22)}  # near none
    of[100] = np.sort(np.concatenate([body[:20], rng.integers(0, 1 << 58, 40).astype(np.uint64)]))
    sets = spark.createDataFrame([(i, len(c), bytearray(jaccard.bitmap(c))) for i, c in of.items()], "s long, n int, bits binary")
    members = [i for i in of if i != 100]
    groups = spark.createDataFrame([(100, 60, i, len(of[i]), True) for i in members], "h long, hn int, s long, n int, ok boolean")
    checked = spark.createDataFrame([(100, i, 60, len(of[i]), len(set(of[100]) & set(of[i]))) for i in members],
                                    "a long, b long, an int, bn int, o int")
    comp = spark.createDataFrame([], "node long, component long")
    first = jaccard._left(groups, sets, comp, checked, few=1)
    cut = first.where("b is null").select("a", "h").distinct()
    assert {r.a for r in cut.collect()} >= set(range(2, 12)) and cut.where("a in (20, 21, 22)").count() == 0
    # what the first round joined: some members are now in one component
    comp = spark.createDataFrame([(i, 1) for i in (1, 2, 3, 4, 5)], "node long, component long")
    got = {(r.a, r.b) for r in jaccard._left(groups, sets, comp, checked, cut=cut).where("b is not null").collect()}
    near = {(a, b) for a, b in itertools.combinations(range(1, 13), 2) if not b <= 5}
    assert {(a, b) for a, b in got if b < 20} == near
    assert {(a, b) for a, b in near if len(set(of[a]) & set(of[b])) >= jaccard.need(len(of[a]), len(of[b]))} == near


def staged(monkeypatch, module):
    """Frames that ``module`` stages, as (name, frame), in order."""
    frames, write = [], module.stage

    def stage(df, name):
        frames.append((name, df))
        return write(df, name)

    monkeypatch.setattr(module, "stage", stage)
    return frames


def test_jaccard_disk(spark, monkeypatch):
    """A hub's own pairs are decided: a group of one member is not compared.  Texts not wanted are left where they are read."""
    docs = []
    for d in range(12):  # pairs that share words enough to meet and too few to link; two near copies
        same = [f"s{d}x{i}" for i in range(20)]
        docs += [(2 * d, " ".join(same + [f"a{d}x{i}" for i in range(14)])), (2 * d + 1, " ".join(same + [f"b{d}x{i}" for i in range(14)]))]
    docs.append((50, docs[3][1] + " end"))
    frames = staged(monkeypatch, jaccard)
    got = {r.doc_id: r.component_id for r in jaccard.link(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: 3 if d == 50 else d for d, _ in docs}
    of = dict(reversed(frames))
    assert of["jaccard-groups"].count() >= 5
    groups = of["jaccard-groups"].groupBy("h").count()
    assert of["jaccard-members"].select("h").distinct().count() <= groups.where("count > 1").count()
    assert of["jaccard-blocks"].count() <= 3  # at most those of the near copies' group
    assert "strategy=broadcast" in of["jaccard-verified"]._jdf.queryExecution().logical().toString()


@pytest.mark.parametrize("marks", [1 << 18, 1])
def test_jaccard_wanted_texts(spark, monkeypatch, marks):
    """Exactly the rows named come, whatever the marks let through; keys may be null or come twice."""
    monkeypatch.setattr(jaccard, "MARKS", marks)
    docs = spark.createDataFrame([(i, f"text {i % 90}") for i in range(300)] + [(None, "no key"), (7, "text 7"), (8, None)],
                                 "doc_id long, text string")
    wanted = [(1, 7, "text 7"), (2, None, "no key"), (3, 299, "text 29"), (4, 5, "text 6")]
    ids = (spark.createDataFrame(wanted, "s long, k long, x string").select("s", "k", F.xxhash64("x").alias("r")))
    got = sorted(tuple(r) for r in jaccard._texts(docs, "doc_id", "text", ids).collect())
    assert got == [(1, "text 7"), (1, "text 7"), (2, "no key"), (3, "text 29")]


def test_components_end_at_stars(spark, monkeypatch):
    frames = staged(monkeypatch, common)
    star = [(1, 4), (5, 1), (1, 4), (2, 9), (3, 3)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(star, "a long, b long"), "a", "b").collect()}
    assert got == {1: 1, 4: 1, 5: 1, 2: 2, 9: 2} and len(frames) == 1
    chain = [(i, i + 1) for i in range(10, 40)] + [(60, 50), (50, 55), (55, 12), (70, 71)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 10 for i in (*range(10, 41), 50, 55, 60)}, 70: 70, 71: 70}


def test_bitmap_never_overstates():
    import numpy as np
    rng = np.random.default_rng(1)
    for n, m, c in ((50, 60, 40), (400, 390, 350), (5, 9, 3), (900, 300, 10)):
        x = rng.integers(0, 1 << 62, n + m, dtype=np.uint64)
        a, b = np.sort(x[:n]), np.sort(np.concatenate([x[:c], x[n:n + m - c]]))
        assert jaccard.apart(jaccard.bitmap(a), jaccard.bitmap(b)) <= (n - c) + (m - c)


def lev1(a, b):
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def test_line_dedup(spark):
    random.seed(5)
    base = ["".join(random.choice("abé \U0001f600c") for _ in range(random.randint(18, 60))).strip() for _ in range(20)]
    extra = []
    for d in range(100, 190):
        ls = []
        for _ in range(random.randint(0, 6)):
            t = random.choice(base)
            for _ in range(random.choice([0, 0, 1, 1, 2])):
                p, o = random.randrange(len(t) + 1), random.random()
                t = t[:p] + (random.choice("abxé") if o < .66 else "") + t[p + (o >= .33):]
            ls += [random.choice(["", "  ", "\t"]) + t] + [""] * (random.random() < .1)
        extra.append((d, "\n".join(ls)))
    rows = odd_docs(spark, extra)
    docs = sorted({(r.doc_id, r.text) for r in rows.collect() if r.text is not None},
                  key=lambda x: (x[0] is not None, x[0] or 0))
    key6 = [t for k, t in docs if k == 6]
    assert len(key6) == 2  # one key, two texts: their order is by hash, and they share no line
    occ = [(k, t, i, x.strip(" \t\r")) for k, t in docs for i, x in enumerate(t.split("\n")) if x.strip(" \t\r")]
    gone = {o[:3] for n, o in enumerate(occ)
            if any(o[3] == u[3] or min(len(o[3]), len(u[3])) >= 24 and lev1(o[3], u[3]) for u in occ[:n])}
    out = lines.dedup(rows)
    assert sorted(out.columns) == sorted([*rows.columns, "n_dropped"])
    got = {(r.doc_id, r.text, r.n_dropped) for r in out.collect()}
    want = {(k, "\n".join(x for i, x in enumerate(t.split("\n")) if (k, t, i) not in gone), sum((k, t, i) in gone for i in range(len(t))))
            for k, t in docs} | {(1, None, 0)}
    assert got == want and out.count() == rows.count()
    assert lines.dedup(no_docs(spark)).count() == 0


def test_sharding(spark, monkeypatch):
    random.seed(4)
    rows = odd_docs(spark, [(100 + i, "w" * random.randint(1, 3000)) for i in range(400)] + [(600 + i, "hot text") for i in range(50)])
    for cell, pack in ((4096, 64), (60, 25)):
        monkeypatch.setattr(sharding, "CELL_GROUPS", cell)
        monkeypatch.setattr(sharding, "PACK", pack)
        got = sharding.by_bytes(rows).collect()
        assert len(got) == rows.count()
        total = [sum(r.size for r in got if r["shard"] == s) for s in range(8)]
        big = max(len((r.text or "").encode()) + 1 for r in rows.collect())
        slack = 50 if cell == 4096 else 9_000  # few and coarse pieces are left at the top
        assert max(sorted(total)[:-1]) - min(total) <= slack and max(total) <= max(big, sum(total) / 8) + slack
        for s in range(8):
            slots = sorted(r["slot"] for r in got if r["shard"] == s)
            assert slots == list(range(len(slots)))
        of = {}
        text = {r.doc_id: (r.text or "") for r in rows.collect() if r.doc_id != 6 and r.doc_id is not None}
        for r in got:
            if r.doc_id in text:
                assert of.setdefault(text[r.doc_id], r["shard"]) == r["shard"]
                assert r["text_crc32"] == zlib.crc32(text[r.doc_id].encode())
                assert r["size"] == len(text[r.doc_id].encode()) + 1
    assert sharding.by_bytes(no_docs(spark)).count() == 0


def test_sharding_at_production_cell_size(spark):
    """More groups than one cell holds: the levels that their number asks for, and shards still near equal."""
    rng = random.Random(3)
    rows = spark.createDataFrame([(i, "x" * rng.randint(1, 400) + str(i)) for i in range(9_000)], "doc_id long, text string")
    got = sharding.by_bytes(rows).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    total = [r.b for r in got]
    assert sum(r.n for r in got) == 9_000 and len(total) == 8
    assert max(total) - min(total) <= 0.001 * sum(total)


def test_differencing_beats_greedy_example():
    got = sharding.differencing([[x, 0] for x in (8, 7, 6, 5, 4)], 2)
    sums = [0, 0]
    for x, g in zip((8, 7, 6, 5, 4), got):
        sums[g[0]] += x
    assert abs(sums[0] - sums[1]) == 2  # the method's known result for this list


def smith_waterman(a, b):
    row, best = [0] * (len(b) + 1), 0
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(max(0, row[j - 1] + (2 if x == y else -1), row[j] - 1, new[-1] - 1))
        best, row = max(best, *new), new
    return best


def test_decontamination(spark):
    random.seed(6)
    voc = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(random.choice(voc) for _ in range(random.randint(12, 40)))) for i in range(15)]
    items += [(50, "Two words"), (51, None), (52, ""), (53, items[0][1])]
    docs = []
    for d in range(100, 160):
        w = [random.choice(voc) for _ in range(random.randint(5, 60))]
        if d % 3 == 0:
            p = items[d % 15][1].split()
            for _ in range(d % 5):
                o = random.randrange(len(p))
                p[o:o + 1] = random.choice([[], ["x1"], ["x2", "x3"]])
            w[len(w) // 2:len(w) // 2] = p
        docs.append((d, " ".join(w) + ("." if d % 2 else "")))
    docs.append((200, "here are TWO, words!"))
    rows = odd_docs(spark, docs)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    split = lambda t: re.sub(r"[\x00-\x7f]", lambda m: m[0].lower() if m[0].isalnum() else " ", t or "").split()
    texts = {k: [t for q, t in ((r.doc_id, r.text) for r in rows.collect()) if q == k] for k in {r.doc_id for r in rows.collect()}}
    want = {}
    for k, ts in texts.items():
        for i, t in items:
            a = split(t)
            if a and k != 5:  # the very long text is made of other words
                s = max(smith_waterman(a, split(x)) for x in ts) / (2 * len(a))
                if s >= 0.5:
                    want[k, i] = round(s, 9)
    for block in (20_000, 4):
        got = {(r.doc_id, r.item_id): round(r.score, 9) for r in decontam.contaminated(rows, bench, block_items=block).collect()}
        assert got == want and (200, 50) in got and len(got) >= 20
    assert decontam.contaminated(no_docs(spark), bench).count() == 0
    assert decontam.contaminated(rows, bench.limit(0)).count() == 0


def test_decontamination_edited_copies_of_one_kind(spark):
    w = [f"w{i}" for i in range(30)]
    edited = " ".join(w[:15] + ["other"] + w[16:])  # three grams of the item are in no text
    docs = spark.createDataFrame([(d, f"a{d} b{d} {edited} c{d}") for d in range(12)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")
    got = {(r.doc_id, r.score) for r in decontam.contaminated(docs, bench).collect()}
    assert got == {(d, 57 / 60) for d in range(12)}


def test_decontamination_copies_without_the_rare_grams(spark):
    w = [f"w{i}" for i in range(40)]
    changed = w[:4] + [f"x{i}" for i in range(6)] + w[10:]  # scores 62 of 80 by frequent grams alone
    docs = [(d, " ".join(w[:6] + [f"a{d}"] + w[9:] if d < 2 else [f"b{d}"] + changed)) for d in range(10)]
    docs += [(d, " ".join([f"b{d}"] * 9 + w[d:d + 3] + ["w1", "w2"] * 20)) for d in range(10, 30)]  # frequent, but far away
    docs += [(50, " ".join(w)), (51, " ".join(x for i in range(0, 40, 4) for x in w[i:i + 4] + ["y1", "y2"]))]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")
    split = {d: t.split() for d, t in docs}
    want = {d: smith_waterman(w, t) / 80 for d, t in split.items()}
    for part in (rows, rows.where("doc_id in (4, 12, 51)")):  # alike among many texts and few
        got = {r.doc_id: r.score for r in decontam.contaminated(part, bench).collect()}
        assert got == {r.doc_id: want[r.doc_id] for r in part.collect() if want[r.doc_id] >= 0.5}
    assert {d for d in want if want[d] >= 0.5} == {*range(10), 50, 51}


def test_decontamination_bounds_and_slices():
    random.seed(8)
    voc = [f"w{i}" for i in range(12)]  # few words: nearly every pair shares grams
    items = [(i, " ".join(random.choice(voc) for _ in range(random.randint(1, 25)))) for i in range(12)]
    docs = [(d, " ".join(random.choice(voc) for _ in range(random.randint(1, 90)))) for d in range(40)]
    bench = decontam.Items(*zip(*items), 0.5)
    h, first, at, g = decontam._hits([t.encode() for _, t in docs], bench.grams, decontam._filter(bench.grams))
    d, item, lo, hi = decontam._spans(bench, first, np.searchsorted(first, at, "right") - 1, at, np.searchsorted(bench.grams, g))
    may = decontam._may_reach(bench, h, item, lo, hi, 0.5)
    reach = [decontam.smith_waterman(bench.of(i), h[a:b])[0] / (2 * len(bench.of(i))) >= 0.5 for i, a, b in zip(item, lo, hi)]
    assert len(may) > 100 and all(m >= r for m, r in zip(may, reach)) and any(reach) and not all(may)
    total, group = np.cumsum([3, 1, 1, 9, 2, 2, 2, 1]), np.array([0, 0, 1, 1, 2, 2, 2, 3])
    assert [(c.start, c.stop) for c in decontam._cuts(total, group, 6)] == [(0, 2), (2, 3), (3, 4), (4, 7), (7, 8)]


@pytest.mark.parametrize("min_score", [0.5, 0.65])
def test_decontamination_loses_no_pair(spark, min_score):
    """Every pair is aligned here, without any seed; edits of all kinds and rates, in texts of frequent words."""
    random.seed(12)
    voc = [f"w{min(int(random.expovariate(0.05)), 60)}" for _ in range(400)]
    items = [(i, " ".join(random.choice(voc) for _ in range(random.choice([1, 2, 3, 8, 25, 30])))) for i in range(14)]
    docs = []
    for d in range(120):
        out, every = [], random.choice([2, 3, 4, 6])
        for j, x in enumerate(items[d % 14][1].split()):
            o = random.random()
            out += [x] if j % every else [x, "put"] if o < 0.4 else [f"z{d}"] if o < 0.8 else []
        out = [random.choice(voc) for _ in range(random.randint(0, 15))] + out + [random.choice(voc) for _ in range(random.randint(0, 15))]
        docs.append((d, " ".join(out)))
    third = [f"t{i}" for i in range(30)]
    items.append((90, " ".join(third)))
    docs.append((900, " ".join(x if i % 3 else f"other{i}" for i, x in enumerate(third))))  # no three words in a row are left
    docs.append((901, " ".join(y for x in third for y in (x, "between"))))  # no two
    want = {(d, i): round(smith_waterman(x.split(), t.split()) / (2 * len(x.split())), 9) for d, t in docs for i, x in items}
    want = {k: v for k, v in want.items() if v >= min_score}
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string"), min_score=min_score)
    assert {(r.doc_id, r.item_id): round(r.score, 9) for r in got.collect()} == want and len(want) > 30
    if min_score == 0.5:
        assert (900, 90) in want and (901, 90) in want


def test_seeds_are_the_rare_ones():
    items = decontam.Items([1], ["the cat of the house sat on the red mat"], 0.5)
    all_units = len(items.place)
    often = {int(g): 1000 for g in items.of(0)[[0, 2, 3, 7]]}
    the = decontam.gram_hashes(items.of(0)[:1], 1)[0]
    items.keep_rare({int(the): 10_000, **often})
    assert all_units == 19 and len(items.place) == 19 - (10 - 1) + 1 and the not in items.grams


def test_decontamination_of_an_item_that_repeats_a_gram(spark):
    w = [f"w{i}" for i in range(36)] + ["w0", "w1", "w2", "end"]
    copy = [x for i in range(0, 36, 2) for x in (*w[i:i + 2], "put")] + w[36:]  # its first gram is the item's last
    rows = spark.createDataFrame([(1, " ".join(copy))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")
    got = decontam.contaminated(rows, bench, min_score=0.7).collect()
    assert [tuple(r) for r in got] == [(1, 1, smith_waterman(w, copy) / 80, 0, 58)] and got[0].score == 62 / 80


def pages(spark):
    random.seed(8)
    big = "".join(random.choice("abcdef ") for _ in range(40_000))
    rows = [(1, "http://a/1", "x" * 99), (2, None, "x" * 99), (3, "http://a/3", "x" * 100), (4, "http://a/4", "x" * 100),
            (0, "http://a/0", "é" * 50), (9, "http://bad\r\nX: y", "é" * 50), (10, "u", None), (11, "u", ""), (12, "u", big), (13, "v", big),
            (None, "n", "without a key " * 20), (14, "n", "without a key " * 20)]
    rows += [(100 + i, f"http://b/{i}", "".join(random.choice("abc\n") for _ in range(random.randint(0, 3000)))) for i in range(60)]
    return spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, record_type string")


@pytest.mark.parametrize("split", [700, 4 << 20])
def test_warc_round_trip(spark, split):
    rows = pages(spark)
    got = warc.round_trip(rows, split_bytes=split).collect()
    by = {}
    for r in rows.collect():
        b = (r.html or "").encode()
        by.setdefault(b, []).append(r.page_id)
    want = set()
    for b, ids in by.items():
        first = min(ids, key=lambda k: (k is not None, k or 0))
        for k in ids:
            again = len(b) >= 100 and k != first
            want.add((k, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first if again else None))
    assert {(r.page_id, r.declared_bytes, r.declared_digest, r.record_type, r.refers_to) for r in got} == want
    assert len(got) == rows.count()
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.declared_digest for r in got if r.payload is not None)
    assert warc.round_trip(rows.limit(0)).count() == 0


def test_every_split_gives_every_record_once(spark):
    root = scratch_path(spark, "warc-test").replace("file:", "file://", 1)
    manifest = warc.write(pages(spark), root).where("bytes > 0").collect()
    store, _ = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
    m = max(manifest, key=lambda r: r.bytes)
    with store.open_input_file(m.path) as f:
        whole = [p for p, _ in warc.scan(f, 0, m.bytes, m.bytes)]
        assert len(whole) > 3
        for step in (97, 1000, 4096):
            got = [p for s in range(0, m.bytes, step) for p, _ in warc.scan(f, s, min(m.bytes, s + step), m.bytes, piece=500)]
            assert got == whole
        # magic numbers that begin no record are passed over
        data = warc.MAGIC + b"junk" + f.read_at(m.bytes, 0) + warc.MAGIC * 3
    path = m.path + ".odd"
    with store.open_output_stream(path, compression=None) as o:
        o.write(data)
    with store.open_input_file(path) as f:
        assert [p - 7 for p, _ in warc.scan(f, 0, len(data), len(data))] == whole
