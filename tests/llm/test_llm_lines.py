"""Line dedup on a large group of near copies, against brute force."""
import random

import tidewatch.llm.lines as lines


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] or a[i + 1:] == b[i:] or a[i:] == b[i + 1:]


def test_group_of_near_copies(spark, monkeypatch):
    rng = random.Random(8)
    base = " ".join(rng.choice(["stone", "river", "lamp", "green", "seven", "quiet"]) for _ in range(18))
    texts = []
    for i in range(400):  # a word replaced, as copies of a page differ, some with one character changed, some as they are
        w = base.split()
        w[rng.randrange(len(w))] = rng.choice(["marble", "oaks", "winterly", "blue"]) + str(rng.randrange(40))
        t = " ".join(w)
        if i % 4 == 0:
            p = rng.randrange(len(t))
            t = rng.choice([t[:p] + t[p + 1:], t[:p] + "x" + t[p:], t[:p] + "y" + t[p + 1:]])
        texts.append(t)
    texts += [base, base + "s", base[1:], "short line", "short lime"]
    rng.shuffle(texts)
    want = sum(1 for i, t in enumerate(texts)
               if t in texts[:i] or len(t) >= 24 and any(len(u) >= 24 and within_one(t, u) for u in texts[:i]))
    counts, real = {}, lines.stage

    def stage(df, name):
        d = real(df, name)
        counts[name] = d.count()
        return d

    monkeypatch.setattr(lines, "stage", stage)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = lines.dedup(docs).collect()
    assert sum(r.n_dropped for r in got) == want > 30
    kept = {r.doc_id for r in got if not r.n_dropped}
    assert kept == {i for i, t in enumerate(texts) if t not in texts[:i]
                    and not (len(t) >= 24 and any(len(u) >= 24 and within_one(t, u) for u in texts[:i]))}
    # a word's change is not within one character: such lines emit next to no variants
    assert counts["line-variants"] < 15 * len(texts)
