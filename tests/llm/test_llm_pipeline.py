"""The pipeline against its stages' own rules on a small table."""
import hashlib
import os

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from odd import odd_docs
from test_llm_joins import lev1, shingles, smith_waterman
from tidewatch.session import scratch_path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark):
    words = [f"term{i}" for i in range(300)]
    rng = np.random.default_rng(3)
    say = lambda n: " ".join(rng.choice(words, n))
    item = say(25)
    rows = [(100 + i, say(40) + "\n" + say(30), "en", "s", 1) for i in range(40)]
    rows += [(200 + i, f"{say(12)} idiot moron {say(9)} worthless scum {say(4)}", "en", "s", 1) for i in range(12)]
    rows += [(300, rows[0][1], "en", "s", 1), (301, rows[1][1].split("\n")[0] + "\n" + say(30), "en", "s", 1)]
    rows += [(302, rows[2][1] + " more", "en", "s", 1), (303, say(10) + " " + item + " " + say(10), "en", "s", 1)]
    near = say(60).split()
    rows += [(400 + i, " ".join(near[:i * 9] + [f"x{i}"] + near[i * 9 + 1:]), "en", "s", 1) for i in range(4)]
    docs = odd_docs(spark).select("doc_id", "text", "lang", "source", "n_chars").unionAll(spark.createDataFrame(rows, COLUMNS))
    labels = spark.createDataFrame([(k, 1, 1 if 200 <= k < 300 else 0) for k in range(100, 310)], "doc_id long, quality int, toxic int")
    base = scratch_path(spark, "pipeline-test")
    docs.write.parquet(f"{base}/documents.parquet")
    labels.write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, item


def test_pipeline(spark):
    base, item = tables(spark)
    docs = spark.read.parquet(f"{base}/documents.parquet")
    seen = []
    for name, f in cp.STAGES:
        before = {(r.doc_id, r.text) for r in docs.collect()}
        docs = cp.stage(f(spark, docs, base), "test")
        seen.append(name)
        if name == "bpe encoding and decoding":
            t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            want = {(k, hashlib.sha256(np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes()).hexdigest())
                    for k, x in before}
            assert {(r.doc_id, r.ids_sha256) for r in docs.collect()} == want
            break
        assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
        after = {(r.doc_id, r.text) for r in docs.collect()}
        keys = {k for k, _ in after}
        if name == "toxicity":
            assert after <= before and before - after == {x for x in before if x[0] and 200 <= x[0] < 212}
        elif name == "line dedup":
            assert 300 not in keys  # every line occurs earlier
            assert dict(after)[301].count("\n") == 0 and all(len(x or "") == n for _, x, n in
                                                             ((r.doc_id, r.text, r.n_chars) for r in docs.collect()
                                                              if r.text is not None))
            lines = [x.strip(" \t\r") for _, t in after if t for x in t.split("\n")]
            long = [x for x in lines if len(x) >= 24]
            assert len(set(long)) == len(long)
            assert not any(lev1(a, b) for i, a in enumerate(long) for b in long[:i] if abs(len(a) - len(b)) < 2)
        elif name == "n-gram jaccard join":
            sets = [shingles(t) for _, t in after]
            assert not any(a and b and 100 * len(a & b) >= 75 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
            assert 400 in keys and not keys & {401, 402, 403} and after <= before
        elif name == "benchmark decontamination":
            assert before - after == {x for x in before if x[0] == 303}
            assert not any(smith_waterman(item.split(), (t or "").split()) >= 25 for _, t in after if t and len(t) < 5000)
    assert seen == [n for n, _ in cp.STAGES]
    again = cp.run(spark, base)
    assert sorted(map(str, again.collect())) == sorted(map(str, docs.collect()))


def test_nothing_else_imports_the_folder():
    top = os.path.dirname(os.path.abspath(cp.__file__))
    for folder, _, names in os.walk(os.path.join(top, "tidewatch")):
        if not folder.endswith("llm"):
            for n in names:
                if n.endswith(".py"):
                    assert "tidewatch.llm" not in open(os.path.join(folder, n), encoding="utf-8").read()
