"""Operators that need no join: quality, BPE, language ID, toxicity."""
import collections
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from odd import no_docs, odd_docs
from tidewatch.llm import bpe, langid, quality, toxicity
from tidewatch.llm.bpe import WordBPE

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_encoder_equals_library(library):
    import random
    random.seed(1)
    m = WordBPE(open(PATH, encoding="utf-8").read(), cache_words=500)
    texts = ["".join(random.choice(a) for _ in range(random.randint(0, 50)))
             for a in ("abcdehinorstu'éß .!?-_1ΣΩ<|>\n", "aehinot", "lar ", "İẞﬁé\x1c\x85 ½²٣日本😀") for _ in range(700)]
    texts += ["I'LL don't 's'S'll <|endoftext|> x<|startoftext|>y<|endoftext", "a" * 3000, "ha" * 999]
    for t in texts:
        e = library.encode(t, add_special_tokens=False)
        ids = m.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == e.ids, t
        assert m.decode(ids).decode() == library.decode(e.ids, skip_special_tokens=False)


def test_bpe_rows(spark, library):
    rows = odd_docs(spark)
    got = collections.Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in bpe.encode_decode(rows, PATH).collect())
    want = collections.Counter()
    for r in rows.collect():
        e = library.encode(r.text or "", add_special_tokens=False)
        want[r.doc_id, len(e.ids), np.array(e.ids, "<u4").tobytes(), library.decode(e.ids, skip_special_tokens=False)] += 1
    assert got == want
    assert bpe.encode_decode(no_docs(spark), PATH).count() == 0


def base_of(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    c = collections.Counter(tuple(w[j:j + 8]) for j in range(len(w) - 7))
    again = {i for j in range(len(w) - 7) if c[tuple(w[j:j + 8])] > 1 for i in range(j, j + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(again))


def test_base_counts(spark):
    p = "one two three four five six seven eight nine"
    extra = [(20, f"{p} {p}"), (21, f"x {p}\n{p} y\n{p} y"), (22, "go " * 40), (23, "a\n\na\n b\nb\n#*$%&|<> x"), (24, f" {p} ")]
    rows = odd_docs(spark, extra)
    d = quality.base_counts(rows)
    got = sorted(((r.doc_id or -1), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in d.collect())
    assert got == sorted((r.doc_id or -1, *base_of(r.text)) for r in rows.collect())


def odd_kept(spark, table):
    return {r.doc_id for r in quality.judge(odd_docs(spark), table).where("kept").collect()}


def grams(t, n=8192):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
    pair = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
            for a, b in zip(h, h[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(x) % n for x in h + pair]


def test_quality_ratios_by_hand(spark):
    """Hashed counts of every trusted and every row, and mean log ratios, against plain sums."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 7 = 0")
    good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")
    texts, ids = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id for r in good.collect()}
    raw, target = np.zeros(8192), np.zeros(8192)
    for k, t in texts.items():
        for g in grams(t):
            raw[g] += 1
            target[g] += k in ids
    llr = np.log((target + 1) / (target.sum() + 8192)) - np.log((raw + 1) / (raw.sum() + 8192))
    table = quality.ratios(docs, good)
    assert np.allclose(table.first().llr, llr)
    for r in quality.judge(docs, table).collect():
        g = grams(texts[r.doc_id])
        want = llr[g].mean() if g else 0.0
        assert abs(r.score - want) < 1e-9
        assert r.kept == (not r.base_failed and want >= -0.03) or abs(want + 0.03) < 1e-9


def test_quality_verdict(spark):
    # 10,000 texts: with a tenth of them the hashed counts are too thin for these shares
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    table = quality.ratios(docs, labels.where("quality = 1"))
    got = quality.judge(docs, table).join(labels, "doc_id").where("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in got}
    assert n.get((1, False), 0) <= 0.01 * n[1, True] and n.get((0, True), 0) <= 0.1 * n[0, False]
    # ratios follow the definition
    llr = table.first().llr
    assert len(llr) == 8192 and any(x > 0 for x in llr) and any(x < 0 for x in llr)
    odd = quality.judge(odd_docs(spark), table)
    assert odd.count() == 11 and odd.where("kept and base_failed").count() == 0
    # every trusted row counts, and a filter does not bring the whole chain down to the scan
    judged = quality.judge(docs, table)
    size = lambda d: len(d._jdf.queryExecution().optimizedPlan().toString())
    assert size(judged.where("kept")) < 1.5 * size(judged)
    assert odd_kept(spark, table) <= {8, 5}
    empty = quality.ratios(no_docs(spark), no_docs(spark))
    assert set(empty.first().llr) == {0.0} and quality.judge(no_docs(spark), empty).count() == 0
    plan = quality.judge(docs, table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = langid.train(docs, learn=crc != 1)
    assert sorted(model) == ["de", "en", "es", "fr"]
    held = docs.where(crc == 1).where("doc_id % 5 = 0")
    p = langid.predict(held, model).join(held.select("doc_id", "lang"), "doc_id")
    right, n = p.where("lang = lang_pred").count(), p.count()
    assert right >= 0.96 * n
    odd = {(r.doc_id, r.lang_pred, r.score) for r in langid.predict(odd_docs(spark), model).collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (7, "und", 0.0)} <= odd
    assert all(0 <= s <= 1 for _, _, s in odd)
    none = langid.train(no_docs(spark), learn=F.lit(True))
    assert none == {} and langid.predict(odd_docs(spark), none).where("lang_pred <> 'und'").count() == 0


def test_language_ties_and_rare_languages(spark):
    """A language with one row is learned like any other; equal sizes go to the first name."""
    rows = [(i, "der die das und nicht mit einem haus " * 3, "de") for i in range(40)]
    rows += [(100, "zzyx qwyx vvox xxyz kwyz " * 5, "xx"), (101, "aaa bbb", None), (102, None, "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, learn=F.lit(True))
    assert sorted(model) == ["de", "xx"]
    small = langid.train(docs, learn=F.lit(True), model_bytes=2_000)
    assert sorted(small) == ["de", "xx"] and all(len(d) <= 1_000 for d in small.values())
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert got[100] == "xx" and got[0] == "de" and got[102] == "und"
    same = {"b": model["de"], "a": model["de"]}
    assert {r.lang_pred for r in langid.predict(docs.where("doc_id < 40"), same).collect()} == {"a"}


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = toxicity.train(docs, labels, learn=crc != 2)
    n = {(r.toxic, r.p): r["count"] for r in toxicity.score(docs.where(crc == 2), model).join(labels, "doc_id")
         .groupBy("toxic", (F.col("score") >= 0.3).alias("p")).count().collect()}
    assert n[1, True] >= 0.75 * (n[1, True] + n.get((1, False), 0)) and n.get((0, True), 0) <= 0.01 * n[0, False]
    odd = toxicity.score(odd_docs(spark), model, whole=True)
    assert odd.columns.count("score") == 1 and odd.count() == 11
    s = {r.doc_id: r.score for r in odd.collect()}
    assert s[1] == s[2] == s[3] < 0.3
    none = toxicity.train(no_docs(spark), labels.limit(0), learn=F.lit(True))
    two = spark.createDataFrame([(1, "you idiot and moron and worthless scum"), (2, "fine words")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(two, none).collect()}
    assert got[1] >= 0.3 > got[2]


@pytest.mark.parametrize("seed", range(10))
def test_label_model_weighs_copies_once(seed):
    rng = np.random.default_rng(seed)
    y = rng.random(4000) < 0.3
    flip = lambda p: np.where(rng.random(4000) < p, y, ~y)
    good, fair = flip(0.9), flip(0.7)
    v = np.where(np.stack([good, fair, fair, fair], 1), 1, -1)
    post, accuracy, corr = toxicity.label_model(v, 0.3)
    assert accuracy[0] > accuracy[1] and corr[1, 2] > 0.9 and abs(corr[0, 1]) < 0.3
    assert ((post > 0.5) == y).mean() > 0.85
    assert abs(accuracy[0] - (good == y).mean()) < 0.06 and abs(accuracy[1] - (fair == y).mean()) < 0.06


def test_label_model_posterior_by_hand():
    v = np.array([[1, 0, -1], [0, 1, -1], [-1, -1, 1], [0, 0, 0]])
    rng = np.random.default_rng(1)
    table = rng.random((2, 3, 3)) + 0.1
    table /= table.sum(2, keepdims=True)
    share, prior = np.array([1.0, 0.5, 1.0]), 0.2
    got = toxicity._posterior(v, table, share, prior)
    for row, p in zip(v, got):
        like = [np.prod([table[c, j, x + 1] ** share[j] for j, x in enumerate(row)]) for c in (0, 1)]
        assert abs(p - prior * like[1] / (prior * like[1] + (1 - prior) * like[0])) < 1e-9
    # expected counts, summed by hand
    post = np.array([0.9, 0.6, 0.1, 0.3])
    t = toxicity._tables(v, post)
    toxic = [sum(post[i] for i in range(4) if v[i, 0] == x) + s for x, s in ((-1, 0.2), (0, 0.8), (1, 0.6))]
    assert np.allclose(t[1, 0], np.array(toxic) / sum(toxic))
