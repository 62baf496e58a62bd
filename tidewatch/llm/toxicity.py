"""Toxicity by weak supervision (operator 1).

1. A bounded sample of labelled texts (``max_labelled``, half of each label as
   far as there are, first by hash of the key) is read.
2. Voters: hand-written lexicons, lexicons and word-stem patterns mined from
   the sample, and plain patterns.  A voter says toxic, clean, or abstains.
   The annotators' label is one more voter, so wrong labels can be outvoted.
3. A generative label model, fitted by expectation-maximisation, estimates each
   voter's accuracy and the correlations between voters given the unknown
   class; correlated voters share their weight.
4. A linear classifier over word and stem features is trained on the model's
   posterior labels and scores every whole text in one pass, without shuffle.

Defined results: null and empty texts get the score of a text without any
feature.  Without labelled rows only the hand-written lexicons vote.  Repeated
rows are scored alike; extra columns are not read.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import stage

_WORD = re.compile(r"[^\W\d_]+")
#: hand-written lexicons, one voter each
LEXICONS = {
    "insult_en": "idiot idiots moron morons stupid loser losers pathetic worthless scum trash clown disgusting dumb imbecile",
    "insult_fr": "connard connards salaud salope abruti crétin débile ordure",
    "insult_de": "arschloch idioten trottel dummkopf abschaum drecksau vollidiot",
    "insult_es": "imbécil estúpido estúpida gilipollas cabrón basura pendejo",
    "threat": "kill die destroy hurt hate",
}
_SECOND_PERSON = re.compile(r"\b(?:you|your|du|dein|tu|vous|usted)\b")
_SHOUT = re.compile(r"!{2,}|\b[A-Z]{4,}(?:\s+[A-Z]{4,})+")
STEMS = (4, 5, 6)


def features(text: str) -> set[str]:
    """Lower-case words, and their stems (first letters) marked by a star."""
    words = set(_WORD.findall(text.lower()))
    out = set(words)
    for n in STEMS:
        out.update([w[:n] + "*" for w in words if len(w) > n])
    return out


def _sample(docs, labels, learn, key, text, label, most):
    """(key, text, label) of at most ``most`` labelled rows, half of each label if possible."""
    rows = (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).where(learn)
            .groupBy(key).agg(F.max(label).cast("int").alias("_y"))
            .withColumn("_h", F.xxhash64(key)))
    part = [rows.where(F.col("_y") == y).orderBy("_h", key).limit(most // 2) for y in (0, 1)]
    ids = stage(part[0].unionAll(part[1]).select(F.col(key).alias("_k"), "_y"), "tox-ids")  # at most `most` rows
    return stage(docs.join(F.broadcast(ids), F.col(key) == F.col("_k"))
                 .select(F.col("_k"), F.coalesce(F.col(text), F.lit("")).alias("_t"), "_y"), "tox-sample")


def _mine(sample: DataFrame, n_features: int, min_docs: int) -> list[tuple[str, int, int]]:
    """Features by (toxic, clean) document counts, strongest association first."""
    def count(batches):
        seen: dict[str, list[int]] = {}
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for f in features(t):
                    seen.setdefault(f, [0, 0])[y] += 1
                if len(seen) > 200_000:
                    yield out(seen)
                    seen = {}
        if seen:
            yield out(seen)

    def out(seen):
        v = list(seen.values())
        return pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array([x[1] for x in v], pa.int64()),
                                           pa.array([x[0] for x in v], pa.int64())], ["f", "pos", "neg"])

    c = (sample.select("_t", "_y").mapInArrow(count, "f string, pos bigint, neg bigint")
         .groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
         .where(F.col("pos") + F.col("neg") >= min_docs))
    odds = F.log((F.col("pos") + 0.5) / (F.col("neg") + 0.5))
    strength = odds * F.sqrt(F.col("pos") + F.col("neg"))
    # features of clean texts are left out: many of them would outvote one plain insult
    top = c.where(F.col("pos") > 8 * (F.col("neg") + 0.5)).orderBy(strength.desc(), "f").limit(n_features).collect()
    return [(r.f, r.pos, r.neg) for r in top]


def _voters(mined, n_groups: int) -> dict[str, frozenset[str]]:
    """Lexicon voters: the hand-written ones and groups of mined words or stems."""
    out = {k: frozenset(v.split()) for k, v in LEXICONS.items()}
    # a mined entry occurs in toxic documents much more often than in clean ones
    good = [f for f, p, n in mined if p >= 4 and p > 8 * (n + 0.5)]
    for kind, part in (("word", [f for f in good if f[-1] != "*"]), ("stem", [f for f in good if f[-1] == "*"])):
        for g in range(n_groups):
            if part[g::n_groups]:
                out[f"mined_{kind}_{g}"] = frozenset(part[g::n_groups])
    return out


def votes(text: str, found: set[str], lexicons: dict[str, frozenset[str]]) -> list[int]:
    """1 toxic, -1 clean, 0 abstains; one for each lexicon, then the patterns."""
    hits = [1 if found & lex else 0 for lex in lexicons.values()]
    said = any(hits)
    return hits + [1 if said and _SECOND_PERSON.search(text.lower()) else 0,
                   1 if said and _SHOUT.search(text) else 0,
                   -1 if not said else 0,  # no lexicon finds anything
                   -1 if not found else 0]  # no words at all


def _blocks(v: np.ndarray, same: float = 0.95) -> np.ndarray:
    """For each voter the first voter it agrees with where either of them votes; copies share one."""
    first = np.arange(v.shape[1])
    for j in range(v.shape[1]):
        for i in range(j):
            either = (v[:, i] != 0) | (v[:, j] != 0)
            if first[i] == i and either.any() and (v[either, i] == v[either, j]).mean() >= same:
                first[j] = i
                break
    return first


def _voices(v: np.ndarray, prior: float) -> np.ndarray:
    """Weights to start with.  If a voter that takes both sides is right equally
    often in both classes, the share of its votes for toxic gives that rate a:
    prior a + (1 - prior) (1 - a).  One-sided voters have weight 1."""
    n = np.maximum((v != 0).sum(0), 1)
    share = (v > 0).sum(0) / n
    both = np.minimum(share, (v < 0).sum(0) / n) >= 0.02
    if abs(2 * prior - 1) < 0.1:  # the share says nothing where classes are even
        return np.ones(v.shape[1])
    right = np.clip((share - (1 - prior)) / (2 * prior - 1), 0.55, 0.95)
    return np.where(both, np.log(right / (1 - right)), 1.0)


def _tables(v: np.ndarray, post: np.ndarray) -> np.ndarray:
    """P(vote | class) by expected counts: class x voter x vote."""
    onehot = np.stack([v == -1, v == 0, v == 1], 2).astype(float)
    table = np.einsum("ci,ijk->cjk", np.stack([1 - post, post]), onehot)
    # smoothing holds a voter to be better than chance until votes say otherwise
    table += np.array([[0.6, 0.8, 0.2], [0.2, 0.8, 0.6]])[:, None, :]
    return table / table.sum(2, keepdims=True)


def _posterior(v: np.ndarray, table: np.ndarray, share: np.ndarray, prior: float) -> np.ndarray:
    """P(toxic | votes) where voter j's likelihood ratio counts to the power share[j]."""
    onehot = np.stack([v == -1, v == 0, v == 1], 2).astype(float)
    logit = np.einsum("ijk,jk,j->i", onehot, np.log(table[1]) - np.log(table[0]), share) + np.log(prior / (1 - prior))
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _correlation(v: np.ndarray, post: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Correlation of the votes that is left given the class."""
    expect = alone[:, :, 2] - alone[:, :, 0]
    rest = [(v - expect[c]) * np.sqrt(p)[:, None] for c, p in ((0, 1 - post), (1, post))]
    cov = sum(r.T @ r for r in rest)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    return cov / np.outer(sd, sd)


def label_model(v: np.ndarray, prior: float, rounds: int = 30, least: float = 0.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of toxic, accuracies, correlations) from votes (documents x voters).

    Each voter has a table P(vote | class).  After every step the correlation
    that the class leaves between voters is measured, and a voter's likelihood
    ratio counts to the power 1 / (1 + its correlations of at least ``least``):
    a block of copies counts once, whatever their number.  The start is a vote
    in which copies (``_blocks``) have one voice, weighed by the voters' first
    moments (``_voices``), so that copies cannot define the class either.
    An accuracy is the share of a voter's votes that name the class.
    """
    first = np.unique(_blocks(v))
    voice = v[:, first] @ _voices(v[:, first], prior)
    post = 1 / (1 + np.exp(-np.clip(voice + np.log(prior / (1 - prior)), -30, 30)))
    for _ in range(rounds):
        table = _tables(v, post)
        corr = _correlation(v, post, table)
        other = np.where(corr > least, corr, 0) * (1 - np.eye(len(corr)))
        new = _posterior(v, table, 1 / (1 + other.sum(1)), prior)
        done = np.abs(new - post).max() < 1e-6
        post = new
        if done:
            break
    table = _tables(v, post)
    right = prior * table[1, :, 2] + (1 - prior) * table[0, :, 0]
    wrong = prior * table[1, :, 0] + (1 - prior) * table[0, :, 2]
    return post, right / (right + wrong), _correlation(v, post, table)


def _fit_linear(rows: list[np.ndarray], target: np.ndarray, weight: np.ndarray, k: int, l2: float = 0.01,
                rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on presence features with weights of at least 0, by adaptive gradient steps."""
    flat = np.concatenate(rows) if rows else np.zeros(0, int)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, b = np.zeros(k), 0.0
    mw, mb, total = np.zeros(k), 0.0, weight.sum()
    vw, vb = np.zeros(k), 0.0
    for t in range(1, rounds + 1):
        z = b + np.bincount(doc, w[flat], len(rows))
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * weight / total
        gw = np.bincount(flat, g[doc], k) + l2 * w / total
        gb = g.sum()
        mw, mb = 0.9 * mw + 0.1 * gw, 0.9 * mb + 0.1 * gb
        vw, vb = 0.999 * vw + 0.001 * gw * gw, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        w = np.maximum(w - 0.1 * (mw / c1) / (np.sqrt(vw / c2) + 1e-8), 0)  # a finding never speaks against toxicity
        b -= 0.1 * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, learn, key: str = "doc_id", text: str = "text", label: str = "toxic",
          max_labelled: int = 12_000, n_features: int = 4_000, n_groups: int = 12, min_docs: int = 6) -> dict:
    """Model: weights by feature, intercept, and the label model's findings.

    Bounds: ``max_labelled`` rows are fitted on, ``n_features`` features kept;
    what the driver holds is at most the features found in each of these rows.
    """
    share = labels.where(F.col(label).isin(0, 1)).where(learn).agg(F.avg(F.col(label).cast("double"))).first()[0]
    prior = min(0.5, max(0.005, share or 0.05))
    sample = _sample(docs, labels, learn, key, text, label, max_labelled)
    mined = _mine(sample, n_features, min_docs)
    lexicons = _voters(mined, n_groups)
    names = sorted({f for f, _, _ in mined} | {w for s in LEXICONS.values() for w in s.split()})
    place = {f: i for i, f in enumerate(names)}

    def look(batches):
        for b in batches:
            v, idx = [], []
            for t in b.column(0).to_pylist():
                f = features(t)
                v.append(votes(t, f, lexicons))
                idx.append(sorted(place[x] for x in f if x in place))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(v, pa.list_(pa.int32())),
                                              pa.array(idx, pa.list_(pa.int32()))], ["y", "v", "f"])

    got = sample.select("_t", "_y").mapInArrow(look, "y int, v array<int>, f array<int>").collect()
    fixed = {w: 3.0 for s in ("insult_en", "insult_fr", "insult_de", "insult_es") for w in LEXICONS[s].split()}
    if not got or len({r.y for r in got}) < 2:
        return {"weights": fixed, "intercept": float(np.log(prior / (1 - prior))) - 1, "prior": prior,
                "accuracy": {}, "correlation": np.zeros((0, 0))}
    y = np.array([r.y for r in got])
    v = np.array([[*r.v, 1 if r.y else -1] for r in got])
    balance = y.mean()
    post, accuracy, corr = label_model(v, balance)
    weight = np.where(y == 1, prior / balance, (1 - prior) / (1 - balance))
    # half-way to the true prior: rare but clear cases keep their say
    w, b = _fit_linear([np.array(r.f, int) for r in got], post, np.sqrt(weight), len(names))
    return {"weights": {f: float(x) for f, x in zip(names, w) if abs(x) > 1e-3}, "intercept": b, "prior": prior,
            "accuracy": dict(zip([*lexicons, "second_person", "shout", "no_hit", "no_word", "annotator"],
                                 map(float, accuracy))), "correlation": corr}


def score(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """(key, score, n_features) of every row, whole texts, no shuffle.

    ``whole``: all columns of the input in place of the key; input columns
    named score or n_features are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model["weights"], model["intercept"]))  # at most n_features
    given = docs.drop("score", "n_features") if whole else docs.select(key, text)
    names = given.columns if whole else [key]
    at = [given.columns.index(n) for n in names]

    def run(batches):
        weights, b0 = shared.value
        stems = {f[:-1] for f in weights if f[-1] == "*"}
        known: dict[str, tuple] = {}  # features of a word, emptied when full

        for batch in batches:
            scores, counts = [], []
            for t in batch.column(text).cast(pa.string()):
                found: set = set()
                for word in set(_WORD.findall((t.as_py() or "").lower())):
                    f = known.get(word)
                    if f is None:
                        f = tuple([word] if word in weights else []) + tuple(
                            word[:n] + "*" for n in STEMS if len(word) > n and word[:n] in stems)
                        if len(known) > 100_000:
                            known.clear()
                        known[word] = f
                    if f:
                        found.update(f)
                z = b0 + sum(weights.get(f, 0.0) for f in sorted(found))
                scores.append(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in at), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())],
                [*names, "score", "n_features"])

    return given.mapInArrow(run, given.select(*names).schema.add("score", "double").add("n_features", "long"))
