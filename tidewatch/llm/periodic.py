"""Periodic run detection (operator 12).

A run is a stretch of consecutive words, ``[^\\x20\\x09-\\x0D]+``, with smallest
period q and at least max(6, 4q) words that no neighbouring word extends.
Seed-and-extend on diagonals, for periods scale by scale (q from s to 2s - 1,
s = 1, 2, 4, ...):

* A run of period q agrees with itself, shifted by q, over at least max(6 - q,
  3q) words.  The k-grams of the least such overlap in the scale, k = 5 and then
  3s, are indexed by a sort.
* A gram is at least as long as any period of its scale, so two places in a run
  closer than its smallest period cannot hold the same gram: a place's next
  occurrence lies exactly one smallest period on.  Neighbouring occurrences in
  one document therefore give every seed (place, lag), at most one a place, and
  all pairs of a frequent gram are never listed.
* For every lag the furthest covered place is kept: a seed inside it only moves
  the border, any other starts a stretch.  Stretches are extended both ways and
  reported if they are long enough; multiples of the smallest period get no seed.
* Texts without a repeated gram leave the search; the next scale's grams are
  longer, so nothing is lost.  Time grows as n log n in the words of a text.

Texts are handled in pieces of a batch inside tasks, without any shuffle; a
text is never cut.  Words are compared by 64-bit hashes within one text.

``collapse`` keeps the first period of each run: a word goes if some run holds
it after that run's first q words.

Defined results: null text has no words, no runs, and its collapsed text is
empty.  Empty tables give no rows; repeated rows are alike.  Input columns
named runs or collapsed are replaced, others pass through.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewatch.llm.common import mix, slices, word_hashes

_A, _B = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
RUN = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def _joined(x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
    """Hash of each gram in ``x`` followed by the one in ``y`` that starts ``step`` words on.

    Ends wrap around: a gram over a text's end holds the text's closing mark and equals no other."""
    return mix(x * _A + np.roll(y, -step) * _B)


def _stretches(a: np.ndarray, lag: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, end, lag) of what the seeds cover on each diagonal."""
    o = np.lexsort((a, lag))
    a, lag = a[o], lag[o]
    new = np.ones(len(a), bool)
    new[1:] = (lag[1:] != lag[:-1]) | (a[1:] > a[:-1] + k)  # beyond what the lag has covered so far
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(a)) - 1
    return a[head], a[tail] + k, lag[head]


def _extended(w: np.ndarray, s: np.ndarray, e: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches moved out to the first words that differ; a text's closing mark always does."""
    while True:
        more = (s > 0) & (w[s - 1] == w[s - 1 + q])
        s = s - more
        right = (e + q < len(w)) & (w[np.minimum(e, len(w) - 1)] == w[np.minimum(e + q, len(w) - 1)])
        e = e + right
        if not more.any() and not right.any():
            return s, e


def find(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period.

    ``h``: hashes of the words of all texts; ``first``: where each text starts, and the end."""
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n + 1)  # every text is closed by a mark found nowhere else
    base = first[:-1] + np.arange(len(n))
    w = np.empty(len(doc), np.uint64)
    mark = base + n
    plain = np.ones(len(w), bool)
    plain[mark] = False
    w[plain] = h
    w[mark] = mix(np.arange(len(n), dtype=np.uint64) + _B)
    at = np.arange(len(w))
    found = []
    g, scale = w, 1
    while len(w) and 4 * scale <= n.max(initial=0):
        double = _joined(g, g, scale)
        if scale == 1:
            k, grams = 5, _joined(_joined(double, double, 2), g, 4)
        else:
            k, grams = 3 * scale, _joined(double, g, 2 * scale)
        order = np.argsort(grams, kind="stable")
        sorted_ = grams[order]
        a, b = order[:-1], order[1:]
        same = (sorted_[1:] == sorted_[:-1]) & (doc[a] == doc[b])
        a, lag = a[same], (b - a)[same]
        if not len(a):
            break
        seeds = (lag >= scale) & (lag < 2 * scale)
        if seeds.any():
            s, e, q = _stretches(a[seeds], lag[seeds], k)
            s, e = _extended(w, s, e, q)
            ok = e - s + q >= np.maximum(6, 4 * q)
            if ok.any():
                d = doc[s[ok]]
                found.append(np.stack([d, at[s[ok]] - base[d], (e - s + q)[ok], q[ok]], 1))
        # only texts with a repeated gram, and long enough for the next scale, go on
        on = np.zeros(len(n), bool)
        on[doc[a]] = True
        on &= n >= 8 * scale
        n = np.where(on, n, 0)
        stay = on[doc]
        w, g, doc, at = w[stay], double[stay], doc[stay], at[stay]
        scale *= 2
    if not found:
        return np.zeros((0, 4), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 1] + runs[:, 3], 1)
    np.add.at(edge, runs[:, 1] + runs[:, 2], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns, ``runs`` (by start, then period) and the ``collapsed`` text."""
    plain = docs.drop("runs", "collapsed")
    names, at = plain.columns, plain.columns.index(text)
    schema = T.StructType(list(plain.schema.fields)).add("runs", RUN).add("collapsed", T.StringType())
    item = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def run(batches):
        for b in slices(batches):
            texts = [t.encode() if t is not None else b"" for t in b.column(at).to_pylist()]
            got = find(*word_hashes(texts, lower=False))
            bound = np.searchsorted(got[:, 0], np.arange(len(texts) + 1))
            kept = [_collapsed(t.split(), got[bound[i]:bound[i + 1]]).decode() for i, t in enumerate(texts)]
            runs = pa.ListArray.from_arrays(
                pa.array(bound, pa.int32()),
                pa.StructArray.from_arrays([pa.array(got[:, c]) for c in (1, 2, 3)], fields=list(item)))
            yield pa.RecordBatch.from_arrays([*b.columns, runs, pa.array(kept, pa.string())], [*names, "runs", "collapsed"])

    return plain.mapInArrow(run, schema)
