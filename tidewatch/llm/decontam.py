"""Benchmark decontamination (operator 8).

Rare n-gram seeds join texts to test items, and a Smith-Waterman alignment over
words scores each pair, so edited and paraphrased copies count as well.

1. Seeds are rare words and word pairs of the items.  An alignment of
   ``min_score`` s with an item of m words has M matched words in r runs, and at
   least r - 1 errors between them, so 2 M - (r - 1) >= 2 s m.  It matches M
   words and M - r neighbouring pairs: together at least 2 s m - 1 of the item's
   2 m - 1 words and pairs.  The item may therefore leave out all but one of that
   many: those that the texts hold most often, counted over all texts.  One of
   the others must be in every text that reaches s: no copy is lost, and what a
   text matches does not depend on the other texts.
2. Where a text holds a seed, the words around it are compared with the item:
   as many on either side as an alignment of ``min_score`` through the seed can
   reach.  Two upper bounds of the score leave out what cannot reach
   ``min_score``: the best run of the text's words, or of the item's, when every
   word that the other side has anywhere counts as a match.
3. What is left is aligned.  The score is the alignment's score over the item's
   own, 1 for a whole copy; pairs of ``min_score`` or more are reported with the
   aligned words' place.

Items go out to the tasks in blocks of ``block_items``, so what is broadcast is
bounded whatever the benchmark's size; texts are read twice a block (counts,
then seeds) and never shuffled.

Words are ``[^\\x20\\x09-\\x0D]+`` in lower case (A-Z) with ASCII punctuation read
as blanks; places count such words.  Defined results: null and empty texts
and items match nothing; items with equal texts are all reported; repeated rows
are reported alike; extra columns are not read.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import gram_hashes, mix, stage, text_chunks, word_hashes

MATCH, MISMATCH, GAP = 2, -1, -1
#: lengths of the grams: the bound on seeds rests on words and pairs
SIZES = (1, 2)
#: seeds or words handled at once by the vectorised steps (one long text may exceed it)
SLICE = 1 << 18
_SPAN = np.uint64(0x9E3779B97F4A7C15)
_PUNCTUATION = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def plain(text: bytes) -> bytes:
    """Text with ASCII punctuation as blanks: an edit of a comma is no edit."""
    return text.translate(_PUNCTUATION)


def smith_waterman(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(best local score of a against b, start and end of the aligned part of b).

    Row by row; within a row, gaps run on by a running maximum.
    """
    m = len(b)
    best, end = 0, 0
    row = np.zeros(m + 1, np.int64)
    start = np.arange(m + 1)  # where the alignment that ends here began
    slope = -GAP * np.arange(m + 1)
    at = (0, 0, 0)
    for x in a:
        diag = row[:-1] + np.where(b == x, MATCH, MISMATCH)
        up = row[1:] + GAP
        cur = np.zeros(m + 1, np.int64)
        own = np.maximum(np.maximum(diag, up), 0)
        cur[1:] = own
        frm = np.arange(m + 1)
        frm[1:] = np.where(own == 0, np.arange(1, m + 1), np.where(diag >= up, start[:-1], start[1:]))
        lifted = cur + slope  # a gap in a: cur[j] = max over i <= j of cur[i] + GAP (j - i)
        run = np.maximum.accumulate(lifted)
        src = np.maximum.accumulate(np.where(lifted == run, np.arange(m + 1), 0))
        row, start = run - slope, frm[src]
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
            at = (best, int(start[k]), end)
    return at


class Items:
    """Words and seeds of a block of test items; seed k stands at the places first[k] to first[k + 1] - 1 of
    ``item`` and ``place``."""

    def __init__(self, ids: list, texts: list[str | None], min_score: float):
        self.ids, self.min_score = ids, min_score
        self.words, self.word = word_hashes([plain((t or "").encode()) for t in texts])
        self.size = np.diff(self.word)
        units = [np.concatenate([gram_hashes(w, n) for n in SIZES]) for w in map(self.of, range(len(ids)))]
        g = np.concatenate([*units, np.zeros(0, np.uint64)])
        order = np.argsort(g, kind="stable")
        self.item = np.repeat(np.arange(len(ids)), [len(x) for x in units])[order]
        places = [np.arange(len(self.of(i)) - n + 1) for i in range(len(ids)) for n in SIZES]
        self.place = np.concatenate([*places, np.zeros(0, int)])[order]
        self._index(g[order])
        # every word put in costs a point, and this many points are between a whole copy and min_score
        self.pad = np.maximum(self.size // 2 + 4, np.floor(MATCH * self.size * (1 - min_score) + 1e-6).astype(int))

    def _index(self, g: np.ndarray) -> None:
        self.grams, first = np.unique(g, return_index=True)
        self.first = np.append(first, len(g))

    def keep_rare(self, count: dict[int, int]) -> None:
        """Leave out each item's most frequent words and pairs, as many as no copy needs (``count``: in all texts)."""
        n = np.diff(self.first)
        often = np.repeat([count.get(int(g), 0) for g in self.grams], n)
        gram = np.repeat(np.arange(len(n)), n)
        total = np.bincount(self.item, minlength=len(self.ids))
        need = np.maximum(np.ceil(MATCH * self.min_score * self.size - 1e-9).astype(int) - 1, 1)
        order = np.lexsort((gram, often, self.item))  # rarest first within an item
        nth = np.arange(len(order)) - np.repeat(np.cumsum(total) - total, total)
        seed = np.zeros(len(order), bool)
        seed[order] = nth <= (total - need)[self.item[order]]
        g = np.repeat(self.grams, n)[seed]
        self.item, self.place = self.item[seed], self.place[seed]
        self._index(g)

    def of(self, item: int) -> np.ndarray:
        return self.words[self.word[item]:self.word[item + 1]]


def _hits(texts: list[bytes], wanted: np.ndarray, filt: np.ndarray):
    """(words, first word of each text, places and hashes of the words and pairs found)."""
    h, first = word_hashes([plain(t) for t in texts])
    found = []
    for n in SIZES:
        g = gram_hashes(h, n)
        at = np.flatnonzero(filt[(g >> np.uint64(40)).astype(np.int64)])
        if len(at):
            at = at[np.isin(g[at], wanted)]
            text = np.searchsorted(first, at, "right") - 1
            at = at[at + n <= first[text + 1]]  # no gram runs over a text's end
            found.append((at, g[at]))
    at = np.concatenate([x[0] for x in found]) if found else np.zeros(0, int)
    g = np.concatenate([x[1] for x in found]) if found else np.zeros(0, np.uint64)
    order = np.argsort(at, kind="stable")
    return h, first, at[order], g[order]


def _filter(wanted: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << 24, bool)
    out[(wanted >> np.uint64(40)).astype(np.int64)] = True
    return out


def _ragged(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """start[i] to start[i] + size[i] - 1 for every i, and the i of each."""
    of = np.repeat(np.arange(len(start)), size)
    return np.arange(len(of)) - (np.cumsum(size) - size - start)[of], of


def _cuts(total: np.ndarray, group: np.ndarray | None = None, limit: int = SLICE):
    """Slices of at most about ``limit``, given running totals; a slice ends where a group does unless that alone is more."""
    i = 0
    while i < len(total):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + limit, "right")))
        if group is not None and j < len(total) and group[j - 1] == group[j]:
            begin = int(np.searchsorted(group, group[j]))
            j = begin if begin > i else j
        yield slice(i, j)
        i = j


def _spans(items: Items, first: np.ndarray, text: np.ndarray, at: np.ndarray, k: np.ndarray):
    """(text, item, start, end) of the words to compare for grams ``k`` found at ``at``; what meets is one."""
    idx, of = _ragged(items.first[k], items.first[k + 1] - items.first[k])
    item, d, p = items.item[idx], text[of], at[of]
    lo = p - items.place[idx] - items.pad[item]
    hi = np.minimum(first[d + 1], lo + items.size[item] + 2 * items.pad[item])
    lo = np.maximum(first[d], lo)
    order = np.lexsort((lo, item, d))
    d, item, lo, hi = d[order], item[order], lo[order], hi[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (item[1:] != item[:-1])
    lift = np.cumsum(new) * (int(first[-1]) + 1)  # the running maximum starts anew with every pair
    new[1:] |= lo[1:] > (np.maximum.accumulate(hi + lift) - lift)[:-1]
    begin = np.flatnonzero(new)
    return d[begin], item[begin], lo[begin], np.maximum.reduceat(hi, begin)


def _best_runs(held: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Best score of a run of words in each group (``of`` counts them) if held words match and others cost a point."""
    gain = np.where(held, MATCH, max(MISMATCH, GAP))
    after = np.cumsum(gain)
    lift = of * (MATCH + 1) * (len(of) + 1)  # the running minimum starts anew with every group
    low = np.minimum.accumulate(after - gain - lift) + lift
    return np.maximum.reduceat(after - low, np.flatnonzero(np.diff(of, prepend=-1)))


def _may_reach(items: Items, h: np.ndarray, item: np.ndarray, lo: np.ndarray, hi: np.ndarray, min_score: float):
    """Whether text words lo to hi and the item may align to min_score: false only if they cannot."""
    a, of_a = _ragged(items.word[item], items.size[item])
    b, of_b = _ragged(lo, hi - lo)
    # equal words of one span have equal keys; a clash only lets a span through
    a = mix(items.words[a] + of_a.astype(np.uint64) * _SPAN)
    b = mix(h[b] + of_b.astype(np.uint64) * _SPAN)
    most = np.minimum(_best_runs(np.isin(a, b), of_a), _best_runs(np.isin(b, a), of_b))
    return most / (MATCH * items.size[item]) >= min_score


def _counts(docs, grams: np.ndarray, key, text) -> dict[int, int]:
    """How often the texts hold each of a block's words and pairs; those that none holds are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(grams)

    def run(batches):
        wanted = shared.value
        filt, n = _filter(wanted), np.zeros(len(wanted), np.int64)
        for _, texts in text_chunks(batches, key, text):
            n += np.bincount(np.searchsorted(wanted, _hits(texts, wanted, filt)[3]), minlength=len(wanted))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[at].view(np.int64)), pa.array(n[at])], ["g", "n"])

    got = docs.select(key, text).mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).collect()
    return {int(np.int64(r.g).view(np.uint64)): r.n for r in got}


def _block(docs, ids, texts, key, text, min_score, item_type):
    items = Items(ids, texts, min_score)
    items.keep_rare(_counts(docs, items.grams, key, text))
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        items = shared.value
        filt = _filter(items.grams)
        for keys, texts in text_chunks(batches, key, text):
            h, first, at, g = _hits(texts, items.grams, filt)
            k = np.searchsorted(items.grams, g)
            doc = np.searchsorted(first, at, "right") - 1
            best: dict[tuple[int, int], tuple] = {}
            for c in _cuts(np.cumsum(items.first[k + 1] - items.first[k]), doc):
                d, item, lo, hi = _spans(items, first, doc[c], at[c], k[c])
                for e in _cuts(np.cumsum(hi - lo + items.size[item])):
                    for x in np.flatnonzero(_may_reach(items, h, item[e], lo[e], hi[e], min_score)) + e.start:
                        x_lo, x_hi, of = int(lo[x]), int(hi[x]), (int(d[x]), int(item[x]))
                        score, s, t = smith_waterman(items.of(of[1]), h[x_lo:x_hi])
                        best[of] = max(best.get(of, (0,)), (score, x_lo, x_hi, x_lo + s, x_lo + t))
            rows = []
            for (d, item), (score, _, _, s, e) in best.items():
                score /= MATCH * int(items.size[item])
                if score >= min_score:
                    rows.append((keys[d], items.ids[item], score, s - int(first[d]), e - int(first[d])))
            if rows:
                c = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[0], kind), pa.array(c[1], kind2), pa.array(c[2], pa.float64()),
                     pa.array(c[3], pa.int64()), pa.array(c[4], pa.int64())],
                    [key, "item_id", "score", "first_word", "end_word"])

    kind, kind2 = (pa.int64() if t == "bigint" else pa.int32() if t == "int" else pa.string()
                   for t in (docs.schema[key].dataType.simpleString(), item_type))
    return docs.select(key, text).mapInArrow(
        run, f"{key} {docs.schema[key].dataType.simpleString()}, item_id {item_type}, score double, "
             "first_word long, end_word long")


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text", min_score: float = 0.5,
                 block_items: int = 20_000) -> DataFrame:
    """(key, item_id, score, first_word, end_word) of every text and item that align well enough."""
    item_type = benchmark.schema[item_key].dataType.simpleString()
    listed = stage(benchmark.select(F.col(item_key).alias("i"), F.col(item_text).alias("t"))
                   .where(F.trim("t") != ""), "bench-items")
    total = listed.agg(F.count(F.lit(1)).alias("c"), F.sum(F.octet_length("t")).alias("b")).first()
    # a block holds at most block_items items and about 64 MB of their texts
    blocks = max(1, -(-total.c // block_items), -(-(total.b or 0) // (64 << 20)))
    out = None
    for b in range(blocks):
        part = listed.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).orderBy("i", "t").collect()
        got = _block(docs, [r.i for r in part], [r.t for r in part], key, text, min_score, item_type)
        out = got if out is None else out.unionAll(got)
    return out
