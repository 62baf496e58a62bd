"""Hard-negative mining (operator 13).

For each anchor the first ``n_positives`` rows of its label are its positives,
and for each of these the first ``n_negatives`` rows of another label whose
score lies between 50 and 95 percent of the positive's.  Scores are integer
inner products of the components floor(256 x); higher first, ties by smaller id.

Rotated one-bit codes with stored alignment:

* ``index`` turns each vector y = R v / |v| by a seeded rotation R and stores
  the signs of y as the code c (c / sqrt(D) has length one), the alignment
  a = <c, y> / sqrt(D), and |v|.
* A turned anchor u is rounded to ``QUERY_BITS`` bits a component, so that
  <u', c> is a sum of popcounts of the code with the anchor's bit planes, one
  machine word at a time.  With t = <u', c> / sqrt(D), the part of y outside the
  code's direction has length sqrt(1 - a^2) and that of u' sqrt(|u'|^2 - t^2):
  by Cauchy-Schwarz the score lies within |v| (a t +- (sqrt(|u'|^2 - t^2)
  sqrt(1 - a^2) + |u - u'|)).  Nothing here is a probability; the interval holds
  always, and is widened by the floating-point error.
* Rows whose interval cannot reach the ``n_positives``-th best lower bound, or
  the band of scores that the positives ask for, are dropped; the others are
  scored with integers, and only those scores decide.

Rows and anchors are dealt by hash into blocks of even size; each pair of
blocks is one bounded task, whatever the labels, and what it returns is a few
rows for an anchor, merged by a rank.  Anchors are a stated query set.

Defined results: rows with a null id, label or vector, or with a null, NaN or
infinite component take no part.  Of rows with equal ids the smallest (label,
vector) counts.  Shorter vectors are filled with zeros.  Integer components are
held within +-2^26, so that scores of up to 1,024 components fit a long.
Without anchors or partners there are no rows.  Other columns are not read.
"""
from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import stage

ROW_BLOCK = 4_096
ANCHOR_BLOCK = 8_192
QUERY_BITS = 6
LARGEST = 1 << 26
_SUB = 64  # anchors compared at a time within a block


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation of ``dim`` dimensions."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(dim)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _matrix(v: pa.Array, dim: int) -> np.ndarray:
    """Integer vectors as rows of ``dim`` components, filled with zeros."""
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    n = np.diff(v.offsets.to_numpy())
    out = np.zeros((len(v), dim), np.int64)
    out[np.arange(dim) < n[:, None]] = v.flatten().to_numpy()
    return out


def codes(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, align, norm) of integer vectors whose dimension is a multiple of 64."""
    dim = v.shape[1]
    norm = np.sqrt((v.astype(float) ** 2).sum(1))
    y = v @ rotation(dim).T / np.maximum(norm, 1.0)[:, None]
    code = np.packbits(y >= 0, axis=1, bitorder="little").view(np.uint64)
    return code, np.abs(y).sum(1) / np.sqrt(dim), norm


class Query:
    """An anchor block, turned and rounded: bit planes, steps and what rounding cost."""

    def __init__(self, v: np.ndarray):
        dim = v.shape[1]
        u = v @ rotation(dim).T
        self.low = u.min(1, initial=0.0)
        self.step = np.maximum((u.max(1, initial=0.0) - self.low) / ((1 << QUERY_BITS) - 1), 1e-12)
        level = np.rint((u - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        rounded = self.low[:, None] + level * self.step[:, None]
        self.planes = [np.packbits(level >> b & 1, axis=1, bitorder="little").view(np.uint64) for b in range(QUERY_BITS)]
        self.total = rounded.sum(1)
        self.square = (rounded ** 2).sum(1)
        self.lost = np.sqrt(((u - rounded) ** 2).sum(1))
        self.norm = np.sqrt((v.astype(float) ** 2).sum(1))

    def intervals(self, at: np.ndarray, code: np.ndarray, align: np.ndarray, norm: np.ndarray):
        """Bounds of the scores of all rows (down) with the anchors ``at`` (across)."""
        dim = code.shape[1] * 64
        ones = np.bitwise_count(code).sum(1, dtype=np.int64)
        dot = np.zeros((len(code), len(at)))
        for b, plane in enumerate(self.planes):
            for w in range(code.shape[1]):
                dot += np.bitwise_count(code[:, w, None] & plane[at, w][None]) * float(1 << b)
        # <u', signs> = 2 <u', ones> - sum u'
        dot = 2 * (self.step[at] * dot + self.low[at] * ones[:, None]) - self.total[at]
        t = dot / np.sqrt(dim)
        off = np.sqrt(np.maximum(self.square[at] - t * t, 0.0)) * np.sqrt(np.maximum(1 - align ** 2, 0.0))[:, None]
        half = norm[:, None] * (off + self.lost[at] + 1e-9 * self.norm[at]) + 1e-6
        mid = (norm * align)[:, None] * t
        return mid - half, mid + half


def index(rows: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """(id, label, v, code, align, norm, z): integer vectors with their codes; z deals them to blocks."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))  # NaN is the largest
    whole = F.transform(vector, lambda x: F.least(F.greatest(
        F.floor(256 * x.cast("double")), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int"))
    d = (rows.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()).where(fine)
         .select(F.col(key).alias("id"), F.struct(F.col(label).cast("long").alias("label"), whole.alias("v")).alias("x"))
         .groupBy("id").agg(F.min("x").alias("x")).select("id", "x.label", "x.v"))
    d = stage(d.withColumn("z", F.xxhash64(F.monotonically_increasing_id())), "negatives-vectors")
    dim = -(-max(d.agg(F.max(F.size("v"))).first()[0] or 1, 1) // 64) * 64

    def run(batches):
        for b in batches:
            code, align, norm = codes(_matrix(b.column("v"), dim))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(align), pa.array(norm)],
                [*b.schema.names, "code", "align", "norm"])

    schema = T.StructType(list(d.schema.fields)).add("code", "binary").add("align", "double").add("norm", "double")
    return stage(d.mapInArrow(run, schema), "negatives-codes")


def _block(t: pa.Table) -> tuple:
    """(id, label, code, align, norm, integer vectors), in order of label."""
    t = t.sort_by([("label", "ascending"), ("id", "ascending")])
    code = np.array([np.frombuffer(c, np.uint64) for c in t.column("code").to_pylist()])
    return (t.column("id").to_numpy(), t.column("label").to_numpy(), code, t.column("align").to_numpy(),
            t.column("norm").to_numpy(), _matrix(t.column("v"), code.shape[1] * 64))


def _pieces(n: int):
    return (np.arange(i, min(i + _SUB, n)) for i in range(0, n, _SUB))


def _best(i: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    return i[np.lexsort((ids[i], -score[i]))[:k]]


def _positives(n_positives: int):
    """Of a row block, the best rows of each anchor's label."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = {"anchor": [], "other": [], "score": []}
        if rows.num_rows and anchors.num_rows:
            ids, label, code, align, norm, v = _block(rows)
            a_id, a_label, _, _, _, a_v = _block(anchors)
            for own in np.unique(a_label):
                s, e = np.searchsorted(label, [own, own + 1])
                mine = np.flatnonzero(a_label == own)
                query = Query(a_v[mine])
                for at in _pieces(len(mine) if e > s else 0):
                    low, high = query.intervals(at, code[s:e], align[s:e], norm[s:e])
                    for c, a in enumerate(mine[at]):
                        lows = low[ids[s:e] != a_id[a], c]
                        least = np.partition(lows, -n_positives)[-n_positives] if len(lows) > n_positives else -np.inf
                        i = s + np.flatnonzero((high[:, c] >= least) & (ids[s:e] != a_id[a]))
                        score = v[i] @ a_v[a]
                        o = _best(np.arange(len(i)), ids[i], score, n_positives)
                        out["anchor"] += [a_id[a]] * len(o)
                        out["other"] += ids[i[o]].tolist()
                        out["score"] += score[o].tolist()
        return pa.table({k: pa.array(x, pa.int64()) for k, x in out.items()})
    return run


def _negatives(n_negatives: int):
    """Of a row block, the best rows of other labels within each positive's band."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = {"anchor": [], "positive": [], "positive_score": [], "other": [], "score": []}
        if rows.num_rows and anchors.num_rows:
            ids, label, code, align, norm, v = _block(rows)
            # positives come in the block's order of anchors
            anchors = anchors.sort_by([("label", "ascending"), ("id", "ascending")])
            partners = anchors.column("partners").to_pylist()
            a_id, a_label, _, _, _, a_v = _block(anchors)
            query = Query(a_v)
            for at in _pieces(len(a_id)):
                low, high = query.intervals(at, code, align, norm)
                for c, a in enumerate(at):
                    # 50 p <= 100 x <= 95 p; an empty band has least > most
                    bands = [(p["other"], p["score"], -(-50 * p["score"] // 100), 95 * p["score"] // 100) for p in partners[a]]
                    bands = [b for b in bands if b[2] <= b[3]]
                    if not bands:
                        continue
                    least, most = min(b[2] for b in bands), max(b[3] for b in bands)
                    i = np.flatnonzero((high[:, c] >= least) & (low[:, c] <= most) & (label != a_label[a]))
                    score = v[i] @ a_v[a]
                    for other, p, lo, hi in bands:
                        o = _best(np.flatnonzero((score >= lo) & (score <= hi)), ids[i], score, n_negatives)
                        out["anchor"] += [a_id[a]] * len(o)
                        out["positive"] += [other] * len(o)
                        out["positive_score"] += [p] * len(o)
                        out["other"] += ids[i[o]].tolist()
                        out["score"] += score[o].tolist()
        return pa.table({k: pa.array(x, pa.int64()) for k, x in out.items()})
    return run


def _pairs(rows: DataFrame, anchors: DataFrame, blocks: tuple[int, int], fn, schema: str) -> DataFrame:
    """``fn(row block, anchor block)`` for every pair of blocks."""
    n_rows, n_anchors = blocks
    r = (rows.withColumn("rb", F.pmod("z", F.lit(n_rows)).cast("int"))
         .withColumn("ab", F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1)))).drop("z"))
    a = (anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # columns of its own beside the rows'
         .withColumn("ab", F.pmod("z", F.lit(n_anchors)).cast("int"))
         .withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)))).drop("z"))
    return r.groupBy("rb", "ab").cogroup(a.groupBy("rb", "ab")).applyInArrow(fn, schema)


def _first(d: DataFrame, by: list[str], n: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("other"))
    return d.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def mine(rows: DataFrame, anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
         n_positives: int = 5, n_negatives: int = 3, row_block: int = ROW_BLOCK,
         anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor``: condition on the column ``id``, which holds the ids."""
    table = index(rows, key, label, vector)
    queries = table.where(anchor)
    n, m = table.count(), queries.count()
    blocks = (max(-(-n // row_block), 1), max(-(-m // anchor_block), 1))
    found = _pairs(table, queries, blocks, _positives(n_positives), "anchor long, other long, score long")
    positives = _first(found, ["anchor"], n_positives).groupBy("anchor").agg(
        F.collect_list(F.struct("other", "score")).alias("partners"))  # n_positives at most
    positives = stage(positives, "negatives-positives")
    queries = queries.join(positives, F.col("id") == F.col("anchor")).drop("anchor")
    found = _pairs(table, queries, blocks, _negatives(n_negatives),
                   "anchor long, positive long, positive_score long, other long, score long")
    return _first(found, ["anchor", "positive"], n_negatives).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
