"""N-gram Jaccard join by set-relation skipping (operator 3).

A text's set is its distinct 5-word shingles; texts with equal sets form one
class and are handled once.  Two classes link when 100 * intersection >= 75 *
union.  The join is exact and yields links enough to connect whatever links
connect; pairs already connected are skipped.

1. Shingles are ordered rare first, by the corpus frequency of their rarest
   word (hashed, a table of fixed size), then by hash.  Linked sets share one
   of the first n - ceil(0.75 n) + 1 shingles of each (prefix).
2. Index lists: classes by prefix shingle, with size and position.  In each
   list the class that shares most of its prefix with others is the hub.
   Size and position bounds skip entries that cannot link to the hub.
3. Hub pairs are verified: a parity bitmap of each set bounds the symmetric
   difference from below; what passes is intersected.
4. Answers of other members are derived from the hub's: members linked to the
   hub are connected.  Any two classes of a list meet in its hub's group, so
   only members of different components of a group are left; the hub's own
   pairs are all decided.  They are compared in blocks of one size class: blocks
   out of a member's size range or of its component alone are never visited,
   pairs are decided by their overlaps with the hub where these bound the pair's
   overlap, then by bitmaps, and the rest is intersected.  A member takes its
   closest few of a block first; those with more are compared again, without a
   limit, once the components of the first round are known.

Bitmaps are made as the sets are named and join a member when its block is
known; of the texts, only those whose sets are to be intersected are shuffled,
told apart by a table of marks of fixed size.

Shingles and sets are known by 64-bit hashes.  A shingle's index list is put
together by one task (16 bytes for a distinct set); the groups, of any size, are
compared in blocks, which bounds a task's memory, not the sum of comparisons
within a group whose members stay apart.

Defined results: null, empty and blank texts have n_shingles 0 and are a
component of their own, as are texts without a link.  Null keys are rows like
others and are never a component's smallest key unless no other is there.
Repeated rows have equal sets.  Extra columns are not read.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import components, gram_hashes, mix, slices, stage, text_chunks, word_hashes

N = 5
_U = np.uint64
_BUCKETS = 1 << 18
_SLICES = 64
_HASH_BITS = _U((1 << 58) - 1)
#: prefix shingles that a task holds before it deals them out
PIECE = 500_000
BLOCK = 512
#: words of 64 bits in the table of marks that tells which texts may be wanted
MARKS = 1 << 18


def need(a, b):
    """Smallest intersection of linked sets of sizes a and b: ceil(3 (a + b) / 7)."""
    return -(-3 * (a + b) // 7)


def row_hash(key, text_hash):
    """Name of a row by its key and its text's xxhash64."""
    return F.xxhash64(key, text_hash)


# --- rarity of words -----------------------------------------------------------------
def _word_levels(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """(level by word bucket, number of words): level is the logarithm of the bucket's count."""
    def count(batches):
        c = np.zeros(_BUCKETS, np.int64)
        for _, texts in text_chunks(batches, text, text):
            h, _ = word_hashes(texts)
            c += np.bincount((h >> _U(46)).astype(np.int64), minlength=_BUCKETS)
        yield from out(enumerate(c.reshape(_SLICES, -1)))

    def add(batches):
        got: dict[int, np.ndarray] = {}
        for b in batches:
            for s, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(x, np.int64)
                got[s] = got[s] + x if s in got else x
        yield from out(got.items())

    def out(parts):
        for s, x in parts:
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["s", "x"])

    one = docs.select(text).mapInArrow(count, "s int, x binary")
    rows = one.repartition(_SLICES, "s").mapInArrow(add, "s int, x binary").collect()  # fixed size
    total = np.zeros(_BUCKETS, np.int64)
    for r in rows:
        x = np.frombuffer(r.x, np.int64)
        total[r.s * len(x):(r.s + 1) * len(x)] += x
    return np.floor(np.log2(total + 1.0)).astype(np.uint8), int(total.sum())


# --- sets ----------------------------------------------------------------------------
def shingle_sets(texts: list[bytes], levels: np.ndarray | None = None):
    """For each text its distinct shingles as sorted 64-bit codes.

    With ``levels`` the code starts with the level of the shingle's rarest word,
    so codes sort rare first; without, it is the hash alone.
    """
    h, first = word_hashes(texts)
    g = gram_hashes(h, N) & _HASH_BITS
    if levels is not None:
        lv = levels[(h >> _U(46)).astype(np.int64)]
        low = lv[:len(g)].copy()
        for j in range(1, N):
            np.minimum(low, lv[j:j + len(g)], out=low)
        g |= low.astype(np.uint64) << _U(58)
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if b - a >= N:
            s = np.sort(g[a:b - N + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif b > a:
            x = gram_hashes(h[a:b], b - a) & _HASH_BITS
            yield x | (lv[a:b].min().astype(np.uint64) << _U(58)) if levels is not None else x
        else:
            yield np.zeros(0, np.uint64)


def set_id(s: np.ndarray) -> int:
    """Name of a set, from its hashes in hash order."""
    return int(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)) if len(s) else 0


def bitmap(s: np.ndarray) -> bytes:
    """Parity bitmap: bit j tells whether an odd number of members fall on it."""
    size = 256
    while size < 4 * len(s):
        size *= 2
    return np.packbits(np.bincount((mix(s) & _U(size - 1)).astype(np.int64), minlength=size) & 1).tobytes()


def _fold(x: np.ndarray, size: int) -> np.ndarray:
    """Bitmap of ``size`` bytes from a larger one; bit numbers are taken modulo its length."""
    while len(x) > size:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def apart(a: bytes, b: bytes) -> int:
    """Lower bound of the symmetric difference's size."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    n = min(len(x), len(y))
    return int(_ONES[_fold(x, n) ^ _fold(y, n)].sum())


def _strip(codes: np.ndarray) -> np.ndarray:
    return np.sort(codes & _HASH_BITS)


# --- index lists ---------------------------------------------------------------------
def _planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side: the high, mostly zero ones shrink in the shuffle."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unplanes(x: bytes, kind) -> np.ndarray:
    w = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(w, -1).T).reshape(-1).view(kind)


def _lists(docs: DataFrame, key: str, text: str, levels, n_buckets: int) -> DataFrame:
    """(t, s, n, p): prefix shingle, set, size, position, of shingles that several sets have in their prefix."""
    def emit(batches):
        seen, parts, size = set(), [], 0
        for _, texts in text_chunks(batches, text, text):
            for codes in shingle_sets(texts, levels.value):
                n = len(codes)
                if not n:
                    continue
                s = set_id(_strip(codes))
                if s in seen:  # copies near each other are sent once
                    continue
                seen.add(s)
                m = n - -(-3 * n // 4) + 1
                parts.append((codes[:m].copy(), np.full(m, s, np.int64), np.full(m, n, np.uint32),
                              np.arange(m, dtype=np.uint32)))
                size += m
            if size >= PIECE:
                yield from deal(parts)
                parts, size = [], 0
            if len(seen) > 200_000:
                seen.clear()
        if parts:
            yield from deal(parts)

    def deal(parts):
        t, s, n, p = (np.concatenate(x) for x in zip(*parts))
        b = (mix(t) % _U(n_buckets)).astype(np.int64)
        order = np.argsort(b, kind="stable")
        t, s, n, p, b = t[order], s[order], n[order], p[order], b[order]
        cut = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]]))
        for lo, hi in zip(cut[:-1], cut[1:]):
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(b[lo])], pa.int32()),
                 pa.array([_planes(t[lo:hi])], pa.binary()), pa.array([_planes(s[lo:hi])], pa.binary()),
                 pa.array([_planes(n[lo:hi])], pa.binary()), pa.array([_planes(p[lo:hi])], pa.binary())],
                ["b", "t", "s", "n", "p"])

    def gather(batches):
        held, at = [], None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if row[0] != at and held:
                    yield from several(held)
                    held = []
                at = row[0]
                held.append([_unplanes(row[1], np.uint64), _unplanes(row[2], np.int64),
                             _unplanes(row[3], np.uint32), _unplanes(row[4], np.uint32)])
        if held:
            yield from several(held)

    def several(held):
        t, s, n, p = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((s, t))
        t, s, n, p = t[order], s[order], n[order], p[order]
        new = np.concatenate([[True], (t[1:] != t[:-1]) | (s[1:] != s[:-1])])  # copies from several tasks
        t, s, n, p = t[new], s[new], n[new], p[new]
        start = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        size = np.diff(np.concatenate([start, [len(t)]]))
        size = np.repeat(size, size)
        keep = size > 1
        if keep.any():
            for i in range(0, int(keep.sum()), 50_000):
                part = slice(i, i + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t[keep][part].view(np.int64)), pa.array(s[keep][part]),
                     pa.array(n[keep][part].astype(np.int32)), pa.array(p[keep][part].astype(np.int32)),
                     pa.array(size[keep][part])], ["t", "s", "n", "p", "c"])

    blobs = docs.select(text).mapInArrow(emit, "b int, t binary, s binary, n binary, p binary")
    return (blobs.repartition(n_buckets, "b").sortWithinPartitions("b")
            .mapInArrow(gather, "t long, s long, n int, p int, c long"))


def _hub_groups(lists: DataFrame) -> DataFrame:
    """(h, hn, s, n, ok): members of each hub's group; ok: size and position allow a link to the hub."""
    support = lists.groupBy("s").agg((F.sum("c") / F.first("n")).alias("w"))
    l = lists.join(support, "s")
    best = l.groupBy("t").agg(F.max(F.struct("w", "s", "n", "p")).alias("m"))
    l = l.select("t", "s", "n", "p").join(best.select("t", F.col("m.s").alias("h"), F.col("m.n").alias("hn"),
                                                      F.col("m.p").alias("hp")), "t").where("s <> h")
    most = (F.least("p", "hp") + 1 + F.least(F.col("n") - F.col("p"), F.col("hn") - F.col("hp")) - 1)
    ok = (4 * F.least("n", "hn") >= 3 * F.greatest("n", "hn")) & (7 * most >= 3 * (F.col("n") + F.col("hn")))
    return l.groupBy("h", "s").agg(F.first("hn").alias("hn"), F.first("n").alias("n"), F.max(ok).alias("ok"))


# --- verification --------------------------------------------------------------------
def _close(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose bitmaps allow a link."""
    p = (pairs.join(sets.select(F.col("s").alias("a"), F.col("n").alias("an"), F.col("bits").alias("ab")), "a")
         .join(sets.select(F.col("s").alias("b"), F.col("n").alias("bn"), F.col("bits").alias("bb")), "b"))

    def run(batches):
        for batch in batches:
            a, b, an, bn, x, y = (batch.column(c) for c in ("a", "b", "an", "bn", "ab", "bb"))
            keep = [m + n - 2 * need(m, n) >= apart(u, v) for m, n, u, v in
                    zip(an.to_pylist(), bn.to_pylist(), x.to_pylist(), y.to_pylist())]
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])

    return p.mapInArrow(run, "a long, b long")


def _verify(pairs: DataFrame, codes: DataFrame) -> DataFrame:
    """(a, b, an, bn, o): intersection sizes.  Sets b are brought to a; a goes to each of its portions."""
    sized = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("c")).withColumn("k", F.ceil(F.col("c") / BLOCK).cast("int"))
    members = pairs.join(sized, "a").select(
        F.col("b").alias("s"), "a", F.pmod(F.xxhash64("b"), F.col("k")).cast("int").alias("z"), F.lit(1).alias("r"))
    hubs = sized.select(F.col("a").alias("s"), "a", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("z"),
                        F.lit(0).alias("r"))
    rows = codes.select("s", "codes").join(members.unionAll(hubs), "s").select("a", "z", "r", "s", "codes")
    rows = rows.repartition("a", "z").sortWithinPartitions("a", "z", "r")

    def run(batches):
        hub = hub_id = None
        for batch in slices(batches):
            out = []
            for a, r, s, c in zip(*(batch.column(x).to_pylist() for x in ("a", "r", "s", "codes"))):
                c = np.frombuffer(c, np.uint64)
                if r == 0:
                    hub, hub_id = c, a
                else:
                    assert hub_id == a
                    at = np.searchsorted(hub, c)
                    o = int((hub[np.minimum(at, len(hub) - 1)] == c).sum())
                    out.append((a, s, len(hub), len(c), o))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                    zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))], ["a", "b", "an", "bn", "o"])

    return rows.mapInArrow(run, "a long, b long, an int, bn int, o int")


def _texts(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(_s, t): the text of each wanted set (s, k, r), found by key and text hash; a row listed twice comes twice,
    which does no harm.

    Marks of fixed size, one bit for some of a hash's bits, leave out nearly
    all other texts where they are read; the join is with what is left.
    """
    w = wanted.select(F.col("s").alias("_s"), F.col("k").alias("_k"), F.col("r").alias("_r"))
    word, bit = "(shiftright({0}, 6) & %d)" % (MARKS - 1), "cast({0} & 63 AS int)"
    marks = w.groupBy(F.expr(word.format("_r")).alias("_w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, {bit.format('_r')})")).alias("_m"))
    rows = (docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("r"), F.col(text).alias("t"))
            .join(F.broadcast(marks), F.expr(f"{word.format('r')} = _w"))
            .where(f"(shiftright(_m, {bit.format('r')}) & 1) = 1").select("k", "r", "t"))
    return rows.join(w, F.expr("r = _r AND k <=> _k")).select("_s", "t")


def _linked(checked: DataFrame) -> DataFrame:
    return checked.where(100 * F.col("o") >= 75 * (F.col("an") + F.col("bn") - F.col("o"))).select("a", "b")


# --- what is left in the groups ------------------------------------------------------
def _left(groups: DataFrame, sets: DataFrame, comp: DataFrame, checked: DataFrame, few: int | None = None,
          cut: DataFrame | None = None) -> DataFrame:
    """(a, b, h): pairs of group h and different components that may link.

    ``few``: for each member only its closest ones in a block; a member whose
    list was cut comes once more as (a, null, h).  ``cut``: compare these
    members only, and without a limit; all others have had their whole list.
    """
    g = groups.select("h", "s", "n")  # not the hub itself: its pairs are decided
    if cut is not None:
        cut = cut.select("h", F.col("a").alias("s")).distinct()
        g = g.join(cut.select("h").distinct(), "h", "semi")
    g = (g.join(comp.select(F.col("node").alias("s"), "component"), "s", "left")
         .withColumn("c", F.coalesce("component", "s")).drop("component"))
    main = g.groupBy("h", "c").count()
    # the largest component of a group needs no comparison with itself: all others are compared with every member
    top = (main.groupBy("h").agg(F.max(F.struct("count", "c")).alias("m"), F.count(F.lit(1)).alias("cs")).where("cs > 1")
           .select("h", F.col("m.c").alias("top")))
    # sizes of linked sets are within 3 to 4: neighbouring classes of this scale
    scale = F.floor(F.log("n") / F.lit(float(np.log(4 / 3)))).cast("int")
    g = (g.join(top, "h").withColumn("t", scale)
         .join(checked.select(F.col("a").alias("h"), F.col("b").alias("s"), "o"), ["h", "s"], "left"))
    g = stage(g, "jaccard-members")
    probe = g.where("c <> top") if cut is None else g.join(cut, ["h", "s"], "semi")
    probe = probe.withColumn("t", F.explode(F.array(F.col("t") - 1, F.col("t"), F.col("t") + 1)))

    def portions(rows, count, x):
        return rows.groupBy("h", "t").agg(
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(count), F.min("c").alias(f"{x}_c"), F.max("c").alias(f"{x}_d"),
            F.min("n").alias(f"{x}_low"), F.max("n").alias(f"{x}_high"))

    blocks = (portions(g, "k", "g").join(portions(probe, "m", "q"), ["h", "t"])
              .where("least(g_c, q_c) <> greatest(g_d, q_d)").drop("g_c", "g_d", "q_c", "q_d"))
    blocks = stage(blocks, "jaccard-blocks")
    # a class's members fall into k blocks; a probe meets the blocks of its own and the neighbouring classes only
    cols = ["h", "s", "c", "n", "o", "t"]
    base = g.join(blocks, ["h", "t"]).where("4 * n >= 3 * q_low AND 3 * n <= 4 * q_high").select(
        *cols, F.pmod(F.xxhash64("s"), F.col("k")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("j"), F.lit(False).alias("probe"))
    probe = probe.join(blocks, ["h", "t"]).where("4 * n >= 3 * g_low AND 3 * n <= 4 * g_high").select(
        *cols, F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("i"),
        F.pmod(F.xxhash64(F.lit(3), "s"), F.col("m")).cast("int").alias("j"), F.lit(True).alias("probe"))
    rows = (base.unionAll(probe).join(sets.select("s", "bits"), "s")
            .repartition("h", "t", "i", "j").sortWithinPartitions("h", "t", "i", "j"))

    def run(batches):
        held, at = [], None
        for batch in batches:
            for r in batch.to_pylist():
                k = (r["h"], r["t"], r["i"], r["j"])
                if k != at and held:
                    yield from block(held)
                    held = []
                at = k
                held.append(r)
        if held:
            yield from block(held)

    def block(rows):
        base = sorted((r for r in rows if not r["probe"]), key=lambda r: r["n"])
        n, c, s = (np.array([r[x] for r in base], np.int64) for x in ("n", "c", "s"))
        o = np.array([-1 if r["o"] is None else r["o"] for r in base], np.int64)
        width = np.array([len(r["bits"]) for r in base])
        parts = []  # entries by width of their bitmaps, still sorted by size
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            parts.append((at, np.frombuffer(b"".join(base[i]["bits"] for i in at), np.uint8).reshape(len(at), w)))
        folded: dict = {}
        out, more = set(), set()
        for q in (r for r in rows if r["probe"]):
            m, bits, found = q["n"], np.frombuffer(q["bits"], np.uint8), []
            for at, table in parts:
                # entries out of the size range are skipped as a whole
                lo, hi = np.searchsorted(n[at], -(-3 * m // 4)), np.searchsorted(n[at], 4 * m // 3, "right")
                if lo == hi:
                    continue
                w = min(len(bits), table.shape[1])
                key = (table.shape[1], w)
                if key not in folded:
                    folded[key] = np.bitwise_xor.reduce(table.reshape(len(table), -1, w), axis=1)
                x = at[lo:hi]
                needed = -(-3 * (m + n[x]) // 7)
                d = _ONES[folded[key][lo:hi] ^ _fold(bits, w)].sum(1, dtype=np.int64)
                keep = (m + n[x] - 2 * needed >= d) & (c[x] != q["c"]) & (s[x] != q["s"])
                if q["o"] is not None:
                    # overlap bounded by what both share with the hub and what each has besides
                    bound = np.minimum(q["o"], o[x]) + np.minimum(m - q["o"], n[x] - o[x])
                    keep &= (o[x] < 0) | (bound >= needed)
                found += zip(d[keep].tolist(), s[x][keep].tolist())
            if few is not None and len(found) > few:
                found = sorted(found)[:few]
                more.add(q["s"])
            out.update((min(q["s"], y), max(q["s"], y)) for _, y in found)
        h = rows[0]["h"]
        ends = sorted(out) + [(x, None) for x in sorted(more)]
        if ends:
            a, b = zip(*ends)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                              pa.array([h] * len(a), pa.int64())], ["a", "b", "h"])

    return rows.mapInArrow(run, "a long, b long, h long")


def _unchecked(found: DataFrame, checked: DataFrame) -> DataFrame:
    """(a, b, h): pairs that no verification has seen, once and without a group, and members whose list was cut."""
    done = checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    once = found.select("a", "b", F.when(F.col("b").isNull(), F.col("h")).alias("h")).distinct()
    return once.join(done, ["a", "b"], "left_anti")


def link(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept, row) of every row.

    ``kept``: the row is the one of its component that stays; ``row``: the
    row's name by key and text, as ``row_hash`` gives it.
    """
    spark = docs.sparkSession
    levels, n_words = _word_levels(docs, text)
    levels = spark.sparkContext.broadcast(levels)  # fixed size

    kind = docs.schema[key].dataType.simpleString()

    def name(batches):
        for b in batches:
            arrow = b.column("k").type
            h = iter(b.column("r").to_pylist())
            for keys, texts in text_chunks([b], "k", "t"):
                sets = list(shingle_sets(texts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, arrow), pa.array([next(h) for _ in keys], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in sets], pa.int64()),
                     pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary())],
                    ["k", "r", "n", "s", "bits"])

    n_buckets = max(spark.sparkContext.defaultParallelism, n_words // 800_000 + 1)
    lists = stage(_lists(docs, key, text, levels, n_buckets), "jaccard-lists")
    groups = stage(_hub_groups(lists), "jaccard-groups")
    # after the index lists, whose shuffle takes the most disk
    meta = stage(docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("r"), F.col(text).alias("t"))
                 .mapInArrow(name, f"k {kind}, r long, n long, s long, bits binary"), "jaccard-meta")
    wanted = groups.select(F.col("h").alias("s")).union(groups.select("s")).distinct()
    sets = stage(meta.join(wanted, "s").groupBy("s").agg(  # with one row that has the set
        F.min(F.struct("k", "r")).alias("m"), F.first("n").cast("int").alias("n"), F.first("bits").alias("bits"))
        .select("s", "n", "bits", "m.k", "m.r"), "jaccard-sets")
    meta = meta.drop("bits")

    def build(batches):
        for b in batches:
            ids = iter(b.column("_s").to_pylist())
            for _, texts in text_chunks([b], "_s", "t"):
                sets = list(shingle_sets(texts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([next(ids) for _ in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], ["s", "n", "codes"])

    def verified(pairs):
        ends = pairs.select(F.col("a").alias("s")).union(pairs.select(F.col("b").alias("s"))).distinct()
        codes = _texts(docs, key, text, sets.join(ends, "s")).mapInArrow(build, "s long, n int, codes binary")
        return stage(_verify(pairs, codes), "jaccard-verified")

    pairs = groups.where("ok").select(F.col("h").alias("a"), F.col("s").alias("b"))
    # a pair may come from either side
    pairs = pairs.groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(
        F.first("a").alias("a"), F.first("b").alias("b")).select("a", "b")
    checked = verified(stage(_close(pairs, sets), "jaccard-close"))
    comp = stage(components(_linked(checked), "a", "b"), "jaccard-components")

    def joined(found, checked, comp):
        rest = found.where("b is not null").select("a", "b")
        if rest.isEmpty():
            return checked, comp
        new = verified(rest)
        checked, links = checked.unionAll(new), _linked(new)
        if links.isEmpty():
            return checked, comp
        links = links.union(comp.select("node", "component"))
        return checked, stage(components(links, "a", "b"), "jaccard-components")

    found = stage(_unchecked(_left(groups, sets, comp, checked, few=3), checked), "jaccard-left")
    checked, comp = joined(found, checked, comp)
    cut = found.where("b is null").select("a", "h")
    if not cut.isEmpty():  # members that had more candidates than the limit meet all of them
        found = stage(_unchecked(_left(groups, sets, comp, checked, cut=cut), checked), "jaccard-left")
        checked, comp = joined(found, checked, comp)
    m = meta.join(comp.select(F.col("node").alias("s"), "component"), "s", "left")
    m = m.withColumn("c", F.coalesce("component", "s"))
    # the component's first row by key (nulls last), then by hash of the text
    m = m.withColumn("o", F.struct(F.col("k").isNull().alias("z"), "k", "r"))
    low = m.where("n > 0").groupBy("c").agg(F.min("o").alias("low"))
    alone = F.col("n") == 0
    return m.join(low, "c", "left").select(
        F.col("k").alias(key), F.col("n").alias("n_shingles"),
        F.when(alone, F.col("k")).otherwise(F.col("low.k")).alias("component_id"),
        (alone | (F.col("o") == F.col("low"))).alias("kept"), row_hash(F.col("k"), F.col("r")).alias("row"))
