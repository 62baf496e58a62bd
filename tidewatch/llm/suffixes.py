"""Exact substring dedup over suffix arrays (operator 4).

Removes every byte covered by a ``length``-byte string that also starts in a
document with a smaller key.  Strings are judged on the input, overlaps count,
matches never cross documents.

1. Every window of ``length`` bytes belongs to its smallest hashed 16-byte
   gram, so equal windows belong to equal grams wherever they stand.  Windows
   in a row with one smallest gram form a run.  Runs meet by gram: runs of one
   content go whole but for the smallest key's.  What is left of a gram goes on
   if runs of several documents also agree in the bytes before the gram or in
   those behind it, as equal windows do on one side at least.
2. These runs' bytes are dealt by gram into shards of bounded size.  A shard
   builds a suffix array over their windows by Larsson-Sadakane refinement
   (groups sorted by prefix, doubled until all are single, only groups not yet
   single are sorted again), and the neighbours' common prefixes.  Neighbours
   with a common prefix of ``length`` or more are equal windows; the smallest
   key among them decides.
3. A gram that stands in very many runs is spread over several shards.  What
   those cannot decide alone, the windows of their own smallest key, is merged
   across shards: windows are dealt into sorted ranges by binary search among
   splitters, and the smallest key of each decides.
4. The byte ranges found are joined to the texts and cut out.

Keys are integers; a null key counts as smaller than all others.  Null text is
empty.  Texts shorter than ``length`` lose nothing.  Rows with equal keys never
match each other; rows equal in key and text are treated alike.  A text equal
to one with a smaller key is removed whole.  Columns besides key and text are
not read.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import mix, powers, slices, stage, text_chunks
from tidewatch.llm.jaccard import _planes, _unplanes

GRAM = 16
PIECE = 2 << 20
HOT_RUNS = 20_000
_U = np.uint64
_NULL = -(1 << 63)


# --- runs of windows with one smallest gram ------------------------------------------
def _words8(a: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number, first byte highest; zeros behind the end."""
    x = np.concatenate([a, np.zeros(8, np.uint8)]).astype(np.uint64)
    for shift in (1, 2, 4):
        y = x[:-shift] << _U(8 * shift)
        y |= x[shift:]
        x = y
    return x[:len(a)]


#: a gram's hash with its place below, modulo 2**20: the smaller of two equal grams is the first
_PLACE = 20
_LOW = (1 << _PLACE) - 1


def window_runs(a: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(gram hash, first window, last window, gram's place) of every run of some texts' bytes.

    ``ends``: where each text ends.  The place is that of the gram's first
    occurrence in all windows of the run, -1 if there is no single one."""
    n = len(a)
    none = np.zeros(0, np.int64)
    if n < length:
        return none.astype(np.uint64), none, none, none
    w = _words8(a)
    h = w[:n - GRAM + 1] * _U(0x9E3779B97F4A7C15)
    h += w[8:n - GRAM + 9] * _U(0xC2B2AE3D27D4EB4F)
    h ^= h >> _U(32)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(29)
    h &= _U((1 << 64) - 1 - _LOW)
    h |= np.arange(len(h), dtype=np.uint64) & _U(_LOW)
    span = length - GRAM + 1  # grams in a window
    low, width = h, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    g = low >> _U(_PLACE)
    new = np.empty(len(g), bool)
    new[0] = True
    np.not_equal(g[1:], g[:-1], out=new[1:])
    begins = np.concatenate([[0], ends[:-1]])
    new[begins[begins < len(new)]] = True
    # no run has windows that reach into the next text
    over = np.maximum(ends - length + 1, begins)
    new[over[over < len(new)]] = True
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(g)]]) - 1
    text = np.searchsorted(ends, first, "right")
    whole = first + length <= ends[text]
    first, last = first[whole], last[whole]
    place, same = low[first] & _U(_LOW), low[first] == low[last]
    at = first + ((place.astype(np.int64) - first) & _LOW)
    # places begin anew at multiples of 2**20: there the first occurrence is not known
    same &= first >> _PLACE == (last + length) >> _PLACE
    return g[first], first, last, np.where(same, at, -1)


# --- suffix array and common prefixes ------------------------------------------------
def refined(a: np.ndarray, depth: int | None = None, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes, rank) by Larsson-Sadakane refinement, sorted by at least ``depth`` bytes (default: wholly).

    Suffixes that agree that far stay a group of one rank, the place of its
    first.  ``wanted``: suffixes to return; the others are sorted only as far as
    the order of these takes, and their rank says no more."""
    n = len(a)
    # a byte is followed by the end of the text, which sorts first: lengths tell zeros apart
    key = _words8(a)
    sa = np.argsort(key)
    key = key[sa]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = start
    h = 8
    # suffixes shorter than 8 bytes tie with ones that go on with zero bytes: the next round's end mark parts them
    short = np.arange(max(0, n - 8), n)
    while depth is None or h == 8 or h < depth:
        if wanted is not None and depth is not None and 2 * h >= depth:
            sa, wanted = sa[wanted[sa]], None  # the last round
        of = rank[sa]
        edge = np.concatenate([[True], of[1:] != of[:-1], [True]])
        open_ = np.flatnonzero(~(edge[1:] & edge[:-1]))  # places in sa of groups not yet single
        if not len(open_):
            break
        at = sa[open_]
        nxt = np.minimum(at + h, n)
        nxt_rank = rank[nxt] + 1
        if h == 8 and len(short):
            tail = at + h > n
            nxt_rank = np.where(tail, at + h - n, nxt_rank + 9) if tail.any() else nxt_rank + 9
            nxt_rank = np.where(tail, 9 - nxt_rank, nxt_rank)  # the shorter the suffix, the smaller
        # a group's rank is below n, the next rank below n + 10: one number sorts by both
        both = of[open_] * (n + 16) + nxt_rank
        order = np.argsort(both)
        at, both = at[order], both[order]
        sa[open_] = at
        r = of[open_]  # groups keep their places
        group = np.concatenate([[True], r[1:] != r[:-1]])
        split = np.concatenate([[True], both[1:] != both[:-1]])
        i = np.arange(len(at))
        rank[at] = np.maximum.accumulate(np.where(split, r + i - np.maximum.accumulate(np.where(group, i, 0)), 0))
        h *= 2
    return (sa if wanted is None else sa[wanted[sa]]), rank[:n]


def suffix_array(a: np.ndarray) -> np.ndarray:
    """Sorted suffixes."""
    return refined(a)[0]


def common_prefixes(a: np.ndarray, sa: np.ndarray, start: np.ndarray, size: np.ndarray, most: int,
                    rank: np.ndarray | None = None) -> np.ndarray:
    """Common prefix (up to ``most``) of each suffix with the one before it in ``sa``, 0 for suffixes not in it.

    Neighbours are compared by 8 bytes at a time, only those go on that agree.
    ``rank``: groups sorted by ``most`` bytes or more only; within one the answer
    is ``most``.  ``start``, ``size``: the pieces ``a`` consists of, which comparing
    by words does not ask for.
    """
    n = len(a)
    out = np.zeros(n, np.int64)
    x, y = sa[1:], sa[:-1]
    if rank is not None:
        tied = rank[x] == rank[y]
        out[x[tied]] = most
        x, y = x[~tied], y[~tied]
    words = np.concatenate([_words8(a), np.zeros(1, np.uint64)])
    for h in range(0, most, 8):
        other = words[np.minimum(x + h, n)] ^ words[np.minimum(y + h, n)]
        agree = other == 0
        differ = ~agree
        z = other[differ]
        same = np.full(len(z), h, np.int64)
        for byte in range(1, 8):
            same += z < _U(1 << (8 * byte))
        out[x[differ]] = np.minimum(np.minimum(same, n - np.maximum(x, y)[differ]), most)
        x, y = x[agree], y[agree]
        if not len(x):
            break
    out[x] = np.minimum(most, n - np.maximum(x, y))
    return out


# --- jobs ----------------------------------------------------------------------------
def _batch(cols, names):
    return pa.RecordBatch.from_arrays(cols, names)


_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def _sums(a: np.ndarray) -> np.ndarray:
    """Weighted sum of the bytes before each place."""
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_VALUE[a] * powers(len(a))[0][:len(a)], out=total[1:])
    return total


def content_hashes(total: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hash of ``n`` bytes from each start on, by the bytes' sums."""
    return mix((total[start + n] - total[start]) * powers(len(total) - 1)[1][start] + mix(n.astype(np.uint64)))


#: bytes of text handled at once when runs are made: the numbers of that many places stay in a core's cache
_CHUNK = 1 << 17
_KINDS = (np.uint64, np.uint64, np.int64, np.int64, np.uint32, np.uint32, np.uint32, np.uint32)


def contexts(total: np.ndarray, first: np.ndarray, n: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (1 to 2**24) of a run's gram with the bytes before it, and with those behind it.

    Of the ``length - GRAM`` bytes that a window has beside its gram, half or
    more stand on one side, so equal windows' runs agree in one of the two.  0: no
    window has as many on that side, or (both 0) the gram has no single place."""
    side = (length - GRAM + 1) // 2
    out = []
    for lo, fits in ((place - side, place - side >= first), (place, place + GRAM + side <= first + n)):
        x = np.zeros(len(first), np.uint32)
        at = np.flatnonzero(fits & (place >= 0))
        x[at] = (content_hashes(total, lo[at], np.full(len(at), GRAM + side)) >> _U(40)).astype(np.uint32) + np.uint32(1)
        out.append(x)
    return out[0], out[1]


def shared(g: np.ndarray, k: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether a run may have a window in common with one of another key; ``g``: sorted."""
    if not len(g):
        return np.zeros(0, bool)
    start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    size = np.diff(np.concatenate([start, [len(g)]]))
    # grams without a single place in some run are met by all
    out = np.repeat(np.minimum.reduceat(np.maximum(left, right), start) == 0, size)
    out &= np.repeat(np.minimum.reduceat(k, start) != np.maximum.reduceat(k, start), size)
    of = np.repeat(np.arange(len(start), dtype=np.uint64), size) << _U(32)
    for side in (left, right):
        some = np.flatnonzero(side)
        if len(some):
            both = of[some] | side[some]
            order = np.argsort(both)
            some, both = some[order], both[order]
            begin = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
            n = np.diff(np.concatenate([begin, [len(some)]]))
            out[some] |= np.repeat(np.minimum.reduceat(k[some], begin) != np.maximum.reduceat(k[some], begin), n)
    return out


def _runs(rows: DataFrame, length: int, n_buckets: int, hot_runs: int) -> DataFrame:
    """(k, tag, s, e, z, g): byte ranges to remove (z 0), and runs that suffix arrays decide (z: shards for the gram g)."""
    names = ["b", "g", "c", "k", "tag", "p", "n", "l", "r"]

    def emit(batches):
        seen: dict[int, int] = {}
        parts, size = [], 0
        for ids, texts in text_chunks(_paired(batches), "id", "t", _CHUNK):
            mine = []
            for (k, tag), t in zip(ids, texts):
                if len(t) < length or seen.get(tag, k + 1) <= k:
                    continue  # an equal text with a smaller or equal key has been sent by this task
                if len(seen) > 200_000:
                    seen.clear()
                seen[tag] = k
                mine.append((k, tag, t))
            if not mine:
                continue
            k, tag, kept = zip(*mine)
            a = np.frombuffer(b"".join(kept), np.uint8)
            ends = np.cumsum([len(t) for t in kept])
            g, first, last, place = window_runs(a, ends, length)
            n = last - first + length
            total = _sums(a)
            text = np.searchsorted(ends, first, "right")
            p = first - np.concatenate([[0], ends[:-1]])[text]
            parts.append((g, content_hashes(total, first, n), np.array(k, np.int64)[text], np.array(tag, np.int64)[text],
                          p.astype(np.uint32), n.astype(np.uint32), *contexts(total, first, n, place, length)))
            size += len(g)
            if size >= 200_000:
                yield from deal(parts)
                parts, size = [], 0
        if parts:
            yield from deal(parts)

    def deal(parts):
        cols = [np.concatenate(x) for x in zip(*parts)]
        b = (cols[0] % _U(n_buckets)).astype(np.int64)
        order = np.argsort(b)
        cols, b = [x[order] for x in cols], b[order]
        cut = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]]))
        for lo, hi in zip(cut[:-1], cut[1:]):
            yield _batch([pa.array([int(b[lo])], pa.int32()), *(pa.array([_planes(x[lo:hi])], pa.binary()) for x in cols)], names)

    def gather(batches):
        held, at = [], None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(9))):
                if row[0] != at and held:
                    yield from several(held)
                    held = []
                at = row[0]
                held.append([_unplanes(x, t) for x, t in zip(row[1:], _KINDS)])
        if held:
            yield from several(held)

    def several(held):
        cols = [np.concatenate(x) for x in zip(*held)]
        # a gram met once decides nothing
        order = np.argsort(cols[0])
        g = cols[0][order]
        edge = np.concatenate([[True], g[1:] != g[:-1], [True]])
        met = order[~(edge[1:] & edge[:-1])]
        if not len(met):
            return
        g, c, k, tag, p, n, left, right = (x[met] for x in cols)
        order = np.lexsort((k, p, tag, c, g))
        g, c, k, tag, p, n, left, right = (x[order] for x in (g, c, k, tag, p, n, left, right))
        # one row of equal texts, the smallest key's; the others are removed as copies
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1]) | (tag[1:] != tag[:-1]) | (p[1:] != p[:-1])])
        g, c, k, tag, p, n, left, right = (x[new] for x in (g, c, k, tag, p, n, left, right))
        one = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])]))
        size = np.diff(np.concatenate([one, [len(g)]]))
        least = np.repeat(np.minimum.reduceat(k, one), size)
        yield from out(np.flatnonzero(k > least), k, tag, p, n, np.zeros(len(k), np.int32), np.zeros(len(k), np.int64))
        keep = np.flatnonzero(k == least)
        keep = keep[shared(g[keep], k[keep], left[keep], right[keep])]
        if not len(keep):
            return
        g, k, tag, p, n = (x[keep] for x in (g, k, tag, p, n))
        start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        size = np.diff(np.concatenate([start, [len(g)]]))
        z = np.repeat(-(-size // hot_runs), size).astype(np.int32)
        yield from out(np.arange(len(g)), k, tag, p, n, z, g.astype(np.int64))

    def out(rows, k, tag, p, n, z, g):
        for i in range(0, len(rows), 50_000):
            x = rows[i:i + 50_000]
            s = p[x].astype(np.int64)
            yield _batch([pa.array(k[x]), pa.array(tag[x]), pa.array(s), pa.array(s + n[x]), pa.array(z[x]), pa.array(g[x])],
                         ["k", "tag", "s", "e", "z", "g"])

    blobs = rows.select("k", "tag", "t").mapInArrow(
        emit, "b int, g binary, c binary, k binary, tag binary, p binary, n binary, l binary, r binary")
    return (blobs.repartition(n_buckets, "b").sortWithinPartitions("b")
            .mapInArrow(gather, "k long, tag long, s long, e long, z int, g long"))


class _Rows:
    """A batch whose id column is (k, tag); a view for text_chunks."""

    def __init__(self, b):
        self.b, self.num_rows = b, b.num_rows

    def slice(self, i, n):
        return _Rows(self.b.slice(i, n))

    def column(self, name):
        return self if name == "id" else self.b.column("t")

    def to_pylist(self):
        return list(zip(*(self.b.column(c).to_pylist() for c in ("k", "tag"))))


def _paired(batches):
    return map(_Rows, batches)


def _segments(rows: DataFrame, runs: DataFrame, n_shards: int) -> DataFrame:
    """Byte segments of the runs, dealt by gram: (shard, salt, lengths, bytes, keys, tags, places)."""
    want = (runs.groupBy("k", "tag").agg(F.collect_list(F.struct(F.col("s").alias("p"), "e", "z", "g")).alias("want"))
            .select(F.col("k").alias("_k"), F.col("tag").alias("_tag"), "want"))
    d = rows.join(want, F.expr("k = _k AND tag = _tag")).select("k", "tag", "t", "want")

    def run(batches):
        parts, size = [], 0
        for b in slices(batches, 64):
            texts = [t or b"" for t in b.column("t").to_pylist()]
            want = b.column("want")
            many = pc.list_value_length(want).to_numpy(zero_copy_only=False)
            p, e, z, g = (want.flatten().field(c).to_numpy() for c in ("p", "e", "z", "g"))
            k, tag = (np.repeat(b.column(c).to_numpy(), many) for c in ("k", "tag"))
            ends = np.cumsum([len(t) for t in texts])
            a = np.frombuffer(b"".join(texts), np.uint8)
            at = p + np.repeat(np.concatenate([[0], ends[:-1]]), many)
            salt = (k.view(np.uint64) % z.astype(np.uint64)).astype(np.int64)
            n = e - p
            take = np.repeat(at - np.cumsum(n) + n, n) + np.arange(n.sum())
            parts.append((g.view(np.uint64) % _U(n_shards), salt * (z > 1), z > 1, n, a[take], k, tag, p.astype(np.uint32)))
            size += int(n.sum())
            if size >= PIECE:
                yield from deal(parts)
                parts, size = [], 0
        if parts:
            yield from deal(parts)

    def deal(parts):
        shard, salt, hot, n, data, k, tag, p = (np.concatenate(x) for x in zip(*parts))
        at = np.cumsum(n) - n
        order = np.lexsort((salt, hot, shard.astype(np.int64)))
        s, h, z = shard[order].astype(np.int64), hot[order], salt[order]
        cut = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (h[1:] != h[:-1]) | (z[1:] != z[:-1]), [True]]))
        for lo, hi in zip(cut[:-1], cut[1:]):
            x = order[lo:hi]
            take = np.repeat(at[x] - np.cumsum(n[x]) + n[x], n[x]) + np.arange(n[x].sum())
            yield _batch([pa.array([int(s[lo])], pa.int32()), pa.array([int(z[lo]) if h[lo] else -1], pa.int64()),
                          pa.array([_planes(n[x].astype(np.uint32))], pa.binary()), pa.array([data[take].tobytes()], pa.binary()),
                          *(pa.array([_planes(c[x])], pa.binary()) for c in (k, tag, p))],
                         ["shard", "salt", "n", "data", "k", "tag", "p"])

    return d.mapInArrow(run, "shard int, salt long, n binary, data binary, k binary, tag binary, p binary")


def _distinct(data: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first segment of each content, content of each segment)."""
    _, first, of = np.unique(content_hashes(_sums(data), at, n), return_index=True, return_inverse=True)
    return first, of


def shard_matches(data: np.ndarray, n: np.ndarray, k: np.ndarray, length: int):
    """For the segments of a shard: (segment, first byte, end) to remove, and of what is not decided by
    smaller keys here, the (segment, window) of each content's smallest key."""
    at = np.cumsum(n) - n
    first, of = _distinct(data, at, n)
    u_n = n[first]
    u_at = np.cumsum(u_n) - u_n
    take = np.repeat(at[first] - u_at, u_n) + np.arange(u_n.sum())
    text = data[take]
    u_k = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(u_k, of, k)
    piece = np.repeat(np.arange(len(first)), u_n)
    offset = np.arange(len(text)) - u_at[piece]
    # only suffixes that start a window are sorted to the end
    sa, rank = refined(text, length, offset + length <= u_n[piece])
    lcp = common_prefixes(text, sa, u_at, u_n, length, rank)
    # runs of neighbours with a common prefix of `length`; the smallest key among their windows
    new = lcp[sa] < length
    best = np.empty(len(text), np.int64)
    best[sa] = np.minimum.reduceat(u_k[piece[sa]], np.flatnonzero(new))[np.cumsum(new) - 1]
    # copies of a segment with a larger key go whole
    whole = np.flatnonzero(k > u_k[of])
    yield whole, np.zeros(len(whole), np.int64), n[whole]
    # the others, by window
    rest = np.flatnonzero(k == u_k[of])
    m = n[rest] - length + 1
    seg = np.repeat(rest, m)
    o = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
    gone = best[u_at[of[seg]] + o] < k[seg]
    s, e, oo = seg[gone], o[gone], None
    new = np.concatenate([[True], (s[1:] != s[:-1]) | (e[1:] != e[:-1] + 1)]) if len(s) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    ends = np.concatenate([starts[1:], [len(s)]]) - 1 if len(starts) else starts
    yield s[starts], e[starts], e[ends] + length
    yield seg[~gone], o[~gone], oo


def _shards(segments: DataFrame, length: int, n_shards: int) -> DataFrame:
    """(w, k, tag, s, e): byte ranges to remove (w null), or windows still open (w: their bytes)."""
    d = segments.repartition(n_shards, "shard", "salt").sortWithinPartitions("shard", "salt")

    def run(batches):
        held, at = [], None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if row[:2] != at and held:
                    yield from solve(held, at[1] >= 0)
                    held = []
                at = row[:2]
                held.append([_unplanes(row[2], np.uint32), np.frombuffer(row[3], np.uint8), _unplanes(row[4], np.int64),
                             _unplanes(row[5], np.int64), _unplanes(row[6], np.uint32)])
        if held:
            yield from solve(held, at[1] >= 0)

    def solve(held, open_):
        n, data, k, tag, p = (np.concatenate(x) for x in zip(*held))
        n, p = n.astype(np.int64), p.astype(np.int64)
        found = list(shard_matches(data, n, k, length))
        for seg, s, e in found[:2]:
            for i in range(0, len(seg), 50_000):
                x = seg[i:i + 50_000]
                yield _batch([pa.nulls(len(x), pa.binary()), pa.array(k[x]), pa.array(tag[x]),
                              pa.array(p[x] + s[i:i + 50_000]), pa.array(p[x] + e[i:i + 50_000])],
                             ["w", "k", "tag", "s", "e"])
        if open_:
            seg, o, _ = found[2]
            at = np.cumsum(n) - n
            for i in range(0, len(seg), 10_000):
                x, y = seg[i:i + 10_000], o[i:i + 10_000]
                w = data[(at[x] + y)[:, None] + np.arange(length)]
                yield _batch([pa.array([r.tobytes() for r in w], pa.binary()), pa.array(k[x]), pa.array(tag[x]),
                              pa.array(p[x] + y), pa.array(p[x] + y + length)], ["w", "k", "tag", "s", "e"])

    return d.mapInArrow(run, "w binary, k long, tag long, s long, e long")


def _merge(open_: DataFrame) -> DataFrame:
    """(k, tag, s, e) of open windows that a smaller key holds in another shard."""
    d = open_.repartitionByRange("w").sortWithinPartitions("w", "k")

    def run(batches):
        at, low = None, None
        for b in batches:
            w, k = b.column("w").to_pylist(), b.column("k").to_pylist()
            gone = []
            for x, y in zip(w, k):
                if x != at:
                    at, low = x, y
                gone.append(y > low)
            yield b.filter(pa.array(gone, pa.bool_())).select(["k", "tag", "s", "e"])

    return d.select("w", "k", "tag", "s", "e").mapInArrow(run, "k long, tag long, s long, e long")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50,
          shard_bytes: int = 1 << 20, hot_runs: int = HOT_RUNS) -> DataFrame:
    """(key, n_bytes, n_removed, spans, kept) of every row; ``kept``: the bytes that stay, ``spans``: (start, end) removed."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(_NULL)).alias("k"), raw.alias("t"))
    rows = rows.withColumn("tag", F.xxhash64("t"))
    meta = stage(rows.select("k", "tag", F.octet_length("t").cast("long").alias("n"), F.crc32("t").alias("c")),
                 "suffix-meta")
    n_bytes = meta.agg(F.sum("n")).first()[0] or 0
    spark = docs.sparkSession
    least = spark.sparkContext.defaultParallelism
    runs = stage(_runs(rows, length, max(least, n_bytes // (2 << 20)), hot_runs), "suffix-runs")
    open_ = runs.where("z > 0")
    # a run has about 70 bytes; the number of shards follows the bytes to sort
    n_shards = max(least, open_.count() * 70 // shard_bytes)
    found = stage(_shards(_segments(rows, open_, n_shards), length, n_shards), "suffix-ranges")
    cuts = (runs.where("z = 0").drop("z", "g").unionAll(found.where("w is null").drop("w"))
            .unionAll(_merge(found.where("w is not null"))))
    # a text equal to one with a smaller key goes whole
    first = meta.where(F.col("n") >= length).groupBy("tag", "n", "c").agg(F.min("k").alias("k0"), F.count(F.lit(1)).alias("m"))
    copies = (meta.join(first.where("m > 1"), ["tag", "n", "c"]).where("k > k0")
              .select("k", "tag", F.lit(0).cast("long").alias("s"), F.col("n").alias("e")).distinct())
    cuts = (cuts.unionAll(copies).groupBy("k", "tag").agg(F.collect_list(F.struct("s", "e")).alias("cuts"))
            .select(F.col("k").alias("_k"), F.col("tag").alias("_tag"), "cuts"))
    d = rows.join(cuts, F.expr("k = _k AND tag = _tag"), "left").select("key", "t", "cuts")
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        out, size = [], 0
        for b in batches:
            for x, t, c in zip(*(b.column(i) for i in range(3))):
                t = t.as_py()
                spans = []
                if c.is_valid:
                    s, e = c.values.field("s").to_numpy(), c.values.field("e").to_numpy()
                    order = np.argsort(s, kind="stable")
                    s, e = s[order], np.maximum.accumulate(e[order])
                    new = np.concatenate([[True], s[1:] > e[:-1]])
                    i = np.flatnonzero(new)
                    spans = list(zip(s[i].tolist(), e[np.concatenate([i[1:], [len(s)]]) - 1].tolist()))
                edges = [0, *(y for z in spans for y in z), len(t)]
                kept = b"".join([t[lo:hi] for lo, hi in zip(edges[0::2], edges[1::2])])
                out.append((x.as_py(), len(t), len(t) - len(kept), [{"start": a, "end": z} for a, z in spans], kept))
                size += len(kept) + 100
                if size >= 4 << 20:
                    yield rows_of(out)
                    out, size = [], 0
        if out:
            yield rows_of(out)

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def rows_of(out):
        c = list(zip(*out))
        ints = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[kind]
        return _batch([pa.array(c[0], ints), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()),
                       pa.array(c[3], span), pa.array(c[4], pa.binary())], [key, "n_bytes", "n_removed", "spans", "kept"])

    return d.mapInArrow(run, f"{key} {kind}, n_bytes long, n_removed long, "
                             "spans array<struct<start:long,end:long>>, kept binary")
