"""Line dedup within an edit bound (operator 5).

A line's text is compared without leading and trailing blanks (space, tab,
carriage return).  Order of lines: key, then line number.  An occurrence goes
when an earlier one has the same text, or when its text is within one edit
(Levenshtein; insertion, deletion or substitution of a character) of a text
that occurs earlier and both have at least ``min_fuzzy`` characters.  Blank
lines stay.

Deletion-neighbourhood join, on distinct texts only:

* A first pass keeps the texts that can have a partner at all: one edit leaves
  the first or the last half of a line as it is, so partners share one of two
  half keys at the shorter one's length.
* Among those, further passes narrow the place of the edit to one of 8 pieces,
  outside of which partners agree, and then to a quarter of such a piece
  (``PIECES``).  Lines that differ by a word fall out here, in any number.
* Every text left emits all variants with one character of such a piece deleted
  as hashed keys.  Two texts of one length within one edit share the variant *and* the place of
  the deletion; a text that is one character shorter *is* a variant of the
  longer one.  Keys are grouped with the earliest occurrence for each, so a key
  with any number of lines sends one row per task and no pair is listed.
* Each text's partners, at most one for a key, are verified with the edit
  distance; the earliest occurrence stays.

Defined results: null text has no lines and stays null; null keys sort first.
Rows equal in key and text are one document listed twice and are treated
alike.  A text all of whose non-blank lines go keeps its blank lines.  Input
columns named n_lines or n_dropped are replaced, others pass through.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import slices, stage

_BLANKS = " \t\r"
MIN_FUZZY = 24
PIECES = (8, 32)  # each number divides the next


def _occurrences(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, r, i, t): key, row hash (tells repeated keys apart), line number, trimmed text; no blank lines."""
    d = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.xxhash64(text).alias("r"),
                                                   F.posexplode(F.split(text, "\n")).alias("i", "t"))
    return d.withColumn("t", F.btrim("t", F.lit(_BLANKS))).where("t <> ''")


def _halves(t):
    """Half keys of a text: its own, and those of texts one character shorter."""
    n = F.char_length(t)

    def pair(size):
        m = F.floor(size / 2).cast("int")
        return [F.xxhash64(F.lit(1), size, F.substring(t, F.lit(1), m)),
                F.xxhash64(F.lit(2), size, F.right(t, size - m))]
    return F.array(*pair(n), *pair(n - 1))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _fold(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def deletion_keys(t: str) -> tuple[np.ndarray, int]:
    """Hashes of the variants with character 0, 1, ... deleted, and of the text itself."""
    c = np.frombuffer(t.encode("utf-32-le"), np.uint32).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)
    c ^= c >> np.uint64(29)
    p = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(c), _STEP)]))
    left = np.concatenate([[np.uint64(0)], np.cumsum(c * p[:-1])])  # sum of c[j] p[j] over j < i
    back = np.concatenate([[np.uint64(0)], np.cumsum(c[1:] * p[:-2])])  # with all places moved down by one
    return _fold(left[:-1] + (back[-1] - back)), int(_fold(left[-1:])[0])


def _piece(n: int, q: int, pieces: int) -> tuple[int, int]:
    """Borders of piece ``q`` of a text of ``n`` characters."""
    return q * n // pieces, (q + 1) * n // pieces


def _piece_keys(texts: DataFrame, pieces: int) -> DataFrame:
    """(h, q, own, x): hash of all but piece q, cut as in a text of the own length or of one less.

    Partners differ within one piece, so they share this key at the shorter one's length.
    ``todo`` lists the pieces to cut: (q, own)."""
    def run(batches):
        for b in batches:
            rows = []
            for h, t, todo in zip(*(b.column(c).to_pylist() for c in ("h", "t", "todo"))):
                for x in todo:
                    n, q = len(t) - (not x["own"]), x["q"]
                    s, e = _piece(n, q, pieces)
                    x_key = f"{n}/{q}/{t[:s]}\0{t[len(t) - (n - e):]}".encode()
                    rows.append((h, q, x["own"], xxhash.xxh3_64_intdigest(x_key) - (1 << 63)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int32(), pa.bool_(), pa.int64()))],
                    ["h", "q", "own", "x"])

    return texts.select("h", "t", "todo").mapInArrow(run, "h long, q int, own boolean, x long")


def _able(texts: DataFrame) -> DataFrame:
    """(h, q, kind): pieces, of the finest cut, in which a text may differ from a partner.

    kind 0: from one of its length, 1: from one a character shorter, 2: from one a character longer."""
    able = None
    for was, pieces in zip((1, *PIECES), PIECES):
        parts = F.sequence(F.lit(0), F.lit(pieces // was - 1))
        if able is None:
            cut = F.transform(F.sequence(F.lit(0), F.lit(2 * pieces - 1)), lambda i: F.struct(
                (i % pieces).cast("int").alias("q"), (i < pieces).alias("own")))
            d = texts.withColumn("todo", cut)
        else:  # the parts of the pieces left
            cut = (able.select("h", "q", (F.col("kind") != 1).alias("own")).distinct()
                   .select("h", "own", F.explode(F.transform(parts, lambda i: (F.col("q") * (pieces // was) + i).cast("int"))).alias("q")))
            d = texts.join(cut.groupBy("h").agg(F.collect_list(F.struct("q", "own")).alias("todo")), "h")  # at most 2 a piece
        keys = stage(_piece_keys(d, pieces), "line-pieces")
        groups = (keys.groupBy("x").agg(F.count(F.when(F.col("own"), 1)).alias("co"), F.count(F.when(~F.col("own"), 1)).alias("cp"))
                  .where("co > 1 OR (co > 0 AND cp > 0)"))
        roles = F.filter(F.array(F.when(F.col("own") & (F.col("co") > 1), 0), F.when(~F.col("own") & (F.col("co") > 0), 1),
                                 F.when(F.col("own") & (F.col("cp") > 0), 2)), lambda c: c.isNotNull())
        able = keys.join(groups, "x").select("h", "q", F.explode(roles).alias("kind")).distinct()
    return able


def _variants(texts: DataFrame, able: DataFrame) -> DataFrame:
    """(x, place, own, h, k, r, i): hashed deletion variants.

    ``able``: (h, q, kind) pieces in which a text may differ from a partner;
    kind 0: from one of its length (place: the deletion's), 1: from one that is
    a character shorter (place -1), 2: from one a character longer (the text itself).
    """
    def run(batches):
        for b in batches:
            for h, k, r, i, t, todo in zip(*(b.column(n).to_pylist() for n in ("h", "k", "r", "i", "t", "todo"))):
                keys, whole = deletion_keys(t)
                rows: set[tuple[int, int, bool]] = set()
                for x in todo:
                    if x["kind"] == 0:
                        rows.update((int(keys[p]), p, False) for p in range(*_piece(len(t), x["q"], PIECES[-1])))
                    elif x["kind"] == 1:
                        s, e = _piece(len(t) - 1, x["q"], PIECES[-1])
                        rows.update((int(keys[p]), -1, False) for p in range(s, e + 1))
                    else:
                        rows.add((whole, -1, True))
                m = len(rows)
                x, place, own = zip(*sorted(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()), pa.array(place, pa.int32()), pa.array(own, pa.bool_()),
                     pa.array([h] * m, pa.int64()), pa.array([k] * m, b.column("k").type),
                     pa.array([r] * m, pa.int64()), pa.array([i] * m, pa.int32())],
                    ["x", "place", "own", "h", "k", "r", "i"])

    kind = texts.schema["k"].dataType.simpleString()
    todo = able.groupBy("h").agg(F.collect_set(F.struct("q", "kind")).alias("todo"))  # at most 3 for a piece
    return (texts.join(todo, "h").select("h", "k", "r", "i", "t", "todo")
            .mapInArrow(run, f"x long, place int, own boolean, h long, k {kind}, r long, i int"))


def _without(docs: DataFrame, gone: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with the listed line numbers cut out of ``text``, n_lines and n_dropped appended."""
    plain = docs.drop("n_lines", "n_dropped")
    names = plain.columns
    g = gone.select(F.col("k").alias("__k"), F.col("r").alias("__r"), F.col("gone").alias("__gone"))
    d = (plain.withColumn("__h", F.xxhash64(text))
         .join(g, F.expr(f"__h = __r AND `{key}` <=> __k"), "left")
         .drop("__h", "__k", "__r"))
    at = names.index(text)

    def run(batches):
        for b in slices(batches):
            out, n, cut = [], [], []
            for t, drop in zip(b.column(at).to_pylist(), b.column("__gone").to_pylist()):
                lines = t.split("\n") if t is not None else []
                drop = set(drop or ())
                n.append(sum(1 for x in lines if x.strip(_BLANKS)))
                cut.append(len(drop))
                out.append(t if not drop else "\n".join([x for i, x in enumerate(lines) if i not in drop]))
            cols = b.columns[:-1]
            cols[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(cut, pa.int64())],
                                             [*names, "n_lines", "n_dropped"])

    return d.mapInArrow(run, plain.schema.add("n_lines", "long").add("n_dropped", "long"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_fuzzy: int = MIN_FUZZY) -> DataFrame:
    """The input's columns with ``text`` less its removed lines, plus n_lines and n_dropped."""
    lines = _occurrences(docs, key, text)
    fuzzy = F.char_length("t") >= min_fuzzy
    # hashes only: occurrences, and for each distinct text its half keys
    occ = stage(lines.select("k", "r", "i", F.xxhash64("t").alias("h"), F.xxhash64(F.lit(7), "t").alias("h2"),
                             F.when(fuzzy, _halves(F.col("t"))).alias("halves")), "line-occurrences")
    first = stage(occ.groupBy("h", "h2").agg(F.min(F.struct("k", "r", "i")).alias("f"),
                                             F.first("halves").alias("halves")), "line-first")
    keys = first.where("halves is not null").select("h", F.explode("halves").alias("x"))
    shared = keys.groupBy("x").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").select("x")
    able = stage(keys.join(shared, "x").select("h").distinct().join(first.drop("halves"), "h")
                 .select("h", "f.k", "f.r", "f.i"), "line-candidates")
    per_doc = able.groupBy("k", "r").agg(F.collect_list(F.struct("i", "h")).alias("_c"))
    texts = (docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.xxhash64(text).alias("_r"))
             # merged at every size: a list small enough to broadcast here is not so on a larger corpus
             .join(per_doc.hint("merge"), F.expr("_r = r AND _k <=> k"))
             .select("k", "r", F.split("_t", "\n").alias("_l"), F.explode("_c").alias("_x"))
             .select("k", "r", "_x.i", "_x.h", F.btrim(F.get("_l", F.col("_x.i")), F.lit(_BLANKS)).alias("t"))
             .dropDuplicates(["h"]))
    texts = stage(texts, "line-texts")
    v = stage(_variants(texts, _able(texts)), "line-variants").withColumn("f", F.struct("k", "r", "i", "h"))
    # within a key: the same place of deletion, or (place -1) a variant against the text itself
    v = v.select("x", "h", "f", "place", "own")
    low = (v.groupBy("x", "place").agg(
        F.min("f").alias("any"), F.min(F.when(F.col("own"), F.col("f"))).alias("whole"),
        F.min(F.when(~F.col("own"), F.col("f"))).alias("part"), F.min("h").alias("a"), F.max("h").alias("b"))
        .where("a <> b").select("x", "place", "any", "whole", "part"))
    partner = F.when(F.col("place") >= 0, F.col("any")).when(F.col("own"), F.col("part")).otherwise(F.col("whole"))
    pairs = (v.join(low, ["x", "place"]).select("h", "f", partner.alias("p")).where("p is not null and p < f")
             .select("h", F.col("p.h").alias("g")).distinct())
    t = texts.select("h", "t")
    near = (pairs.join(t, "h").join(t.select(F.col("h").alias("g"), F.col("t").alias("u")), "g")
            .where((F.levenshtein("t", "u", 1) >= 0)).select("h").distinct().withColumn("near", F.lit(True)))
    near = stage(near, "line-near")
    verdict = first.select("h", "h2", "f").join(near, "h", "left")
    gone = (occ.select("k", "r", "i", "h", "h2").join(verdict, ["h", "h2"])
            .where(F.coalesce("near", F.lit(False)) | ~F.struct("k", "r", "i").eqNullSafe(F.col("f")))
            .groupBy("k", "r").agg(F.collect_set("i").alias("gone")))
    return _without(docs, gone, key, text)
