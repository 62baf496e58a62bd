"""Quality rules (operator 2), DataFrame functions only.

Base rules look at a text's words, ``[^\\x20\\x09-\\x0D]+``.  The verdict is a
hashed n-gram log-likelihood ratio: single words and word pairs are hashed into
``n_buckets``; two multinomials, of the trusted target texts and of the whole
raw corpus, give each bucket the log ratio of its probabilities; a text's score
is the mean over its grams, and texts under the threshold go.

Counts of the raw corpus cover every row, those of the target every trusted
row: a mark table of fixed size leaves out texts that are not, then a merge join
on the ids decides.  No other text moves; the table of ratios has ``n_buckets``
numbers.

Defined results: null and empty texts have no words, score 0 and fail the base
rules.  Without trusted rows every ratio is 0 and the base rules decide.
Repeated rows are judged alike.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import stage

WINDOW = 8
_SPACES = "[\\x20\\x09-\\x0D]+"


def _words(d: DataFrame, text: Column, *keep) -> DataFrame:
    """``_w``: the words of a text, none for null or blank text."""
    d = d.select(*keep, F.split(F.coalesce(text, F.lit("")), _SPACES).alias("_w"))
    # a text that starts or ends with white space has an empty piece there
    edge = (F.get("_w", 0) == "") | (F.element_at("_w", -1) == "")
    return d.withColumn("_w", F.when(edge, F.array_remove("_w", "")).otherwise(F.col("_w")))


def _joined(h: Column, step: int) -> Column:
    """Hash of every element with the one ``step`` behind it."""
    n = F.size(h) - step
    pair = F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b))
    return F.when(n > 0, pair).otherwise(F.array().cast("array<bigint>"))


def _hashes(d: DataFrame) -> DataFrame:
    """``_h1`` words' hashes and ``_h2`` word pairs' hashes in place of ``_w``."""
    d = d.withColumn("_h1", F.transform("_w", lambda w: F.xxhash64(w))).drop("_w")
    return d.withColumn("_h2", _joined(F.col("_h1"), 1))


def base_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ``_h1``, ``_h2``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    body = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(F.col(key), body.alias("_b"))
    d = d.withColumn("_solid", F.regexp_replace("_b", _SPACES, ""))
    d = d.withColumn("_lines", F.filter(F.split("_b", "\n"), lambda x: F.regexp_like(x, F.lit("[^\\x20\\x09-\\x0D]"))))
    d = _words(d, F.col("_b"), key, F.length("_solid").cast("long").alias("word_chars"),
               (F.length("_solid") - F.length(F.regexp_replace("_solid", "[#*$%&|<>]", ""))).cast("long")
               .alias("n_symbols"),
               (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"))
    d = _hashes(d).withColumn("n_words", F.size("_h1").cast("long"))
    d = d.withColumn("_h4", _joined(F.col("_h2"), 2))
    # a window of 8 words that comes twice holds runs of 4 that do; few texts have any
    none = F.array().cast("array<bigint>")
    d = d.withColumn("_h8", F.when(F.size(F.array_distinct("_h4")) < F.size("_h4"), _joined(F.col("_h4"), 4))
                     .otherwise(none)).drop("_h4")
    d = d.withColumn("_at", F.when(
        F.size(F.array_distinct("_h8")) < F.size("_h8"),
        F.sort_array(F.transform("_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))).drop("_h8")
    at = F.col("_at")
    again = F.filter(at, lambda x, k: (F.get(at, k - 1)["h"] == x["h"]).eqNullSafe(True)
                     | (F.get(at, k + 1)["h"] == x["h"]).eqNullSafe(True))
    d = d.withColumn("_starts", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("_at")
    starts = F.col("_starts")
    covered = F.aggregate(
        F.transform(starts, lambda x, k: F.least(F.coalesce(F.get(starts, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return d.withColumn("n_repeat_words", covered).drop("_starts")


def _bucket(h: Column, n_buckets: int) -> Column:
    return F.pmod(h, F.lit(n_buckets)).cast("int")


def _bucket_counts(docs: DataFrame, text: str, n_buckets: int, name: str) -> DataFrame:
    """(b, name): grams of all rows by bucket, summed in each task before the shuffle."""
    d = _hashes(_words(docs, F.col(text))).select(F.explode(F.concat("_h1", "_h2")).alias("h"))
    return d.groupBy(_bucket(F.col("h"), n_buckets).alias("b")).agg(F.count(F.lit(1)).alias(name))


def _bitmap(ids: DataFrame, bits: int) -> DataFrame:
    """One row: ``bits`` marks, 64 to a number, set where an id hashes to."""
    at = ids.select(F.pmod(F.xxhash64("_k"), F.lit(bits)).alias("p"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))
    set_ = at.groupBy(F.shiftright("p", 6).cast("int").alias("w")).agg(F.bit_or(one).alias("m"))
    every = ids.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("w")).join(set_, "w", "left")
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", F.coalesce("m", F.lit(0).cast("long")).alias("m")))),
                                 lambda s: s["m"]).alias("marks"))


def _trusted_texts(docs: DataFrame, trusted: DataFrame, key: str, text: str, bits: int = 1 << 23) -> DataFrame:
    """Rows whose id is trusted.  Marks of a fixed size (1 MB) leave out most of the
    others before the join, which decides; so few texts move, at any size alike."""
    ids = stage(trusted.select(F.col(key).alias("_k")).where("_k is not null").distinct(), "quality-trusted")
    marks = stage(_bitmap(ids, bits), "quality-marks")
    p = F.pmod(F.xxhash64(key), F.lit(bits))
    d = docs.select(key, text).withColumn("_m", marks.scalar())
    word = F.get("_m", F.shiftright(p, 6).cast("int"))
    hit = F.call_function("shiftright", word, (p % 64).cast("int")).bitwiseAND(F.lit(1).cast("long"))
    return d.where(hit == 1).select(key, text).join(ids.hint("merge"), F.col(key) == F.col("_k"), "semi")


def ratios(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", n_buckets: int = 8_192,
           alpha: float = 1.0) -> DataFrame:
    """One row: ``llr``, an array of ``n_buckets`` log ratios (target over raw)."""
    good = _trusted_texts(docs, trusted, key, text)
    d = (_bucket_counts(docs, text, n_buckets, "raw")
         .join(_bucket_counts(good, text, n_buckets, "target"), "b", "left"))
    d = docs.sparkSession.range(n_buckets).select(F.col("id").cast("int").alias("b")).join(d, "b", "left")
    d = stage(d.select("b", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target")),
              "quality-counts")
    sums = d.agg(F.sum("raw").alias("r"), F.sum("target").alias("t")).first()
    a, n = alpha, alpha * n_buckets
    llr = (F.log((F.col("target") + a) / (sums.t + n)) - F.log((F.col("raw") + a) / (sums.r + n))
           if sums.t else F.lit(0.0))
    return stage(d.agg(F.transform(F.array_sort(F.collect_list(F.struct("b", llr.alias("x")))), lambda s: s["x"])
                       .alias("llr")), "quality-ratios")


def judge(docs: DataFrame, table: DataFrame, key: str = "doc_id", text: str = "text", n_buckets: int = 8_192,
          threshold: float = -0.03) -> DataFrame:
    """(key, n_words, base counts, score, base_failed, kept) of every row, in one pass without shuffle."""
    d = base_counts(docs, key, text).withColumn("_llr", table.scalar())
    llr = F.col("_llr")
    total = sum(F.aggregate(h, F.lit(0.0), lambda s, g: s + F.get(llr, _bucket(g, n_buckets))) for h in ("_h1", "_h2"))
    n = F.size("_h1") + F.size("_h2")
    d = d.withColumn("score", F.when(n > 0, total / n).otherwise(0.0)).drop("_h1", "_h2", "_llr")
    d = d.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    d = d.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    # out of a generator: filters on these columns stay above it, and the chain is not worked out again below
    return d.select(F.inline(F.array(F.struct(*d.columns))))
