"""Mixing sources to target weights (operator 11).

Sources in code point order (null last) weigh 5, 2, 1, repeating, and share all
words by weight.  A target stops at ``MAX_RATE`` times its source's words; the
excess goes to the others by weight until none is above.  With every target
below its cap equal to ``share * weight``, that is one number: each round sums
the caps already reached and the weights left, which raises the share, until no
more caps are reached.  Sums are whole numbers, so the rounds are exact.

A source's repetition rate is target / words.  Each document is taken
floor(rate) times, plus one copy if its hash-seeded draw, uniform in [0, 1), is
below the fraction.  A document has ``DRAWS`` draws, cut from SHA-256 digests of
its key; one aggregate sums what each of them would take, and a source uses the
draw that comes nearest its target (ties: the first).  So long documents leave
small sources near their target too, and reruns agree.

Words are summed per source before any shuffle; the rates join by source, of
which Spark broadcasts or merges by measured size.  Sources are ranked in range
partitions, so their number is not bound to one task.

Defined results: null or empty text has 0 words.  A null source is a source.
Documents with equal keys draw alike; without a key the text's digest seeds.  A
source without words has target 0 and its documents are taken 0 times.  Input
columns named size, source_size, target, rate, copies or copy are replaced.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.llm.common import stage

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
DRAWS = 16
_SPACES = " \t\n\x0b\x0c\r"
_OWN = ["size", "source_size", "target", "rate", "copies", "copy"]


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACES))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, "[\\x20\\x09-\\x0D]+"))).cast("long")


def _seed(key: str, text: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.md5(F.col(text).cast("binary")), F.lit(""))


def draws(seed: Column) -> list[Column]:
    """``DRAWS`` numbers in [0, 1): 32 bits each of SHA-256 digests of the seed."""
    out = []
    for d in range(-(-DRAWS // 8)):
        digest = F.sha2(F.concat(F.lit(f"mix:{d}:"), seed).cast("binary"), 256)
        out += [F.conv(F.substring(digest, 8 * j + 1, 8), 16, 10).cast("double") / 4294967296.0 for j in range(8)]
    return out[:DRAWS]


def _weighed(sources: DataFrame) -> DataFrame:
    """(src, words, weight): rank by code point through range partitions and their offsets."""
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = stage(sources.repartitionByRange(parts, F.col("src").asc_nulls_last())
              .withColumn("part", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offset = s.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("src").asc_nulls_last())) - 1
    rank = F.col("before") + F.col("place")
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), (rank % len(WEIGHTS)).cast("int"))
    return s.withColumn("place", place).join(offset, "part").select("src", "words", weight.cast("long").alias("weight"))


def _share(s: DataFrame) -> tuple[int, int]:
    """Words for one unit of weight below the cap, as numerator and denominator."""
    total, weights = (int(x or 0) for x in s.agg(F.sum("words"), F.sum("weight")).first())
    num, den = total, max(weights, 1)
    while True:
        capped = _at_cap(num, den)
        cap, left = (int(x or 0) for x in s.agg(
            F.sum(F.when(capped, MAX_RATE * F.col("words")).cast("decimal(38,0)")),
            F.sum(F.when(~capped, F.col("weight")))).first())
        if not left or (total - cap, left) == (num, den):
            return num, den
        num, den = total - cap, left


def _at_cap(num: int, den: int) -> Column:
    big = "decimal(38,0)"
    return (MAX_RATE * F.col("words")).cast(big) * F.lit(den).cast("decimal(19,0)") < (
        F.lit(num).cast("decimal(19,0)") * F.col("weight").cast("decimal(10,0)"))


def rates(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per source: src, source_size, target, rate and ``draw``, the draw its documents use."""
    sizes = stage(docs.select(F.col(source).alias("src"), word_count(F.col(text)).alias("size"),
                              _seed(key, text).alias("seed")), "mix-sizes")
    s = stage(_weighed(sizes.groupBy("src").agg(F.sum("size").alias("words"))), "mix-weights")
    num, den = _share(s)
    target = (F.when(_at_cap(num, den), (MAX_RATE * F.col("words")).cast("double"))
              .otherwise(F.lit(float(num)) * F.col("weight").cast("double") / F.lit(float(den))))
    rate = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(0.0)
    s = (s.withColumn("target", target).withColumn("rate", rate)
         .select("src", F.col("words").alias("source_size"), "target", "rate"))
    s = stage(s, "mix-targets")
    part = F.col("rate") - F.floor("rate")
    d = sizes.join(s.withColumnRenamed("src", "_src"), F.expr("src <=> _src"))
    sums = d.groupBy("src").agg(*[F.sum(F.when(u < part, F.col("size")).otherwise(0)).alias(f"d{j}")
                                  for j, u in enumerate(draws(F.col("seed")))])
    sums = sums.withColumnRenamed("src", "_src")
    miss = F.array(*[F.struct(F.abs(F.floor("rate") * F.col("source_size") + F.col(f"d{j}") - F.col("target")).alias("m"),
                              F.lit(j).alias("draw")) for j in range(DRAWS)])
    return stage(s.join(sums, F.expr("src <=> _src")).select(
        "src", "source_size", "target", "rate", F.array_min(miss)["draw"].alias("draw")), "mix-rates")


def plan(docs: DataFrame, table: DataFrame, key: str = "doc_id", text: str = "text",
         source: str = "source") -> DataFrame:
    """The input's columns with size, source_size, target, rate and copies of every document."""
    plain = docs.drop(*_OWN)
    t = table.select(F.col("src").alias("__src"), F.col("draw").alias("__draw"), "source_size", "target", "rate")
    d = plain.withColumn("size", word_count(F.col(text))).join(t, F.expr(f"`{source}` <=> __src"))
    u = F.get(F.array(*draws(_seed(key, text))), F.col("__draw"))
    copies = F.floor("rate") + F.when(u < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return d.select(*plain.columns, "size", "source_size", "target", "rate", copies.cast("int").alias("copies"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed corpus: each document ``copies`` times, numbered by ``copy`` from 1."""
    d = plan(docs, rates(docs, key, text, source), key, text, source).where("copies > 0")
    return d.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
