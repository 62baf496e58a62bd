"""Shared helpers: staging tables, batch iteration, vectorised word hashing."""
from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.session import ensure_checkpoint_dir, scratch_path

#: bytes of text handled at once by the vectorised helpers (one long text may exceed it)
CHUNK_BYTES = 1 << 20


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back:
    the lineage ends there, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


#: session setting: "false" leaves finished steps' shuffle files to the driver's own garbage collections
RELEASE = "spark.tidewatch.releaseShuffles"


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished steps now: it acts
    when the driver's garbage is collected, else much later.

    The events of a finished step hold its plan until all listeners have seen
    them and the next query's, hence the small query; garbage collected before
    that would leave the step's files a step longer."""
    if spark.conf.get(RELEASE, "true").lower() != "true":
        return
    spark.sql("SELECT 1").collect()
    gc.collect()
    try:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    except Py4JJavaError:  # a slow listener: the next release collects what is left
        pass
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slices(batches: Iterable, rows: int = 256) -> Iterator:
    """Batches of few rows, so that Python objects are made for few texts at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def text_chunks(batches: Iterable[pa.RecordBatch], key: str = "doc_id", text: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """(keys, UTF-8 texts) in pieces of about ``limit`` bytes; null text is empty."""
    keys: list = []
    texts: list[bytes] = []
    size = 0
    for b in slices(batches):
        for k, t in zip(b.column(key).to_pylist(), b.column(text).cast(pa.binary()).to_pylist()):
            keys.append(k)
            texts.append(t or b"")
            size += len(texts[-1]) + 1
            if size >= limit:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


# --- hashing of words, [^\x20\x09-\x0D]+, over many texts at once -----------------
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BYTE = np.random.Generator(np.random.PCG64(20240601)).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE_WORD = np.where(_SPACE, _U(0), _BYTE)
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n + 1`` of each."""
    global _pow, _inv
    if len(_pow) <= n:
        m = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 1))
        _pow = np.concatenate([[_U(1)], np.cumprod(np.full(m, _BASE, np.uint64))])
        _inv = np.concatenate([[_U(1)], np.cumprod(np.full(m, _INV, np.uint64))])
    return _pow, _inv


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts in order, and the first word of each
    text as an index (length ``len(texts) + 1``)."""
    data = b" ".join(texts) + b" "
    if lower:
        data = data.translate(_LOWER)
    a = np.frombuffer(data, np.uint8)
    power, inv = powers(len(a))
    space = _SPACE[a]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    total = np.concatenate([[_U(0)], np.cumsum(_BYTE_WORD[a] * power[: len(a)])])
    h = mix((total[end] - total[start]) * inv[start] + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return h, np.searchsorted(start, at)


_STEP = np.array([pow(0xC2B2AE3D27D4EB4F, i + 1, 1 << 64) for i in range(64)], np.uint64)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words (texts' borders not heeded)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = words[:m] * _STEP[0]
    for j in range(1, n):
        out = out + words[j:j + m] * _STEP[j % 64]
    return mix(out + _U(n))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): smallest node reachable over the links.

    Each round hooks every root onto the smallest neighbouring label and
    shortens paths (large-star/small-star), so the number of rounds grows with
    the logarithm of the longest chain.  Rounds end when all links are stars:
    every larger end has one link and is no smaller end.  They are staged in the
    shared folder; hot nodes are met by partial aggregation only.
    """
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = stage(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")

    def stars(x):
        ends = x.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("low")).unionAll(
            x.select("v", F.lit(0), F.lit(1)))
        return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("low").alias("low")).where("up > 1 OR up = 1 AND low = 1").count() == 0

    while not stars(e):
        # large star: every larger neighbour of a node is tied to the node's smallest neighbour
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v"))
        # small star: smaller neighbours and the node itself are tied to the smallest
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").union(low2.select("u", F.col("m").alias("v"))).distinct())
        # no more files than the links ask for, whatever the number of shuffle partitions
        e = stage(small.coalesce(8 + e.count() // 250_000), "cc")
    roots = e.select(F.col("v").alias("u"), "v")
    return e.union(roots).distinct().select(F.col("u").alias("node"), F.col("v").alias("component"))
