"""Deduplication by payload fingerprint.

Streaming: event-time watermark + ``dropDuplicatesWithinWatermark`` keeps the
state bounded (one short hash per key, expired by the watermark).
Batch: ``dropDuplicatesWithinWatermark`` is rejected on batch frames, and plain
``dropDuplicates`` keeps an arbitrary row, so batch keeps the *earliest*
arrival per key: ``groupBy(key).agg(min(struct(time, ...)))`` — partial
aggregation before the shuffle (re-sent copies collapse map-side), and the
key is a hash, so a hot device is never a hot key.

``payload_determined=True`` groups by every column instead (a hash aggregate,
valid only when all columns are parsed from the fingerprinted payload).  It
is not the default: filters on values computed *after* dedup (predicted
class, binary flag) then reference only grouping keys, Catalyst pushes them
below the aggregate and inlines the whole parse -> transform -> score chain
into the filter condition several times over.  The struct aggregate keeps
those filters above the dedup.

``first_copies`` dedups wide rows of files: only fingerprints and the rows'
places are shuffled, some 30 bytes a row whatever its width; the rows that stay
are then read again, which shuffles nothing.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.schema import DEDUP_DELAY
from tidewatch.session import release_shuffles


def dedup_by_key(df: DataFrame, key: str = "row_hash", time_col: str = "kafka_timestamp",
                 delay: str = DEDUP_DELAY, payload_determined: bool = False, salts: int = 0) -> DataFrame:
    """``salts`` (streams): copies of one payload first meet in so many parts of
    its own, dealt by arrival time, and then once more; a payload that is sent
    very often does not pass through one task.  Copies further apart than the
    delay may be kept in either form, in the salted one rather dropped."""
    if df.isStreaming:
        d = df.withWatermark(time_col, delay)
        if salts:
            salt = F.pmod(F.xxhash64(time_col), F.lit(int(salts))).cast("int")
            d = d.withColumn("_salt", salt).dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
        return d.dropDuplicatesWithinWatermark([key])
    others = [c for c in df.columns if c not in (key, time_col)]
    if payload_determined:
        return df.groupBy(key, *others).agg(F.min(time_col).alias(time_col)).select(*df.columns)
    first = F.min(F.struct(F.col(time_col), *[F.col(c) for c in others])).alias("_r")
    return (df.groupBy(key).agg(first)
              .select(F.col(f"_r.{time_col}").alias(time_col), F.col(key),
                      *[F.col(f"_r.{c}").alias(c) for c in others])
              .select(*df.columns))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row dedup (= SELECT DISTINCT)."""
    return df.dropDuplicates()


#: bits of a place that count a file's rows; rows in one bitmap (2 ** BITMAP_BITS); rows whose
#: bitmaps, a bit a row, are broadcast at once
ROW_BITS, BITMAP_BITS, ROWS_AT_ONCE = 40, 15, 1 << 28
#: whether the bit of ``_row`` is set in its bitmap
_KEPT = "CAST(conv(hex(substring(bits, CAST(_row >> 3 & {bytes} AS INT) + 1, 1)), 16, 10) AS INT) >> CAST(_row & 7 AS INT) & 1 = 1"


def in_files(df: DataFrame, path: str) -> DataFrame:
    """``df`` if all it does is project and filter the rows of Parquet files, so that
    a row has the same place (``_metadata``) each time; else its rows, written to ``path``."""
    plan = node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    if plan.deterministic() and node.nodeName() == "LogicalRelation":
        relation = node.relation()
        if relation.getClass().getSimpleName() == "HadoopFsRelation" and relation.fileFormat().toString() == "Parquet":
            return df
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def first_copies(df: DataFrame, key: Column, path: str, time_col: str | None = None) -> Iterator[DataFrame]:
    """One row of ``df`` (``in_files``) per ``key``, its earliest copy by ``time_col``
    if given, as frames over whole files of about ``ROWS_AT_ONCE`` rows.

    The key and the place of every row meet in one aggregate; the places of first
    copies become bitmaps in ``path``, by which the rows are picked where they are
    read, before anything is computed from them.  A repeated task picks the same rows."""
    spark = df.sparkSession
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("_file").agg((F.max("_row") + 1).alias("rows")).orderBy("_file").collect()  # a row per file
    files = pa.table({"_file": pa.array([r["_file"] for r in sizes], pa.string()), "_no": pa.array(range(len(sizes)), pa.int64())})
    files = F.broadcast(spark.createDataFrame(files))
    place = F.shiftleft("_no", ROW_BITS).bitwiseOR(F.col("_row"))
    if time_col:
        place = F.struct(F.col(time_col).isNull().alias("unknown"), F.col(time_col).alias("time"), place.alias("place"))
    first = placed.join(files, "_file").select(key.alias("k"), place.alias("p")).groupBy("k").agg(F.min("p").alias("p"))
    at = F.col("p.place" if time_col else "p")
    (first.select(at.alias("at")).groupBy(F.shiftright("at", BITMAP_BITS).alias("map"))
     .agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))).alias("bits")).write.parquet(path))
    release_shuffles(spark)
    per_file = ROW_BITS - BITMAP_BITS
    maps = (spark.read.parquet(path).join(files, F.shiftright("map", per_file) == F.col("_no"))
            .select(F.col("_file").alias("file"), F.col("map").bitwiseAND(F.lit((1 << per_file) - 1)).alias("map"), "bits"))
    rounds, n = [[]], 0
    for r in sizes:
        if rounds[-1] and n + r["rows"] > ROWS_AT_ONCE:
            rounds, n = rounds + [[]], 0
        rounds[-1].append(r["_file"])
        n += r["rows"]
    kept = (F.col("_file") == F.col("file")) & (F.shiftright("_row", BITMAP_BITS) == F.col("map")) \
        & F.expr(_KEPT.format(bytes=(1 << BITMAP_BITS - 3) - 1))
    for some in rounds:
        rows, bits = (placed, maps) if len(rounds) == 1 else (placed.where(F.col("_file").isin(some)), maps.where(F.col("file").isin(some)))
        yield rows.join(F.broadcast(bits), kept, "leftsemi").drop("_file", "_row")
