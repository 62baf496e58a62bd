"""Stored keyed folders: batches, snapshots and the manifest that names them.

A store is a folder with one sub-folder per micro-batch (``batch_id=N``), and
beside it ``<folder>_snapshots/upto=N`` with the latest version of every key up
to batch N.  ``_manifests`` holds one small JSON file per state of the store:
which snapshot and which later batches belong to it.  A state takes effect by
one rename that fails if the number is taken, so readers see the state before
or after it and two writers cannot both succeed; whatever no manifest names (a
batch or snapshot that is being written, or was left by a crash) is not read.

``compact`` writes the snapshot in key order over ranges, and describes its
files in ``<folder>_files``: the least and greatest value of ordered columns,
and for keyword columns which values a file holds.  A lookup picks its files
from these tables before any file is opened; inside them Parquet statistics and
bloom filters skip row groups.  What is kept on the driver is a list of files,
never rows.

``clean`` first forgets old manifests and then removes only folders that none
of those left names; it may stop at any point and be run again.
"""
from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.operators.merge import snapshot_path
from tidewatch.operators.topk import latest_per_key

BATCH = "batch_id"


@dataclass(frozen=True)
class Manifest:
    """One state of a store: the snapshot's batch (or None) and the batches after it."""
    version: int = 0
    upto: int | None = None
    batches: tuple[int, ...] = ()

    def holds(self, batch_id: int) -> bool:
        return batch_id in self.batches or (self.upto is not None and batch_id <= self.upto)


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, p = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _files(spark, path)
    fs.delete(p, True)


def _manifests(path: str) -> str:
    return f"{path.rstrip('/')}/_manifests"


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in children(spark, _manifests(path)) if re.fullmatch(r"\d{12}\.json", n))


def _read_manifest(spark: SparkSession, path: str, version: int) -> Manifest:
    fs, p = _files(spark, f"{_manifests(path)}/{version:012d}.json")
    stream = fs.open(p)
    try:
        d = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Manifest(d["version"], d["upto"], tuple(d["batches"]))


def current(spark: SparkSession, path: str) -> Manifest | None:
    """The newest state, or None for a folder without a manifest."""
    v = _versions(spark, path)
    return _read_manifest(spark, path, v[-1]) if v else None


def commit(spark: SparkSession, path: str, m: Manifest) -> None:
    """Publish a state.  Raises if its version exists: another writer was first."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, target = _files(spark, f"{_manifests(path)}/{m.version:012d}.json")
    _, draft = _files(spark, f"{_manifests(path)}/.{m.version}-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(asdict(m)).encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(rename, 1)
    how[0] = rename.NONE  # never over an existing file
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, how)
    except Exception:
        fs.delete(draft, False)
        raise


def write_batch(df: DataFrame, path: str, batch_id: int, sort_by: list[str] | None = None) -> bool:
    """Write one batch and name it.  A batch that is named already is left alone
    (a replay after a crash repeats it); one that is not is written anew."""
    spark, batch_id = df.sparkSession, int(batch_id)
    m = current(spark, path) or Manifest()
    if m.holds(batch_id):
        return False
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")
    commit(spark, path, Manifest(m.version + 1, m.upto, tuple(sorted((*m.batches, batch_id)))))
    return True


def _read(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    return spark.read.option("basePath", base).parquet(*paths).withColumn(BATCH, F.col(BATCH).cast("long"))


def read_batches(spark: SparkSession, path: str, m: Manifest | None) -> DataFrame | None:
    """Rows of the batches after the snapshot; without a manifest, of every batch."""
    if m is None:
        return spark.read.parquet(path).withColumn(BATCH, F.col(BATCH).cast("long"))
    base = path.rstrip("/")
    return _read(spark, base, [f"{base}/{BATCH}={b}" for b in m.batches]) if m.batches else None


def read_snapshot(spark: SparkSession, path: str, m: Manifest | None, files: list[str] | None = None) -> DataFrame | None:
    """Rows of the snapshot, of the given files only if there are any given."""
    if m is None or m.upto is None:
        return None
    folder = snapshot_path(path, m.upto)
    return _read(spark, folder, [folder] if files is None else files) if files is None or files else None


def _union(parts: list[DataFrame | None]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [p for p in parts if p is not None])


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every version that the newest state names."""
    m = current(spark, path)
    return _union([read_snapshot(spark, path, m), read_batches(spark, path, m)])


def latest(spark: SparkSession, path: str, key: str, order: list[str]) -> DataFrame:
    """The newest version of every key: read cost is the snapshot and the batches after it."""
    return latest_per_key(read(spark, path), key, order)


def compact(spark: SparkSession, path: str, key: str, order: list[str], layout: list[str] | None = None,
            zones: list[str] = (), keywords: list[str] = (), bloom: list[str] = (), files: int | None = None) -> Manifest:
    """Fold all named batches into a new snapshot in the order of ``layout``
    (default: the key), describe its files, and name it in place of them."""
    m = current(spark, path)
    if m is None or not m.batches:
        return m or Manifest()
    top, target = m.batches[-1], snapshot_path(path, m.batches[-1])
    layout = layout or [key]
    parts = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = (latest(spark, path, key, order).withColumn(BATCH, F.lit(top).cast("long"))
         .repartitionByRange(parts, *layout).sortWithinPartitions(*layout).write.mode("overwrite").partitionBy(BATCH))
    for c in (*keywords, *bloom):
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(target)
    _describe(spark, path, top, zones or layout, keywords)
    done = Manifest(m.version + 1, top, ())
    commit(spark, path, done)
    return done


def _tables(path: str, upto: int) -> str:
    return f"{path.rstrip('/')}_files/upto={upto}"


def _describe(spark: SparkSession, path: str, upto: int, zones: list[str], keywords: list[str]) -> None:
    d = spark.read.parquet(snapshot_path(path, upto)).withColumn("file", F.col("_metadata.file_path"))
    bounds = [f(c).alias(f"{n}_{c}") for c in zones for n, f in (("least", F.min), ("most", F.max))]
    d.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *bounds).write.mode("overwrite").parquet(f"{_tables(path, upto)}/zones")
    if keywords:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in keywords]))
        (d.select("file", pairs.alias("p")).select("p.field", "p.value", "file").distinct()
         .repartitionByRange("field", "value", "file").sortWithinPartitions("field", "value")
         .write.mode("overwrite").parquet(f"{_tables(path, upto)}/postings"))


def pick_files(spark: SparkSession, path: str, m: Manifest | None, zones: Column | None = None,
               keywords: dict[str, list] | None = None) -> list[str] | None:
    """Snapshot files that can hold a match.  ``zones`` is a condition on the
    columns least_x and most_x, ``keywords`` gives the wanted values per column."""
    if m is None or m.upto is None:
        return None
    d = spark.read.parquet(f"{_tables(path, m.upto)}/zones")
    if zones is not None:
        d = d.where(zones)
    d = d.select("file")
    for field, values in (keywords or {}).items():
        p = spark.read.parquet(f"{_tables(path, m.upto)}/postings")
        d = d.join(p.where((F.col("field") == field) & F.col("value").isin([str(v) for v in values])).select("file"), "file", "semi")
    return sorted(r.file for r in d.collect())


def clean(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Forget all but the newest ``keep`` manifests, then remove folders that none
    of them names.  Younger batches and snapshots, which may be in writing, stay."""
    versions = _versions(spark, path)
    left = [_read_manifest(spark, path, v) for v in versions[-keep:]]
    if not left or left[-1].upto is None:
        return []
    for v in versions[:-keep]:
        _delete(spark, f"{_manifests(path)}/{v:012d}.json")
    oldest = min((m.upto if m.upto is not None else -1) for m in left)
    named, gone = {b for m in left for b in m.batches}, []
    for name in children(spark, path):
        if (got := re.fullmatch(rf"{BATCH}=(\d+)", name)) and int(got[1]) <= oldest and int(got[1]) not in named:
            gone.append(f"{path.rstrip('/')}/{name}")
    snaps = {m.upto for m in left}
    for base in (f"{path.rstrip('/')}_snapshots", f"{path.rstrip('/')}_files"):
        for name in children(spark, base):
            if (got := re.fullmatch(r"upto=(\d+)", name)) and int(got[1]) < left[-1].upto and int(got[1]) not in snaps:
                gone.append(f"{base}/{name}")
    for folder in gone:
        _delete(spark, folder)
    return gone
