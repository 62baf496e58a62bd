"""WARC writing and splittable reading (operator 9).

Writing: each record is one gzip member.  Equal payloads of at least
``min_revisit`` bytes are stored once: the row with the smallest key holds the
response, the others are revisit records that refer to it.  Who is who is
decided on digests alone; payloads are shuffled once, by key.  A task writes
its archives under names of its own and reports them in a manifest table, so
what a lost or repeated task left behind is never read.

Reading: archives are cut into byte ranges.  A task looks for the gzip magic
in its range, takes a candidate for a member only if its first bytes decode to
a WARC header, and owns the records that start inside its range, reading past
the range's end for the last one.

Files are reached through ``pyarrow.fs`` by URI, so the shared folder may be
any store that it knows.

Defined results: a null payload is empty; a null URL is written as a URN of
the key; a null key sorts first and comes back as null.  Each row gives one
record; rows equal in key, URL and payload are written alike, all as the
response if they come first.  An empty table gives no archives and no records.
Extra columns are not read.
"""
from __future__ import annotations

import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm.common import slices, stage
from tidewatch.session import ensure_checkpoint_dir, scratch_path

MAGIC = b"\x1f\x8b\x08"
MIN_REVISIT = 100
ARCHIVE_BYTES = 64 << 20
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space
_DATE = "2024-01-01T00:00:00Z"


def record_id(key, copy: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{key}:{copy}')}>"


def record(key, copy: int, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member.  ``refers_to``: the response's (key, copy) for a revisit, else None."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(key, copy)}", f"WARC-Date: {_DATE}",
            f"WARC-Target-URI: {url if url and not set(url) & set(chr(13) + chr(10)) else f'urn:page:{key}'}",
            f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}", f"X-Payload-Length: {len(payload)}"]
    if key is not None:
        head.append(f"X-Page-Key: {key}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(*refers_to)}"]
        if refers_to[0] is not None:
            head.append(f"X-Refers-To-Key: {refers_to[0]}")
    c = zlib.compressobj(4, zlib.DEFLATED, 31)
    return c.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + c.flush()


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
          min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives under ``path``; returns the manifest (path, bytes) of those that count."""
    raw = F.coalesce(F.col(html), F.lit("")).cast("binary")
    p = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), raw.alias("b"))
    p = p.withColumn("d", F.sha2("b", 256)).withColumn("n", F.octet_length("b")).withColumn("ud", F.xxhash64("u"))
    meta = stage(p.select("k", "ud", "d", "n"), "warc-digests")
    big = meta.where(F.col("n") >= min_revisit)
    first = (big.groupBy("d").agg(F.min(F.struct("k", "ud")).alias("f"), F.count(F.lit(1)).alias("c"))
             .where("c > 1").select("d", F.col("f.k").alias("fk"), F.col("f.ud").alias("fu")))
    # payloads go to the tasks by key; only (digest, first key) of repeated payloads is joined to keys
    who = (big.join(first, "d").groupBy("k", "ud", "d").agg(F.first("fk").alias("fk"), F.first("fu").alias("fu"))
           .select(F.col("k").alias("_k"), F.col("ud").alias("_u"), F.col("d").alias("_d"), "fk", "fu",
                   F.lit(True).alias("again")))
    rows = p.join(who, F.expr("k <=> _k AND ud = _u AND d = _d"), "left")
    kind = pages.schema[key].dataType

    def run(batches):
        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        out, name, size, done = None, "", 0, []
        for b in slices(batches):
            for k, u, ud, payload, d, again, fk, fu in zip(*(b.column(c).to_pylist() for c in
                                                             ("k", "u", "ud", "b", "d", "again", "fk", "fu"))):
                copy = ud & 0xFFFFFFFF
                refers = (fk, fu & 0xFFFFFFFF) if again and (k, ud) != (fk, fu) else None
                if out is None:
                    name = f"{base}/part-{uuid.uuid4().hex}.warc.gz"
                    out, size = store.open_output_stream(name, compression=None), 0
                data = record(k, copy, u, payload, d, refers)
                out.write(data)
                size += len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((name, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()),
                                          pa.array([x[1] for x in done], pa.int64())], ["path", "bytes"])

    return stage(rows.select("k", "u", "ud", "b", "d", "again", "fk", "fu").mapInArrow(run, "path string, bytes long"),
                 "warc-manifest")


def headers(data: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields and the block's place, or None if this is no WARC record."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/1.") or end < 0:
        return None
    try:
        lines = data[:end].decode().split("\r\n")[1:]
    except UnicodeDecodeError:
        return None
    h = dict(x.split(": ", 1) for x in lines if ": " in x)
    return (h, end + 4) if "WARC-Type" in h and "Content-Length" in h else None


class Window:
    """Pieces of a file by place; the last piece read is kept."""

    def __init__(self, f, size: int, piece: int):
        self.f, self.size, self.piece, self.at, self.buf = f, size, piece, 0, b""

    def get(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at``; none only at the end of the file."""
        if not self.at <= at < self.at + len(self.buf):
            self.at, self.buf = at, self.f.read_at(min(self.piece, self.size - at), at) if at < self.size else b""
        return self.buf[at - self.at:at - self.at + n]

    def find(self, start: int, end: int) -> int:
        """Place of the next gzip magic that starts in [start, end), or -1."""
        while start < end:
            self.get(start, 1)
            i = self.buf.find(MAGIC, start - self.at)
            if i >= 0:
                return self.at + i if self.at + i < end else -1
            behind = self.at + len(self.buf)
            if behind >= self.size:
                return -1
            start = max(start + 1, behind - len(MAGIC) + 1)  # the magic may lie across two pieces
            self.at, self.buf = 0, b""
        return -1


def scan(f, start: int, end: int, size: int, piece: int = 1 << 20):
    """Whole members that start in [start, end) of a seekable file: (place, decoded bytes)."""
    window = Window(f, size, piece)
    pos = window.find(start, end)
    while pos >= 0:
        got = _member(window, pos)
        if got is not None:
            yield pos, got[0]
        pos = window.find(pos + 1 if got is None else got[1], end)


def _member(window: Window, pos: int):
    """(decoded bytes, place behind the member) if a whole WARC member starts here, else None."""
    z, out, head = zlib.decompressobj(31), [], b""
    while not z.eof:
        data = window.get(pos, 1 << 15)
        if not data:
            return None  # cut off
        try:
            out.append(z.decompress(data))
        except zlib.error:
            return None
        pos += len(data)
        if len(head) < 7:
            head += out[-1]
            if b"WARC/1."[:len(head)] != head[:7]:
                return None
    whole = b"".join(out)
    return (whole, pos - len(z.unused_data)) if headers(whole) else None


def read(spark: SparkSession, manifest: DataFrame, root: str, split_bytes: int = 4 << 20,
         key_type: str = "long") -> DataFrame:
    """One row for each record: page_id, type, url, refers_to, declared length and digest, payload."""
    ranges = (manifest.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start")))
    # one range for each task at a time; ranges are few bytes, the archives stay where they are
    ranges = ranges.repartition(max(1, min(100_000, ranges.count())), "path", "start")

    def run(batches):
        store, _ = fs.FileSystem.from_uri(root)
        for b in batches:
            for path, size, start in zip(*(b.column(c).to_pylist() for c in ("path", "bytes", "start"))):
                with store.open_input_file(path) as f:
                    rows, held = [], 0
                    for place, data in scan(f, start, min(size, start + split_bytes), size):
                        h, at = headers(data)
                        block = data[at:at + int(h["Content-Length"])]
                        payload = None
                        if h["WARC-Type"] == "response":
                            payload = block[block.find(b"\r\n\r\n") + 4:]
                        rows.append((h.get("X-Page-Key"), h["WARC-Type"], h.get("WARC-Target-URI"),
                                     h.get("X-Refers-To-Key"), int(h["X-Payload-Length"]),
                                     h["WARC-Payload-Digest"].removeprefix("sha256:"), payload, path, place))
                        held += len(data)
                        if held >= 4 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch(rows)

    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string(),
             pa.int64()]
    names = ["page_id", "record_type", "url", "refers_to", "declared_bytes", "declared_digest", "payload", "path", "place"]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    got = ranges.mapInArrow(run, "page_id string, record_type string, url string, refers_to string, "
                                 "declared_bytes long, declared_digest string, payload binary, path string, place long")
    return got.withColumns({"page_id": F.col("page_id").cast(key_type), "refers_to": F.col("refers_to").cast(key_type)})


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
               split_bytes: int = 4 << 20) -> DataFrame:
    """Write all pages, read the archives back."""
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    root = scratch_path(spark, "warc")
    if root.startswith("file:") and "://" not in root:
        root = root.replace("file:", "file://", 1)
    manifest = write(pages, root, key, url, html)
    return read(spark, manifest, root, split_bytes, pages.schema[key].dataType.simpleString())
