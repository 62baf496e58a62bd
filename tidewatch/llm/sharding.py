"""Shards of near equal bytes by Karmarkar-Karp differencing (operator 6).

Rows with equal texts form a group that stays in one shard.  The differencing
method combines the two partial partitions with the largest spread, heaviest
part with lightest, until one is left.  It runs on at most ``CELL_GROUPS``
pieces at a time: where there are more, they are dealt by hash into cells, each
cell is packed by the method into ``PACK`` parts, and the parts are the pieces
of the next level, until one cell is left; that one is parted into the shards.
A large group fills a part of its own all the way up, and a bounded share of the
groups skips the cells: these small pieces even out the last one.  The driver
only steers; sums and assignments stay in tables.

Defined results: null text counts as empty (size 1) and groups with empty
texts.  Null or repeated keys are rows like others.  An empty table gives no
rows.  A group larger than a shard's share cannot be split; the rest is then
balanced around it.
"""
from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import stage

CELL_GROUPS = 4_096
PACK = 64


def differencing(sums: list[list[int]], k: int) -> list[list[int]]:
    """For partial partitions (k sums each): slot of the result that each one's slot goes to."""
    members: list[list[tuple[int, int]]] = []  # per result slot, (partition, slot)
    heap = []
    for i, s in enumerate(sums):
        order = sorted(range(k), key=lambda j: (-s[j], j))
        heap.append((s[order[-1]] - s[order[0]], i, [s[j] for j in order], [[(i, j)] for j in order]))
    heapq.heapify(heap)
    n = len(sums)
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)  # largest spread first: the key is lightest - heaviest
        _, _, b, y = heapq.heappop(heap)
        parts = []
        for j in range(k):
            p, q = x[j], y[k - 1 - j]
            if len(p) < len(q):
                p, q = q, p
            p.extend(q)
            parts.append((a[j] + b[k - 1 - j], j, p))
        parts.sort(key=lambda t: (-t[0], t[1]))
        n += 1
        heapq.heappush(heap, (parts[-1][0] - parts[0][0], n, [t[0] for t in parts], [t[2] for t in parts]))
    members = heap[0][3] if heap else [[] for _ in range(k)]
    out = [[0] * k for _ in sums]
    for slot, m in enumerate(members):
        for i, j in m:
            out[i][j] = slot
    return out


def _pack(pieces: DataFrame, k: int) -> DataFrame:
    """(piece, parent, bytes): each cell's pieces parted into k by the method; parents are numbered by cell."""
    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bytes", "piece"], ascending=[False, True])
        got = differencing([[int(b)] + [0] * (k - 1) for b in rows["bytes"]], k)
        return rows.assign(parent=rows["cell"] * k + [g[0] for g in got])[["piece", "parent", "bytes"]]

    return pieces.groupBy("cell").applyInPandas(solve, "piece long, parent long, bytes long")


def _place(groups: DataFrame, k: int) -> DataFrame:
    """(piece, shard) of every group."""
    pieces, n = groups.select("piece", "bytes"), groups.count()
    loose, of = None, None
    if n > CELL_GROUPS:
        share = F.pmod(F.col("piece"), F.lit(-(-2 * n // CELL_GROUPS))) == 0  # about CELL_GROUPS / 2 of them
        loose, pieces = pieces.where(share), pieces.where(~share)
    while n > CELL_GROUPS:
        cells = -(-n // CELL_GROUPS)
        up = stage(_pack(pieces.withColumn("cell", F.pmod(F.xxhash64("piece"), F.lit(cells))), PACK), "shard-cells")
        of = up.select("piece", "parent") if of is None else stage(
            of.join(up.select(F.col("piece").alias("parent"), F.col("parent").alias("next")), "parent")
            .select("piece", F.col("next").alias("parent")), "shard-level")
        pieces, n = up.groupBy(F.col("parent").alias("piece")).agg(F.sum("bytes").alias("bytes")), cells * PACK
    # parents are small numbers, groups' names hashes: kept apart by a mark
    last = pieces.withColumn("group", F.lit(of is None))
    if loose is not None:
        last = last.unionAll(loose.withColumn("group", F.lit(True)))
    last = stage(last.withColumn("id", F.xxhash64("piece", "group")), "shard-last")
    done = stage(_pack(last.select(F.col("id").alias("piece"), "bytes", F.lit(0).cast("long").alias("cell")), k), "shard-top")
    done = last.join(done.select(F.col("piece").alias("id"), F.col("parent").cast("int").alias("shard")), "id")
    out = done.where("group").select("piece", "shard")
    if of is not None:
        out = out.unionAll(of.join(done.where("not group").select(F.col("piece").alias("parent"), "shard"), "parent")
                           .select("piece", "shard"))
    return out


def by_bytes(docs: DataFrame, n_shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot) of every row; texts are not shuffled."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key), (F.octet_length(raw) + 1).cast("long").alias("s"), F.crc32(raw).alias("c"),
                       F.xxhash64(raw).alias("h"))
    rows = stage(rows, "shard-rows")
    groups = rows.groupBy("h", "c", "s").agg(F.sum("s").alias("bytes"))
    groups = stage(groups.withColumn("piece", F.xxhash64("h", "c", "s")), "shard-groups")
    where = _place(groups.groupBy("piece").agg(F.sum("bytes").alias("bytes")), n_shards)
    parts = groups.select("h", "c", "s", "piece").join(where, "piece")
    placed = stage(rows.join(parts.drop("piece"), ["h", "c", "s"])
                   .select(key, F.col("s").alias("size"), F.col("c").alias("text_crc32"), "shard", "h"), "shard-placed")
    # slots: rank within a bounded chunk, after the rows of the shard's earlier chunks
    n_chunks = max(1, placed.count() // (n_shards * 4_096))
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64(key, "h"), F.lit(n_chunks)))
    before = (placed.groupBy("shard", "chunk").count()
              .withColumn("before", F.sum("count").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("count")))
    rank = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy(key, "h"))
    return (placed.withColumn("rank", rank).join(before.drop("count"), ["shard", "chunk"])
            .select(key, "size", "text_crc32", "shard", (F.col("before") + F.col("rank") - 1).cast("long").alias("slot")))
