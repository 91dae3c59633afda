"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions.

The ring is cut into cells.  A row's cell comes from its id, and the first
virtual node clockwise names its home shard.  Each shard first takes the rows
of its own arcs up to its bound; what a full shard cannot take continues
clockwise to the next virtual node whose shard has room.  Bounds are the exact
share of the row count, so shard sizes differ by one row at most.

Only the counts of the cells reach the driver, and their number is a
parameter; rows learn their shard and slot from their rank within their cell.
"""

from __future__ import annotations

import bisect
import hashlib
import json
from itertools import groupby

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Cells of the ring: three hexadecimal digits of the id's MD5.
RING_CELLS = 4096
#: Parts of a cell, by the text's hash, so that an id of very many rows is not ranked in one task.
CELL_PARTS = 8
VIRTUAL_NODES = 128


def ring(n_shards: int, virtual_nodes: int = VIRTUAL_NODES, cells: int = RING_CELLS) -> list[tuple[int, int]]:
    """``(position, shard)`` of every virtual node in ring order; adding a shard only adds nodes."""
    def position(shard: int, node: int) -> int:
        digest = hashlib.md5(f"shard-{shard}-node-{node}".encode()).digest()
        return int.from_bytes(digest[:8], "big") * cells >> 64

    return sorted((position(s, v), s) for s in range(n_shards) for v in range(virtual_nodes))


def bounds(total: int, n_shards: int) -> list[int]:
    """Rows that each shard holds: equal but for one."""
    return [total // n_shards + (s < total % n_shards) for s in range(n_shards)]


def place(counts: dict[tuple[int, int], int], n_shards: int, nodes: list[tuple[int, int]]) -> list[tuple]:
    """Pieces ``(cell, part, lo, hi, shard, slot)``: ranks lo..hi-1 of a cell part get slots from ``slot`` on."""
    room = bounds(sum(counts.values()), n_shards)
    used = [0] * n_shards
    positions = [p for p, _ in nodes]
    pieces, overflow = [], []

    def give(cell, part, lo, shard, want):
        n = min(want, room[shard])
        if n:
            pieces.append((cell, part, lo, lo + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return n

    for cell, group in groupby(sorted(counts), key=lambda k: k[0]):
        home = bisect.bisect_left(positions, cell) % len(nodes)
        for _, part in group:
            n = counts[cell, part]
            done = give(cell, part, 0, nodes[home][1], n)
            if done < n:
                overflow.append((cell, part, done, n, home))
    for cell, part, lo, n, home in overflow:
        step = home
        while lo < n:
            step = (step + 1) % len(nodes)
            lo += give(cell, part, lo, nodes[step][1], n - lo)
    return pieces


def shard_rows(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs(doc_id, text)``.

    Size is the UTF-8 length of the text (null: none) plus 1.  The law is
    ``rows``: counts differ by one at most, and slots of a shard run from 0
    without gaps.  Null ids share one cell; repeated rows are separate rows of
    the same cell, and which of two equal rows comes first makes no difference.
    ``grown_shard`` is null under this law.  Other columns are not carried.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).select(
        "*",
        F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 3), 16, 10)
        .cast("int")
        .alias("cell"),
        F.pmod("text_crc32", F.lit(CELL_PARTS)).cast("int").alias("part"),
    )
    counts = {(r["cell"], r["part"]): r["count"] for r in rows.groupBy("cell", "part").count().collect()}
    pieces = place(counts, n_shards, ring(n_shards))
    plan = spark.range(1).select(
        F.inline(
            F.from_json(
                F.lit(json.dumps([dict(zip(("cell", "part", "lo", "hi", "shard", "base"), p)) for p in pieces])),
                "array<struct<cell int, part int, lo long, hi long, shard int, base long>>",
            )
        )
    )
    order = Window.partitionBy("cell", "part").orderBy("doc_id", "size", "text_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("long") - 1)
    # at most RING_CELLS * CELL_PARTS pieces and one more for each full shard: broadcast
    return (
        ranked.join(F.broadcast(plan), ["cell", "part"])
        .where("rank >= lo and rank < hi")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
