"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a 60-bit ring; a row's key is hashed to
the ring and belongs to the next point clockwise.  Loads are bounded: a shard
takes at most its capacity of rows and keys that find it full continue to the
next shard clockwise.  With ``N`` rows and ``S`` shards the first ``N mod S``
shards on the ring may hold ``ceil(N/S)`` and the others ``floor(N/S)``, so the
loads add up to ``N`` and counts differ by one at most (law ``rows``).

All keys between two ring points see the same order of shards, so the walk
needs only the row count of each of the ``S * vnodes`` arcs: a fixed number of
counts (a parameter, not the data's size) is brought to the driver, the walk
runs over them, and its result is a list of at most ``arcs + shards`` pieces
(arc, first rank, shard, first slot).  Rows get their exact rank inside the arc
by a two-level count (small content-hashed bins, then a window inside a bin),
and a broadcast of the pieces turns the rank into shard and slot.  No row
leaves the executors, and no task sees a whole arc or shard.

Movement when a shard is added is limited to the new shard's share, the keys
that its points take over, and the overflow that shifts with them.

Defined results: a null text has size 1 and crc 0; a null id is a key of its
own; rows alike in id and text are interchangeable; an empty table gives an
empty table; fewer rows than shards leave some shards empty.
"""

from __future__ import annotations

import bisect
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinerank.llm.common import empty_frame, maybe_broadcast, written

RING_BITS = 60
#: Rows that one ranking bin should hold.
BIN_ROWS = 2000


def _point(label: str) -> int:
    return int.from_bytes(hashlib.md5(label.encode()).digest()[:8], "big") >> (64 - RING_BITS)


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(point, shard) in ring order."""
    return sorted((_point(f"shard-{s}/{v}"), s) for s in range(shards) for v in range(vnodes))


def walk(counts: dict[int, int], points: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Pieces (arc, first rank, shard, first slot) of the bounded-load walk.

    Arc ``i`` holds the keys whose next point is ``points[i]``; arcs are taken in
    ring order, the rows of an arc in rank order.
    """
    n = sum(counts.values())
    order = list(dict.fromkeys(s for _, s in points))
    room = {s: n // shards + (i < n % shards) for i, s in enumerate(order)}
    load = dict.fromkeys(range(shards), 0)
    pieces = []
    for arc in range(len(points)):
        left, rank, at = counts.get(arc, 0), 0, arc
        while left:
            s = points[at % len(points)][1]
            take = min(left, room[s] - load[s])
            if take:
                pieces.append((arc, rank, s, load[s]))
                load[s] += take
                rank, left = rank + take, left - take
            at += 1
    return pieces


def ring_shards(docs: DataFrame, shards: int = 16, vnodes: int = 64) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``."""
    if shards < 1 or vnodes < 1:
        raise ValueError("shards and vnodes must be at least 1")
    spark: SparkSession = docs.sparkSession
    points = ring(shards, vnodes)
    text = F.col("text").cast("string")
    d = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    h = F.conv(F.substring(F.md5(key), 1, RING_BITS // 4), 16, 10).cast("long")
    # the arc is the number of points before the hash, found by the top 16 bits, then exactly
    arcs = [p for p, _ in points]
    top = 1 << 16
    lo = [bisect.bisect_left(arcs, b << (RING_BITS - 16)) for b in range(top + 1)]
    # an Arrow table needs no Python workers, which would stay beside the later work of the executors
    inside = [arcs[lo[b] : lo[b + 1]] for b in range(top)]
    guide = spark.createDataFrame(pa.table({"top": pa.array(range(top), pa.int32()), "lo": pa.array(lo[:top], pa.int32()), "inside": pa.array(inside, pa.list_(pa.int64()))}))
    d = d.withColumn("h", h).withColumn("top", F.shiftright("h", RING_BITS - 16).cast("int")).join(F.broadcast(guide), "top")
    arc = F.pmod(F.col("lo") + F.size(F.filter("inside", lambda p: p < F.col("h"))), F.lit(len(points)))
    d = written(d.select("doc_id", "size", "text_crc32", "h", arc.cast("int").alias("arc")), "keys")

    counts = {r["arc"]: r["n"] for r in d.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    bins = max(1, sum(counts.values()) // (len(points) * BIN_ROWS))
    d = d.withColumn("bin", F.pmod(F.xxhash64("h", "size", "text_crc32"), F.lit(bins)))
    before = Window.partitionBy("arc").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = d.groupBy("arc", "bin").agg(F.count(F.lit(1)).alias("n")).select("arc", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("arc", "bin").orderBy("h", "size", "text_crc32", "doc_id")
    d = d.withColumn("rn", F.row_number().over(within) - 1)
    d = d.join(maybe_broadcast(starts, 48, len(points) * bins), ["arc", "bin"]).withColumn("rank", F.col("first") + F.col("rn"))

    by_arc: dict[int, list] = {}
    for a, rank, s, slot in walk(counts, points, shards):
        by_arc.setdefault(a, []).append({"first": rank, "shard": s, "slot": slot})
    if by_arc:
        piece = pa.struct([("first", pa.int64()), ("shard", pa.int32()), ("slot", pa.int64())])
        pieces = spark.createDataFrame(pa.table({"arc": pa.array(list(by_arc), pa.int32()), "pieces": pa.array(list(by_arc.values()), pa.list_(piece))}))
    else:
        pieces = empty_frame(spark, "arc int, pieces array<struct<first:long,shard:int,slot:long>>")
    d = d.join(F.broadcast(pieces), "arc")
    hit = F.element_at(F.filter("pieces", lambda p: p["first"] <= F.col("rank")), -1)
    return d.withColumn("p", hit).select("doc_id", "size", "text_crc32", F.col("p.shard").alias("shard"), (F.col("p.slot") + F.col("rank") - F.col("p.first")).alias("slot"))
