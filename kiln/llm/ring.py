"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``VNODES`` points on a hash ring; a row belongs to the shard
of the next point clockwise of its own hash. A shard takes rows only up to its
capacity; what overflows continues clockwise to the next point whose shard
still has room. With capacities that sum to the number of rows the counts are
exact (at most one apart), and since only overflow leaves its home arc, adding
a shard moves little.

Only the row count per arc (shards x VNODES numbers) reaches the driver. The
walk around the ring turns them into segments (arc, first rank, shard, first
slot); rows then find their segment by their rank in hash order within the
arc, so the result does not depend on partitioning."""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.frames import hash60

SHARDS = 40
VNODES = 128
RING = 1 << 60
MAX_POINTS = 1 << 20               # bound of the ring table on the driver


def ring_points(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """Sorted (position, shard); a shard's points do not depend on the others."""
    if not 0 < shards * vnodes <= MAX_POINTS:
        raise ValueError(f"shards x vnodes must be between 1 and {MAX_POINTS}")
    return sorted((int(hashlib.md5(f"point|{s}|{v}".encode()).hexdigest()[:15], 16), s)
                  for s in range(shards) for v in range(vnodes))


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows a shard may hold: an equal part, rounded up for the first ones;
    ``slack`` adds a share of it for looser balance and less movement."""
    base, extra = divmod(rows, shards)
    return [base + (s < extra) + int(base * slack) for s in range(shards)]


def walk(points: list[tuple[int, int]], loads: list[int], capacity: list[int]
         ) -> list[tuple[int, int, int, int, int]]:
    """Segments (arc, first rank, end rank, shard, first slot): every arc's
    rows, in rank order, fill the shard of its point; the rest of the arc goes
    on clockwise. Each arc first fills its own shard, then overflow moves a
    point at a time, arcs in ring order."""
    room = list(capacity)
    used = [0] * len(capacity)
    segments: list[tuple[int, int, int, int, int]] = []
    waiting = [(arc, 0, n) for arc, n in enumerate(loads) if n]
    arcs = len(points)
    open_after: list[int] = []
    step = 0
    while waiting:
        rest = []
        if step:                       # jump over points whose shard is full
            open_after = [i for i in range(arcs) if room[points[i][1]] > 0]
            if not open_after:
                raise ValueError("capacities are below the number of rows")
        for arc, start, end in waiting:
            at = arc
            if step:
                k = bisect.bisect_left(open_after, arc)
                at = open_after[k % len(open_after)]
            shard = points[at][1]
            take = min(room[shard], end - start)
            if take:
                segments.append((arc, start, start + take, shard, used[shard]))
                room[shard] -= take
                used[shard] += take
            if start + take < end:
                rest.append((arc, start + take, end))
        waiting, step = rest, step + 1
    return segments


def bounded_ring(rows: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, slack: float = 0.0,
                 key: str = "doc_id", order: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 within
    the shard) to every row. ``order`` names columns that tell rows of equal
    key apart; rows equal in them all are interchangeable. Rows with a null key
    are placed by those columns. An empty table stays empty."""
    points = ring_points(shards, vnodes)
    spark = rows.sparkSession
    bounds = [p for p, _ in points]
    # the arc of a hash: its ring cell (fixed, equal width) narrows the search to a few points
    cells = 1 << max(1, (len(points) - 1).bit_length())
    width = RING // cells
    first_in_cell = [bisect.bisect_left(bounds, c * width) for c in range(cells + 1)]
    lists = [bounds[first_in_cell[c]:first_in_cell[c + 1]] for c in range(cells)]
    ring = spark.createDataFrame(
        [(c, first_in_cell[c], lists[c]) for c in range(cells)], "_cell long, _first int, _points array<long>")
    h = hash60("ring", F.coalesce(F.col(key).cast("string"), F.concat_ws("|", *order)))
    placed = rows.withColumn("_h", h).withColumn("_cell", F.floor(F.col("_h") / F.lit(width))) \
        .join(F.broadcast(ring), "_cell") \
        .withColumn("_arc", F.pmod(F.col("_first") + F.size(F.filter("_points", lambda p: p < F.col("_h"))),
                                   F.lit(len(points)))) \
        .drop("_cell", "_first", "_points")
    counts = {r["_arc"]: r["n"] for r in placed.groupBy("_arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    loads = [counts.get(a, 0) for a in range(len(points))]
    segments = walk(points, loads, capacities(sum(loads), shards, slack))
    per_arc: dict[int, list] = {}
    for arc, start, end, shard, slot in segments:
        per_arc.setdefault(arc, []).append((start, end, shard, slot))
    table = spark.createDataFrame(
        [(a, s) for a, s in per_arc.items()] or [],
        "_arc int, _segments array<struct<start:long,end:long,shard:int,slot:long>>")
    w = Window.partitionBy("_arc").orderBy("_h", F.col(key).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])
    ranked = placed.withColumn("_rank", F.row_number().over(w).cast("long") - 1).join(F.broadcast(table), "_arc")
    mine = F.filter("_segments", lambda s: (s["start"] <= F.col("_rank")) & (F.col("_rank") < s["end"]))[0]
    return ranked.withColumn("_seg", mine) \
        .withColumn("shard", F.col("_seg.shard")) \
        .withColumn("slot", F.col("_seg.slot") + F.col("_rank") - F.col("_seg.start")) \
        .drop("_h", "_arc", "_rank", "_segments", "_seg")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 16; null text: 16), text_crc32 (null
    text: null), law ``rows``, shard, slot, grown_shard (null: the law does
    not fix growth) for every row of ``docs`` (doc_id, text). Repeated rows are
    rows like any other; ties of doc_id are ordered by checksum and size."""
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    out = bounded_ring(rows, shards, order=("text_crc32", "size"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
