"""Consistent-hash ring with virtual nodes and bounded loads.

Each shard has ``VNODES`` points on the ring. A row's home is the first point clockwise
from the hash of its id. Shards may hold at most floor or ceil of rows / shards (the first
shards get the ceil), so counts are at most one apart. Rows that overflow a full shard
continue clockwise to the next point whose shard has room. Points take rows in rounds: in
round k each point, in ring order, is offered the rows whose home lies k points back, in
ring order, and its shard accepts the first of them until it is full.

Only the number of rows of each arc between points goes to the driver (shards * VNODES
numbers); there the rounds are played on counts, which gives each arc a few intervals of
rank with a shard. Rows are ranked within their arc and take the interval's shard.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window, functions as F

VNODES = 256
RING = 1 << 62


def points(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(place, shard) of all points in ring order; a shard's points don't depend on the others."""
    def place(s, v):
        return int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") % RING
    return sorted((place(s, v), s) for s in range(shards) for v in range(vnodes))


def play(counts: list[int], owners: list[int], shards: int) -> list[list[tuple[int, int, int]]]:
    """For each arc, intervals (first rank, end rank, shard) of its rows by the rounds above."""
    total, n = sum(counts), len(owners)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    taken = [0] * n                                       # rows of each arc that have a shard
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    open_arcs = [a for a in range(n) if counts[a]]
    hop = 0
    while open_arcs:
        left = []
        for arc in sorted(open_arcs, key=lambda a: (a + hop) % n):
            shard = owners[(arc + hop) % n]
            take = min(room[shard], counts[arc] - taken[arc])
            if take:
                out[arc].append((taken[arc], taken[arc] + take, shard))
                taken[arc] += take
                room[shard] -= take
            if taken[arc] < counts[arc]:
                left.append(arc)
        open_arcs, hop = left, hop + 1
    return out


def assign(docs: DataFrame, shards: int, vnodes: int = VNODES) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, home_shard) for every row of ``docs`` (doc_id, text; others are ignored).

    ``size`` is the text's UTF-8 bytes plus 8; a null text has none, and the checksum of
    an empty one. ``slot`` counts a shard's rows from 0 without gaps. Rows without id have the place of
    their checksum and size, whatever the number of shards. Rows that share an id share its place; they are ranked by
    checksum and size there, and each takes a slot. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ring = points(shards, vnodes)
    places, owners = [p for p, _ in ring], [s for _, s in ring]
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    key = F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("no id"), "text_crc32", "size")).otherwise(F.xxhash64("doc_id")), F.lit(RING))
    rows = rows.withColumn("key", key)
    # A row's arc: the ring is cut into equal cells of a few points each; those before the key are counted.
    cells = 1 << (len(places) - 1).bit_length()
    width = RING // cells
    begins = [bisect.bisect_left(places, c * width) for c in range(cells + 1)]
    cell = F.expr(f"cast(key div {width} as int)")
    frame = spark.createDataFrame([(c, begins[c], [p for p in places[begins[c]:begins[c + 1]]]) for c in range(cells)], "cell int, base int, inside array<long>")
    arc = F.pmod(F.col("base") + F.size(F.filter("inside", lambda p: p < F.col("key"))), F.lit(len(places)))
    rows = rows.withColumn("cell", cell).join(F.broadcast(frame), "cell").withColumn("arc", arc.cast("int")).drop("cell", "base", "inside")
    counts = [0] * len(places)
    for r in rows.groupBy("arc").count().collect():
        counts[r["arc"]] = r["count"]
    pieces, filled = [], [0] * shards
    for a, intervals in enumerate(play(counts, owners, shards)):
        for lo, hi, shard in intervals:
            pieces.append((a, lo, hi, shard, filled[shard] - lo, owners[a]))
            filled[shard] += hi - lo
    cuts = spark.createDataFrame(pieces, "arc int, lo long, hi long, shard int, shift long, home_shard int")
    nested = cuts.groupBy("arc", "home_shard").agg(F.collect_list(F.struct("lo", "hi", "shard", "shift")).alias("cuts"))
    rank = F.row_number().over(Window.partitionBy("arc").orderBy("key", "doc_id", "text_crc32", "size")) - 1
    ranked = rows.withColumn("rank", rank.cast("long")).join(F.broadcast(nested), "arc")
    own = F.element_at(F.filter("cuts", lambda c: (c["lo"] <= F.col("rank")) & (F.col("rank") < c["hi"])), 1)
    return (ranked.withColumn("own", own)
            .select("doc_id", "size", "text_crc32", F.col("own.shard").alias("shard"), (F.col("rank") + F.col("own.shift")).alias("slot"), "home_shard"))
