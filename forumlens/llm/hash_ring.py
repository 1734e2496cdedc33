"""Shards by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

The ring has ``shards * VNODES`` points; a row stands at the hash of its doc_id and belongs to the next
point clockwise.  A shard takes rows only up to its quota: the row count divided by the shards, the
first shards one more for the remainder.  Rows that find their shard full go on clockwise to the next
point of a shard with room.  So row counts differ by one at most (the law ``rows``), and with one more
shard a row moves only if a new point or the changed quotas push it.

Only counts decide: rows are counted in ``shards * VNODES * CELLS`` cells of the ring, a number that
the parameters fix, and the driver walks these counts once (``placement``).  Ranks inside a cell
are a window per cell; equal rows are first combined into one with a count, so neither a hot key nor
a hot text meets in one window.

Defined results: null text: size 1 and text_crc32 0; null doc_id stands at the hash of the empty string;
equal rows are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 8
VNODES = 64
CELLS = 16
SPACE = 1 << 56


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(position, shard) of all points, in ring order."""
    place = lambda s, v: int.from_bytes(hashlib.sha256(f"shard {s} point {v}".encode()).digest()[:7], "big")
    return sorted((place(s, v), s) for s in range(shards) for v in range(vnodes))


def placement(points: list[tuple[int, int]], shards: int, counts: dict[int, int], cells: int) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, rows, shard, first slot): where each stretch of a cell's rows goes.

    ``counts`` has the rows of each cell; cells are numbered along the ring, ``cells`` to an arc, and the
    arc k ends at point k.  Each pass moves every waiting stretch one arc on, in ring order; a shard with
    room takes what fits.  A shard that fills up is off the ring from then on.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    waiting = [(c // cells, c, 0, n) for c, n in sorted(counts.items()) if n]
    out = []
    while waiting:
        rest = []
        for arc, cell, first, n in waiting:
            shard = points[arc][1]
            took = min(n, room[shard] - used[shard])
            if took:
                out.append((cell, first, took, shard, used[shard]))
                used[shard] += took
            if took < n:
                rest.append((arc, cell, first + took, n - took))
        free = [s for s in range(shards) if used[s] < room[s]]
        waiting = []
        for arc, cell, first, n in rest:
            while points[arc][1] not in free:
                arc = (arc + 1) % len(points)
            waiting.append((arc, cell, first, n))
    return out


def assign(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, cells: int = CELLS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is not ``key``)."""
    spark = docs.sparkSession
    points = ring(shards, vnodes)
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"))
    one = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    digest = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256)
    at = F.conv(F.substring(digest, 1, 14), 16, 10).cast("long")
    # The arc of a row ends at the first point that is not before it; past the last one it is the first.
    placed = one.withColumn("at", at)
    bounds = spark.createDataFrame(_cell_table(points, cells), "bucket long, low long, high long, cell int")
    placed = placed.withColumn("bucket", F.shiftright("at", 56 - _BITS))
    placed = placed.join(F.broadcast(bounds), "bucket").filter((F.col("at") >= F.col("low")) & (F.col("at") < F.col("high")))
    counts = {r[0]: r[1] for r in placed.groupBy("cell").agg(F.sum("n")).collect()}
    plan = placement(points, shards, counts, cells)
    inside = Window.partitionBy("cell").orderBy("at", F.col("doc_id").asc_nulls_first(), "size", "text_crc32")
    ranked = placed.withColumn("first", F.coalesce(F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    steps = spark.createDataFrame(plan, "cell int, from long, rows long, shard int, slot0 long")
    low = F.greatest("first", "from")
    high = F.least(F.col("first") + F.col("n"), F.col("from") + F.col("rows"))
    met = ranked.join(F.broadcast(steps), "cell").withColumns({"low": low, "high": high}).filter(F.col("low") < F.col("high"))
    each = met.withColumn("rank", F.explode(F.sequence(F.col("low"), F.col("high") - 1)))
    return each.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("slot0") + F.col("rank") - F.col("from")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


_BITS = 10


def _cell_table(points: list[tuple[int, int]], cells: int) -> list[tuple[int, int, int, int]]:
    """(bucket, low, high, cell): the ring cut into cells, each listed under every bucket it meets.

    Buckets are the leading bits of a position, so finding a row's cell is an equi-join.
    """
    stops = [p for p, _ in points]
    arcs = [(k, (stops[k - 1] + 1) if k else 0, stops[k] + 1) for k in range(len(stops))]
    arcs.append((0, stops[-1] + 1, SPACE))  # past the last point: on to the first
    out = []
    for arc, low, high in arcs:
        # Of the first arc, the part past the last point comes first on the way to its point.
        span = range(cells) if arc else (range(cells // 2, cells) if low == 0 else range(cells // 2))
        if high <= low:
            continue
        width = -(-(high - low) // len(span))
        for i, c in enumerate(span):
            a, b = low + i * width, min(high, low + (i + 1) * width)
            if a < b:
                out.extend((k, a, b, arc * cells + c) for k in range(a >> (56 - _BITS), ((b - 1) >> (56 - _BITS)) + 1))
    return out
