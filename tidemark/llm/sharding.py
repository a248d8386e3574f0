"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, with DataFrame functions only.

Every shard has POINTS points on a ring of 64-bit hashes.  A row belongs to the shard of the first point at or after
the hash of its doc_id; rows that find their shard full go on clockwise to the next shard with room.  The
ring is settled by counts of its arcs, a bounded table whatever the number of rows: rows are put in the order of the
ring once, and an arc gives each shard one stretch of that order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .work import saved

#: Points of a shard on the ring; seeds of the hashes of keys and of points.
POINTS, KEY_SEED, POINT_SEED = 256, 7, 11
#: The ring is looked up by its highest bits: so many cells.
CELL_BITS = 12


def ring(spark: SparkSession, shards: int, points: int = POINTS) -> list[tuple[int, int]]:
    """(position, shard) of every point, clockwise.  A further shard adds points and moves none."""
    rows = spark.range(shards).select(F.col("id").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    rows = rows.select(F.xxhash64("shard", "i", F.lit(POINT_SEED)).alias("at"), F.col("shard").cast("int"))
    return sorted((r["at"], r["shard"]) for r in rows.collect())  # shards x points rows


def _arcs(spark: SparkSession, points: list[tuple[int, int]]) -> DataFrame:
    """cell, arc, after, upto: the arcs of the ring in the cells that they reach into; at most arcs and cells together."""
    least, most, shift = -(1 << 63), (1 << 63) - 1, 64 - CELL_BITS
    rows, after = [], least - 1
    for arc, upto in enumerate([at for at, _ in points] + [most]):
        if upto > after:
            rows += [(cell, arc, max(after, least), upto) for cell in range((after + 1) >> shift, (upto >> shift) + 1)]
        after = upto
    return spark.createDataFrame(rows, "cell long, arc int, after long, upto long")


def stretches(counts: dict[int, int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, from, upto, shard, slot) of stretches of the order of the ring that one shard takes; slot: its first row's.

    counts: rows by arc; owners: the shard of each arc, clockwise; room: most rows of each shard, in all as many as there
    are rows.  Every arc gives its own shard what that has room for, clockwise from the least hash.  What is left
    goes, in the same order, on from its arc to the next shard with room.
    """
    room, taken, out, left, at = list(room), [0] * len(room), [], [], 0

    def take(arc: int, begin: int, upto: int, shard: int) -> int:
        n = min(upto - begin, room[shard])
        if n:
            out.append((arc, begin, begin + n, shard, taken[shard]))
            room[shard] -= n
            taken[shard] += n
        return begin + n

    for arc, owner in enumerate(owners):
        upto = at + counts.get(arc, 0)
        begin = take(arc, at, upto, owner)
        if begin < upto:
            left.append((arc, begin, upto))
        at = upto
    for arc, begin, upto in left:
        place = arc
        while begin < upto:
            place = (place + 1) % len(owners)
            begin = take(arc, begin, upto, owners[place])
    return out


def shard(docs: DataFrame, shards: int = 16, points: int = POINTS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    The law is `rows`: counts of shards are at most one apart, the first of them one above the others if they
    don't come out even; grown_shard is null.  size: UTF-8 bytes of the text and 1; a null text has none and
    the checksum of the empty text.  slot numbers a shard's rows from 0 without gaps.  Rows that share a doc_id have one
    place on the ring, in the order of their texts' hashes; a null doc_id is a key as others, and a key with more rows
    than a shard holds is continued in the next.  An empty table gives no rows; columns other than doc_id and
    text are not looked at; rows in = rows out.

    Texts are read once; one exchange deals narrow rows by ranges of (hash, text, row), so equal rows can be split too.
    """
    spark, text = docs.sparkSession, F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("t"))
    order = ["h", "t", "row"]
    rows = saved(rows.withColumns({"h": F.xxhash64("doc_id", F.lit(KEY_SEED)), "row": F.monotonically_increasing_id()}), "keys")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # range << 33, and the place in it
    rows = rows.withColumns({"bin": F.shiftright(place, 33), "i": place.bitwiseAND(F.lit((1 << 33) - 1))})
    around = ring(spark, shards, points)
    inside = (F.shiftright(F.col("h"), 64 - CELL_BITS) == F.col("cell")) & (F.col("h") <= F.col("upto")) & ((F.col("h") > F.col("after")) | (F.col("after") == -(1 << 63)))
    rows = saved(rows.join(F.broadcast(_arcs(spark, around)), inside).select("doc_id", "size", "text_crc32", "arc", "bin", "i"), "ring")

    counts = {r["arc"]: r["n"] for r in rows.groupBy("arc").agg(F.count("*").alias("n")).collect()}  # at most shards x points + 1 rows
    total = sum(counts.values())
    owners = [s for _, s in around] + [around[0][1]]  # what lies beyond the last point belongs to the first
    made = stretches(counts, owners, [total // shards + (s < total % shards) for s in range(shards)])
    made = spark.createDataFrame(made, "arc int, begin long, upto long, shard int, slot long")  # at most arcs + shards rows
    sizes = rows.groupBy("bin").agg((F.max("i") + 1).alias("n"))  # one row a range
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    rows = rows.join(offsets, "bin").withColumn("g", F.col("off") + F.col("i"))
    rows = rows.join(F.broadcast(made), "arc").where((F.col("g") >= F.col("begin")) & (F.col("g") < F.col("upto")))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("slot") + F.col("g") - F.col("begin")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
