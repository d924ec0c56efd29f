"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring of 65,536 positions; a row's key hashes to a position and belongs to
the next point clockwise.  A shard takes rows up to its load bound; rows beyond it continue clockwise to the next
point whose shard has room.  The bounds are tight (they add up to the number of rows and differ by one at most),
so counts are at most one apart; a row leaves its home shard only when that shard is full.

All rows of one position take the same way round the ring, so the ring is walked once on the driver, on the number
of rows of each position (65,536 numbers, whatever the input).  Spark ranks the rows of each position, and a row's
rank tells its shard and slot.  Ranks come from counts per (position, bucket) plus a row number inside a bucket of
about ``BUCKET_ROWS`` rows, so neither a shard nor a hot key is one task's work.
"""

from __future__ import annotations

import math
import zlib

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from peerscope.llm.shared import stage, table

SHARDS = 24
VNODES = 64
POSITIONS = 1 << 16
BUCKET_ROWS = 50_000


def ring_points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node in ring order; of points on one position the lowest shard's stays."""
    points: dict[int, int] = {}
    for s in range(shards):
        for v in range(vnodes):
            at = zlib.crc32(f"shard-{s}/vnode-{v}".encode()) % POSITIONS
            points[at] = min(s, points.get(at, s))
    for s in sorted(set(range(shards)) - set(points.values())):
        points[next(p for p in range(POSITIONS) if p not in points)] = s
    return sorted(points.items())


def walk(demand: dict[int, int], shards: int, vnodes: int) -> list[tuple[int, int, int, int, int]]:
    """(position, shard, first rank, rows, first slot): where the rows of each position land under the load bounds.

    Home rows are placed first, in ring order; then each position's overflow continues clockwise.
    """
    points = ring_points(shards, vnodes)
    n = sum(demand.values())
    at_point, i = {}, 0
    for position in sorted(demand):
        while i < len(points) and points[i][0] < position:
            i += 1
        at_point[position] = i % len(points)
    home = [0] * shards
    for position, i in at_point.items():
        home[points[i][1]] += demand[position]
    bound = [n // shards] * shards
    for s in sorted(range(shards), key=lambda s: (-home[s], s))[: n % shards]:
        bound[s] += 1
    used = [0] * shards
    segments: list[tuple[int, int, int, int, int]] = []

    def place(position: int, s: int, done: int) -> int:
        here = min(demand[position] - done, bound[s] - used[s])
        if here:
            segments.append((position, s, done, here, used[s]))
            used[s] += here
        return done + here

    left = {}
    for position, i in at_point.items():
        done = place(position, points[i][1], 0)
        if done < demand[position]:
            left[position] = done
    following = list(range(len(points)))  # the next point, itself included, that may have room

    def open_point(i: int) -> int:
        path = []
        while True:
            i %= len(points)
            if following[i] != i:
                path.append(i)
                i = following[i]
            elif used[points[i][1]] >= bound[points[i][1]]:
                path.append(i)
                following[i] = (i + 1) % len(points)
                i = following[i]
            else:
                break
        for p in path:
            following[p] = i
        return i

    for position, done in left.items():
        while done < demand[position]:
            done = place(position, points[open_point(at_point[position])][1], done)
    return segments


def assign_shards(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``; the law is ``rows``.

    Null key: has a position like any key.  Null text: no bytes (size 8, checksum 0).  Repeated rows and rows with
    one key share a position and are told apart by their place in the input, so each has its own slot.  Empty input
    gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    name = F.coalesce(F.concat(F.lit("key/"), F.col(key).cast("string")), F.lit("none"))
    rows = stage(docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
        F.pmod(F.xxhash64(name), F.lit(POSITIONS)).cast("int").alias("position"),
    ), "shard-rows")
    buckets = max(1, math.ceil(rows.count() / BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    cells = rows.groupBy("position", "bucket").agg(F.count(F.lit(1)).alias("n"))
    demand = {r["position"]: r["n"] for r in cells.groupBy("position").agg(F.sum("n").alias("n")).collect()}
    segments = spark.createDataFrame(
        walk(demand, shards, vnodes),
        "position int, shard int, first long, rows long, first_slot long")
    before = W.partitionBy("position").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = (
        rows.withColumn("nth", F.row_number().over(W.partitionBy("position", "bucket").orderBy("row")) - 1)
        .join(cells, ["position", "bucket"])
        .withColumn("rank", F.col("before") + F.col("nth"))
    )
    s = F.broadcast(segments).alias("s")  # at most one row a position and one a shard more
    inside = (F.col("r.position") == F.col("s.position")) & (F.col("rank") >= F.col("first")) \
        & (F.col("rank") < F.col("first") + F.col("rows"))
    return ranked.alias("r").join(s, inside).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("first_slot") + F.col("rank") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """``docs`` as one Parquet folder a shard (``shard=N``); a shard of any size is written by many tasks."""
    placed = assign_shards(docs, shards).select(
        F.col("doc_id").alias("_id"), F.col("size").alias("_size"), F.col("text_crc32").alias("_crc"), "shard", "slot")
    same = W.partitionBy("_id", "_size", "_crc")
    placed = placed.withColumn("_nth", F.row_number().over(same.orderBy("shard", "slot")))
    body = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select(
        F.struct("*").alias("_doc"), F.col("doc_id").alias("_id"),
        (F.octet_length(body) + F.lit(8)).cast("long").alias("_size"), F.crc32(body.cast("binary")).alias("_crc"))
    named = named.withColumn("_nth", F.row_number().over(same.orderBy(F.lit(0))))
    on = [named[c].eqNullSafe(placed[c]) for c in ("_id", "_size", "_crc", "_nth")]
    named.join(placed, on).select("shard", "slot", F.col("_doc").alias("document")) \
        .write.partitionBy("shard").parquet(path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law (rows), shard, slot, grown_shard of every document over 24 shards; null texts have 8 bytes."""
    return assign_shards(table(spark, sf_dir, "documents"))
