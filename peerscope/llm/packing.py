"""Conflict-constrained best-fit packing.

Texts become training sequences of at most ``capacity`` words.  A text longer than that is cut: its full pieces fill
a bin each, its rest is packed.  A bin takes at most one piece of a source and of a duplicate cluster, so no sequence
holds two texts of one source or two copies (with ``near``, two near copies).  Pieces come largest first; open bins are ordered by the room they have
left and carry bitmaps of their sources and clusters; the search starts at the first bin with enough room and goes on
to the next larger ones until a compatible bin is found, which is the tightest.  None: a new bin.

Rows are dealt over shards of about ``SHARD_ROWS`` rows, packed independently; only ids and sizes travel, not texts.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from peerscope.llm.minhash_dedup import near_duplicates
from peerscope.llm.shared import stage, table

CAPACITY = 2048
SHARD_ROWS = 4000

Piece = tuple[int, int, int, int]  # row, piece, first word, words


def best_fit(sizes: Sequence[int], sources: Sequence[object], clusters: Sequence[object], capacity: int) -> list[tuple[Piece, int, int]]:
    """(piece, bin, first place in the bin) of every row; a null source or cluster conflicts with nothing."""
    out: list[tuple[Piece, int, int]] = []
    bins = 0
    rest: list[Piece] = []
    for row, size in enumerate(sizes):
        full = size // capacity
        for k in range(full):
            out.append(((row, k, k * capacity, capacity), bins, 0))
            bins += 1
        if size % capacity or not size:
            rest.append((row, full, full * capacity, size - full * capacity))
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    several = Counter(c for c in clusters if c is not None)
    cluster_bit = {c: 1 << i for i, c in enumerate(c for c, n in several.items() if n > 1)}
    room: list[tuple[int, int]] = []  # (words left, bin), ascending
    held: dict[int, tuple[int, int]] = {}  # bin: bitmaps of sources and clusters
    for piece in sorted(rest, key=lambda p: (-p[3], p[0])):
        row, _, _, size = piece
        source, cluster = source_bit.get(sources[row], 0), cluster_bit.get(clusters[row], 0)
        at = bisect.bisect_left(room, (size, -1))
        while at < len(room):
            s, c = held[room[at][1]]
            if not (s & source or c & cluster):
                break
            at += 1
        if at < len(room):
            left, b = room.pop(at)
            s, c = held[b]
        else:
            left, b, s, c = capacity, bins, 0, 0
            bins += 1
        out.append((piece, b, capacity - left))
        held[b] = s | source, c | cluster
        bisect.insort(room, (left - size, b))
    return out


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, key: str = "doc_id",
                   text: str = "text", source: str = "source", cluster: str | None = None, near: bool = False) -> DataFrame:
    """doc_id, piece, start_word, n_words, bin_id, bin_offset, source: where each piece of each text goes.

    Words are runs of bytes other than 0x20 and 0x09-0x0D.  ``cluster`` names a column of duplicate clusters; without
    it equal texts are one, or with ``near`` the components of ``near_duplicates``, rows without an id included.  Null and
    empty texts are pieces of 0 words; they and null sources conflict with nothing.  A text of more words than a bin holds
    is cut into full pieces and a rest.  Bins that fit equally well: the oldest takes the piece.  Repeated rows are packed each for itself, in different bins.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), F.col(text).alias("text"),
        F.col(source).cast("string").alias("source"), (F.col(cluster).cast("string") if cluster else F.lit(None).cast("string")).alias("named"))
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    kind = F.col("named") if cluster else F.concat_ws("/", F.xxhash64("text"), F.octet_length("text"))
    if near and not cluster:
        docs = stage(docs, "pack-texts")
        found = near_duplicates(docs, "row").select(F.col("doc_id").alias("row"), F.col("component_id").cast("string").alias("kind"))
        rows = docs.select("row", "doc_id", words.alias("size"), "source").join(found, "row", "left")
        rows = rows.select("row", "doc_id", "size", "source", F.when(F.col("size") > 0, F.col("kind")).alias("cluster"))
    else:
        rows = docs.select("row", "doc_id", words.alias("size"), "source", F.when(words > 0, kind).alias("cluster"))
    rows = stage(rows, "pack-rows")
    shards = max(1, math.ceil(rows.count() / shard_rows))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def shard(table_: pa.Table) -> pa.Table:
        table_ = table_.sort_by("row")
        number = table_["shard"][0].as_py() << 32
        col = {c: table_[c].to_pylist() for c in ("size", "source", "cluster")}
        placed = best_fit(col["size"], col["source"], col["cluster"], capacity)
        of = pa.array([p[0] for p, _, _ in placed], pa.int64())
        return pa.table({
            "doc_id": table_["doc_id"].take(of), "piece": pa.array([p[1] for p, _, _ in placed], pa.int32()),
            "start_word": pa.array([p[2] for p, _, _ in placed], pa.int64()), "n_words": pa.array([p[3] for p, _, _ in placed], pa.int64()),
            "bin_id": pa.array([number + b for _, b, _ in placed], pa.int64()), "bin_offset": pa.array([o for _, _, o in placed], pa.int64()),
            "source": table_["source"].take(of)})

    return rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).groupBy("shard").applyInArrow(
        shard, f"doc_id {id_type}, piece int, start_word long, n_words long, bin_id long, bin_offset long, source string")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes; a bin takes one of a group of equal texts."""
    return pack_documents(table(spark, sf_dir, "documents"))
