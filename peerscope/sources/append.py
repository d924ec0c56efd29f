"""Incremental append (Q1): only rows whose fingerprint is not stored yet.

Every append is a folder of its own, and beside it lies its Bloom filter, a table of 64-bit words: a fingerprint's hash
names one word and four bits of it.  The number of words, a power of two, follows the rows of the append.  A new batch
meets the filters first; the fingerprints whose bits are all set in some append are looked up in the stored fingerprints
of these appends alone, all others are new.  So a batch travels, and what may be stored already, but never the stored
fingerprints as a whole; filters are left as they lie wherever the batch is small enough to be broadcast (Spark measures).

Rows and filter are published together, so a lost run leaves no trace and a repeated one adds nothing.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from peerscope.sources.publish import Folders, StagedRun

BITS_PER_ROW = 12
BITS_OF_A_ROW = 4
APPEND = "append_id"


def filter_level(rows: int) -> int:
    """Binary logarithm of the number of words that a filter of ``rows`` fingerprints has."""
    return max(1, math.ceil(math.log2(max(1, rows) * BITS_PER_ROW / 64)))


def slot(fingerprint: str, level: Column) -> Column:
    """The word of a fingerprint in a filter of 2^level words."""
    return F.call_function("shiftrightunsigned", F.xxhash64(fingerprint), (F.lit(64) - level).cast("int"))


def mask(fingerprint: str) -> Column:
    """The fingerprint's bits in its word."""
    h = F.xxhash64(fingerprint, F.lit("bits"))
    out = F.lit(0).cast("long")
    for i in range(BITS_OF_A_ROW):
        bit = F.call_function("shiftrightunsigned", h, F.lit(6 * i)).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return out


def bloom_filter(rows: DataFrame, fingerprint: str, level: int) -> DataFrame:
    """(slot, word) of the fingerprints of ``rows``; words without a bit are left out."""
    return rows.filter(F.col(fingerprint).isNotNull()).select(slot(fingerprint, F.lit(level)).alias("slot"), mask(fingerprint).alias("mask")) \
        .groupBy("slot").agg(F.bit_or("mask").alias("word"))


def filters_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}_filters"


def _levels(folders: Folders, table_path: str) -> list[int]:
    """Levels of the stored filters, from the folder listing."""
    names = [p.rsplit("/", 1)[1] for p in folders.children(filters_path(table_path))]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("level="))


def maybe_stored(spark: SparkSession, fingerprints: DataFrame, table_path: str, fingerprint: str, levels: list[int]) -> DataFrame:
    """(append_id, fingerprint) of those that an append's filter has; a few more than are stored, but all of these."""
    filters = spark.read.schema(f"slot long, word long, level int, {APPEND} string").parquet(filters_path(table_path))
    asked = fingerprints.select(fingerprint, mask(fingerprint).alias("mask"), F.explode(F.array(*map(F.lit, levels))).alias("level")) \
        .withColumn("slot", slot(fingerprint, F.col("level")))
    return filters.join(asked, ["level", "slot"]).filter(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask")).select(APPEND, fingerprint)


def known_fingerprints(spark: SparkSession, fingerprints: DataFrame, table_path: str, fingerprint: str, scratch: str) -> DataFrame | None:
    """The fingerprints that are stored already; None if nothing is stored with filters.

    Those that may be stored are written to ``scratch`` first: their appends, at most as many as there are folders, are
    the only ones whose fingerprints are read, and their measured size lets Spark choose the join.
    """
    levels = _levels(Folders(spark), table_path)
    if not levels:
        return None
    maybe_stored(spark, fingerprints, table_path, fingerprint, levels).write.parquet(scratch)
    kind = fingerprints.schema[fingerprint].dataType.simpleString()
    maybe = spark.read.schema(f"{APPEND} string, `{fingerprint}` {kind}").parquet(scratch)
    appends = [r[0] for r in maybe.select(APPEND).distinct().collect()]
    stored = spark.read.schema(f"`{fingerprint}` {kind}, {APPEND} string").parquet(table_path).filter(F.col(APPEND).isin(appends))
    return stored.join(maybe, [APPEND, fingerprint], "left_semi").select(fingerprint).distinct()


def append_new_rows(new: DataFrame, table_path: str, spark: SparkSession, hash_col: str = "row_hash") -> int:
    """Q1: append the rows whose fingerprint is not stored yet, each fingerprint once; the number of rows appended.

    The table gains the partition column ``append_id``.  A null fingerprint equals nothing, so such a row is always new.
    A table that was written without filters keeps its layout: its fingerprints are anti-joined as a whole.  One writer
    at a time.
    """
    path, fresh = table_path.rstrip("/"), new.dropDuplicates([hash_col])
    with StagedRun(spark, path) as run:
        folders = Folders(spark)
        if folders.exists(path) and not folders.exists(filters_path(path)):
            return _append_plain(fresh, path, spark, hash_col)
        known = known_fingerprints(spark, fresh.select(hash_col), path, hash_col, f"{run.folder}/maybe")
        if known is not None:
            fresh = fresh.join(known, hash_col, "left_anti")
        now = dt.datetime.now(tz=dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        append = f"{APPEND}={now}-{uuid.uuid4().hex[:8]}"
        counted = Observation(f"append_{uuid.uuid4().hex}")
        rows = run.place("rows", f"{path}/{append}")
        fresh.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(rows)
        n = int(counted.get["rows"])
        if n:
            level = filter_level(n)
            words = run.place("filter", f"{filters_path(path)}/level={level}/{append}")
            bloom_filter(spark.read.schema(fresh.schema).parquet(rows), hash_col, level).write.parquet(words)
            run.publish()
    return n


def _append_plain(fresh: DataFrame, path: str, spark: SparkSession, hash_col: str) -> int:
    try:
        stored = spark.read.parquet(path).select(hash_col)
    except AnalysisException as e:
        raise ValueError(f"{path} has no column {hash_col}") from e
    counted = Observation(f"append_{uuid.uuid4().hex}")
    fresh.join(stored, hash_col, "left_anti").observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return int(counted.get["rows"])
