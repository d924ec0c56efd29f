"""Deduplication and snapshot selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerscope.functions.columns import col_of, row_hash


def with_row_hash(df: DataFrame, cols: Sequence[str], name: str = "row_hash") -> DataFrame:
    """Add the md5 fingerprint of ``cols`` (J1) as column ``name``."""
    return df.withColumn(name, row_hash(*cols))


def dedup_by_hash(df: DataFrame, hash_col: str = "row_hash", deterministic: bool = False) -> DataFrame:
    """Technical dedup (G1): one row per fingerprint.

    Default: ``dropDuplicates`` - partial aggregation on the map side, so
    byte-identical repeats collapse before the shuffle, one exchange on the
    fingerprint.  ``deterministic=True`` fixes the survivor of a NULL/''
    collision by ordering on the remaining columns (one exchange, sort based).
    """
    if not deterministic:
        return df.dropDuplicates([hash_col])
    others = [c for c in df.columns if c != hash_col]
    w = Window.partitionBy(hash_col).orderBy(*[F.asc_nulls_first(c) for c in others])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str | Column,
    tie_breakers: Sequence[str | Column] = (),
    descending: bool = True,
) -> DataFrame:
    """Latest row per key (G2), NULL order values last.

    Tie-breakers make the survivor deterministic.  The filter on
    ``row_number() = 1`` lets Spark insert a ``WindowGroupLimit`` before the
    shuffle, so each task only ships its local winner per key: a hot key
    costs one row per task, not all its rows.
    """
    o = col_of(order_by)
    first = F.desc_nulls_last(o) if descending else F.asc_nulls_last(o)
    ties = [F.asc_nulls_last(col_of(t)) if isinstance(t, str) else t for t in tie_breakers]
    w = Window.partitionBy(*keys).orderBy(first, *ties)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_snapshot(df: DataFrame, partition_col: str = "ingestion_date") -> DataFrame:
    """Rows of the newest snapshot only.

    Written as an uncorrelated scalar subquery on the partition column.
    Catalyst evaluates it once and, for a partitioned table, applies it as a
    runtime partition filter: older snapshots are never read.
    """
    newest = df.select(F.max(partition_col)).scalar()
    return df.filter(F.col(partition_col) == newest)


def latest_valid_snapshot(df: DataFrame, partition_col: str = "ingestion_date", min_rows: int = 1) -> DataFrame:
    """Newest snapshot holding at least ``min_rows`` rows (T11 fall-back).

    One small aggregation counts rows per partition (one row per snapshot),
    the newest partition passing the volume check is chosen as a scalar
    subquery, and only that partition is read.  A broken newest snapshot
    falls back to the previous good one instead of being read silently.
    """
    counts = df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("_n"))
    good = counts.filter(F.col("_n") >= F.lit(min_rows)).select(F.max(partition_col)).scalar()
    return df.filter(F.col(partition_col) == good)
