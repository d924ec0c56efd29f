"""Writers (B1-B3; Q1 is in ``append``)."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from peerscope.operators.quality import QualitySuite
from peerscope.sources import publish
from peerscope.sources.append import append_new_rows
from peerscope.sources.publish import EmptySnapshot
from peerscope.sources.tables import qualified_name, with_comments

__all__ = ["EmptySnapshot", "append_new_rows", "materialize", "qualified_name", "write_all_or_nothing", "write_raw_partition"]


def write_raw_partition(df: DataFrame, root: str, source: str, ingestion_date: dt.date | str | None = None,
                        mode: str = "overwrite", batch_id: int | str | None = None) -> str:
    """B1: land a snapshot as ``{root}/{source}/ingestion_date=YYYY-MM-DD``.

    Dynamic partition overwrite replaces only that day's partition, so a
    second run on the same day replaces the first (as the reference does)
    and earlier snapshots stay.  With ``batch_id`` (stream micro-batches)
    each batch is its own sub-partition ``batch_id=...``: a replayed batch
    replaces exactly its own files, so the write is idempotent.

    A snapshot without rows is an error: dynamic overwrite would leave the
    day's older partition in place.  (A batch may have no valid rows.)
    """
    d = F.lit(str(ingestion_date)).cast("date") if ingestion_date is not None else F.current_date()
    path = f"{root.rstrip('/')}/{source}"
    out = df.withColumn("ingestion_date", d)
    parts = ["ingestion_date"]
    if batch_id is not None:
        out = out.withColumn("batch_id", F.lit(str(batch_id)))
        parts.append("batch_id")
        mode = "overwrite"
    rows = Observation(f"raw_{source}_{uuid.uuid4().hex}")
    (out.observe(rows, F.count(F.lit(1)).alias("n")).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
     .partitionBy(*parts).parquet(path))
    if batch_id is None and not rows.get["n"]:
        raise EmptySnapshot(f"{source}: no rows to land; earlier partitions are unchanged")
    return path


def materialize(spark: SparkSession, df: DataFrame, layer: str, model: str, path: str | None = None,
                descriptions: Mapping[str, str] | None = None) -> str:
    """B2: full-refresh table of a layer (``saveAsTable`` overwrite), without a gate; builds use ``AuditedTables``.

    With ``path`` the table is external at that location (shared storage).
    ``descriptions`` become the comments of the columns they name (Q4).
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    name = qualified_name(layer, model)
    w = with_comments(df, descriptions).write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def write_all_or_nothing(frames: Mapping[str, DataFrame], suites: Mapping[str, QualitySuite],
                         root: str, ingestion_date: dt.date | str | None = None) -> list[str]:
    """Check every table first, write all of them aside, and publish them together.

    A failed gate, an empty table or a failed write leaves the raw layer as it was.
    """
    for suite in suites.values():
        suite.enforce()
    if not frames:
        return []
    spark = next(iter(frames.values())).sparkSession
    date = ingestion_date or dt.datetime.now(tz=dt.timezone.utc).date()
    publish.write_all_or_nothing(spark, frames, root, date)
    return [f"{root.rstrip('/')}/{name}" for name in frames]
