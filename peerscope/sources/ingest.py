"""Batch ingest: landed files -> validated, dated raw partitions.

Every landed file is read once: its rows are typed and written aside while the same pass counts them, the ones that
break the contract and the ones left out by rule.  Only when every table of the run passed are all of them published
together as the ``ingestion_date`` partition of their raw folders; a run that fails leaves the raw layer as it was.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.operators.quality import observe_discards
from peerscope.sources import readers as R
from peerscope.sources.contracts import CENSUS_TABLES, MUNICIPIO, OLIST, PIX, TableContract
from peerscope.sources.publish import StagedRun
from peerscope.sources.readers import InvalidSource

__all__ = ["InvalidSource", "TableReport", "ingest_landing"]


@dataclass
class TableReport:
    source: str
    rows: int
    invalid: int
    low_volume: bool
    discarded: int = 0  # rows left out by rule (M11)


@dataclass
class Landed:
    """One source as landed: contract columns, ``_valid``, and perhaps ``_discarded`` and a text of what is broken."""

    source: str
    path: str
    rows: DataFrame
    minimum: int
    contract: TableContract | None = None  # still to be typed


def _stage(run: StagedRun, landed: Landed, date: dt.date | str, sample_rows: int | None) -> TableReport:
    """Write a source aside in one pass that also counts its rows, invalid rows and discarded rows.

    ``sample_rows``: the head is looked at before, so that a large file of the
    wrong kind fails early; all rows are validated all the same.
    """
    df = landed.rows
    broken = F.col(R.BAD) if R.BAD in df.columns else F.lit(None).cast("string")
    left_out = F.col("_discarded") if "_discarded" in df.columns else F.lit(False)
    invalid = ~left_out & ~F.col("_valid")
    if sample_rows:
        bad = df.limit(sample_rows).filter(invalid).count()
        if bad:
            return TableReport(landed.source, sample_rows, bad, False)
    counted, counts = observe_discards(df, f"ingest_{landed.source}_{uuid.uuid4().hex}", left_out,
                                       invalid=F.count_if(invalid), broken=F.max(broken))
    kept = counted.filter(~left_out)
    typed = landed.contract.typed(kept) if landed.contract else kept.drop("_valid", "_discarded", R.BAD)
    run.write_partition(typed, landed.source, date, counts)
    found = counts.get
    n = int(found["rows"] - found["discarded"])
    if found["broken"] is not None:
        raise R.broken_document(landed.path, found["broken"])
    return TableReport(landed.source, n, int(found["invalid"]), n < landed.minimum, int(found["discarded"]))


def landed_files(spark: SparkSession, landing: str) -> dict[str, str]:
    """Name -> path of the files and folders of pages in a landing folder (local folder, HDFS or object store)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(landing)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return {s.getPath().getName(): s.getPath().toString() for s in fs.listStatus(folder)}


def ingest_landing(
    spark: SparkSession,
    landing: str,
    raw_root: str,
    ingestion_date: dt.date | str | None = None,
    sample_rows: int | None = None,
) -> list[TableReport]:
    """Ingest every recognised file of a landing folder, all or nothing.

    Recognised: the business CSVs by file name, ``municipios.json``,
    ``censo_<table>.json`` and ``pix.json``; each is one file or a folder of
    files, at any depth.  Unknown names are ignored (K2).  A broken document,
    an invalid row or a source without rows stops the run, and nothing of it is
    published.
    """
    date = ingestion_date or dt.datetime.now(tz=dt.timezone.utc).date()
    with StagedRun(spark, raw_root) as run:
        reports = [_stage(run, landed, date, sample_rows) for landed in recognised(spark, landing)]
        bad = [r for r in reports if r.invalid]
        if bad:
            raise InvalidSource(f"invalid rows, nothing written: {[(r.source, r.invalid) for r in bad]}")
        empty = [r.source for r in reports if not r.rows]
        if empty:
            raise InvalidSource(f"no rows, nothing written: {empty}")
        if reports:
            run.publish()
    return reports


def recognised(spark: SparkSession, landing: str) -> list[Landed]:
    """The sources found in a landing folder, by file name."""
    paths = landed_files(spark, landing)
    out = [Landed(c.raw_name, paths[c.file_name], R.read_csv_table(spark, paths[c.file_name], c), c.min_rows, c)
           for c in OLIST.values() if c.file_name in paths]
    dumps = [("municipios.json", "ibge_localidades", R.municipios_rows, MUNICIPIO.min_rows),
             *((f"censo_{t}.json", f"ibge_censo_{t}", R.sidra_rows, n) for t, n in CENSUS_TABLES.items()),
             ("pix.json", "bcb_pix", R.pix_rows, PIX.min_rows)]
    return out + [Landed(source, paths[name], read(spark, paths[name]), minimum) for name, source, read, minimum in dumps if name in paths]
