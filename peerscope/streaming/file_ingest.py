"""Event-driven file ingest with Structured Streaming (K1-K4).

A stream over the *listing* of a landing folder (``pathGlobFilter`` = the table's file name pattern, which is also how
unknown files are ignored, K2) hands each micro-batch a bounded number of files.  Their columns are bound by the names
in each file's own header; files that break the contract are quarantined, whole (K3); the others land in the raw layer
as a dated partition (B1).

A ledger, a table beside the checkpoint, remembers every version of a file (name, modification time, length) with what
became of it.  Rows, quarantine and ledger of a micro-batch are published together, so a micro-batch that is replayed
finds its files in the ledger and adds nothing.  A file that is uploaded again under its old name has another version:
``ingest_stream`` looks for such files once the stream has drained the folder, and the new version replaces the rows of
the old one (K4).  If the new version is rejected, the old rows stay.  ``Trigger.AvailableNow`` processes what is there
and stops, so the same job runs on a schedule or on demand; a new checkpoint starts a new ledger and reads all again.
"""

from __future__ import annotations

import csv
import hashlib
import threading
import uuid
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from peerscope.operators.dedup import latest_per_key
from peerscope.sources.contracts import TableContract
from peerscope.sources.publish import Folders, StagedRun

MAX_FILES = 1000  # of a micro-batch
HEADER_BYTES = 1 << 16
LISTING = "path string, modificationTime timestamp, length long, content binary"
LEDGER = "file string, modified timestamp, length long, status string, rows long, landed_at timestamp, ingestion_date date, batch_id string"
LANDED = "landed"
_ONE_AT_A_TIME: defaultdict[str, threading.Lock] = defaultdict(threading.Lock)  # writers of one ledger in this process


@dataclass
class IngestReport:
    table: str
    batches: int
    rows_in: int
    rows_written: int
    rows_rejected: int
    low_volume: bool


def _versions(listing: DataFrame) -> DataFrame:
    """(path, file, modified, length) of listed files; contents are not read."""
    return listing.select("path", F.col("_metadata.file_path").alias("file"), F.col("modificationTime").alias("modified"), "length")


def list_files(spark: SparkSession, landing: str, pattern: str) -> DataFrame:
    """The versions of the files in a landing folder that a table's pattern names."""
    return _versions(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(landing))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Every version of a file that was handled, with what became of it."""
    if not Folders(spark).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def pending(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Versions that were not handled yet: new files, and files uploaded again under their old name."""
    known = ledger.select("file", "modified", "length")
    return listing.join(known, ["file", "modified", "length"], "left_anti")


def _header(folders: Folders, path: str) -> tuple[str, ...]:
    """Column names of a file's first line."""
    first = folders.read(path, HEADER_BYTES).lstrip("\ufeff").splitlines()[:1]
    return tuple(c.strip() for c in next(csv.reader(first), ())) if first else ()


def _literal(path: str) -> str:
    """A path whose special characters a reader takes as they are."""
    return "".join(f"\\{c}" if c in "\\*?[]{}" else c for c in path)


def _read_group(spark: SparkSession, header: Sequence[str], paths: Sequence[str], contract: TableContract) -> DataFrame:
    """Rows of files that share a header: the contract's columns as text, and the file they are from."""
    rows = (spark.read.schema(", ".join(f"`{c}` string" for c in header)).option("header", True).option("escape", '"')
            .option("quote", '"').option("multiLine", contract.multiline).csv([_literal(p) for p in paths]))
    return rows.select(*[F.col(f"`{n}`") for n in contract.text_schema.fieldNames()], F.col("_metadata.file_path").alias("_file"))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


class FileLander:
    """Lands batches of files of one table: binds, checks, splits and publishes them."""

    def __init__(self, spark: SparkSession, contract: TableContract, raw_root: str, checkpoint: str, quarantine: str,
                 whole_file: bool = True, ingestion_date=None) -> None:
        self.spark, self.contract, self.whole_file, self.ingestion_date = spark, contract, whole_file, ingestion_date
        self.raw = f"{raw_root.rstrip('/')}/{contract.raw_name}"
        self.quarantine = f"{quarantine.rstrip('/')}/{contract.name}"
        self.ledger = f"{checkpoint.rstrip('/')}_ledger"
        self.key = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:8]
        self.stats = {"batches": 0, "rows_in": 0, "written": 0, "rejected": 0}

    def land(self, files: DataFrame, batch: str) -> None:
        """Land those of ``files`` (versions, at most ``MAX_FILES`` or so) that the ledger does not have yet."""
        with _ONE_AT_A_TIME[self.ledger], StagedRun(self.spark, self.raw, f"{self.ledger}_staging") as run:
            ledger = read_ledger(self.spark, self.ledger)
            todo = {f.file: f for f in pending(files, ledger).collect()}
            if todo:
                self._land(run, todo, ledger, f"{self.key}-{batch}")
                run.publish()

    def _land(self, run: StagedRun, todo: dict[str, Row], ledger: DataFrame, batch: str) -> None:
        names = set(self.contract.text_schema.fieldNames())
        folders, groups, unbound = Folders(self.spark), defaultdict(list), {}
        for f in todo.values():
            header = _header(folders, f.path)
            missing = sorted(names.difference(header))
            twice = sorted(n for n in names if header.count(n) > 1) or len(set(map(str.lower, header))) < len(header)
            if missing or twice:
                unbound[f.file] = f"no column {', '.join(missing)} in the header" if missing else "a column name appears twice in the header"
            else:
                groups[header].append(f.path)
        status, counts = dict(unbound), {}
        date = self.ingestion_date or max(f.modified for f in todo.values()).date()
        if groups:
            rows = _union([_read_group(self.spark, h, paths, self.contract) for h, paths in groups.items()]) \
                .withColumn("_valid", self.contract.validity()).persist()  # read once, used by the counts and by both sinks
            found = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("_valid")).alias("bad")).collect()
            counts = {r["_file"]: (r["n"], r["bad"]) for r in found}
            if self.whole_file:
                status |= {f: f"{bad} invalid rows" for f, (_, bad) in counts.items() if bad}
            good = self._good(rows, status)
            landed = f"ingestion_date={date}/batch_id={batch}"
            typed = good.select(*[(F.col(n).try_cast(t) if t.simpleString() != "string" else F.col(n)).alias(n)
                                  for n, t, _ in self.contract.fields], F.col("_file").alias("_source_file"))
            typed.write.parquet(run.place("rows", f"{self.raw}/{landed}"))
            self._replace(run, ledger, [f for f in todo if f not in status])
        kept_aside = []
        if groups:
            rejected = rows.filter(F.col("_file").isin([f for f in status if f not in unbound])) if self.whole_file else rows.filter(~F.col("_valid"))
            kept_aside.append(rejected.drop("_valid").withColumn("_line", F.lit(None).cast("string")))
        if unbound:
            lines = self.spark.read.text([_literal(todo[f].path) for f in unbound]).select(
                *[F.lit(None).cast("string").alias(n) for n in self.contract.text_schema.fieldNames()],
                F.col("_metadata.file_path").alias("_file"), F.col("value").alias("_line"))
            kept_aside.append(lines)
        reason = F.create_map(*[F.lit(x) for pair in (status or {"": ""}).items() for x in pair])
        aside = _union(kept_aside).withColumn("_reason", F.coalesce(F.try_element_at(reason, F.col("_file")), F.lit("invalid row")))
        aside.write.parquet(run.place("quarantine", f"{self.quarantine}/batch_id={batch}"))
        entries = [(f.file, f.modified, f.length, status.get(f.file, LANDED), int(counts.get(f.file, (0, 0))[0]), date) for f in todo.values()]
        schema = "file string, modified timestamp, length long, status string, rows long, ingestion_date string"
        self.spark.createDataFrame([(*e[:5], str(e[5])) for e in entries], schema) \
            .withColumn("ingestion_date", F.col("ingestion_date").cast("date")).withColumn("landed_at", F.current_timestamp()) \
            .write.parquet(run.place("ledger", f"{self.ledger}/batch_id={batch}"))
        self._count(counts, unbound, status, aside)
        if groups:
            rows.unpersist()

    def _good(self, rows: DataFrame, status: dict[str, str]) -> DataFrame:
        return rows.filter(~F.col("_file").isin(list(status))) if self.whole_file else rows.filter("_valid")

    def _replace(self, run: StagedRun, ledger: DataFrame, files: list[str]) -> None:
        """Rewrite the partitions that hold older versions of files that land now, without them."""
        before = latest_per_key(ledger.filter((F.col("status") == LANDED) & F.col("file").isin(files)), ["file"], "landed_at", ["batch_id"])
        places = defaultdict(list)
        for r in before.collect():
            places[f"ingestion_date={r.ingestion_date}/batch_id={r.batch_id}"].append(r.file)
        for i, (place, old) in enumerate(sorted(places.items())):
            part = self.spark.read.parquet(f"{self.raw}/{place}")
            part.filter(~F.col("_source_file").isin(old)).write.parquet(run.place(f"rewritten-{i}", f"{self.raw}/{place}"))

    def _count(self, counts: dict[str, tuple[int, int]], unbound: dict[str, str], status: dict[str, str], aside: DataFrame) -> None:
        if self.whole_file:
            bad = sum(n for f, (n, _) in counts.items() if f in status)
        else:
            bad = sum(b for _, b in counts.values())
        lines = aside.filter(F.col("_file").isin(list(unbound))).count() if unbound else 0
        n = sum(n for n, _ in counts.values())
        self.stats["batches"] += 1
        self.stats["rows_in"] += n + lines
        self.stats["written"] += n - bad
        self.stats["rejected"] += bad + lines


def _lander(spark, landing, contract, raw_root, checkpoint, quarantine_root, whole_file, ingestion_date) -> FileLander:
    return FileLander(spark, contract, raw_root, checkpoint, quarantine_root or f"{raw_root.rstrip('/')}_quarantine", whole_file, ingestion_date)


def _pattern(contract: TableContract, glob: str | None) -> str:
    return glob or contract.file_name or "*.csv"


def start_ingest_stream(
    spark: SparkSession,
    landing: str,
    contract: TableContract,
    raw_root: str,
    checkpoint: str,
    quarantine_root: str | None = None,
    glob: str | None = None,
    whole_file: bool = True,
    ingestion_date=None,
    processing_time: str | None = None,
    max_files: int = MAX_FILES,
):
    """Start the ingest stream for one table (K1); returns ``(query, stats)``.

    ``processing_time=None`` processes what has landed and stops
    (``availableNow``); a value such as ``"1 minute"`` keeps the stream
    running and picks up each new file as it lands - the streaming
    counterpart of an upload event.  A micro-batch takes at most ``max_files``
    files.

    Rows land in the folder that the layered build reads (``raw_name``).
    ``whole_file``: any invalid row rejects its whole file (a file either lands
    completely or not at all); otherwise rows are rejected one by one.  Rejected
    rows, and the lines of files whose header lacks a column, always go to a
    quarantine, by default beside the raw layer, with the reason.  Without
    ``ingestion_date`` a batch is dated by its newest file.
    """
    lander = _lander(spark, landing, contract, raw_root, checkpoint, quarantine_root, whole_file, ingestion_date)
    listing = (spark.readStream.format("binaryFile").schema(LISTING).option("pathGlobFilter", _pattern(contract, glob))
               .option("maxFilesPerTrigger", max_files).load(landing))

    def handle(files: DataFrame, batch_id: int) -> None:
        lander.land(files, f"{batch_id:08d}")

    w = _versions(listing).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if processing_time is None else w.trigger(processingTime=processing_time)
    return w.start(), lander.stats


def ingest_changed(
    spark: SparkSession,
    landing: str,
    contract: TableContract,
    raw_root: str,
    checkpoint: str,
    quarantine_root: str | None = None,
    glob: str | None = None,
    whole_file: bool = True,
    ingestion_date=None,
    max_files: int = MAX_FILES,
) -> dict[str, int]:
    """K4: land the files whose version the ledger does not have, ``max_files`` at a time, whatever their names.

    This is how a file uploaded again under its old name is found: the stream remembers names only.
    """
    lander = _lander(spark, landing, contract, raw_root, checkpoint, quarantine_root, whole_file, ingestion_date)
    listing = list_files(spark, landing, _pattern(contract, glob))
    while todo := pending(listing, read_ledger(spark, lander.ledger)).orderBy("modified", "file").limit(max_files).collect():
        some = spark.createDataFrame(todo, listing.select("file", "modified", "length", "path").schema)
        lander.land(some, f"again-{uuid.uuid4().hex}")
    return lander.stats


def ingest_stream(
    spark: SparkSession,
    landing: str,
    contract: TableContract,
    raw_root: str,
    checkpoint: str,
    quarantine_root: str | None = None,
    glob: str | None = None,
    whole_file: bool = True,
    ingestion_date=None,
    max_files: int = MAX_FILES,
) -> IngestReport:
    """Run the ingest for one table until the landing folder is drained (K1), files uploaded again included (K4)."""
    q, stats = start_ingest_stream(spark, landing, contract, raw_root, checkpoint, quarantine_root, glob,
                                   whole_file, ingestion_date, max_files=max_files)
    q.awaitTermination()
    again = ingest_changed(spark, landing, contract, raw_root, checkpoint, quarantine_root, glob, whole_file, ingestion_date, max_files)
    total = {k: n + again[k] for k, n in stats.items()}
    low = contract.min_rows > 0 and total["written"] < contract.min_rows
    return IngestReport(contract.name, total["batches"], total["rows_in"], total["written"], total["rejected"], low)


def unrecognised_files(spark: SparkSession, landing: str, known: list[str]) -> DataFrame:
    """K2: landed files whose name matches no table (content is not read).

    ``known`` are file names; like the dispatch, each covers its re-uploads under a further suffix.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    stems = [k.rpartition(".") for k in known]
    fits = F.lit(False)
    for stem, dot, ext in stems:
        fits = fits | (name.startswith(stem or ext) & name.endswith(dot + ext if stem else ""))
    return files.filter(~fits).select("path", name.alias("file_name"))


def stem_glob(file_name: str) -> str:
    """``olist_orders_dataset.csv`` -> ``olist_orders_dataset*.csv``.

    The landed name selects the table (K1); an upload under a further suffix
    (``..._2.csv``) is a further file of it.
    """
    stem, dot, ext = file_name.rpartition(".")
    return f"{stem}*.{ext}" if dot else f"{file_name}*"


def ingest_all_streams(
    spark: SparkSession,
    landing: str,
    raw_root: str,
    checkpoint_root: str,
    quarantine_root: str | None = None,
    contracts: dict | None = None,
    ingestion_date=None,
) -> dict[str, IngestReport]:
    """K1 + K2: one ``availableNow`` stream per business table, dispatched by
    file name; files matching no table are left alone (list them with
    ``unrecognised_files``)."""
    from peerscope.sources.contracts import OLIST

    out = {}
    for key, c in (contracts or OLIST).items():
        if not c.file_name:
            continue
        out[key] = ingest_stream(
            spark, landing, c, raw_root, f"{checkpoint_root.rstrip('/')}/{c.name}", quarantine_root,
            glob=stem_glob(c.file_name), ingestion_date=ingestion_date)
    return out
