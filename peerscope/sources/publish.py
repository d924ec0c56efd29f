"""Write, check, publish: folders are written aside and take their places together, or not at all.

Everything of a run is written below ``{root}_staging/run-...`` and checked there.  ``publish`` first writes the list of
moves as one small file, ``PUBLISH``: from then on the run counts as published.  The moves themselves are renames of
folders; one that is interrupted is completed from the list by ``finish_publishing``, which every later run calls
first.  A run that fails before has touched nothing but its own folder.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

JOURNAL = "PUBLISH"


class Folders:
    """The folder operations that publishing needs, on whatever file system a path names."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def children(self, path: str) -> list[str]:
        """Paths in a folder, by name; a missing folder has none."""
        fs, p = self._at(path)
        return sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.exists(p) else []

    def move(self, source: str, target: str) -> None:
        fs, p = self._at(source)
        t = self._jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(t.getParent())
        if not fs.rename(p, t):
            raise OSError(f"could not move {source} to {target}")

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def write(self, path: str, text: str) -> None:
        """A small file that appears whole or not at all."""
        part = f"{path}.{uuid.uuid4().hex}"
        fs, p = self._at(part)
        out = fs.create(p, False)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(part, path)

    def read(self, path: str, most: int | None = None) -> str:
        """A file's text, or that of its first ``most`` bytes."""
        fs, p = self._at(path)
        source = fs.open(p)
        try:
            raw = source.readAllBytes() if most is None else source.readNBytes(most)
            return bytes(raw).decode("utf-8", "strict" if most is None else "replace")
        finally:
            source.close()


def staging_root(root: str) -> str:
    return f"{root.rstrip('/')}_staging"


def finish_publishing(spark: SparkSession, root: str, staging: str | None = None) -> list[str]:
    """Complete the moves of published runs that were interrupted, oldest run first; the runs completed.

    A staging folder has one writer at a time, so a list found there belongs to a run that ended.
    """
    folders = Folders(spark)
    done = []
    for run in folders.children(staging or staging_root(root)):
        if folders.exists(f"{run}/{JOURNAL}"):
            _move_all(folders, run, json.loads(folders.read(f"{run}/{JOURNAL}")))
            done.append(run)
    return done


def _move_all(folders: Folders, run: str, moves: list[list[str]]) -> None:
    for source, target, kept in moves:
        if not folders.exists(source):  # moved before the interruption
            continue
        if folders.exists(target):
            aside = kept or f"{run}/replaced-{uuid.uuid4().hex}"
            if kept and folders.exists(kept):
                folders.move(kept, f"{run}/replaced-{uuid.uuid4().hex}")
            folders.move(target, aside)
        folders.move(source, target)
    folders.delete(run)


class StagedRun:
    """One run's folders, written aside.  Use as a context: what is not published is removed at the end."""

    def __init__(self, spark: SparkSession, root: str, staging: str | None = None) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.staging = staging or staging_root(root)
        finish_publishing(spark, root, self.staging)
        now = dt.datetime.now(tz=dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        self.folder = f"{self.staging}/run-{now}-{uuid.uuid4().hex[:8]}"
        self.moves: list[list[str]] = []

    def __enter__(self) -> "StagedRun":
        return self

    def __exit__(self, *_) -> None:
        folders = Folders(self.spark)
        if not folders.exists(f"{self.folder}/{JOURNAL}"):
            folders.delete(self.folder)
        if not folders.children(self.staging):
            folders.delete(self.staging)

    def place(self, name: str, target: str, kept: str | None = None) -> str:
        """The folder to write ``target``'s new content to; ``kept``: where its old content goes, removed if None."""
        source = f"{self.folder}/{name}"
        self.moves.append([source, target, kept])
        return source

    def write_partition(self, df: DataFrame, source: str, ingestion_date: dt.date | str,
                        observation: Observation | None = None) -> int:
        """B1: write a source's snapshot aside as its ``ingestion_date`` partition; the rows counted.

        An ``observation`` that ``df`` already carries has its own ``rows``.
        """
        day = f"ingestion_date={ingestion_date}"
        rows = observation or Observation(f"staged_{uuid.uuid4().hex}")
        observed = df if observation else df.observe(rows, F.count(F.lit(1)).alias("rows"))
        observed.write.option("compression", "snappy").parquet(self.place(f"{source}/{day}", f"{self.root}/{source}/{day}"))
        return int(rows.get["rows"])

    def publish(self) -> None:
        """Give every folder its place; nothing of the run is visible before, all of it after."""
        folders = Folders(self.spark)
        folders.write(f"{self.folder}/{JOURNAL}", json.dumps(self.moves))
        _move_all(folders, self.folder, self.moves)


def write_all_or_nothing(spark: SparkSession, frames: Mapping[str, DataFrame], root: str, ingestion_date: dt.date | str) -> dict[str, int]:
    """The snapshots of several sources, published together; rows of each.  One without rows stops them all."""
    with StagedRun(spark, root) as run:
        rows = {name: run.write_partition(df, name, ingestion_date) for name, df in frames.items()}
        empty = [name for name, n in rows.items() if not n]
        if empty:
            raise EmptySnapshot(f"no rows to land for {', '.join(empty)}; nothing was published")
        run.publish()
    return rows


class EmptySnapshot(ValueError):
    """A snapshot of no rows was to be landed."""
