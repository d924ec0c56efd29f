"""Incremental append: Bloom filters, exactness against sets, plans that follow the batch."""

import os
import random

import pytest
from pyspark.sql import functions as F

from peerscope.sources import append as A
from peerscope.sources import publish


def batch(spark, xs):
    return spark.createDataFrame([(x, None if x is None else f"h{x}") for x in xs], "x long, row_hash string").repartition(3)


def stored(spark, path):
    return [r.x for r in spark.read.parquet(path).collect()]


def test_appends_equal_sets(spark, tmp_dir):
    rng, path, known = random.Random(1), os.path.join(tmp_dir, "t"), set()
    for n in (3, 500, 40, 500, 0, 2000):
        xs = [rng.randrange(3000) for _ in range(n)]
        assert A.append_new_rows(batch(spark, xs), path, spark) == len(set(xs) - known)
        known |= set(xs)
        assert sorted(stored(spark, path)) == sorted(known)
        assert A.append_new_rows(batch(spark, xs), path, spark) == 0
    assert len(spark.read.parquet(A.filters_path(path)).select("level").distinct().collect()) > 2
    assert A.append_new_rows(batch(spark, [None, None, 1]), path, spark) == 1 + (1 not in known)
    assert A.append_new_rows(batch(spark, [None]), path, spark) == 1  # a null fingerprint equals nothing


def test_filters_have_every_fingerprint_and_few_others(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    A.append_new_rows(batch(spark, range(4000)), path, spark)
    asked = batch(spark, range(8000)).select("row_hash")
    maybe = {r.row_hash for r in A.maybe_stored(spark, asked, path, "row_hash", [A.filter_level(4000)]).collect()}
    assert {f"h{x}" for x in range(4000)} <= maybe and len(maybe) < 4000 + 4000 * 0.1
    assert {r.row_hash for r in A.known_fingerprints(spark, asked, path, "row_hash", os.path.join(tmp_dir, "maybe")).collect()} == {f"h{x}" for x in range(4000)}


def test_stored_fingerprints_are_not_shuffled(spark, tmp_dir):
    """With a small batch neither the filters nor the stored rows are exchanged, and only the matching appends are read."""
    path = os.path.join(tmp_dir, "t")
    for i in range(3):
        A.append_new_rows(batch(spark, range(i * 1000, i * 1000 + 1000)), path, spark)
    fresh = batch(spark, range(1500, 1510)).select("row_hash")
    fresh.write.parquet(os.path.join(tmp_dir, "fresh"))
    fresh = spark.read.parquet(os.path.join(tmp_dir, "fresh"))
    found = A.known_fingerprints(spark, fresh, path, "row_hash", os.path.join(tmp_dir, "maybe"))
    assert found.count() == 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    below = [line for line in plan.split("== Initial Plan ==")[0].splitlines() if "SortMergeJoin" in line]
    assert not below and "BroadcastHashJoin" in plan
    matching = {r.append_id for r in spark.read.parquet(os.path.join(tmp_dir, "maybe")).collect()}
    assert len(matching) < 3 and all(a in plan for a in matching) and "PartitionFilters: [isnotnull(append_id" in plan


def test_a_lost_append_adds_nothing(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    A.append_new_rows(batch(spark, range(5)), path, spark)
    monkeypatch.setattr(A, "bloom_filter", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        A.append_new_rows(batch(spark, range(10)), path, spark)
    assert sorted(stored(spark, path)) == list(range(5))
    monkeypatch.undo()
    move, seen = publish.Folders.move, []

    def dies(self, source, target):
        if publish.JOURNAL not in target:
            if seen:
                raise OSError("lost")
            seen.append(target)
        move(self, source, target)

    monkeypatch.setattr(publish.Folders, "move", dies)
    with pytest.raises(OSError):
        A.append_new_rows(batch(spark, range(10)), path, spark)
    monkeypatch.undo()
    assert A.append_new_rows(batch(spark, range(10)), path, spark) == 0  # the published append is completed first
    assert sorted(stored(spark, path)) == list(range(10))


def test_a_table_without_filters_keeps_its_layout(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    batch(spark, range(5)).write.parquet(path)
    assert A.append_new_rows(batch(spark, range(8)), path, spark) == 3
    assert sorted(stored(spark, path)) == list(range(8)) and "append_id" not in spark.read.parquet(path).columns


def test_rows_with_partition_like_columns(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    rows = batch(spark, range(4)).withColumns({"level": F.lit(1), "slot": F.lit(2), "word": F.lit("w"), "mask": F.lit("m")})
    assert A.append_new_rows(rows, path, spark) == 4 and A.append_new_rows(rows, path, spark) == 0
