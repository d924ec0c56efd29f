"""Write, check, publish: all or nothing, interrupted runs, one read per landed file."""

import json
import os

import pytest

from peerscope.sources import publish
from peerscope.sources.ingest import InvalidSource, ingest_landing
from peerscope.sources.publish import EmptySnapshot, StagedRun, finish_publishing, write_all_or_nothing
from tests.fixture_raw import write_landing


def tree(root):
    """Every table of a raw layer with its rows' text."""
    return {d: sorted(os.listdir(os.path.join(root, d))) for d in sorted(os.listdir(root))} if os.path.exists(root) else {}


def rows_of(spark, root, source):
    return sorted(map(tuple, spark.read.parquet(os.path.join(root, source)).collect()), key=str)


HEADER_ONLY = {"product_category_name_translation.csv": "product_category_name,product_category_name_english\n",
               "municipios.json": "[]", "pix.json": '{"value": []}'}


@pytest.mark.parametrize("name", HEADER_ONLY)
def test_a_table_without_rows_publishes_nothing(spark, tmp_dir, name):
    landing, raw = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "raw")
    write_landing(spark, landing)
    path = os.path.join(landing, name)
    good = open(path, encoding="utf-8").read() if os.path.exists(path) else None
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER_ONLY[name])
    with pytest.raises(InvalidSource, match="no rows"):
        ingest_landing(spark, landing, raw, "2024-02-01")
    assert not os.path.exists(raw) and not os.path.exists(raw + "_staging")
    if good is None:
        os.remove(path)
    else:
        with open(path, "w", encoding="utf-8") as f:
            f.write(good)
    ingest_landing(spark, landing, raw, "2024-02-01")
    before = tree(raw), rows_of(spark, raw, "olist_sellers")
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER_ONLY[name])
    with open(os.path.join(landing, "olist_sellers_dataset.csv"), "a", encoding="utf-8") as f:
        f.write("s77,1000,x,SP\n")
    with pytest.raises(InvalidSource):
        ingest_landing(spark, landing, raw, "2024-02-01")
    assert (tree(raw), rows_of(spark, raw, "olist_sellers")) == before


@pytest.mark.parametrize("text", ['[{"NC": "6", "NN"', '[{"NC": "6"}]'])
def test_a_broken_document_publishes_nothing(spark, tmp_dir, text):
    landing, raw = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "raw")
    write_landing(spark, landing)
    with open(os.path.join(landing, "censo_9936.json"), "w", encoding="utf-8") as f:
        f.write(text)
    with pytest.raises(InvalidSource):
        ingest_landing(spark, landing, raw, "2024-02-01")
    assert not os.path.exists(raw)


def scans(spark, name):
    """How many executed plans read a landed file of this name."""
    store = spark._jsparkSession.sharedState().statusStore().executionsList()
    return sum(name in store.apply(i).physicalPlanDescription() for i in range(store.size()))


def test_each_landed_file_is_read_once(spark, tmp_dir):
    landing, raw = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "raw")
    write_landing(spark, landing)
    reports = {r.source: r for r in ingest_landing(spark, landing, raw, "2024-02-01")}
    for name in ("pix.json", "municipios.json", "censo_9514.json", "censo_10295.json"):
        assert scans(spark, os.path.join(landing, name)) == 1, name
    for source, r in reports.items():
        assert r.rows == spark.read.parquet(os.path.join(raw, source)).count() and r.invalid == 0
    records = json.load(open(os.path.join(landing, "pix.json"), encoding="utf-8"))["value"]
    left_out = sum(x.get("Municipio_Ibge") is None or x.get("Estado_Ibge") is None for x in records)
    assert (reports["bcb_pix"].rows, reports["bcb_pix"].discarded) == (len(records) - left_out, left_out)


def frames(spark, value):
    return {name: spark.createDataFrame([(value, name)], "x int, s string") for name in ("a", "b", "c")}


def test_several_frames_are_published_together(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw")
    assert write_all_or_nothing(spark, frames(spark, 1), root, "2024-01-01") == {"a": 1, "b": 1, "c": 1}
    with pytest.raises(EmptySnapshot, match="c"):
        write_all_or_nothing(spark, frames(spark, 2) | {"c": spark.createDataFrame([], "x int, s string")}, root, "2024-01-01")
    with pytest.raises(Exception, match="(?i)divide"):
        write_all_or_nothing(spark, frames(spark, 3) | {"c": spark.sql("SELECT 1 DIV id AS x, 's' AS s FROM range(1)")}, root, "2024-01-01")
    assert [rows_of(spark, root, s)[0][0] for s in "abc"] == [1, 1, 1]
    write_all_or_nothing(spark, frames(spark, 4), root, "2024-01-02")
    assert [len(rows_of(spark, root, s)) for s in "abc"] == [2, 2, 2] and not os.path.exists(root + "_staging")


@pytest.mark.parametrize("moves", range(6))
def test_an_interrupted_publishing_is_completed(spark, tmp_dir, monkeypatch, moves):
    root = os.path.join(tmp_dir, "raw")
    write_all_or_nothing(spark, frames(spark, 1), root, "2024-01-01")
    move, seen = publish.Folders.move, []

    def dies(self, source, target):
        if publish.JOURNAL not in target:
            if len(seen) == moves:
                raise OSError("lost")
            seen.append(target)
        move(self, source, target)

    monkeypatch.setattr(publish.Folders, "move", dies)
    with pytest.raises(OSError, match="lost"):
        write_all_or_nothing(spark, frames(spark, 2), root, "2024-01-01")
    monkeypatch.setattr(publish.Folders, "move", move)
    assert len(finish_publishing(spark, root)) == 1
    assert [rows_of(spark, root, s)[0][0] for s in "abc"] == [2, 2, 2]
    assert finish_publishing(spark, root) == []


def test_a_run_without_a_journal_is_removed(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw")
    with pytest.raises(ZeroDivisionError), StagedRun(spark, root) as run:
        run.write_partition(frames(spark, 1)["a"], "a", "2024-01-01")
        1 / 0
    assert not os.path.exists(root) and not os.path.exists(root + "_staging")
