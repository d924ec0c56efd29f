"""Snapshot choice from listings and footers, and JSON lines of any shape."""

import os

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from peerscope.sources import readers as R


def land(spark, root, date, n):
    spark.range(n).selectExpr("id", f"'{date}' AS v").coalesce(1).write.parquet(os.path.join(root, f"ingestion_date={date}"))


def test_broken_snapshots_are_passed_over(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw", "s")
    for date, n in (("2024-01-01", 100), ("2024-01-02", 90), ("2024-01-03", 20), ("2024-01-04", 0)):
        land(spark, root, date, n)
    os.makedirs(os.path.join(root, "ingestion_date=2024-01-05"))  # no file at all
    os.makedirs(os.path.join(root, "ingestion_date=2024-01-06"))
    with open(os.path.join(root, "ingestion_date=2024-01-06", "part-0.parquet"), "wb") as f:
        f.write(b"not parquet")
    registry = R.SourceRegistry(spark, os.path.join(tmp_dir, "raw"))
    df = registry.read_snapshot("s")
    assert (df.count(), {str(r.ingestion_date) for r in df.collect()}) == (20, {"2024-01-03"})
    assert [v for v, _ in registry.chosen["s"].passed_over] == ["2024-01-06", "2024-01-05", "2024-01-04"]
    assert R.choose_snapshot(spark, root, min_share=0.5).value == "2024-01-02"
    assert R.choose_snapshot(spark, root, min_rows=95).value == "2024-01-01"
    assert R.choose_snapshot(spark, root, min_rows=1000) is None
    assert R.snapshot_values(spark, os.path.join(tmp_dir, "none")) == []
    with pytest.raises(R.InvalidSource):
        registry.read_snapshot("none")


def test_one_partition_is_read(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw", "s")
    for date in ("2024-01-01", "2024-01-02"):
        land(spark, root, date, 10)
    df = R.SourceRegistry(spark, os.path.join(tmp_dir, "raw")).register(["s"], ["s"])["s"]
    files = df.inputFiles()
    assert len(files) == 1 and "2024-01-02" in files[0]
    assert [f.name for f in df.schema] == ["id", "v", "ingestion_date"] and dict(df.dtypes)["ingestion_date"] == "date"
    assert spark.sql("SELECT count(*) FROM raw_s").first()[0] == 10


def test_json_lines_of_any_shape(spark, tmp_dir):
    lines = ['{"a": 1, "b": "x"}', '{"a": "oops", "c": {"d": [1, 2]}}', "{not json", "", "  ", "3", "null", '["a"]', "{}", '{"a": null}',
             '{"a": 5, "a b": true}', '{"a": 99999999999999999999999}']
    path = os.path.join(tmp_dir, "x.jsonl")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines))
    df = R.read_jsonl_variant(spark, path)
    assert sorted(r._bad for r in df.filter("NOT _valid").collect()) == sorted(["{not json", "3", "null", '["a"]'])
    assert df.filter("_valid").count() == 6 and df.filter("_valid AND record IS NULL").count() == 0
    bound = R.bind_fields(df.filter("_valid"), StructType([StructField("a", LongType()), StructField("b", StringType())]))
    assert sorted((r.a, r.b) for r in bound.collect() if r.a is not None) == [(1, "x"), (5, None)]
    fields = {(r.field, r.type): r.n for r in R.observed_fields(df.filter("_valid")).collect() if r.field is not None}
    assert fields[("a", "BIGINT")] == 2 and fields[("a", "STRING")] == 1 and fields[("c", "OBJECT")] == 1 and fields[("a b", "BOOLEAN")] == 1
    assert R.observed_fields(df.filter("false")).collect() == []
