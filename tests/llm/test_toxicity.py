"""The toxicity query itself: contract columns, held-out accuracy, and what its scores may not depend on."""

import os
import pickle
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerscope.llm import toxicity
from peerscope.llm.catalog import QUERIES

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op5_toxicity"](spark, SF).cache()


def test_contract_columns(spark, scored):
    assert dict(scored.dtypes) | {"rejected": "boolean"} == {
        "doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int", "rejected": "boolean"}
    rows = scored.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_held_out_precision_and_recall(spark, scored):
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("toxic IN (0, 1)").select("doc_id", "toxic").distinct()
    rows = scored.filter("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert len(rows) > 50 and hit / max(1, sum(r.predicted for r in rows)) >= 0.75 and hit / sum(r.toxic for r in rows) >= 0.6


def test_held_out_labels_and_other_columns_are_no_inputs(spark, scored, tmp_path):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic"))).write.parquet(str(tmp_path / "labels.parquet"))
    docs.withColumn("source", F.lit("x")).write.parquet(str(tmp_path / "documents.parquet"))
    again = {r.doc_id: r.score for r in QUERIES["op5_toxicity"](spark, str(tmp_path)).collect()}
    assert again == {r.doc_id: r.score for r in scored.collect()}


def test_a_model_that_travelled_scores_alike():
    rng, known = np.random.default_rng(0), {}
    texts = [toxicity.words_of(" ".join(rng.choice([f"w{i}" for i in range(500)], 30)) + (" bad" if i % 2 else ""), known) for i in range(200)]
    model = toxicity.Classifier().fit(texts, np.arange(200) % 2)
    raw = pickle.dumps(model)
    assert len(raw) < 1_000_000 and np.array_equal(pickle.loads(raw).score(texts), model.score(texts))
    assert np.array_equal(pickle.loads(pickle.dumps(toxicity.Classifier())).score(texts), np.zeros(200))


def test_every_labelled_row_is_learned_from(spark):
    """Rows behind the 8,000 smallest id hashes alone hold a second toxic word."""
    ids = spark.range(13_000).filter(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(4)) != 2)
    order = [r.id for r in ids.orderBy(F.xxhash64("id")).collect()]
    assert len(order) > 9_000
    toxic = {x: ("early" if n < 8_000 else "late") for n, x in enumerate(order) if n % 3 == 0}
    texts = [(i, f"plain text number n{i} {toxic.get(i, 'fine')}", "en") for i in range(13_000)] + [(-1, "plain text late", "en"), (-2, "plain text fine", "en")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in order], "doc_id long, toxic int")
    score = {r.doc_id: r.score for r in toxicity.score_documents(docs, labels).filter("doc_id < 0").collect()}
    assert score[-1] > 0.9 and score[-2] < 0.1


def test_shards_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 50)
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    one, same = toxicity.train(docs, labels)
    copies = docs.union(docs.limit(100)).repartition(7)
    two, again = toxicity.train(copies, labels)
    assert np.array_equal(one.words, two.words) and np.array_equal(one.dense(), two.dense()) and same == again
    assert toxicity._shards(docs, labels, None)[0].count() > 3


def test_long_batches_are_looked_at_in_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 90, (n, 2)).astype(np.int32) for n in (700, 1, 40)]
    model = toxicity.Classifier()
    model.words[:90] = rng.normal(0, 1, (90, toxicity.SIZE))
    row, starts = model._laid_out(texts)
    ends = np.append(starts[1:], len(row)) - toxicity.PAD
    kept, value = model._peaks(row, starts, ends)
    monkeypatch.setattr(toxicity, "PIECE", 64)
    again, other = model._peaks(row, starts, ends)
    assert np.array_equal(kept, again) and np.allclose(value, other, atol=1e-6)
