"""Readers and writers: CSV contracts, nested JSON, SIDRA, OData payload, raw partitions."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from peerscope.operators.dedup import latest_snapshot
from peerscope.sources import contracts as K
from peerscope.sources import readers as R
from peerscope.sources import sinks as W


def test_csv_contract_multiline_and_validity(spark, tmp_dir):
    p = os.path.join(tmp_dir, "olist_order_reviews_dataset.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("review_id,order_id,review_score,review_comment_title,review_comment_message,"
                "review_creation_date,review_answer_timestamp\n")
        f.write('r1,o1,5,,"linha um\nlinha ""dois""",2018-01-01 00:00:00,2018-01-02 10:00:00\n')
        f.write("r2,o2,x,,,2018-01-01 00:00:00,2018-01-02 10:00:00\n")
        f.write("r3,,4,,,2018-01-01 00:00:00,2018-01-02 10:00:00\n")
    df = R.read_csv_table(spark, p, K.OLIST["order_reviews"])
    rows = {r.review_id: r for r in df.collect()}
    assert rows["r1"].review_comment_message == 'linha um\nlinha "dois"'
    assert [rows[k]._valid for k in ("r1", "r2", "r3")] == [True, False, False]
    typed = R.typed_valid_rows(df, K.OLIST["order_reviews"]).first()
    assert typed.review_score == 5 and R.sample_check(df, 1000) == 2


def test_contract_dispatch():
    assert K.contract_for_file("olist_orders_dataset.csv").name == "orders"
    assert K.contract_for_file("unknown.csv") is None


def test_municipios_json(spark, tmp_dir):
    full = {"id": 7700101, "nome": "Vale d'Agua",
            "microrregiao": {"id": 77001, "nome": "Serra", "mesorregiao": {"id": 7701, "nome": "Planalto"}},
            "regiao-imediata": {"id": 770001, "nome": "Serra", "regiao-intermediaria": {
                "id": 7701, "nome": "Vau", "UF": {"id": 77, "sigla": "XY", "nome": "Provincia",
                                                        "regiao": {"id": 1, "sigla": "N", "nome": "Norte"}}}}}
    no_micro = dict(full, id=2, microrregiao=None)
    broken = {"id": 3, "nome": "X"}
    p = os.path.join(tmp_dir, "mun.json")
    with open(p, "w", encoding="utf-8") as f:
        json.dump([full, no_micro, broken], f)
    rows = {r.id_municipio: r for r in R.read_municipios_json(spark, p).collect()}
    assert rows[7700101].uf_sigla == "XY" and rows[7700101].mesorregiao_nome == "Planalto"
    assert rows[2].microrregiao_id is None and rows[2]._valid
    assert not rows[3]._valid


def test_sidra_header_and_sentinels(spark, tmp_dir):
    header = {k: k for k in ["NC", "NN", "MC", "MN", "D1C", "D1N", "D2C", "D2N", "D3C", "D3N", "D4C", "D4N"]}
    header["V"] = "Valor"
    base = {"NC": "6", "NN": "Município", "MC": "45", "MN": "Pessoas", "D1N": "X", "D2C": "93", "D2N": "Pop",
            "D3C": "2022", "D3N": "2022", "D4C": "6794", "D4N": "Total"}
    rows = [header, dict(base, D1C="7700101", V="1234"), dict(base, D1C="7700102", V="-"),
            dict(base, D1C="7700103", V="...", D5C="1", D5N="a")]
    p = os.path.join(tmp_dir, "sidra.json")
    with open(p, "w", encoding="utf-8") as f:
        json.dump(rows, f)
    out = {r.D1C: r for r in R.read_sidra_json(spark, p).collect()}
    assert set(out) == {"7700101", "7700102", "7700103"}
    assert out["7700101"].V == "1234" and out["7700102"].V is None and out["7700103"].V is None
    assert out["7700101"].D5C is None and out["7700103"].D5N == "a"


def test_pix_payload(spark, tmp_dir):
    rec = {n: 1 for n, _, _ in K.PIX.fields}
    rec.update(AnoMes=202211, Municipio_Ibge=7700104.0, Estado_Ibge=43.0, Municipio="X", Estado="RS",
               Sigla_Regiao="S", Regiao="SUL", VL_PagadorPF=1.5, VL_PagadorPJ=2.0, VL_RecebedorPF=1.0,
               VL_RecebedorPJ=3.0)
    p = os.path.join(tmp_dir, "pix.json")
    with open(p, "w", encoding="utf-8") as f:
        json.dump({"value": [rec, dict(rec, Municipio_Ibge=None), dict(rec, Estado_Ibge=None)]}, f)
    kept, discarded = R.read_pix_json(spark, p)
    r = kept.first()
    assert kept.count() == 1 and r.Municipio_Ibge == 7700104 and discarded.first().descartados == 2


def test_raw_partitions_latest_snapshot_and_rerun(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw")
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(1, "a2"), (3, "c")], "id int, v string")
    W.write_raw_partition(old, root, "src", dt.date(2024, 1, 1))
    W.write_raw_partition(new, root, "src", dt.date(2024, 2, 1))
    W.write_raw_partition(new, root, "src", dt.date(2024, 2, 1))  # same-day rerun replaces the partition
    reg = R.SourceRegistry(spark, root)
    df = reg.read("src")
    assert df.count() == 4
    latest = latest_snapshot(df)
    assert sorted((r.id, r.v) for r in latest.collect()) == [(1, "a2"), (3, "c")]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "ingestion_date" in plan


def test_append_new_rows_and_materialize(spark, tmp_dir):
    from peerscope.functions.columns import row_hash
    path = os.path.join(tmp_dir, "tbl")
    a = spark.createDataFrame([(1,), (2,)], "x int").withColumn("row_hash", row_hash("x"))
    b = spark.createDataFrame([(2,), (3,)], "x int").withColumn("row_hash", row_hash("x"))
    assert W.append_new_rows(a, path, spark) == 2
    assert W.append_new_rows(b, path, spark) == 1
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    name = W.materialize(spark, a, "staging_t", "m1", os.path.join(tmp_dir, "wh", "m1"))
    assert spark.table(name).count() == 2


def test_jsonl_fallback(spark, tmp_dir):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    p = os.path.join(tmp_dir, "x.jsonl")
    with open(p, "w", encoding="utf-8") as f:
        f.write('{"a": 1, "b": "x"}\n{"a": "oops", "b": "y"}\n{not json\n')
    df = R.read_jsonl(spark, p, StructType([StructField("a", LongType()), StructField("b", StringType())]))
    assert [r._valid for r in df.orderBy(F.col("_bad").asc_nulls_first()).collect()] == [True, False, False]


def test_write_all_or_nothing(spark, tmp_dir):
    from peerscope.operators.quality import Check, QualityGateError, QualitySuite
    good = spark.createDataFrame([(1,)], "x int")
    bad = spark.createDataFrame([(None,)], "x int")
    root = os.path.join(tmp_dir, "raw")
    suites = {"a": QualitySuite("a", good, [Check("nn", "not_null", column="x")]),
              "b": QualitySuite("b", bad, [Check("nn", "not_null", column="x")])}
    import pytest
    with pytest.raises(QualityGateError):
        W.write_all_or_nothing({"a": good, "b": bad}, suites, root, "2024-01-01")
    assert not os.path.exists(root)  # nothing written
    W.write_all_or_nothing({"a": good}, {"a": suites["a"]}, root, "2024-01-01")
    assert spark.read.parquet(os.path.join(root, "a")).count() == 1


def test_catalog_descriptions(spark):
    from peerscope.operators.quality import undocumented_columns
    spark.sql("CREATE DATABASE IF NOT EXISTS marts_doc")
    spark.sql("DROP TABLE IF EXISTS marts_doc.t")
    spark.sql("CREATE TABLE marts_doc.t (a INT COMMENT 'described', b INT) USING parquet")
    assert undocumented_columns(spark, "marts_doc.t") == ["b"]


def test_batch_writes_are_idempotent(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    W.write_raw_partition(df, root, "s", "2024-01-01", batch_id="a-7")
    W.write_raw_partition(df, root, "s", "2024-01-01", batch_id="a-7")  # replay of batch 7
    W.write_raw_partition(df.limit(1), root, "s", "2024-01-01", batch_id="b-7")  # another stream's batch 7
    got = spark.read.parquet(os.path.join(root, "s"))
    assert got.count() == 3
    assert sorted(r.batch_id for r in got.select("batch_id").distinct().collect()) == ["a-7", "b-7"]


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_csv_columns_are_bound_by_name(spark, tmp_dir):
    import pytest

    c = K.OLIST["category_translation"]
    p = _write(os.path.join(tmp_dir, "a.csv"), "product_category_name_english,more,product_category_name\ntoys,1,brinquedos\n")
    r = R.read_csv_table(spark, p, c).first()
    assert (r.product_category_name, r.product_category_name_english, r._valid) == ("brinquedos", "toys", True)
    p = _write(os.path.join(tmp_dir, "b.csv"), "product_category_name,other\nbrinquedos,toys\n")
    with pytest.raises(R.InvalidSource, match="product_category_name_english"):
        R.read_csv_table(spark, p, c)


def _pix(**changes):
    rec = {n: 1 for n, _, _ in K.PIX.fields} | dict(AnoMes=202211, Municipio_Ibge=7700104.0, Estado_Ibge=77.0, Municipio="X",
                                                    Estado="XY", Sigla_Regiao="S", Regiao="SUL")
    return rec | changes


def test_payment_values_that_do_not_fit_are_invalid(spark, tmp_dir):
    records = [_pix(), _pix(VL_PagadorPF=None), _pix(QT_PagadorPF="many"), _pix(QT_PagadorPF=3.5), _pix(Sigla_Regiao=None)]
    p = _write(os.path.join(tmp_dir, "pix.json"), json.dumps({"value": records}))
    rows, _ = R.read_pix_json(spark, p)
    assert [r._valid for r in rows.collect()] == [True, False, False, False, False]


def test_broken_documents_are_errors(spark, tmp_dir):
    import pytest

    whole = json.dumps({"value": [_pix(), _pix()]})
    for text in (whole[: len(whole) // 2], "{}", '{"value": 3}'):
        with pytest.raises(R.InvalidSource):
            R.read_pix_json(spark, _write(os.path.join(tmp_dir, f"{abs(hash(text))}.json"), text))
    with pytest.raises(R.InvalidSource):
        R.read_sidra_json(spark, _write(os.path.join(tmp_dir, "s.json"), '[{"NC": "6", "NN"'))


def test_census_rows_without_a_required_field_are_invalid(spark, tmp_dir):
    row = {n: "1" for n, _, _ in K.SIDRA.fields}
    p = _write(os.path.join(tmp_dir, "s.json"), json.dumps([row, {k: v for k, v in row.items() if k != "D2C"}]))
    assert sorted(r._valid for r in R.read_sidra_json(spark, p).collect()) == [False, True]


def test_bad_rows_behind_the_sample_stop_the_ingest(spark, tmp_dir):
    import pytest

    from peerscope.sources.ingest import InvalidSource, ingest_landing
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    _write(os.path.join(land, "olist_sellers_dataset.csv"),
           "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,a,SP\ns2,2,b,SP\ns3,notzip,c,SP\n")
    with pytest.raises(InvalidSource):
        ingest_landing(spark, land, os.path.join(tmp_dir, "raw"), "2024-01-01", sample_rows=2)
    assert not os.path.exists(os.path.join(tmp_dir, "raw"))


def test_append_takes_each_fingerprint_once_and_raises_other_errors(spark, tmp_dir):
    import pytest

    path = os.path.join(tmp_dir, "tbl")
    batch = spark.createDataFrame([(1, "h1"), (1, "h1"), (2, "h2")], "x int, row_hash string")
    assert W.append_new_rows(batch, path, spark) == 2
    other = os.path.join(tmp_dir, "other")
    spark.createDataFrame([(1,)], "x int").write.parquet(other)
    with pytest.raises(Exception, match="row_hash"):
        W.append_new_rows(batch, other, spark)
    assert spark.read.parquet(other).count() == 1


def test_empty_snapshot_is_an_error(spark, tmp_dir):
    import pytest

    root = os.path.join(tmp_dir, "raw")
    df = spark.createDataFrame([(1,)], "x int")
    W.write_raw_partition(df, root, "s", "2024-01-01")
    with pytest.raises(W.EmptySnapshot):
        W.write_raw_partition(df.filter("x > 1"), root, "s", "2024-01-01")
    assert spark.read.parquet(os.path.join(root, "s")).count() == 1


def test_marts_carry_descriptions(spark, tmp_dir):
    from peerscope.operators.quality import undocumented_columns
    from peerscope.plans import marts as M
    from peerscope.plans.descriptions import DESCRIPTIONS
    assert set(M.KPI_COLUMNS) | set(M.CENSUS_COLUMNS) | set(M.PIX_ADDITIVE) <= set(DESCRIPTIONS)
    df = spark.createDataFrame([(1, 2)], "id_municipio int, ano int")
    assert undocumented_columns(spark, W.materialize(spark, df, "marts_t", "m2", os.path.join(tmp_dir, "m2"), DESCRIPTIONS)) == []


def test_folders_of_pages_are_ingested(spark, tmp_dir):
    import pytest

    from peerscope.sources.ingest import InvalidSource, ingest_landing
    land, raw = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "raw")
    census = {n: "1" for n, _, _ in K.SIDRA.fields}
    os.makedirs(os.path.join(land, "pix.json", "more"))
    os.makedirs(os.path.join(land, "censo_9514.json"))
    os.makedirs(os.path.join(land, "olist_sellers_dataset.csv"))
    _write(os.path.join(land, "pix.json", "1.json"), json.dumps({"value": [_pix(), _pix()]}))
    _write(os.path.join(land, "pix.json", "more", "2.json"), json.dumps({"value": [_pix(Estado_Ibge=None), _pix()]}))
    for page in ("a", "b"):
        _write(os.path.join(land, "censo_9514.json", f"{page}.json"), json.dumps([census]))
        _write(os.path.join(land, "olist_sellers_dataset.csv", f"{page}.csv"),
               f"seller_id,seller_zip_code_prefix,seller_city,seller_state\n{page},1,x,SP\n")
    reports = {r.source: (r.rows, r.discarded) for r in ingest_landing(spark, land, raw, "2024-01-01")}
    assert reports == {"bcb_pix": (3, 1), "ibge_censo_9514": (2, 0), "olist_sellers": (2, 0)}
    assert {s: spark.read.parquet(os.path.join(raw, s)).count() for s in reports} == {s: n for s, (n, _) in reports.items()}
    _write(os.path.join(land, "olist_sellers_dataset.csv", "c.csv"),
           "seller_id,seller_zip_code_prefix,seller_state,seller_city\nc,1,SP,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        ingest_landing(spark, land, os.path.join(tmp_dir, "raw2"), "2024-01-01")
    os.makedirs(empty := os.path.join(tmp_dir, "landing2", "pix.json"))
    with pytest.raises(InvalidSource):
        ingest_landing(spark, os.path.dirname(empty), os.path.join(tmp_dir, "raw3"), "2024-01-01")


def test_census_rows_with_a_bad_code_stop_the_ingest(spark, tmp_dir):
    import pytest

    from peerscope.sources.ingest import InvalidSource, ingest_landing
    row = {n: "1" for n, _, _ in K.SIDRA.fields}
    header = {n: n for n in row} | {"V": "Valor"}
    bad = [dict(row, D1C=None), dict(row, D1C="x1"), {k: v for k, v in row.items() if k != "D1C"}, dict(row, D1C=None, V=None)]
    os.makedirs(land := os.path.join(tmp_dir, "landing"))
    p = _write(os.path.join(land, "censo_9514.json"), json.dumps([header, row, dict(row, V=None), *bad]))
    assert sorted(r._valid for r in R.read_sidra_json(spark, p).collect()) == [False] * 4 + [True] * 2
    with pytest.raises(InvalidSource):
        ingest_landing(spark, land, os.path.join(tmp_dir, "raw"), "2024-01-01")


def test_an_error_document_among_pages_is_an_error(spark, tmp_dir):
    import pytest

    for i, text in enumerate(('{"error": "busy"}', '{"value": null}')):
        os.makedirs(pages := os.path.join(tmp_dir, f"pix{i}.json"))
        _write(os.path.join(pages, "1.json"), json.dumps({"value": [_pix()]}))
        assert R.read_pix_json(spark, pages)[0].count() == 1
        _write(os.path.join(pages, "2.json"), text)
        with pytest.raises(R.InvalidSource, match="1 of 2"):
            R.read_pix_json(spark, pages)
