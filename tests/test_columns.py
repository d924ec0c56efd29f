"""Column functions on literal tables, including the traps of FIXTURES.md part B."""

import datetime as dt

from pyspark.sql import functions as F

from peerscope.functions import columns as C


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_population_bands(spark):
    pops = [(9999,), (10000,), (49999,), (50000,), (199999,), (200000,), (None,)]
    got = one(spark, C.population_band("p"), pops, "p long")
    assert got == ["Micro (< 10 mil)", "Pequeno (10–50 mil)", "Pequeno (10–50 mil)", "Médio (50–200 mil)",
                   "Médio (50–200 mil)", "Grande (≥ 200 mil)", "Grande (≥ 200 mil)"]  # T1: NULL -> largest
    strict = one(spark, C.population_band("p", strict=True), [(None,)], "p long")
    assert strict == [None]


def test_presence_band_null_and_zero_population(spark):
    # NULL or 0 population -> "Sem presença" (ratio is NULL)
    got = one(spark, C.presence_band("c", "p"), [(3, None), (3, 0), (0, 100000), (2, 10000), (100, 10000)],
              "c long, p long")
    assert got == ["Sem presença", "Sem presença", "Baixa", "Média", "Alta"]


def test_slug(spark):
    got = one(spark, C.slug("s"), [("São João-D'Oeste",), ("Açaí  Grande",), (None,)], "s string")
    assert got == ["sao_joao_d'oeste", "acai__grande", None]  # T9: apostrophe kept, spaces not collapsed


def test_day_diff_counts_boundaries(spark):
    rows = [(dt.datetime(2018, 1, 1, 23, 59), dt.datetime(2018, 1, 2, 0, 1))]
    assert one(spark, C.day_diff("a", "b"), rows, "a timestamp, b timestamp") == [1]
    assert one(spark, C.month_diff("a", "b"), [(dt.datetime(2018, 1, 31), dt.datetime(2018, 2, 1))],
               "a timestamp, b timestamp") == [1]


def test_yyyymm(spark):
    got = one(spark, C.yyyymm_to_date("x"), [("202202",), ("20220x",)], "x string")
    assert got == [dt.date(2022, 2, 1), None]


def test_safe_casts(spark):
    got = one(spark, C.safe_cast("x", "bigint"), [("12",), ("1.0",), ("X",), ("...",), ("",)], "x string")
    assert got == [12, None, None, None, None]
    assert one(spark, C.sentinel_to_null("x"), [("-",), ("...",), ("21494",)], "x string") == [None, None, "21494"]


def test_row_hash_null_and_empty_collide(spark):
    # (NULL, a) and ('', a) give the same fingerprint
    h = one(spark, C.row_hash("a", "b"), [(None, "a"), ("", "a"), ("x", "a")], "a string, b string")
    assert h[0] == h[1] != h[2]
    import hashlib
    assert h[2] == hashlib.md5(b"x|a").hexdigest()


def test_similarity_labels(spark):
    got = one(spark, C.similarity_label("r"), [(0.29,), (0.30,), (0.69,), (0.70,), (None,)], "r double")
    assert got == ["Muito parecido", "Razoavelmente parecido", "Razoavelmente parecido", "Pouco parecido",
                   "Pouco parecido"]


def test_safe_ratio_and_on_time(spark):
    assert one(spark, C.safe_ratio("n", "d"), [(1, 0), (1, 4), (None, 2)], "n long, d long") == [None, 0.25, None]
    t = dt.datetime
    rows = [(None, t(2018, 1, 2)), (t(2018, 1, 1), t(2018, 1, 2)), (t(2018, 1, 3), t(2018, 1, 2))]
    assert one(spark, C.on_time_flag("d", "e"), rows, "d timestamp, e timestamp") == [None, True, False]


def test_concat_key_null_propagates(spark):
    assert one(spark, C.concat_key("a", "b"), [("o1", 2), (None, 3)], "a string, b long") == ["o1-2", None]


def test_file_name_and_prefix(spark):
    rows = [("bucket/landing/olist_orders_dataset.csv",)]
    assert one(spark, C.file_name("p"), rows, "p string") == ["olist_orders_dataset.csv"]
    assert one(spark, C.parent_prefix("p"), rows, "p string") == ["bucket/landing"]


def test_nested_field_null_parent(spark):
    df = spark.createDataFrame([({"a": {"b": 1}},), (None,)], "s struct<a: struct<b: int>>")
    assert [r[0] for r in df.select(C.nested_field("s", "a", "b")).collect()] == [1, None]


def test_sql_functions_registered(spark):
    C.register_sql_functions(spark)
    r = spark.sql("select place_slug('São Paulo') a, null_safe_ratio(1, 0) b").first()
    assert r.a == "sao_paulo" and r.b is None


def test_slug_extended(spark):
    got = one(spark, C.slug("s", extended=True), [("  São  João-Piñón ",)], "s string")
    assert got == ["sao_joao_pinon"]


def test_yyyymm_strict_raises(spark):
    import pytest
    df = spark.createDataFrame([("20220x",)], "x string")
    with pytest.raises(Exception):
        df.select(C.yyyymm_to_date("x", strict=True)).collect()
