"""DataFrame operators: dedup, latest per key, mode, pivots, joins, filters, top-k."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from peerscope.operators import aggregates as A
from peerscope.operators import dedup as D
from peerscope.operators import filters as FL
from peerscope.operators import joins as J
from peerscope.operators import topk as T


def test_mode_tie_and_nulls(spark):
    # T5: a, b, b, a, NULL, NULL, NULL -> 'a' (tie -> smallest, NULLs ignored)
    df = spark.createDataFrame([(1, v) for v in ["a", "b", "b", "a", None, None, None]], "k int, v string")
    assert A.mode_by_group(df, ["k"], "v").first().v == "a"
    assert df.groupBy("k").agg(A.mode_of("v").alias("m")).first().m == "a"


def test_latest_per_key_nulls_last(spark):
    t = dt.datetime
    df = spark.createDataFrame([(1, None, "x"), (1, t(2018, 1, 2), "y"), (1, t(2018, 1, 1), "z")],
                               "k int, ts timestamp, v string")
    assert D.latest_per_key(df, ["k"], "ts", ["v"]).first().v == "y"


def test_dedup_by_hash_is_idempotent(spark):
    from peerscope.functions.columns import row_hash
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "x"), ("a", "x")], "p string, q string")
    h = df.withColumn("row_hash", row_hash("p", "q"))
    once = D.dedup_by_hash(h)
    assert once.count() == 2  # NULL/'' collide (T8), byte-identical repeats collapse
    assert D.dedup_by_hash(once).count() == 2
    det = D.dedup_by_hash(h, deterministic=True).orderBy("q").collect()
    assert [r.q for r in det] == [None, "x"]


def test_latest_snapshot(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 1)), (3, dt.date(2024, 2, 1))],
                               "v int, ingestion_date date")
    assert sorted(r.v for r in D.latest_snapshot(df).collect()) == [2, 3]


def test_pivot_absent_category_is_null(spark):
    df = spark.createDataFrame([(1, "credit_card", 10.0), (1, "boleto", 5.0), (2, "boleto", 1.0)],
                               "o int, t string, v double")
    rows = {r.o: r for r in df.groupBy("o").agg(*A.pivot_agg("t", "v", ["credit_card", "boleto"])).collect()}
    assert rows[1].credit_card_value == 10.0 and rows[2].credit_card_value is None


def test_distinct_counts(spark):
    df = spark.createDataFrame([(1, "p1", "s1"), (1, "p1", "s2"), (1, "p2", "s2"), (2, None, "s1")],
                               "o int, p string, s string")
    got = {r.o: (r.np, r.ns) for r in A.distinct_counts(df, ["o"], {"np": "p", "ns": "s"}).collect()}
    assert got == {1: (2, 2), 2: (0, 1)}


def test_reaggregation_equals_direct(spark):
    df = spark.createDataFrame([(1, 2017, 1, 3), (1, 2017, 2, 4), (1, 2018, 1, 5), (2, 2018, 3, 6)],
                               "m int, y int, mo int, v long")
    yearly = df.groupBy("m", "y").agg(F.sum("v").alias("v"))
    period = A.reaggregate(yearly, ["m"], additive=["v"], distinct_counts={"years": "y"})
    direct = df.groupBy("m").agg(F.sum("v").alias("v"))
    assert sorted((r.m, r.v) for r in period.collect()) == sorted((r.m, r.v) for r in direct.collect())
    assert {r.m: r.years for r in period.collect()} == {1: 2, 2: 1}


def test_centroid_exact(spark):
    df = spark.createDataFrame([(1, 1.1, 2.0), (1, 2.2, 4.0)], "z int, lat double, lng double")
    r = A.centroid(df.withColumn("lat", F.col("lat").cast("decimal(18,2)")), "z",
                   {"lat": "lat", "lng": "lng"}, exact=True).first()
    assert r.lat == 3.3 / 2 and r.lng == 3.0


def test_facet_filter_all_token_and_empty(spark):
    df = spark.createDataFrame([("SP", "a"), ("RJ", "b"), ("MG", "a")], "uf string, seg string")
    assert FL.facet_filter(df, {"uf": ["Todos", "SP"], "seg": []}).count() == 3
    assert FL.facet_filter(df, {"uf": ["SP", "MG"], "seg": ["a"]}).count() == 2
    assert [r.seg for r in FL.facet_options(df, "seg").collect()] == ["a", "b"]


def test_min_rows_gate(spark):
    df = spark.range(9)
    with pytest.raises(FL.NotEnoughRows):
        FL.require_min_rows(df, 10)
    assert FL.require_min_rows(spark.range(20), 10) == 10


def test_top_k_with_rank(spark):
    df = spark.createDataFrame([(i, float(10 - i)) for i in range(10)], "id int, d double")
    got = [(r.rank, r.id) for r in T.top_k(df, [F.asc("d"), F.asc("id")], 3).collect()]
    assert got == [(1, 9), (2, 8), (3, 7)]
    per = T.top_k_per_group(df.withColumn("g", F.col("id") % 2), ["g"], [F.asc("d")], 2)
    assert per.count() == 4


def test_joins_and_orphans(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    dim = spark.createDataFrame([(1, "x")], "k int, name string")
    assert J.lookup_join(fact, dim, "k").count() == 3  # left keeps every fact row
    many = spark.createDataFrame([(1, "x"), (1, "y")], "k int, name string")
    assert [r.k for r in J.orphans(fact, many, "k").collect()] == [2]  # a repeated parent changes nothing
    assert J.orphan_count(fact.union(fact), dim, "k").first().failures == 2
    assert J.orphan_count(fact.filter("k = 1"), dim, "k").first().failures == 0
    assert sorted((r.k, r.name) for r in J.salted_join(fact.filter("k = 1").union(fact), dim, "k", "v").collect()) == [(1, "x")] * 2
    assert J.salted_join(fact, dim, "k", "v", how="left").count() == 3
    assert [r.k for r in J.orphans(fact, dim, "k").collect()] == [2]  # NULL child key passes


def test_computed_key_join_and_coverage(spark):
    left = spark.createDataFrame([("São Paulo", "sp"), ("Rio Branco", "ac"), ("Nowhere", "xx")],
                                 "city string, state string")
    places = spark.createDataFrame([(1, "sao_paulo", "SP"), (2, "rio_branco", "AC")],
                                   "id int, slug string, uf string")
    inner = J.computed_key_join(left, places, "city", "state", "slug", "uf")
    assert sorted(r.id for r in inner.collect()) == [1, 2]
    left_j = J.computed_key_join(left, places, "city", "state", "slug", "uf", how="left")
    cov = J.coverage(left_j, "id").first()
    assert (cov.total, cov.matched) == (3, 2)


def test_covariance_matches_numpy(spark):
    import numpy as np
    rows = [(float(i), float(i * i % 7), float((3 * i) % 5)) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    m, n = A.covariance_matrix(df, ["a", "b", "c"])
    assert n == 20
    assert np.allclose(m, np.cov(np.array(rows).T), rtol=1e-12, atol=1e-12)


def test_latest_valid_snapshot_falls_back(spark):
    rows = [(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 1)), (3, dt.date(2024, 2, 1))]
    df = spark.createDataFrame(rows, "v int, ingestion_date date")
    assert sorted(r.v for r in D.latest_valid_snapshot(df, min_rows=2).collect()) == [1, 2]
    assert [r.v for r in D.latest_valid_snapshot(df, min_rows=1).collect()] == [3]


def test_modes_keep_all_null_keys(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", None), (2, None, None)], "k int, a string, b string")
    got = {r.k: (r.a, r.b) for r in A.modes_by_group(df, ["k"], {"a": "a", "b": "b"}).collect()}
    assert got == {1: ("a", "x"), 2: (None, None)}


def test_usage_rollup_counts_finished_queries(spark):
    rows = [("2024-01-01 10:00:00", 2 ** 40, "QUERY", "DONE"), ("2024-01-01 11:00:00", 2 ** 30, "QUERY", "DONE"),
            ("2024-01-01 12:00:00", 2 ** 40, "LOAD", "DONE"), ("2024-01-01 13:00:00", 2 ** 40, "QUERY", "RUNNING"),
            ("2023-12-31 13:00:00", 2 ** 40, "QUERY", "DONE")]
    df = spark.createDataFrame(rows, "t string, bytes long, job_type string, state string").withColumn("ts", F.col("t").cast("timestamp"))
    got = A.daily_rollup(df, "ts", "bytes", "2024-01-01 00:00:00").collect()
    assert [(r.jobs, r.cost, r.gb_billed) for r in got] == [(2, 6.2561, 1025.0)]


def test_two_level_indicators_equal_one_level(spark):
    """Customers are counted once per group, a NULL customer not at all, and the sums are those of one aggregation."""
    from peerscope.plans.marts import order_kpis

    cols = ("g string, customer_unique_id string, order_status string, total_revenue double, total_freight_value double, "
            "credit_card_value double, credit_card_installments int, boleto_value double, total_payment_value double, "
            "is_on_time boolean, review_score int, delivery_days int, approval_days int")
    rows = [("a", "c1", "delivered", 10.0, 1.0, 11.0, 2, None, 11.0, True, 5, 3, 1), ("a", "c1", "delivered", 20.0, None, None, None, 20.0, 20.0, False, None, 5, None),
            ("a", "c2", "canceled", 7.0, 1.0, None, None, None, None, None, 1, None, 1), ("a", None, "shipped", None, None, None, None, None, None, None, 4, None, 2),
            ("b", None, "created", None, None, None, None, None, None, None, None, None, None)]
    got = {r.g: r for r in order_kpis(spark.createDataFrame(rows, cols), ["g"]).collect()}
    a, b = got["a"], got["b"]
    assert (a.total_pedidos, a.pedidos_entregues, a.pedidos_cancelados, a.pedidos_em_andamento, a.clientes_unicos) == (4, 2, 1, 1, 2)
    assert (a.receita_total, a.ticket_medio, a.frete_medio, a.avg_dias_entrega, a.avg_review_score) == (30.0, 15.0, 1.0, 4.0, 10 / 3)
    assert (a.share_frete, a.avg_parcelas_cartao, a.taxa_entrega_no_prazo, a.pct_pedidos_com_review) == (1 / 30, 2.0, 0.5, 1.5)
    assert (b.total_pedidos, b.clientes_unicos, b.ticket_medio, b.taxa_entrega_no_prazo) == (1, 0, None, None)
