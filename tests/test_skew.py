"""One key holding a third of all rows: results stay exact and the plans reduce
that key map-side (partial aggregation / WindowGroupLimit) before any shuffle."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from peerscope.operators import joins
from peerscope.operators.aggregates import distinct_counts, mode_by_group
from peerscope.operators.dedup import latest_per_key

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skew") / "lines.parquet")
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    part = spark.read.parquet(f"{SF}/part.parquet").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    hot = F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey"))
    li.join(part, "l_partkey", "left").withColumn("k", hot).write.parquet(path)
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW s AS SELECT * FROM read_parquet('{path}')")
    df = spark.read.parquet(path)
    share = df.filter("k = 0").count() / df.count()
    assert share > 0.3
    return df, con


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def test_mode_under_skew(skewed):
    df, con = skewed
    got = {r.k: r.p_type for r in mode_by_group(df, ["k"], "p_type").collect()}
    want = dict(con.execute("""
        SELECT k, p_type FROM (
          SELECT k, p_type, ROW_NUMBER() OVER (PARTITION BY k ORDER BY COUNT(*) DESC, p_type) rn
          FROM s WHERE p_type IS NOT NULL GROUP BY k, p_type) WHERE rn = 1""").fetchall())
    assert got == want
    p = plan(mode_by_group(df, ["k"], "p_type"))
    assert "partial_count" in p  # (key, value) pairs counted before the shuffle


def test_distinct_counts_under_skew(skewed):
    df, con = skewed
    got = {r.k: (r.np, r.ns) for r in distinct_counts(df, ["k"], {"np": "l_partkey", "ns": "l_suppkey"}).collect()}
    want = {k: (a, b) for k, a, b in con.execute(
        "SELECT k, COUNT(DISTINCT l_partkey), COUNT(DISTINCT l_suppkey) FROM s GROUP BY k").fetchall()}
    assert got == want


def test_latest_per_key_under_skew(skewed):
    df, con = skewed
    latest = latest_per_key(df, ["k"], "l_shipdate", ["l_partkey", "l_linenumber", "l_suppkey"])
    got = {r.k: (r.l_partkey, r.l_linenumber, r.l_suppkey) for r in latest.collect()}
    want = {k: (a, b, c) for k, a, b, c in con.execute("""
        SELECT k, l_partkey, l_linenumber, l_suppkey FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY l_shipdate DESC NULLS LAST, l_partkey,
                                       l_linenumber, l_suppkey) rn FROM s) WHERE rn = 1""").fetchall()}
    assert got == want
    assert "WindowGroupLimit" in plan(latest)  # each task ships one row per key


def test_exact_sums_under_skew(skewed):
    df, con = skewed
    money = F.col("l_extendedprice").cast("decimal(18,2)")
    got = {r.k: r.v for r in df.groupBy("k").agg(F.sum(money).cast("double").alias("v")).collect()}
    want = dict(con.execute(
        "SELECT k, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) FROM s GROUP BY k").fetchall())
    assert got == want


# --- joins that divide heavy keys only -----------------------------------------

def test_heavy_keys_are_found_and_no_others(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "warm").when(F.col("id") % 7 == 2, None)
                                    .otherwise(F.col("id").cast("string")).alias("k"))
    keys = spark.range(1).select(joins.heavy_keys(df, "k").alias("h")).first().h
    assert {k for k in keys if k is not None} == {"hot", "warm"}
    assert spark.range(1).select(joins.heavy_keys(df.filter("false"), "k").alias("h")).first().h in (None, [])


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_the_plain_join(spark, how):
    big = spark.range(6000).select(F.col("id").alias("o"), F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 == 1, None)
                                   .otherwise(F.col("id") % 4000).alias("k"))
    small = spark.range(0, 3000, 1).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    small = small.union(spark.createDataFrame([(7, -1), (None, 5)], "k long, v long"))  # a hot key twice, and a null
    got, want = joins.skew_join(big, small, "k", "o", how), big.join(small, "k", how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_only_heavy_keys_are_copied_and_divided(spark):
    """A third of the rows has one key: its rows go to several tasks, and of the other side one row is copied."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        big = spark.range(24_000).select(F.col("id").alias("o"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
        small = spark.range(24_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))

        def most(df):
            return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

        divided = joins.skew_join(big, small, "k", "o")
        assert most(big.join(small, "k")) > 8000 and most(divided) < 4000
        copies = divided._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate explode" in copies
        heavy = joins.heavy_keys(big, "k")
        n = small.select(F.when(F.array_contains(heavy, F.col("k")), 8).otherwise(1).alias("n")).agg(F.sum("n")).first()[0]
        assert n == 24_000 + 7
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_order_fact_with_a_hot_customer_and_a_hot_zip(spark, monkeypatch):
    """P24 on the fixture with a customer who holds a third of the orders: the same rows, joined once by customer."""
    from peerscope.plans import intermediate as I
    from peerscope.plans.layers import LayeredBuild
    from tests.fixture_raw import build

    raw = build(spark)
    one = raw["olist_orders"].first()
    more = spark.range(60).select(F.concat(F.lit("hot"), "id").alias("order_id"), F.lit(one.customer_id).alias("customer_id"))
    rest = raw["olist_orders"].filter(F.col("order_id") == one.order_id).drop("order_id", "customer_id")
    hot = raw["olist_orders"].unionByName(more.crossJoin(rest))
    b = LayeredBuild(spark, enforce=False)
    models = b.run(dict(raw, olist_orders=hot))
    asked = []
    monkeypatch.setattr(I, "skew_join", lambda big, small, on, spread, **k: asked.append(on) or joins.skew_join(big, small, on, spread, **k))
    fact = I.int_fact_orders(*(models[n] for n in (
        "stg_olist_orders", "stg_olist_customers", "int_olist_geolocation", "int_olist_order_payments_agg",
        "int_olist_order_items_agg", "int_olist_order_reviews_agg")))
    assert asked == ["customer_id"]
    plain = models["stg_olist_orders"].join(models["stg_olist_customers"].select("customer_id", "customer_unique_id"), "customer_id")
    assert sorted((r.order_id, r.customer_unique_id) for r in fact.collect()) == sorted((r.order_id, r.customer_unique_id) for r in plain.collect())
    assert fact.filter(F.col("customer_id") == one.customer_id).count() > 60
