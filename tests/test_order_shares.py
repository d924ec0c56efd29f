"""The order fact of the layered models, worked out a share of the orders at a time."""

import glob
import os
import time
from datetime import datetime, timedelta

from peerscope.plans import model_queries as Q
from peerscope.sources.publish import Folders

DAY = datetime(1997, 1, 1)


def _tables(spark, path):
    """Small tables in which keys repeat or are missing, and lines come twice."""
    def put(name, schema, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")

    put("region", "r_regionkey int, r_name string", [(0, "ASIA"), (1, None)])
    put("nation", "n_nationkey int, n_name string, n_regionkey int", [(0, "JAPAN", 0), (1, "INDIA", 1)])
    put("customer", "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        [(k % 45, "c", k % 2, 1.0, None) for k in range(60)])
    put("supplier", "s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(1, "s", 0, 1.0)])
    put("part", "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(k, "p", "b", None if k % 3 == 0 else f"type {k % 4}", k, 1.0) for k in range(12)] + [(1, "again", "b", "type 9", 1, 1.0)])
    put("orders", "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        [(None if k % 50 == 7 else k % 290, None if k % 31 == 5 else k % 50, "FOP"[k % 3], 1.0, DAY + timedelta(days=k % 90), f"{k % 5 + 1}")
         for k in range(300)])
    lines = [(None if k % 40 == 3 else k % 310, k % 13, None if k % 9 == 4 else k % 5, k // 310, 1.0, k % 77 + 0.25, 0.0, 0.05,
              "RAN"[k % 3], "FO"[k % 2], DAY + timedelta(days=k % 60)) for k in range(1500)]
    put("lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz", lines + lines[::7])
    put("events", "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
        [(k, DAY + timedelta(hours=k % 20), None if k % 17 == 2 else k % 200, ("view", "error", "buy")[k % 3], 1.0, None) for k in range(400)])
    return path


def _left(spark):
    """Bytes of the shuffle files on the disk."""
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(f) for d in dirs for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True) if os.path.exists(f))


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_shares_give_the_whole_fact(spark, tmp_dir, monkeypatch):
    path = _tables(spark, f"{tmp_dir}/t")
    t = Q.tables(spark, path)
    staged = {name: Q.STAGING[f"stg_{name}"](t) for name in ("order_payments", "order_items", "products")}
    whole = _rows(Q.to_double(Q.I.int_fact_orders(
        Q.S.stg_olist_orders(Q._twice(t, Q.R.ORDERS), Q.TS), Q._customers(t), Q._geo(t),
        Q.I.int_olist_order_payments_agg(staged["order_payments"]),
        Q.I.int_olist_order_items_agg(staged["order_items"], staged["products"]), Q._reviews(t))))
    monkeypatch.setattr(Q, "ROWS_A_SHARE", 1000)
    seen = []
    share = Q._share
    monkeypatch.setattr(Q, "_share", lambda df, n, i: seen.append((n, i)) or share(df, n, i))
    assert _rows(Q.QUERIES["int_fact_orders"](spark, path)) == whole and len(whole) > 250
    assert set(seen) == {(4, i) for i in range(4)}


def test_a_share_leaves_no_lines_and_no_shuffles_on_the_disk(spark, tmp_dir, monkeypatch):
    """Before, the staged lines and all that was shuffled for them stayed on the disk beside what the fact shuffled."""
    path = _tables(spark, f"{tmp_dir}/t")
    kept = spark.conf.get("spark.checkpoint.dir")
    monkeypatch.setattr(Q, "ROWS_A_SHARE", 1000, raising=False)
    Q.R.landed(Q.tables(spark, path), Q.R.ORDERS).count()
    bytes_before, folders_before = _left(spark), set(Folders(spark).children(kept))
    Q.QUERIES["int_fact_orders"](spark, path)
    new = {os.path.basename(f) for f in set(Folders(spark).children(kept)) - folders_before}
    assert not [f for f in new if f.startswith(("stg-order-payments", "stg-order-items")) or "-share-" in f]
    assert sum(f.startswith(("int-order-payments-agg", "int-order-items-agg", "stg-orders")) for f in new) == 3
    until = time.time() + 20
    while (more := _left(spark) - bytes_before) > 20_000 and time.time() < until:  # deleted in the background
        time.sleep(0.2)
    assert more <= 20_000


def test_rows_of_one_fingerprint_fall_to_one_share(spark):
    """A missing id and an empty one have one fingerprint; so may ids that hold the separator."""
    ids = [(None, 0), ("", 0), ("a|1", 1), ("a", 1), ("a|", 1), ("|b", 0)] + [(f"k{n}", 2) for n in range(60)]
    df = spark.createDataFrame(ids, "order_id string, alike int")
    shares = [Q._share(df, 5, i).collect() for i in range(5)]
    assert sorted(map(repr, sum(shares, []))) == sorted(map(repr, df.collect()))
    for alike in (0, 1):
        assert sum(any(r.alike == alike for r in rows) for rows in shares) == 1
    assert all(shares)
