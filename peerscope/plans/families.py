"""

All of them read whole tables (or data Spark derives from them); limits
appear only where the limit is the feature (the newest-days report).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.functions.columns import (
    concat_key, day_diff, is_present, month_diff, normalize_state, row_hash,
    safe_cast, safe_ratio, sentinel_to_null, slug, to_money, yyyymm_of, yyyymm_to_date,
)
from peerscope.operators import quality as Q
from peerscope.operators.aggregates import centroid, daily_rollup, long_to_wide, mode_by_group
from peerscope.operators.dedup import dedup_by_hash, latest_per_key, latest_snapshot
from peerscope.operators.filters import facet_filter, facet_options
from peerscope.operators.joins import computed_key_join, geocode, orphans
from peerscope.plans import intermediate as I
from peerscope.plans.benchmark_tables import (
    items, payments, place_dim, products, read, tables, to_double,
)
from peerscope.session import checkpoint_dir
from peerscope.sources.append import append_new_rows

EVENT_TYPES = ("click", "view", "purchase", "signup", "error")


# ------------------------------------------------------------ per-order children
def payments_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments pivoted per order."""
    # The mapping fixes the type domain (every flag maps to a listed type or NULL).
    return to_double(I.int_olist_order_payments_agg(payments(read(spark, sf_dir, "lineitem")), closed_domain=True))


def items_agg_dominant_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items per order with the modal product type."""
    return to_double(I.int_olist_order_items_agg(
        items(read(spark, sf_dir, "lineitem")).drop("l_shipdate"), products(read(spark, sf_dir, "part"))))


def latest_per_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event per user, ties broken by event id."""
    ev = read(spark, sf_dir, "events")
    latest = latest_per_key(ev, ["user_id"], "ts", ["event_id"])
    return latest.select("user_id", "event_id", "ts", "event_type", "value",
                         is_present(F.when(F.col("event_type") != "view", F.col("event_type"))).alias("has_comment"))


# ------------------------------------------------------------------- staging
DOC_HASH_COLS = ["doc_id", "text", "lang", "source", "n_chars"]


def row_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A re-delivered batch collapses to one row per fingerprint."""
    docs = read(spark, sf_dir, "documents")
    batches = docs.unionByName(docs)
    hashed = batches.select(row_hash(*DOC_HASH_COLS).alias("row_hash"), "doc_id", "lang", "source", "n_chars")
    return dedup_by_hash(hashed, "row_hash")


def latest_snapshot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the newest snapshot (event day as the snapshot key)."""
    ev = read(spark, sf_dir, "events").withColumn("snapshot_date", F.to_date("ts"))
    return latest_snapshot(ev, "snapshot_date").select("event_id", "user_id", "event_type", "value", "snapshot_date")


def place_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slug of every whole document text."""
    docs = read(spark, sf_dir, "documents")
    return docs.select("doc_id", slug("text").alias("text_slug"), normalize_state("lang").alias("lang_upper"))


# ------------------------------------------------------------------ geography
def _zips(t) -> DataFrame:
    """Zip table: one row per nation key with a free-text city and state."""
    n, r = t["nation"], t["region"]
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("n_nationkey").alias("zip_key"),
        F.regexp_replace("n_name", "_", " ").alias("city"),
        F.lower("r_name").alias("state"),
    )


def _places(t) -> DataFrame:
    n, r = t["nation"], t["region"]
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("n_nationkey").alias("place_id"), F.col("n_name").alias("place_name"),
        slug("n_name").alias("place_slug"), F.col("r_name").alias("uf"),
    )


def slug_state_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders geocoded zip -> (city, state) -> place on computed keys;
    sellers matched to places on their own free-text city."""
    t = tables(spark, sf_dir)
    places = _places(t)
    # Orders are first reduced per customer (map-side partial aggregation);
    # only one row per customer meets the customer table and the geocode.
    per_customer = t["orders"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    cust = t["customer"].select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("zip"))
    geo = geocode(per_customer.join(cust, "o_custkey"), _zips(t), places, "zip", "zip_key", "city", "state",
                  "place_slug", "uf")
    per_place = geo.groupBy("place_id").agg(
        F.sum("n").alias("n_orders"), F.count("o_custkey").alias("n_customers"))
    sellers = t["supplier"].join(_zips(t), F.col("s_nationkey") == F.col("zip_key")).select(
        "s_suppkey", F.regexp_replace("city", " ", "-").alias("seller_city"), F.col("state").alias("seller_state"))
    s = computed_key_join(sellers, places, "seller_city", "seller_state", "place_slug", "uf").groupBy(
        "place_id").agg(F.count("s_suppkey").alias("n_sellers"))
    return (places.select("place_id", "place_name").join(per_place, "place_id", "left")
            .join(s, "place_id", "left"))


def customer_mode_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical attributes per customer by mode."""
    t = tables(spark, sf_dir)
    o = t["orders"]
    prio = mode_by_group(o, ["o_custkey"], "o_orderpriority", "modal_priority")
    status = mode_by_group(o, ["o_custkey"], "o_orderstatus", "modal_status").join(
        o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders")), "o_custkey", "full")
    c = t["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return status.join(prio, "o_custkey", "left").join(c, "o_custkey", "left").withColumnRenamed(
        "o_custkey", "customer_id")


def place_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centroid and modal label per place."""
    c = read(spark, sf_dir, "customer").select(
        "c_nationkey", to_money("c_acctbal").alias("x"), F.col("c_custkey").alias("y"), "c_mktsegment")
    cen = centroid(c, "c_nationkey", {"centroid_x": "x", "centroid_y": "y"}, exact=True)
    modal = mode_by_group(c, ["c_nationkey"], "c_mktsegment", "modal_segment")
    return cen.join(modal, "c_nationkey", "left").select(
        F.col("c_nationkey").alias("place_id"), "centroid_x", "centroid_y", "modal_segment",
        slug("modal_segment").alias("segment_slug"))


def long_to_wide_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one column per event type (max value) per user."""
    ev = read(spark, sf_dir, "events")
    wide = long_to_wide(ev, ["user_id"], "event_type", "value", {k: f"{k}_max" for k in EVENT_TYPES})
    n = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    return wide.join(n, "user_id")


# ------------------------------------------------------------- payment panel
def pix_raw(t) -> DataFrame:
    """Monthly payment rows per place, shaped like the payments source.

    The lines are first reduced per (supplier, month) - map-side partial
    aggregation, no join yet - and only those totals meet ``supplier``, so the
    line table is never shuffled by supplier and a hot supplier is a few rows.
    All measures are additive, so the second level is exact.
    """
    li = t["lineitem"].select("l_suppkey", "l_shipdate", "l_linestatus", "l_returnflag", "l_quantity",
                              to_money("l_extendedprice").alias("v"))
    pay = F.col("l_linestatus") == "O"
    rec = F.col("l_linestatus") == "F"
    pf = F.col("l_returnflag") == "N"
    pj = F.col("l_returnflag") != "N"
    classes = {"pagador_pf": pay & pf, "pagador_pj": pay & pj, "recebedor_pf": rec & pf, "recebedor_pj": rec & pj}
    s = t["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")

    month = yyyymm_of("l_shipdate").alias("ano_mes")
    per_supplier = li.groupBy("l_suppkey", month).agg(
        *[F.sum(F.when(c, F.col("v"))).alias(f"vl_{k}") for k, c in classes.items()],
        *[F.count_if(c).alias(f"qt_{k}") for k, c in classes.items()],
        *[F.sum(F.when(c, F.col("l_quantity"))).alias(f"pes_{k}") for k, c in classes.items()])
    monthly = per_supplier.join(s, "l_suppkey", "inner").groupBy("s_nationkey", "ano_mes").agg(
        *[F.sum(f"{m}_{k}").alias(f"{m}_{k}") for m in ("vl", "qt", "pes") for k in classes])
    monthly = monthly.select("*", *[F.col(f"pes_{k}").cast("bigint").alias(f"qt_pes_{k}") for k in classes])
    dims = place_dim(t).select(
        F.col("place_id").alias("s_nationkey"), F.col("place_name").alias("municipio"),
        F.col("region_name").alias("estado"), F.col("region_name").alias("regiao"))
    n = t["nation"].select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("estado_ibge"))
    return (monthly.join(dims, "s_nationkey", "left").join(n, "s_nationkey", "left")
            .select(F.col("s_nationkey").alias("municipio_ibge"), "ano_mes", "municipio", "estado_ibge", "estado",
                    F.substring("regiao", 1, 2).alias("sigla_regiao"), "regiao",
                    "vl_pagador_pf", "qt_pagador_pf", "vl_pagador_pj", "qt_pagador_pj",
                    "vl_recebedor_pf", "qt_recebedor_pf", "vl_recebedor_pj", "qt_recebedor_pj",
                    "qt_pes_pagador_pf", "qt_pes_pagador_pj", "qt_pes_recebedor_pf", "qt_pes_recebedor_pj"))


def monthly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly payment panel per place."""
    return to_double(I.int_bcb_pix_municipio(pix_raw(tables(spark, sf_dir))))


def municipios(t) -> DataFrame:
    """Place dimension with census-like covariates from the customers."""
    c = t["customer"].select("c_nationkey", to_money("c_acctbal").alias("bal"))
    cov = c.groupBy(F.col("c_nationkey").alias("id_municipio")).agg(
        F.count(F.lit(1)).alias("populacao_residente"),
        (F.sum("bal").cast("double") / F.count("bal").cast("double")).alias("renda_media_per_capita"),
        (F.sum(F.when(F.col("bal") > 0, F.col("bal"))).cast("double")
         / F.nullif(F.count_if(F.col("bal") > 0).cast("double"), F.lit(0.0))).alias("renda_mediana_per_capita"),
        safe_ratio(F.count_if(F.col("bal") > 0), F.count(F.lit(1))).alias("pct_domicilios_com_internet"),
    )
    d = place_dim(t).select(
        F.col("place_id").alias("id_municipio"), F.col("place_name").alias("nome_municipio"),
        F.col("region_name").alias("uf_sigla"), F.col("region_name").alias("macroregiao_nome"))
    return d.join(cov, "id_municipio", "left")


def yearly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P26 / F11 (first level) / F13: yearly payment indicators per place."""
    from peerscope.plans.marts import mart_ibge_pix

    t = tables(spark, sf_dir)
    return to_double(mart_ibge_pix(I.int_bcb_pix_municipio(pix_raw(t)), municipios(t)))


def period_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11 (second level) / F12: whole-period roll-up with re-derived ratios."""
    from peerscope.plans.marts import mart_ibge_pix, pix_period, pix_ratios

    t = tables(spark, sf_dir)
    p = pix_period(mart_ibge_pix(I.int_bcb_pix_municipio(pix_raw(t)), municipios(t)))
    return to_double(p.select("*", *pix_ratios()))


# -------------------------------------------------------------------- scalars
def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SAFE_CAST of dirty text, sentinels to NULL."""
    ev = read(spark, sf_dir, "events")
    k_text = F.regexp_extract("props", r"(\d+)", 1)
    raw = (F.when(F.col("event_type") == "error", F.lit("..."))
           .when(F.col("event_type") == "view", F.lit("-")).otherwise(k_text))
    return ev.select(
        "event_id",
        safe_cast(k_text, "bigint").alias("k_long"),
        safe_cast("event_type", "bigint").alias("type_as_long"),
        safe_cast(F.concat(k_text, F.lit(".5")), "double").alias("k_half"),
        safe_cast(F.substring(F.col("ts").cast("string"), 1, 10), "date").alias("ts_date"),
        safe_cast(sentinel_to_null(raw), "bigint").alias("clean_long"),
    )


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar parts and boundary-counting differences."""
    ev = read(spark, sf_dir, "events")
    later = F.col("ts") + F.expr("INTERVAL 13 HOURS")
    month_later = F.col("ts") + F.expr("INTERVAL 20 DAYS")
    ym = yyyymm_of("ts")
    return ev.select(
        "event_id",
        F.year("ts").alias("year"), F.month("ts").alias("month"), ym.alias("yyyymm"),
        yyyymm_to_date(ym).alias("month_start"),
        day_diff("ts", later).alias("days_crossed"),
        month_diff("ts", month_later).alias("months_crossed"),
    )


def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL-safe ratios of exact per-order sums."""
    li = read(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        safe_ratio(F.sum(to_money("l_discount")), F.sum(to_money("l_tax"))).alias("discount_per_tax"),
        safe_ratio(F.sum(to_money("l_extendedprice")), F.sum(to_money("l_quantity"))).alias("price_per_unit"),
        (safe_ratio(F.count_if(F.col("l_returnflag") == "R"), F.count(F.lit(1))) * F.lit(100.0)).alias("pct_returned"),
    )


def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-line surrogate key and how often it repeats."""
    li = read(spark, sf_dir, "lineitem")
    return li.groupBy(concat_key("l_orderkey", "l_linenumber").alias("line_pk")).agg(
        F.count(F.lit(1)).alias("n_records"))


PROPS_SCHEMA = "k BIGINT, extra STRUCT<x: BIGINT>"


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed parse of a JSON column; a missing parent gives NULL."""
    ev = read(spark, sf_dir, "events")
    p = F.from_json("props", PROPS_SCHEMA)
    return ev.select("event_id", p.getField("k").alias("k"), p.getField("extra").getField("x").alias("extra_x"))


# --------------------------------------------------------------------- facets
FACETS = {"region_name": ["ASIA", "EUROPE"], "c_mktsegment": ["Todos"], "place_name": []}


def _customer_places(t) -> DataFrame:
    return t["customer"].join(
        place_dim(t), F.col("c_nationkey") == F.col("place_id")).select(
        "c_custkey", "c_name", "c_mktsegment", "place_name", "region_name")


def facet_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AND of multi-select facets, 'Todos' or empty = no filter."""
    return facet_filter(_customer_places(tables(spark, sf_dir)), FACETS)


def facet_options_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted distinct facet values."""
    return facet_options(read(spark, sf_dir, "customer"), "c_mktsegment")


USAGE_SINCE = "2024-01-10"


def usage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs, billed GB and cost per day of finished queries, newest 15 days."""
    ev = read(spark, sf_dir, "events").select(
        "ts", (to_money("value") * F.lit(2 ** 30)).alias("billed_bytes"),
        F.when(F.col("event_type") == "signup", F.lit("LOAD")).otherwise(F.lit("QUERY")).alias("job_type"),
        F.when(F.col("event_type") == "error", F.lit("RUNNING")).otherwise(F.lit("DONE")).alias("state"))
    return daily_rollup(ev, "ts", "billed_bytes", USAGE_SINCE)


# -------------------------------------------------------------------- quality
def _first_ship(t) -> DataFrame:
    ship = t["lineitem"].groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))
    return t["orders"].join(ship, F.col("o_orderkey") == F.col("l_orderkey"), "left")


def dq_not_null(spark, sf_dir):
    """M1: orders without any shipped line (NULL after the left join)."""
    return Q.not_null(_first_ship(tables(spark, sf_dir)), "first_ship").select("o_orderkey", "o_orderstatus")


def dq_unique(spark, sf_dir):
    """M2: repeated order-line keys."""
    li = read(spark, sf_dir, "lineitem").withColumn("line_pk", concat_key("l_orderkey", "l_linenumber"))
    return Q.unique(li, "line_pk")


def dq_unique_combo(spark, sf_dir):
    """M3: repeated (order, line number) combinations."""
    return Q.unique_combination(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_accepted(spark, sf_dir):
    """M4: event types outside the accepted list."""
    ev = read(spark, sf_dir, "events")
    return Q.accepted_values(ev, "event_type", ["click", "view", "purchase", "signup"]).select("event_id", "event_type")


def dq_relationships(spark, sf_dir):
    """Orders that no line item refers to."""
    t = tables(spark, sf_dir)
    return orphans(t["orders"], t["lineitem"], "o_orderkey", "l_orderkey").select("o_orderkey")


def dq_expression(spark, sf_dir):
    """M6: rows where the expression is false."""
    li = read(spark, sf_dir, "lineitem")
    return Q.expression_is_true(li, "l_discount <= 0.08").select("l_orderkey", "l_linenumber", "l_discount")


def dq_volume(spark, sf_dir):
    """M7: a row if the table is below the minimum volume."""
    return Q.min_volume(read(spark, sf_dir, "orders"), 20000)


def dq_suite(spark, sf_dir):
    """M1-M7 together: failure count per check (row checks share one pass)."""
    t = tables(spark, sf_dir)
    li = t["lineitem"]
    suite = Q.QualitySuite("lineitem", li, [
        Q.Check("not_null_orderkey", "not_null", column="l_orderkey"),
        Q.Check("accepted_returnflag", "accepted_values", column="l_returnflag", values=["R", "A"]),
        Q.Check("discount_range", "expression", expression="l_discount between 0 and 0.08"),
        Q.Check("unique_line", "unique_combination", columns=["l_orderkey", "l_linenumber"]),
        Q.Check("unique_orderkey", "unique", column="l_orderkey", severity="warn"),
        Q.Check("part_exists", "relationships", column="l_partkey", parent=t["part"], parent_column="p_partkey"),
        Q.Check("min_volume", "min_volume", minimum=100000, severity="warn"),
    ])
    return suite.results()


# ------------------------------------------------------ documented extensions
EVENT_HASH_COLS = ["event_id", "user_id", "event_type", "props"]


def incremental_append(spark, sf_dir):
    """Q1: two batches are appended one after the other; of the second, only the rows not stored yet are added."""
    ev = read(spark, sf_dir, "events").withColumn("row_hash", row_hash(*EVENT_HASH_COLS))
    ts_type = ev.schema["ts"].dataType
    path = f"{checkpoint_dir(spark)}/append-{uuid.uuid4().hex}/events"
    append_new_rows(ev.filter(F.col("ts") < F.lit("2024-01-20").cast(ts_type)), path, spark)
    append_new_rows(ev.filter(F.col("ts") >= F.lit("2024-01-15").cast(ts_type)), path, spark)
    stored = spark.read.parquet(path)
    second = stored.select(F.max("append_id")).scalar()
    return stored.filter(F.col("append_id") == second).select("event_id", "user_id", "event_type", "row_hash")


def freshness_query(spark, sf_dir):
    """Q2: age of the newest load per source against warn / error limits."""
    ev = read(spark, sf_dir, "events")
    return Q.freshness(ev, "event_type", "ts", "2024-02-01", warn_after_days=1, error_after_days=2)


def common_schema(spark, sf_dir):
    """Q3: two business sources mapped to one monthly schema and combined."""
    from peerscope.operators.aggregates import common_business_schema

    t = tables(spark, sf_dir)
    orders = t["orders"].select(
        F.col("o_custkey").alias("party"), yyyymm_of("o_orderdate").alias("ano_mes"),
        F.col("o_orderkey").alias("order_key"), to_money("o_totalprice").alias("revenue"))
    lines = t["lineitem"].select(
        F.col("l_suppkey").alias("party"), yyyymm_of("l_shipdate").alias("ano_mes"),
        F.col("l_orderkey").alias("order_key"), to_money("l_extendedprice").alias("revenue"))
    customers = t["customer"].select(F.col("c_custkey").alias("party"), F.col("c_nationkey").alias("municipio_id"))
    suppliers = t["supplier"].select(F.col("s_suppkey").alias("party"), F.col("s_nationkey").alias("municipio_id"))
    return to_double(common_business_schema({"orders": (orders, customers), "lineitem": (lines, suppliers)}))


# ------------------------------------------------------------ staging models
def _raw_orders(t) -> DataFrame:
    """Orders as the business source lands them: text keys and timestamps."""
    from peerscope.plans.benchmark_tables import STATUS_BY_CODE, _case

    o = t["orders"]
    day = F.expr("INTERVAL 1 DAYS")
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        _case("o_orderstatus", STATUS_BY_CODE).alias("order_status"),
        F.col("o_orderdate").cast("string").alias("order_purchase_timestamp"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("urgent"))
        .otherwise((F.col("o_orderdate") + day).cast("string")).alias("order_approved_at"),
        F.lit(None).cast("string").alias("order_delivered_carrier_date"),
        F.lit(None).cast("string").alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).cast("string").alias("order_estimated_delivery_date"),
    )


def staging_orders(spark, sf_dir):
    """P2 on a re-delivered batch: fingerprint, dedup, SAFE_CAST of text timestamps."""
    from peerscope.plans.staging import stg_olist_orders

    raw = _raw_orders(tables(spark, sf_dir))
    return stg_olist_orders(raw.unionByName(raw), ts_type="timestamp_ntz")


def staging_customers(spark, sf_dir):
    """P1 on a re-delivered batch of customers with free-text city and state."""
    from peerscope.plans.staging import stg_olist_customers

    t = tables(spark, sf_dir)
    raw = t["customer"].join(place_dim(t), F.col("c_nationkey") == F.col("place_id")).select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").cast("long").alias("customer_zip_code_prefix"),
        F.col("place_name").alias("customer_city"), F.col("region_name").alias("customer_state"))
    return stg_olist_customers(raw.unionByName(raw))


def place_labels(spark, sf_dir):
    """Sorted display labels "place - region" for a selection list."""
    from peerscope.operators.filters import selection_options

    d = place_dim(tables(spark, sf_dir))
    return selection_options(d, "place_id", "place_name", "region_name").select("label")
