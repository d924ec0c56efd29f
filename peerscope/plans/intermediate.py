"""Intermediate layer (P14-P24): joins, pivots, mode / centroid, latest per key.

Each model is a function of its input DataFrames.  Column names are those of
the staging layer; see ``peerscope.sources.contracts``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.functions.columns import (
    day_diff, is_present, on_time_flag, slug, yyyymm_to_date,
)
from peerscope.operators.aggregates import distinct_counts, long_to_wide, mode_by_group, modes_by_group, pivot_agg
from peerscope.operators.dedup import latest_per_key
from peerscope.operators.joins import lookup_join, salted_join, skew_join, star_join

# Payment types of the business source (pivot columns).
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
# Census variable codes.
VAR_POPULATION = "93"
VAR_INCOME_MEAN = "13431"
VAR_INCOME_MEDIAN = "13534"


def int_olist_geolocation(geo: DataFrame) -> DataFrame:
    """One row per zip prefix - centroid, modal city / state, city slug."""
    k = ["geolocation_zip_code_prefix"]
    cen = geo.groupBy(*k).agg(
        F.avg("geolocation_lat").alias("geolocation_lat"),
        F.avg("geolocation_lng").alias("geolocation_lng"),
    )
    agg = (cen.join(mode_by_group(geo, k, "geolocation_city"), k, "left")
           .join(mode_by_group(geo, k, "geolocation_state"), k, "left"))
    return agg.select(
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
        slug("geolocation_city").alias("geolocation_city_slug"), "geolocation_state",
    )


def payment_pivot_columns(types: Sequence[str] = PAYMENT_TYPES, type_col: str = "payment_type",
                          value_col: str = "payment_value",
                          installments_col: str = "payment_installments",
                          closed_domain: bool = False) -> list[Column]:
    """The per-order payment measures of P15 as aggregate columns.

    ``closed_domain=True`` (every type is one of ``types`` or NULL) counts
    the distinct types as a sum of per-type presence flags, which keeps the
    aggregation free of a distinct rewrite; otherwise it is
    ``count(distinct type)``.
    """
    t, v = F.col(type_col), F.col(value_col)
    card = types[0]
    aggs = [pivot_agg(t, v, [card], "sum", "{}_value")[0],
            F.max(F.when(t == F.lit(card), F.col(installments_col))).alias(f"{card}_installments")]
    aggs += pivot_agg(t, v, list(types[1:]), "sum", "{}_value")
    aggs.append(F.sum(v).alias("total_payment_value"))
    if closed_domain:
        present = [F.max(F.when(t == F.lit(k), F.lit(1)).otherwise(F.lit(0))) for k in types]
        n = present[0]
        for p in present[1:]:
            n = n + p
        aggs.append(n.cast("bigint").alias("payment_types_count"))
    else:
        aggs.append(F.count_distinct(t).alias("payment_types_count"))
    return aggs


def int_olist_order_payments_agg(payments: DataFrame, types: Sequence[str] = PAYMENT_TYPES,
                                 closed_domain: bool = False) -> DataFrame:
    """Payments pivoted per order.

    The distinct payment-type count is a narrow aggregation of its own,
    joined on ``order_id`` (same partitioning, no extra shuffle), unless the
    type domain is closed, where it is a sum of presence flags.
    """
    cols = payment_pivot_columns(types, closed_domain=closed_domain)
    if closed_domain:
        return payments.groupBy("order_id").agg(*cols)
    base = payments.groupBy("order_id").agg(*cols[:-1])
    n = distinct_counts(payments, ["order_id"], {"payment_types_count": "payment_type"})
    return base.join(n, "order_id", "left")


def int_olist_order_items_agg(
    items: DataFrame, products: DataFrame, extra: Sequence[Column] = (),
) -> DataFrame:
    """Items per order with the dominant product category.

    Three aggregations per order - additive measures (plus ``extra``), the
    two distinct counts (narrow, see ``distinct_counts``) and the dominant
    category (two-phase mode) - joined on ``order_id``.  All three come out
    hash-partitioned on ``order_id``, so the joins add no shuffle, and a
    consumer that reads none of a branch's columns lets Catalyst drop it.
    """
    p = products.select("product_id", "product_category_name")
    enriched = lookup_join(items, p, "product_id", "left")
    base = items.groupBy("order_id").agg(
        F.count("order_item_id").alias("items_count"),
        F.sum("price").alias("total_price"),
        F.sum("freight_value").alias("total_freight_value"),
        (F.sum("price") + F.sum("freight_value")).alias("total_revenue"),
        *extra,
    )
    distinct = distinct_counts(items, ["order_id"], {"unique_products_count": "product_id",
                                                     "unique_sellers_count": "seller_id"})
    dominant = mode_by_group(enriched, ["order_id"], "product_category_name", "dominant_category_name")
    out = base.join(distinct, "order_id", "left").join(dominant, "order_id", "left")
    return out.select("order_id", "items_count", "unique_products_count", "unique_sellers_count", "total_price",
                      "total_freight_value", "total_revenue", "dominant_category_name",
                      *[c for c in base.columns if c not in (
                          "order_id", "items_count", "total_price", "total_freight_value", "total_revenue")])


def int_olist_order_reviews_agg(reviews: DataFrame, key: str = "order_id",
                                tie_breakers: Sequence[str] = ("review_id",)) -> DataFrame:
    """Latest review per order (G2), with a comment flag."""
    latest = latest_per_key(reviews, [key], "review_answer_timestamp", tie_breakers)
    return latest.select(key, "review_score", is_present("review_comment_message").alias("has_comment"))


def int_dim_customers(customers: DataFrame, geo: DataFrame) -> DataFrame:
    """One row per unique customer with modal address (F6) and centroid."""
    canon = modes_by_group(customers, ["customer_unique_id"], {
        "customer_zip_code_prefix": "customer_zip_code_prefix", "customer_state": "customer_state",
        "customer_city": "customer_city"})
    g = geo.select(
        F.col("geolocation_zip_code_prefix").alias("customer_zip_code_prefix"),
        F.col("geolocation_lat").alias("customer_lat"),
        F.col("geolocation_lng").alias("customer_lng"),
    )
    out = lookup_join(canon, g, "customer_zip_code_prefix", "left")
    return out.select(
        "customer_unique_id", "customer_zip_code_prefix", "customer_state", "customer_city",
        slug("customer_city").alias("customer_city_slug"), "customer_lat", "customer_lng",
    )


def int_dim_sellers(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    """Sellers with slug and centroid."""
    g = geo.select(
        F.col("geolocation_zip_code_prefix").alias("seller_zip_code_prefix"),
        F.col("geolocation_lat").alias("seller_lat"),
        F.col("geolocation_lng").alias("seller_lng"),
    )
    out = lookup_join(sellers, g, "seller_zip_code_prefix", "left")
    return out.select(
        "seller_id", "seller_zip_code_prefix", "seller_state", "seller_city",
        slug("seller_city").alias("seller_city_slug"), "seller_lat", "seller_lng",
    )


def int_dim_products(products: DataFrame) -> DataFrame:
    """P20: products with volume."""
    return products.select(
        "product_id", "product_category_name", "product_name_length", "product_description_length",
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        (F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")).alias("product_volume_cm3"),
    )


def int_ibge_censo_covariaveis(c9514: DataFrame, c10295: DataFrame, c9936: DataFrame) -> DataFrame:
    """Census covariates per municipality (F5 x2, C2, E3 x2)."""
    pop = long_to_wide(c9514, ["codigo_municipio", "ano"], "codigo_variavel", "valor",
                       {VAR_POPULATION: "populacao_residente"})
    renda = long_to_wide(c10295, ["codigo_municipio"], "codigo_variavel", "valor",
                         {VAR_INCOME_MEAN: "renda_media_per_capita", VAR_INCOME_MEDIAN: "renda_mediana_per_capita"})
    internet = c9936.select(
        "codigo_municipio", (F.col("pct_domicilios_com_internet") / F.lit(100.0)).alias("pct_domicilios_com_internet")
    )
    out = pop.join(renda, "codigo_municipio", "left").join(internet, "codigo_municipio", "left")
    return out.select(
        "codigo_municipio", F.col("ano").alias("ano_censo"), "populacao_residente",
        "renda_media_per_capita", "renda_mediana_per_capita", "pct_domicilios_com_internet",
    )


def int_ibge_municipios(localidades: DataFrame, covariaveis: DataFrame) -> DataFrame:
    """Municipality dimension with slug and covariates."""
    cov = covariaveis.withColumnRenamed("codigo_municipio", "id_municipio")
    out = localidades.join(cov, "id_municipio", "left")
    return out.select(
        "id_municipio", "nome_municipio", slug("nome_municipio").alias("nome_municipio_slug"),
        "uf_sigla", "uf_nome", "macroregiao_sigla", "macroregiao_nome", "ano_censo",
        "populacao_residente", "renda_media_per_capita", "renda_mediana_per_capita", "pct_domicilios_com_internet",
    )


def int_bcb_pix_municipio(pix: DataFrame, strict_dates: bool = True) -> DataFrame:
    """Monthly payment panel per municipality.

    A YYYYMM that does not parse fails the run (``strict_dates``), as the
    model does; pass ``strict_dates=False`` to get NULL instead.
    """
    c = F.col
    return pix.select(
        "municipio_ibge",
        yyyymm_to_date("ano_mes", strict=strict_dates).alias("ano_mes_data"),
        "municipio", "estado_ibge", "estado", "sigla_regiao", "regiao",
        "vl_pagador_pf", "qt_pagador_pf", "vl_pagador_pj", "qt_pagador_pj",
        (c("vl_pagador_pf") + c("vl_pagador_pj")).alias("vl_total_pagador"),
        (c("qt_pagador_pf") + c("qt_pagador_pj")).alias("qt_total_transacoes_pagador"),
        "qt_pes_pagador_pf", "qt_pes_pagador_pj",
        "vl_recebedor_pf", "qt_recebedor_pf", "vl_recebedor_pj", "qt_recebedor_pj",
        (c("vl_recebedor_pf") + c("vl_recebedor_pj")).alias("vl_total_recebedor"),
        (c("qt_recebedor_pf") + c("qt_recebedor_pj")).alias("qt_total_transacoes_recebedor"),
        "qt_pes_recebedor_pf", "qt_pes_recebedor_pj",
    )


def delivery_measures(purchased: str | Column, approved: str | Column, estimated: str | Column, delivered: str | Column) -> list[Column]:
    """The order fact's durations in days and whether delivery kept its date."""
    return [day_diff(purchased, approved).alias("approval_days"), day_diff(purchased, estimated).alias("estimated_delivery_days"),
            day_diff(purchased, delivered).alias("delivery_days"), on_time_flag(delivered, estimated).alias("is_on_time")]


def int_fact_orders(
    orders: DataFrame,
    customers: DataFrame,
    geo: DataFrame,
    payments_agg: DataFrame,
    items_agg: DataFrame,
    reviews_agg: DataFrame,
    review_key: str = "order_id",
    order_keys: DataFrame | None = None,
) -> DataFrame:
    """One row per order (E4 star join, J6 x3, C6).

    Customers meet their zip code first, so the orders move twice: once by
    customer, where customers with many orders are divided (``order_keys`` is
    any cheaper frame with the orders' ``customer_id``), and once by order.
    Children are pre-aggregated to one row per order, so the left joins
    cannot fan out; their hash partitioning on ``order_id`` is reused.
    """
    c = customers.select("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                         "customer_state", "customer_city")
    g = geo.select(
        F.col("geolocation_zip_code_prefix").alias("customer_zip_code_prefix"),
        F.col("geolocation_lat").alias("customer_lat"),
        F.col("geolocation_lng").alias("customer_lng"),
    )
    c = salted_join(c, g, "customer_zip_code_prefix", "customer_id", how="left")  # one row a zip code: small
    base = skew_join(orders, c, "customer_id", "order_id", keys_of=order_keys)
    joined = star_join(base, [
        (payments_agg, "order_id", "left"),
        (items_agg, "order_id", "left"),
        (reviews_agg, review_key, "left"),
    ])
    p = "order_purchase_timestamp"
    return joined.select(
        "order_id", "customer_id", "customer_unique_id", "order_status",
        p, "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "customer_zip_code_prefix", "customer_state", "customer_city", "customer_lat", "customer_lng",
        *delivery_measures(p, "order_approved_at", "order_estimated_delivery_date", "order_delivered_customer_date"),
        "total_payment_value", "credit_card_value", "credit_card_installments", "boleto_value",
        "voucher_value", "debit_card_value", "not_defined_value", "payment_types_count",
        "items_count", "unique_products_count", "unique_sellers_count", "total_price",
        "total_freight_value", "total_revenue", "dominant_category_name",
        "review_score", "has_comment",
    )
