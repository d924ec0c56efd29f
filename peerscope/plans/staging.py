"""Staging layer (P1-P13): latest snapshot, fingerprint, dedup, safe casts, renames.

One raw row gives at most one staging row; no joins, no business rules.
Snapshot sources (payments panel, municipalities, census) first keep only
their newest ``ingestion_date`` partition (A6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.functions.columns import concat_key, row_hash, safe_cast
from peerscope.operators.dedup import dedup_by_hash, latest_snapshot

# ----------------------------------------------------------------------------
# The columns of each row fingerprint, in fingerprint order.
# ----------------------------------------------------------------------------
HASH_COLUMNS = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                  "customer_state"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
                    "freight_value"],
    "order_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "order_reviews": ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                      "review_creation_date", "review_answer_timestamp"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
                    "geolocation_state"],
    "products": ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
                 "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
                 "product_width_cm"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "ibge_localidades": ["id_municipio", "nome_municipio", "regiao_imediata_id", "regiao_imediata_nome",
                         "regiao_interm_id", "regiao_interm_nome", "uf_id", "uf_sigla", "uf_nome",
                         "macroregiao_id", "macroregiao_sigla", "macroregiao_nome", "microrregiao_id",
                         "microrregiao_nome", "mesorregiao_id", "mesorregiao_nome"],
    "ibge_censo_9514": ["D1C", "D2C", "D2N", "D3C", "D4C", "D4N", "D5C", "D5N", "D6C", "D6N", "V"],
    "ibge_censo_10295": ["D1C", "D2C", "D2N", "D3C", "D4C", "D4N", "D5C", "D5N", "D6C", "D6N", "V"],
    "ibge_censo_9936": ["D1C", "D2C", "D3C", "D4C", "V"],
    "bcb_pix": ["AnoMes", "Municipio_Ibge", "Municipio", "Estado_Ibge", "Estado", "Sigla_Regiao", "Regiao",
                "VL_PagadorPF", "QT_PagadorPF", "VL_PagadorPJ", "QT_PagadorPJ", "VL_RecebedorPF",
                "QT_RecebedorPF", "VL_RecebedorPJ", "QT_RecebedorPJ", "QT_PES_PagadorPF", "QT_PES_PagadorPJ",
                "QT_PES_RecebedorPF", "QT_PES_RecebedorPJ"],
}
# ----------------------------------------------------------------------------

TS = "timestamp"


def _dedup(raw: DataFrame, table: str) -> DataFrame:
    """One row a fingerprint; it is shuffled as its 16 bytes."""
    d = dedup_by_hash(raw.withColumn("row_hash", F.unhex(row_hash(*HASH_COLUMNS[table]))), "row_hash")
    return d.withColumn("row_hash", F.lower(F.hex("row_hash")))


def stg_olist_customers(raw: DataFrame) -> DataFrame:
    """P1."""
    return _dedup(raw, "customers").select("row_hash", *HASH_COLUMNS["customers"])


def stg_olist_orders(raw: DataFrame, ts_type: str = TS) -> DataFrame:
    """Text timestamps -> TIMESTAMP with SAFE_CAST semantics."""
    d = _dedup(raw, "orders")
    return d.select(
        "row_hash", "order_id", "customer_id", "order_status",
        *[safe_cast(c, ts_type).alias(c) for c in HASH_COLUMNS["orders"][3:]],
    )


def stg_olist_order_items(raw: DataFrame, ts_type: str = TS) -> DataFrame:
    """P3."""
    d = _dedup(raw, "order_items")
    return d.select(
        "row_hash", concat_key("order_id", "order_item_id").alias("order_item_pk"),
        "order_id", "order_item_id", "product_id", "seller_id",
        safe_cast("shipping_limit_date", ts_type).alias("shipping_limit_date"), "price", "freight_value",
    )


def stg_olist_order_payments(raw: DataFrame) -> DataFrame:
    """P4."""
    d = _dedup(raw, "order_payments")
    return d.select(
        "row_hash", concat_key("order_id", "payment_sequential").alias("payment_pk"),
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
    )


def stg_olist_order_reviews(raw: DataFrame, ts_type: str = TS) -> DataFrame:
    """P5."""
    d = _dedup(raw, "order_reviews")
    return d.select(
        "row_hash", concat_key("review_id", "order_id").alias("review_pk"),
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        safe_cast("review_creation_date", ts_type).alias("review_creation_date"),
        safe_cast("review_answer_timestamp", ts_type).alias("review_answer_timestamp"),
    )


def stg_olist_geolocation(raw: DataFrame) -> DataFrame:
    """P6."""
    return _dedup(raw, "geolocation").select("row_hash", *HASH_COLUMNS["geolocation"])


def stg_olist_products(raw: DataFrame) -> DataFrame:
    """Also fixes the misspelt column names."""
    d = _dedup(raw, "products")
    return d.select(
        "row_hash", "product_id", "product_category_name",
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    )


def stg_olist_sellers(raw: DataFrame) -> DataFrame:
    """P8."""
    return _dedup(raw, "sellers").select("row_hash", *HASH_COLUMNS["sellers"])


def stg_ibge_localidades(raw: DataFrame) -> DataFrame:
    """Newest snapshot; optional ids may arrive as doubles."""
    d = _dedup(latest_snapshot(raw), "ibge_localidades")
    cols = HASH_COLUMNS["ibge_localidades"]
    return d.select(
        "row_hash", *cols[:12],
        safe_cast("microrregiao_id", "bigint").alias("microrregiao_id"), "microrregiao_nome",
        safe_cast("mesorregiao_id", "bigint").alias("mesorregiao_id"), "mesorregiao_nome",
    )


def _census_long(raw: DataFrame, table: str, d5: str, d6: str) -> DataFrame:
    d = _dedup(latest_snapshot(raw), table)
    return d.select(
        "row_hash",
        safe_cast("D1C", "bigint").alias("codigo_municipio"),
        F.col("D2C").alias("codigo_variavel"), F.col("D2N").alias("variavel"),
        safe_cast("D3C", "bigint").alias("ano"),
        F.col("D4C").alias("codigo_sexo"), F.col("D4N").alias("sexo"),
        F.col("D5C").alias(f"codigo_{d5}"), F.col("D5N").alias(d5),
        F.col("D6C").alias(f"codigo_{d6}"), F.col("D6N").alias(d6),
        safe_cast("V", "double").alias("valor"),
    )


def stg_ibge_censo_9514(raw: DataFrame) -> DataFrame:
    """P10: population by sex and age."""
    return _census_long(raw, "ibge_censo_9514", "declaracao_idade", "idade")


def stg_ibge_censo_10295(raw: DataFrame) -> DataFrame:
    """Income by sex, age group and colour."""
    return _census_long(raw, "ibge_censo_10295", "grupo_idade", "cor_raca")


def stg_ibge_censo_9936(raw: DataFrame) -> DataFrame:
    """Households with internet (percent)."""
    d = _dedup(latest_snapshot(raw), "ibge_censo_9936")
    return d.select(
        "row_hash", safe_cast("D1C", "bigint").alias("codigo_municipio"), safe_cast("D3C", "bigint").alias("ano"),
        safe_cast("V", "double").alias("pct_domicilios_com_internet"),
    )


# Payments-panel column names and their staging names.
PIX_RENAMES = {
    "AnoMes": "ano_mes", "Municipio_Ibge": "municipio_ibge", "Municipio": "municipio", "Estado_Ibge": "estado_ibge",
    "Estado": "estado", "Sigla_Regiao": "sigla_regiao", "Regiao": "regiao",
    "VL_PagadorPF": "vl_pagador_pf", "QT_PagadorPF": "qt_pagador_pf", "VL_PagadorPJ": "vl_pagador_pj",
    "QT_PagadorPJ": "qt_pagador_pj", "VL_RecebedorPF": "vl_recebedor_pf", "QT_RecebedorPF": "qt_recebedor_pf",
    "VL_RecebedorPJ": "vl_recebedor_pj", "QT_RecebedorPJ": "qt_recebedor_pj",
    "QT_PES_PagadorPF": "qt_pes_pagador_pf", "QT_PES_PagadorPJ": "qt_pes_pagador_pj",
    "QT_PES_RecebedorPF": "qt_pes_recebedor_pf", "QT_PES_RecebedorPJ": "qt_pes_recebedor_pj",
}


def stg_bcb_pix(raw: DataFrame) -> DataFrame:
    """Newest snapshot, fingerprint over all 19 columns, snake_case names."""
    d = _dedup(latest_snapshot(raw), "bcb_pix")
    return d.select("row_hash", *[F.col(a).alias(b) for a, b in PIX_RENAMES.items()])
