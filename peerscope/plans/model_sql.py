"""What the layered models make of the raw tables (``raw_tables``), stated in SQL for ``model_queries``."""

from __future__ import annotations

from peerscope.plans import raw_tables as R
from peerscope.plans.oracle_sql import SLUG, kpi_select
from peerscope.plans.staging import HASH_COLUMNS, PIX_RENAMES


class _Names(dict):
    def __missing__(self, name: str) -> str:
        return name


def _raw(text: str) -> str:
    return text.format_map(_Names())


def _hash(columns: list[str]) -> str:
    return "md5(" + " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns) + ")"


def _staged(source: str, text: str, select: str) -> str:
    return f"SELECT {_hash(HASH_COLUMNS[source])} AS row_hash, {select} FROM (SELECT DISTINCT * FROM ({_raw(text)}) r) d"


def _ts(*columns: str) -> str:
    return ", ".join(f"TRY_CAST({c} AS TIMESTAMP) AS {c}" for c in columns)


def _census(number: str, text: str, d5: str, d6: str) -> str:
    return _staged(f"ibge_censo_{number}", text, f"""
        TRY_CAST(D1C AS BIGINT) AS codigo_municipio, D2C AS codigo_variavel, D2N AS variavel, TRY_CAST(D3C AS BIGINT) AS ano,
        D4C AS codigo_sexo, D4N AS sexo, D5C AS codigo_{d5}, D5N AS {d5}, D6C AS codigo_{d6}, D6N AS {d6}, TRY_CAST(V AS DOUBLE) AS valor""")


STG = {
    "stg_order_items": _staged("order_items", R.ORDER_ITEMS, "order_id || '-' || order_item_id AS order_item_pk, order_id, "
                               f"order_item_id, product_id, seller_id, {_ts('shipping_limit_date')}, price, freight_value"),
    "stg_order_payments": _staged("order_payments", R.ORDER_PAYMENTS, "order_id || '-' || payment_sequential AS payment_pk, order_id, "
                                  "payment_sequential, payment_type, payment_installments, payment_value"),
    "stg_order_reviews": _staged("order_reviews", R.ORDER_REVIEWS, "review_id || '-' || order_id AS review_pk, review_id, order_id, review_score, "
                                 f"review_comment_title, review_comment_message, {_ts('review_creation_date', 'review_answer_timestamp')}"),
    "stg_geolocation": _staged("geolocation", R.GEOLOCATION, "d.*"),
    "stg_products": _staged("products", R.PRODUCTS, "product_id, product_category_name, product_name_lenght AS product_name_length, "
                            "product_description_lenght AS product_description_length, product_photos_qty, product_weight_g, "
                            "product_length_cm, product_height_cm, product_width_cm"),
    "stg_sellers": _staged("sellers", R.SELLERS, "d.*"),
    "stg_localidades": _staged("ibge_localidades", R.LOCALIDADES, "d.*"),
    "stg_censo_9514": _census("9514", R.CENSO_9514, "declaracao_idade", "idade"),
    "stg_censo_10295": _census("10295", R.CENSO_10295, "grupo_idade", "cor_raca"),
    "stg_censo_9936": _staged("ibge_censo_9936", R.CENSO_9936, "TRY_CAST(D1C AS BIGINT) AS codigo_municipio, "
                              "TRY_CAST(D3C AS BIGINT) AS ano, TRY_CAST(V AS DOUBLE) AS pct_domicilios_com_internet"),
    "stg_pix": _staged("bcb_pix", R.PIX, ", ".join(f"{a} AS {b}" for a, b in PIX_RENAMES.items())),
    "stg_orders": _staged("orders", R.ORDERS, "order_id, customer_id, order_status, " + _ts(
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date")),
    "stg_customers": _staged("customers", R.CUSTOMERS, "d.*"),
}


def _mode(table: str, key: str, value: str) -> str:
    return f"""(SELECT {key}, {value} FROM (
        SELECT {key}, {value}, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {value}) AS nth
        FROM {table} WHERE {value} IS NOT NULL GROUP BY {key}, {value}) m WHERE nth = 1)"""


ZIP = "geolocation_zip_code_prefix"
CTE = {
    "int_geolocation": f"""
        SELECT c.{ZIP}, lat AS geolocation_lat, lng AS geolocation_lng, geolocation_city,
               {SLUG.format('geolocation_city')} AS geolocation_city_slug, geolocation_state
        FROM (SELECT {ZIP}, avg(geolocation_lat) AS lat, avg(geolocation_lng) AS lng FROM stg_geolocation GROUP BY {ZIP}) c
        LEFT JOIN {_mode('stg_geolocation', ZIP, 'geolocation_city')} a ON a.{ZIP} = c.{ZIP}
        LEFT JOIN {_mode('stg_geolocation', ZIP, 'geolocation_state')} b ON b.{ZIP} = c.{ZIP}""",
    "int_order_reviews_agg": """
        SELECT order_id, review_score, review_comment_message IS NOT NULL AS has_comment FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY review_answer_timestamp DESC NULLS LAST, review_id) AS nth
          FROM stg_order_reviews) r WHERE nth = 1""",
    "int_dim_customers": f"""
        SELECT u.customer_unique_id, z.customer_zip_code_prefix, s.customer_state, c.customer_city,
               {SLUG.format('c.customer_city')} AS customer_city_slug, g.geolocation_lat AS customer_lat, g.geolocation_lng AS customer_lng
        FROM (SELECT DISTINCT customer_unique_id FROM stg_customers) u
        LEFT JOIN {_mode('stg_customers', 'customer_unique_id', 'customer_zip_code_prefix')} z ON z.customer_unique_id = u.customer_unique_id
        LEFT JOIN {_mode('stg_customers', 'customer_unique_id', 'customer_state')} s ON s.customer_unique_id = u.customer_unique_id
        LEFT JOIN {_mode('stg_customers', 'customer_unique_id', 'customer_city')} c ON c.customer_unique_id = u.customer_unique_id
        LEFT JOIN int_geolocation g ON g.{ZIP} = z.customer_zip_code_prefix""",
    "int_dim_sellers": f"""
        SELECT seller_id, seller_zip_code_prefix, seller_state, seller_city, {SLUG.format('seller_city')} AS seller_city_slug,
               g.geolocation_lat AS seller_lat, g.geolocation_lng AS seller_lng
        FROM stg_sellers s LEFT JOIN int_geolocation g ON g.{ZIP} = s.seller_zip_code_prefix""",
    "int_dim_products": """
        SELECT product_id, product_category_name, product_name_length, product_description_length, product_photos_qty,
               product_weight_g, product_length_cm, product_height_cm, product_width_cm,
               product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3 FROM stg_products""",
    "int_censo_covariaveis": """
        SELECT p.codigo_municipio, p.ano AS ano_censo, p.populacao_residente, r.renda_media_per_capita, r.renda_mediana_per_capita,
               i.pct_domicilios_com_internet / 100.0::DOUBLE AS pct_domicilios_com_internet
        FROM (SELECT codigo_municipio, ano, max(valor) FILTER (codigo_variavel = '93') AS populacao_residente
              FROM stg_censo_9514 GROUP BY codigo_municipio, ano) p
        LEFT JOIN (SELECT codigo_municipio, max(valor) FILTER (codigo_variavel = '13431') AS renda_media_per_capita,
                          max(valor) FILTER (codigo_variavel = '13534') AS renda_mediana_per_capita
                   FROM stg_censo_10295 GROUP BY codigo_municipio) r ON r.codigo_municipio = p.codigo_municipio
        LEFT JOIN stg_censo_9936 i ON i.codigo_municipio = p.codigo_municipio""",
    "int_municipios": f"""
        SELECT id_municipio, nome_municipio, {SLUG.format('nome_municipio')} AS nome_municipio_slug, uf_sigla, uf_nome,
               macroregiao_sigla, macroregiao_nome, ano_censo, populacao_residente, renda_media_per_capita,
               renda_mediana_per_capita, pct_domicilios_com_internet
        FROM stg_localidades l LEFT JOIN int_censo_covariaveis c ON c.codigo_municipio = l.id_municipio""",
    "payments_agg": """
        SELECT order_id, sum(payment_value) AS total_payment_value, count(DISTINCT payment_type) AS payment_types_count,
               sum(payment_value) FILTER (payment_type = 'credit_card') AS credit_card_value,
               max(payment_installments) FILTER (payment_type = 'credit_card') AS credit_card_installments,
               sum(payment_value) FILTER (payment_type = 'boleto') AS boleto_value,
               sum(payment_value) FILTER (payment_type = 'voucher') AS voucher_value,
               sum(payment_value) FILTER (payment_type = 'debit_card') AS debit_card_value,
               sum(payment_value) FILTER (payment_type = 'not_defined') AS not_defined_value
        FROM stg_order_payments GROUP BY order_id""",
    "categories": """
        SELECT order_id, product_category_name FROM stg_order_items i JOIN stg_products p ON p.product_id = i.product_id""",
    "items_agg": f"""
        SELECT i.order_id, items_count, unique_products_count, unique_sellers_count, total_price, total_freight_value, total_revenue,
               product_category_name AS dominant_category_name
        FROM (SELECT order_id, count(*) AS items_count, count(DISTINCT product_id) AS unique_products_count,
                     count(DISTINCT seller_id) AS unique_sellers_count, sum(price) AS total_price, sum(freight_value) AS total_freight_value,
                     sum(price) + sum(freight_value) AS total_revenue FROM stg_order_items GROUP BY order_id) i
        LEFT JOIN {_mode('categories', 'order_id', 'product_category_name')} m ON m.order_id = i.order_id""",
    "int_fact_orders": f"""
        SELECT o.order_id, o.customer_id, c.customer_unique_id, order_status, order_purchase_timestamp, order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
               c.customer_zip_code_prefix, c.customer_state, c.customer_city, g.geolocation_lat AS customer_lat, g.geolocation_lng AS customer_lng,
               CAST(date_diff('day', order_purchase_timestamp::DATE, order_approved_at::DATE) AS INTEGER) AS approval_days,
               CAST(date_diff('day', order_purchase_timestamp::DATE, order_estimated_delivery_date::DATE) AS INTEGER) AS estimated_delivery_days,
               CAST(date_diff('day', order_purchase_timestamp::DATE, order_delivered_customer_date::DATE) AS INTEGER) AS delivery_days,
               order_delivered_customer_date <= order_estimated_delivery_date AS is_on_time,
               total_payment_value, credit_card_value, credit_card_installments, boleto_value, voucher_value, debit_card_value,
               not_defined_value, payment_types_count, items_count, unique_products_count, unique_sellers_count, total_price,
               total_freight_value, total_revenue, dominant_category_name, review_score, has_comment
        FROM stg_orders o JOIN stg_customers c ON c.customer_id = o.customer_id
        LEFT JOIN int_geolocation g ON g.{ZIP} = c.customer_zip_code_prefix
        LEFT JOIN payments_agg p ON p.order_id = o.order_id LEFT JOIN items_agg i ON i.order_id = o.order_id
        LEFT JOIN int_order_reviews_agg r ON r.order_id = o.order_id""",
    "mart_orders": f"""
        SELECT k.*, s.vendedores_no_municipio FROM (
          SELECT m.id_municipio, m.nome_municipio, m.uf_sigla, m.macroregiao_nome, CAST(year(order_purchase_timestamp) AS INTEGER) AS ano, {kpi_select()}
          FROM int_fact_orders f JOIN int_geolocation g ON g.{ZIP} = f.customer_zip_code_prefix
          JOIN int_municipios m ON m.nome_municipio_slug = g.geolocation_city_slug AND m.uf_sigla = upper(g.geolocation_state)
          WHERE order_purchase_timestamp >= TIMESTAMP '1996-01-01 00:00:00' GROUP BY 1, 2, 3, 4, 5) k
        LEFT JOIN (
          SELECT id_municipio, count(seller_id) AS vendedores_no_municipio FROM int_dim_sellers d
          JOIN int_municipios m ON m.nome_municipio_slug = d.seller_city_slug AND m.uf_sigla = upper(d.seller_state)
          GROUP BY id_municipio) s ON s.id_municipio = k.id_municipio""",
}

MONEY_COLUMNS = {
    "stg_order_items": ["price", "freight_value"],
    "stg_order_payments": ["payment_value"],
    "int_fact_orders": ["total_payment_value", "credit_card_value", "boleto_value", "voucher_value", "debit_card_value",
                        "not_defined_value", "total_price", "total_freight_value", "total_revenue"],
}


def _query(name: str) -> str:
    ctes = ",\n".join(f"{n} AS ({text})" for n, text in {**STG, **CTE}.items())
    money = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MONEY_COLUMNS.get(name, []))
    return f"WITH {ctes}\nSELECT *{f' REPLACE ({money})' if money else ''} FROM {name}"


ORACLE_SQL = {name: _query(name) for name in [*STG, *CTE] if name not in (
    "stg_orders", "stg_customers", "payments_agg", "categories", "items_agg")}
ORACLE_SQL |= {
    "odata_ingest": f"""
        SELECT * REPLACE (CAST(Municipio_Ibge AS BIGINT) AS Municipio_Ibge,
                          {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in PIX_RENAMES if c.startswith('VL_'))}), TRUE AS _valid
        FROM ({_raw(R.PIX)}) p WHERE AnoMes % 7 <> 0""",
    "sidra_ingest": f"SELECT *, TRUE AS _valid FROM ({_raw(R.CENSO_10295)}) c",
    "municipios_ingest": f"SELECT *, TRUE AS _valid FROM ({_raw(R.LOCALIDADES)}) l",
}
