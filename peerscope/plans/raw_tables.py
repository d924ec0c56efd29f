"""The business, place, census and payment sources as they would land, drawn from the benchmark tables.

Each text is plain SQL that Spark and other engines read alike; ``{table}`` stands for a benchmark table.  They are
inputs of the models, not models: what a model makes of them is stated once in Spark (``model_queries``) and once in
SQL (``model_sql``).  Some values are missing, some lookups have no match and some values tie, on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

PLACE = "JOIN {nation} ON {key} = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"


def _placed(text: str, key: str) -> str:
    return text + " " + PLACE.replace("{key}", key)


ORDERS = """
SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'canceled' END AS order_status,
       CAST(o_orderdate AS STRING) AS order_purchase_timestamp,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' ELSE CAST(o_orderdate + INTERVAL 1 DAY AS STRING) END AS order_approved_at,
       CAST(NULL AS STRING) AS order_delivered_carrier_date,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 30 DAY AS STRING) END AS order_delivered_customer_date,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate + INTERVAL 25 DAY AS STRING)
            ELSE CAST(o_orderdate + INTERVAL 60 DAY AS STRING) END AS order_estimated_delivery_date
FROM {orders}"""

ORDER_ITEMS = """
SELECT CAST(l_orderkey AS STRING) AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
       CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id,
       CAST(l_shipdate AS STRING) AS shipping_limit_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
       CAST(l_extendedprice * l_tax AS DECIMAL(18,4)) AS freight_value
FROM {lineitem}"""

ORDER_PAYMENTS = """
SELECT CAST(l_orderkey AS STRING) AS order_id, CAST(l_linenumber AS BIGINT) AS payment_sequential,
       CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'boleto' ELSE 'voucher' END AS payment_type,
       CAST(l_linenumber AS BIGINT) AS payment_installments, CAST(l_extendedprice AS DECIMAL(18,2)) AS payment_value
FROM {lineitem}"""

ORDER_REVIEWS = """
SELECT CAST(event_id AS STRING) AS review_id, CAST(user_id AS STRING) AS order_id,
       CAST(1 + event_id % 5 AS BIGINT) AS review_score, CAST(NULL AS STRING) AS review_comment_title,
       CASE WHEN event_type <> 'view' THEN event_type END AS review_comment_message,
       CAST(ts AS STRING) AS review_creation_date,
       CASE WHEN event_type = 'error' THEN 'soon' ELSE CAST(ts AS STRING) END AS review_answer_timestamp
FROM {events}"""

CUSTOMERS = _placed("""
SELECT CAST(c_custkey AS STRING) AS customer_id, CONCAT('u', CAST(c_custkey % 400 AS STRING)) AS customer_unique_id,
       CAST(CASE WHEN c_custkey % 11 = 0 THEN 999999 ELSE c_nationkey * 100 + c_custkey % 3 END AS BIGINT) AS customer_zip_code_prefix,
       LOWER(n_name) AS customer_city, CASE WHEN c_custkey % 13 <> 0 THEN r_name END AS customer_state
FROM {customer}""", "c_nationkey")

GEOLOCATION = _placed("""
SELECT CAST(c_nationkey * 100 + c_custkey % 3 AS BIGINT) AS geolocation_zip_code_prefix,
       CAST(c_custkey % 90 AS BIGINT) AS geolocation_lat, CAST(c_custkey AS BIGINT) AS geolocation_lng,
       CASE WHEN c_custkey % 2 = 0 THEN UPPER(n_name) ELSE LOWER(n_name) END AS geolocation_city,
       LOWER(r_name) AS geolocation_state
FROM {customer}""", "c_nationkey")

PRODUCTS = """
SELECT CAST(p_partkey AS STRING) AS product_id, CASE WHEN p_partkey % 9 <> 0 THEN p_type END AS product_category_name,
       CAST(LENGTH(p_name) AS BIGINT) AS product_name_lenght,
       CASE WHEN p_size % 7 <> 0 THEN CAST(p_size AS BIGINT) END AS product_description_lenght,
       CAST(p_size % 5 AS BIGINT) AS product_photos_qty, CAST(p_size * 10 AS BIGINT) AS product_weight_g,
       CAST(p_size AS BIGINT) AS product_length_cm,
       CASE WHEN p_size % 6 <> 0 THEN CAST(p_size + 1 AS BIGINT) END AS product_height_cm,
       CAST(p_size + 2 AS BIGINT) AS product_width_cm
FROM {part}"""

SELLERS = _placed("""
SELECT CAST(s_suppkey AS STRING) AS seller_id,
       CAST(CASE WHEN s_suppkey % 7 = 0 THEN 999999 ELSE s_nationkey * 100 END AS BIGINT) AS seller_zip_code_prefix,
       CASE WHEN s_suppkey % 5 = 0 THEN 'nowhere' ELSE UPPER(n_name) END AS seller_city, LOWER(r_name) AS seller_state
FROM {supplier}""", "s_nationkey")

LOCALIDADES = """
SELECT CAST(n_nationkey AS BIGINT) AS id_municipio, n_name AS nome_municipio,
       CAST(n_nationkey + 100 AS BIGINT) AS regiao_imediata_id, CONCAT(n_name, ' imediata') AS regiao_imediata_nome,
       CAST(n_regionkey + 10 AS BIGINT) AS regiao_interm_id, CONCAT(r_name, ' interm') AS regiao_interm_nome,
       CAST(n_regionkey AS BIGINT) AS uf_id, r_name AS uf_sigla, CONCAT('Estado ', r_name) AS uf_nome,
       CAST(n_regionkey + 50 AS BIGINT) AS macroregiao_id, CAST(n_regionkey AS STRING) AS macroregiao_sigla, r_name AS macroregiao_nome,
       CASE WHEN n_nationkey % 4 <> 0 THEN CAST(n_nationkey + 7 AS BIGINT) END AS microrregiao_id,
       CASE WHEN n_nationkey % 4 <> 0 THEN n_name END AS microrregiao_nome,
       CASE WHEN n_nationkey % 4 <> 0 THEN CAST(n_regionkey + 9 AS BIGINT) END AS mesorregiao_id,
       CASE WHEN n_nationkey % 4 <> 0 THEN r_name END AS mesorregiao_nome
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""


def _census(variable: str, value: str) -> str:
    return f"""
SELECT '6' AS NC, 'Municipio' AS NN, '45' AS MC, 'Unidade' AS MN, {value} AS V, CAST(c_nationkey AS STRING) AS D1C,
       CAST(c_nationkey AS STRING) AS D1N, '{variable}' AS D2C, 'v{variable}' AS D2N, '2022' AS D3C, '2022' AS D3N,
       '6794' AS D4C, 'Total' AS D4N, '1' AS D5C, CAST(NULL AS STRING) AS D5N, '2' AS D6C, 'x' AS D6N
FROM {{customer}} WHERE c_nationkey <> 3 GROUP BY c_nationkey"""


POSITIVE = "COUNT(CASE WHEN c_acctbal > 0 THEN 1 END)"
CENSO_9514 = _census("93", "CAST(COUNT(*) AS STRING)") + " UNION ALL " + _census("1000093", "'100'")
CENSO_10295 = _census("13431", "CAST(MAX(c_custkey) AS STRING)") + " UNION ALL " + _census(
    "13534", "CASE WHEN c_nationkey % 5 = 0 THEN CAST(NULL AS STRING) ELSE CAST(MIN(c_custkey) AS STRING) END")
CENSO_9936 = _census("1000381", f"CAST({POSITIVE} AS STRING)")

_CLASSES = [("Pagador", "O", "PF", "= 'N'"), ("Pagador", "O", "PJ", "<> 'N'"), ("Recebedor", "F", "PF", "= 'N'"),
            ("Recebedor", "F", "PJ", "<> 'N'")]
_SIDE = {k: f"l_linestatus = '{status}' AND l_returnflag {flag}" for side, status, kind, flag in _CLASSES for k in [f"{side}{kind}"]}
PIX = """
SELECT CAST(YEAR(l_shipdate) * 100 + MONTH(l_shipdate) AS BIGINT) AS AnoMes, CAST(s_nationkey AS BIGINT) AS Municipio_Ibge,
       n_name AS Municipio, CAST(n_regionkey AS BIGINT) AS Estado_Ibge, r_name AS Estado, CAST(n_regionkey AS STRING) AS Sigla_Regiao,
       r_name AS Regiao, """ + ", ".join(
    [f"CAST(COUNT(CASE WHEN {_SIDE[k]} THEN 1 END) * 100 AS BIGINT) AS VL_{k}, CAST(COUNT(CASE WHEN {_SIDE[k]} THEN 1 END) AS BIGINT) AS QT_{k}"
     for k in ("PagadorPF", "PagadorPJ", "RecebedorPF", "RecebedorPJ")]
    + [f"CAST(COUNT(DISTINCT CASE WHEN {_SIDE[k]} THEN l_suppkey END) AS BIGINT) AS QT_PES_{k}"
       for k in ("PagadorPF", "PagadorPJ", "RecebedorPF", "RecebedorPJ")]) + """
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey """ + PLACE.replace("{key}", "s_nationkey") + """
GROUP BY YEAR(l_shipdate) * 100 + MONTH(l_shipdate), s_nationkey, n_name, n_regionkey, r_name"""


def landed(t: dict[str, DataFrame], text: str) -> DataFrame:
    """The rows of a text over the benchmark tables ``t``."""
    import re

    names = set(re.findall(r"\{(\w+)\}", text))
    frames = {n: t[n] for n in names}
    spark = next(iter(frames.values())).sparkSession
    return spark.sql(text, **frames)
