"""Marts (P25-P27): yearly indicators per place and one profile per place.

Averages are written as ``sum / count`` in double (``mean_of``) and ratios
through ``safe_ratio``: with exact (decimal) money inputs every number is
then independent of row order and of the engine that computes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from peerscope.functions.columns import (
    per_capita, population_band, presence_band, safe_ratio, with_default,
)
from peerscope.operators.aggregates import reaggregate
from peerscope.operators.joins import computed_key_join, lookup_join, salted_join

# Order status groups of the business source.
DELIVERED = ("delivered",)
CANCELLED = ("canceled", "unavailable")
IN_PROGRESS = ("shipped", "invoiced", "processing", "approved", "created")
SINCE = "2017-01-01"
PROFILE_YEAR = 2018

PLACE_KEYS = ["id_municipio", "nome_municipio", "uf_sigla", "macroregiao_nome"]


def order_kpis(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Yearly order indicators per group.

    ``facts`` carries the order-fact columns (status, money, delivery and
    review measures).  Two hash aggregations: additive measures per group and
    customer, then their sums per group, where the unique customers are the
    rows with a customer.  So the fact is read once, no distinct rewrite is
    needed, and a hot group stays divided by customer.
    """
    c = F.col
    one, zero = F.lit(1), F.lit(0)
    st, score = c("order_status"), c("review_score")
    delivered = st.isin(*DELIVERED)

    def count_if(cond: Column) -> Column:
        return F.sum(F.when(cond, one).otherwise(zero))

    def delivered_sum(x: str) -> Column:  # 'else 0': a delivered NULL stays out of the sum (T3)
        return F.sum(F.when(delivered, c(x)).otherwise(zero))

    additive = {
        "total_pedidos": F.count(one),
        "pedidos_entregues": count_if(delivered),
        "pedidos_cancelados": count_if(st.isin(*CANCELLED)),
        "pedidos_em_andamento": count_if(st.isin(*IN_PROGRESS)),
        "receita_total": delivered_sum("total_revenue"),
        "_freight": delivered_sum("total_freight_value"),
        "_card": delivered_sum("credit_card_value"),
        "_boleto": delivered_sum("boleto_value"),
        "_paid": delivered_sum("total_payment_value"),
        "_on_time": count_if(c("is_on_time") == F.lit(True)),
        "_reviewed": count_if(score.isNotNull()),
        "_positive": count_if(score >= 4),
        "_negative": count_if(score <= 2),
    }
    means = {  # averages: their sum and count are additive
        "ticket_medio": F.when(delivered, c("total_revenue")),
        "frete_medio": F.when(delivered, c("total_freight_value")),
        "avg_parcelas_cartao": F.when(delivered & (c("credit_card_value") > 0), c("credit_card_installments")),
        "avg_dias_entrega": F.when(delivered, c("delivery_days")),
        "avg_dias_aprovacao": F.when(delivered, c("approval_days")),
        "avg_review_score": score,
    }
    customer = "customer_unique_id"
    per_customer = facts.groupBy(*keys, customer).agg(
        *[e.alias(n) for n, e in additive.items()],
        *[F.sum(e).alias(f"_sum_{n}") for n, e in means.items()],
        *[F.count(e).alias(f"_n_{n}") for n, e in means.items()])
    total = {n: F.sum(n) for n in additive}
    return per_customer.groupBy(*keys).agg(
        *[total[n].alias(n) for n in ("total_pedidos", "pedidos_entregues", "pedidos_cancelados", "pedidos_em_andamento")],
        safe_ratio(total["pedidos_entregues"], total["total_pedidos"]).alias("taxa_entrega"),
        safe_ratio(total["pedidos_cancelados"], total["total_pedidos"]).alias("taxa_cancelamento"),
        F.count(customer).alias("clientes_unicos"),
        total["receita_total"].alias("receita_total"),
        safe_ratio(total["_freight"], total["receita_total"]).alias("share_frete"),
        safe_ratio(total["_card"], total["_paid"]).alias("pct_pagamento_cartao"),
        safe_ratio(total["_boleto"], total["_paid"]).alias("pct_pagamento_boleto"),
        safe_ratio(total["_on_time"], total["pedidos_entregues"]).alias("taxa_entrega_no_prazo"),
        safe_ratio(total["_positive"], total["_reviewed"]).alias("pct_avaliacao_positiva"),
        safe_ratio(total["_negative"], total["_reviewed"]).alias("pct_avaliacao_negativa"),
        safe_ratio(total["_reviewed"], total["pedidos_entregues"]).alias("pct_pedidos_com_review"),
        *[safe_ratio(F.sum(f"_sum_{n}"), F.sum(f"_n_{n}")).alias(n) for n in means],
    ).select(*keys, *[n for n in KPI_COLUMNS if n != "vendedores_no_municipio"])


# Indicator, additive and census columns of the marts.
KPI_COLUMNS = [
    "total_pedidos", "pedidos_entregues", "pedidos_cancelados", "pedidos_em_andamento", "taxa_entrega",
    "taxa_cancelamento", "clientes_unicos", "vendedores_no_municipio", "receita_total", "ticket_medio",
    "frete_medio", "share_frete", "pct_pagamento_cartao", "pct_pagamento_boleto", "avg_parcelas_cartao",
    "avg_dias_entrega", "avg_dias_aprovacao", "taxa_entrega_no_prazo", "avg_review_score",
    "pct_avaliacao_positiva", "pct_avaliacao_negativa", "pct_pedidos_com_review",
]


def mart_olist(fact_orders: DataFrame, geolocation: DataFrame, municipios: DataFrame,
               dim_sellers: DataFrame, since: str = SINCE, geocoded: Observation | None = None) -> DataFrame:
    """P25: order indicators per municipality x year.

    Orders are geocoded zip -> (city slug, state) -> municipality (E5): the two
    lookups, one row per zip and per municipality, meet first, and the orders
    join the result once, salted, so that a zip with a third of the orders is
    divided; unmatched orders drop (T14).  The time filter is a range on the
    timestamp, so it reaches the scan.  ``geocoded`` gets the orders in scope
    (``total``) and those with a municipality (``matched``) from the job that
    writes the mart.
    """
    m = municipios.select("id_municipio", "nome_municipio", "nome_municipio_slug", "uf_sigla", "macroregiao_nome")
    g = geolocation.select("geolocation_zip_code_prefix", "geolocation_city_slug", "geolocation_state")
    ts_type = fact_orders.schema["order_purchase_timestamp"].dataType
    facts = fact_orders.filter(F.col("order_purchase_timestamp") >= F.lit(since).cast(ts_type))
    of_zip = g.join(m, (g["geolocation_city_slug"] == m["nome_municipio_slug"]) & (F.upper(g["geolocation_state"]) == m["uf_sigla"]), "inner") \
        .select(F.col("geolocation_zip_code_prefix").alias("customer_zip_code_prefix"), *PLACE_KEYS)
    if geocoded is None:
        facts = salted_join(facts, of_zip, "customer_zip_code_prefix", "order_id")
    else:
        found = salted_join(facts, of_zip.withColumn("_found", F.lit(True)), "customer_zip_code_prefix", "order_id", "left")
        facts = found.observe(geocoded, F.count(F.lit(1)).alias("total"), F.count("_found").alias("matched")).filter("_found").drop("_found")
    agg = order_kpis(facts.withColumn("ano", F.year("order_purchase_timestamp")), [*PLACE_KEYS, "ano"])
    sellers = (
        computed_key_join(dim_sellers, m, "seller_city", "seller_state", "nome_municipio_slug", "uf_sigla")
        .groupBy("id_municipio").agg(F.count("seller_id").alias("vendedores_no_municipio"))
    )
    out = lookup_join(agg, sellers, "id_municipio", "left")
    return out.select(*PLACE_KEYS, "ano", *KPI_COLUMNS)


PIX_ADDITIVE = [
    "total_transacoes_pagador", "total_valor_pagador", "qt_pagador_pf", "total_transacoes_recebedor",
    "total_valor_recebedor", "vl_recebedor_pj", "qt_recebedor_pj",
]
CENSUS_COLUMNS = ["populacao_residente", "renda_media_per_capita", "renda_mediana_per_capita",
                  "pct_domicilios_com_internet"]


def pix_ratios(pop: str = "populacao_residente") -> list[Column]:
    """Ratios re-derived from additive totals."""
    return [
        per_capita("total_valor_pagador", pop).alias("valor_pix_per_capita"),
        per_capita("total_transacoes_pagador", pop).alias("transacoes_pix_per_capita"),
        safe_ratio("qt_pagador_pf", "total_transacoes_pagador").alias("pct_transacoes_pagador_pf"),
        safe_ratio("vl_recebedor_pj", "total_valor_recebedor").alias("pct_valor_recebedor_pj"),
        safe_ratio("qt_recebedor_pj", "total_transacoes_recebedor").alias("pct_transacoes_recebedor_pj"),
    ]


def mart_ibge_pix(pix_monthly: DataFrame, municipios: DataFrame) -> DataFrame:
    """Payment indicators per municipality x year."""
    yearly = pix_monthly.groupBy("municipio_ibge", F.year("ano_mes_data").alias("ano")).agg(
        F.count_distinct("ano_mes_data").alias("n_meses_pix"),
        F.sum("qt_total_transacoes_pagador").alias("total_transacoes_pagador"),
        F.sum("vl_total_pagador").alias("total_valor_pagador"),
        F.sum("qt_pagador_pf").alias("qt_pagador_pf"),
        F.sum("qt_total_transacoes_recebedor").alias("total_transacoes_recebedor"),
        F.sum("vl_total_recebedor").alias("total_valor_recebedor"),
        F.sum("vl_recebedor_pj").alias("vl_recebedor_pj"),
        F.sum("qt_recebedor_pj").alias("qt_recebedor_pj"),
    ).withColumnRenamed("municipio_ibge", "id_municipio")
    m = municipios.select(*PLACE_KEYS, *CENSUS_COLUMNS)
    out = lookup_join(yearly, m, "id_municipio", "inner")
    return out.select(
        *PLACE_KEYS, "ano", *CENSUS_COLUMNS,
        "total_transacoes_pagador", "total_valor_pagador", "qt_pagador_pf",
        per_capita("total_valor_pagador", "populacao_residente").alias("valor_pix_per_capita"),
        per_capita("total_transacoes_pagador", "populacao_residente").alias("transacoes_pix_per_capita"),
        safe_ratio("qt_pagador_pf", "total_transacoes_pagador").alias("pct_transacoes_pagador_pf"),
        "total_transacoes_recebedor", "total_valor_recebedor", "vl_recebedor_pj", "qt_recebedor_pj",
        safe_ratio("vl_recebedor_pj", "total_valor_recebedor").alias("pct_valor_recebedor_pj"),
        safe_ratio("qt_recebedor_pj", "total_transacoes_recebedor").alias("pct_transacoes_recebedor_pj"),
        "n_meses_pix",
    )


def pix_period(mart_pix: DataFrame) -> DataFrame:
    """Whole-period roll-up of the yearly payment mart."""
    return reaggregate(
        mart_pix, ["id_municipio"], additive=PIX_ADDITIVE,
        carried=["nome_municipio", "uf_sigla", "macroregiao_nome", *CENSUS_COLUMNS],
        distinct_counts={"anos_pix_disponiveis": "ano"},
    )


def mart_geo_analytics(mart_olist_df: DataFrame, mart_pix: DataFrame, year: int = PROFILE_YEAR,
                       strict_bands: bool = False) -> DataFrame:
    """One profile per municipality.

    The year filter is on a group key of ``mart_olist`` so Catalyst pushes it
    below that aggregation when both are planned together.
    """
    o = mart_olist_df.filter(F.col("ano") == F.lit(year)).drop("nome_municipio", "uf_sigla", "macroregiao_nome", "ano")
    p = pix_period(mart_pix)
    j = o.join(p, "id_municipio", "inner")
    pop = "populacao_residente"
    # Only the card share gets a default; the boleto share stays NULL.
    sel = [with_default(F.col(c), 0.0).alias(c) if c == "pct_pagamento_cartao" else F.col(c) for c in KPI_COLUMNS]
    return j.select(
        "id_municipio", "nome_municipio", "uf_sigla", "macroregiao_nome",
        *sel,
        *CENSUS_COLUMNS,
        "total_transacoes_pagador", "total_valor_pagador", "total_valor_recebedor",
        "total_transacoes_recebedor",
        *pix_ratios(pop),
        "anos_pix_disponiveis",
        per_capita("receita_total", pop).alias("receita_por_habitante"),
        per_capita("total_pedidos", pop).alias("pedidos_por_habitante"),
        per_capita("clientes_unicos", pop, 10000.0).alias("penetracao_olist"),
        population_band(pop, strict=strict_bands).alias("categoria_populacao"),
        presence_band("clientes_unicos", pop).alias("categoria_olist"),
    )
