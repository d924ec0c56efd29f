"""Descriptions of the marts' columns, stored as column comments in the catalog (Q4)."""

from __future__ import annotations

DESCRIPTIONS = {
    "id_municipio": "Municipality code of seven digits; key.",
    "nome_municipio": "Official name of the municipality.",
    "uf_sigla": "Abbreviation of the state.",
    "macroregiao_nome": "Name of the macro-region.",
    "ano": "Calendar year of the row.",
    "total_pedidos": "Orders of any status.",
    "pedidos_entregues": "Orders that were delivered.",
    "pedidos_cancelados": "Orders that were cancelled or unavailable.",
    "pedidos_em_andamento": "Orders still on their way.",
    "taxa_entrega": "Delivered orders per order.",
    "taxa_cancelamento": "Cancelled orders per order.",
    "clientes_unicos": "Distinct customers who ordered.",
    "vendedores_no_municipio": "Sellers based in the municipality, of any time.",
    "receita_total": "Revenue of delivered orders, R$.",
    "ticket_medio": "Mean revenue of a delivered order, R$.",
    "frete_medio": "Mean freight of a delivered order, R$.",
    "share_frete": "Freight per revenue of delivered orders.",
    "pct_pagamento_cartao": "Share of the amount paid by credit card; 0 in the profile where no amount is known.",
    "pct_pagamento_boleto": "Share of the amount paid by bank slip.",
    "avg_parcelas_cartao": "Mean number of instalments of delivered orders paid by card.",
    "avg_dias_entrega": "Mean days from purchase to delivery.",
    "avg_dias_aprovacao": "Mean days from purchase to approval.",
    "taxa_entrega_no_prazo": "Orders delivered by the estimated date per delivered order.",
    "avg_review_score": "Mean review score, 1 to 5.",
    "pct_avaliacao_positiva": "Share of reviews of 4 or 5.",
    "pct_avaliacao_negativa": "Share of reviews of 1 or 2.",
    "pct_pedidos_com_review": "Reviewed orders per delivered order.",
    "populacao_residente": "Resident population by the census.",
    "renda_media_per_capita": "Mean monthly household income per head by the census, R$.",
    "renda_mediana_per_capita": "Median monthly household income per head by the census, R$.",
    "pct_domicilios_com_internet": "Share of households with internet by the census, 0 to 1.",
    "total_transacoes_pagador": "Instant payments sent.",
    "total_valor_pagador": "Amount of instant payments sent, R$.",
    "qt_pagador_pf": "Instant payments sent by persons.",
    "valor_pix_per_capita": "Amount sent per inhabitant.",
    "transacoes_pix_per_capita": "Payments sent per inhabitant.",
    "pct_transacoes_pagador_pf": "Share of payments sent by persons.",
    "total_transacoes_recebedor": "Instant payments received.",
    "total_valor_recebedor": "Amount of instant payments received, R$.",
    "vl_recebedor_pj": "Amount received by companies, R$.",
    "qt_recebedor_pj": "Instant payments received by companies.",
    "pct_valor_recebedor_pj": "Share of the amount received by companies.",
    "pct_transacoes_recebedor_pj": "Share of payments received by companies.",
    "n_meses_pix": "Months of the year with payment data.",
    "anos_pix_disponiveis": "Years with payment data.",
    "receita_por_habitante": "Revenue of the year per inhabitant.",
    "pedidos_por_habitante": "Orders of the year per inhabitant.",
    "penetracao_olist": "Distinct customers per 10,000 inhabitants.",
    "categoria_populacao": "Size band by resident population.",
    "categoria_olist": "Presence band by customers per 10,000 inhabitants.",
}
