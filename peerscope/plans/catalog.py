"""Registry of the benchmark-table queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from peerscope.plans import benchmark_tables as B
from peerscope.plans import families as M
from peerscope.plans import ingest_queries as K
from peerscope.plans import matching_queries as X
from peerscope.plans import model_queries as Q
from peerscope.plans import model_sql
from peerscope.plans import oracle_sql as S
from peerscope.plans import source_queries as R

QueryFn = Callable[[SparkSession, str], DataFrame]

# name -> (Spark query, SQL oracle or None for a rows-only check)
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {
    "kpi_by_place_year": (B.kpi_by_place_year, S.KPI_BY_PLACE_YEAR),
    "fact_orders": (B.fact_orders_query, S.FACT_ORDERS),
    "payments_pivot": (M.payments_pivot, S.PAYMENTS_PIVOT),
    "items_agg_dominant_type": (M.items_agg_dominant_type, S.ITEMS_AGG_DOMINANT_TYPE),
    "latest_per_key": (M.latest_per_key_query, S.LATEST_PER_KEY),
    "row_hash_dedup": (M.row_hash_dedup, S.ROW_HASH_DEDUP),
    "latest_snapshot": (M.latest_snapshot_query, S.LATEST_SNAPSHOT),
    "place_slug": (M.place_slug, S.PLACE_SLUG),
    "slug_state_join": (M.slug_state_join, S.SLUG_STATE_JOIN),
    "customer_mode_dim": (M.customer_mode_dim, S.CUSTOMER_MODE_DIM),
    "place_centroid": (M.place_centroid, S.PLACE_CENTROID),
    "long_to_wide": (M.long_to_wide_query, S.LONG_TO_WIDE),
    "monthly_panel": (M.monthly_panel, S.MONTHLY_PANEL),
    "yearly_panel": (M.yearly_panel, S.YEARLY_PANEL),
    "period_panel": (M.period_panel, S.PERIOD_PANEL),
    "safe_casts": (M.safe_casts, S.SAFE_CASTS),
    "date_parts": (M.date_parts, S.DATE_PARTS),
    "ratios": (M.ratios, S.RATIOS),
    "composite_key": (M.composite_key, S.COMPOSITE_KEY),
    "json_props": (M.json_props, S.JSON_PROPS),
    "facet_filter": (M.facet_filter_query, S.FACET_FILTER),
    "facet_options": (M.facet_options_query, S.FACET_OPTIONS),
    "usage_rollup": (M.usage_rollup, S.USAGE_ROLLUP),
    "dq_not_null": (M.dq_not_null, S.DQ_NOT_NULL),
    "dq_unique": (M.dq_unique, S.DQ_UNIQUE),
    "dq_unique_combo": (M.dq_unique_combo, S.DQ_UNIQUE_COMBO),
    "dq_accepted": (M.dq_accepted, S.DQ_ACCEPTED),
    "dq_relationships": (M.dq_relationships, S.DQ_RELATIONSHIPS),
    "dq_expression": (M.dq_expression, S.DQ_EXPRESSION),
    "dq_volume": (M.dq_volume, S.DQ_VOLUME),
    "dq_suite": (M.dq_suite, S.DQ_SUITE),
    "incremental_append": (M.incremental_append, S.INCREMENTAL_APPEND),
    "freshness": (M.freshness_query, S.FRESHNESS),
    "common_schema": (M.common_schema, S.COMMON_SCHEMA),
    "place_profile": (B.place_profile, S.PLACE_PROFILE),
    "feature_covariance": (X.feature_covariance, S.FEATURE_COVARIANCE),
    "match_two_features_topk": (X.match_two_features_topk, S.MATCH_TWO_FEATURES_TOPK),
    "match_place_six": (X.match_place_six, S.MATCH_PLACE_SIX),
    "match_comparison_long": (X.match_comparison_long, S.MATCH_COMPARISON_LONG),
    "file_stream_ingest": (K.file_stream_ingest, S.FILE_STREAM_INGEST),
    "staged_publish": (K.staged_publish, S.STAGED_PUBLISH),
    "gated_refresh": (K.gated_refresh, S.GATED_REFRESH),
    "stream_corrections": (K.stream_corrections, S.STREAM_CORRECTIONS),
    "staging_orders": (M.staging_orders, S.STAGING_ORDERS),
    "staging_customers": (M.staging_customers, S.STAGING_CUSTOMERS),
    "place_labels": (M.place_labels, S.PLACE_LABELS),
    **{name: (query, getattr(S, name.upper())) for name, query in R.QUERIES.items()},
    **{name: (query, model_sql.ORACLE_SQL[name]) for name, query in Q.QUERIES.items()},
}


def queries() -> dict[str, QueryFn]:
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql is not None}
