"""Matching queries over the place profiles.

The candidate set is one row per place.  It is derived from whole tables
(the profile aggregates every order, line and customer), then written once
to the checkpoint folder so that the few small jobs of a match (covariance,
target lookup, percentile, top-k) do not recompute the aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.operators.aggregates import covariance_terms
from peerscope.operators.filters import complete_cases
from peerscope.operators.matching import FEATURES, comparison_long, match_one
from peerscope.plans.benchmark_tables import place_profile_frame, tables, to_double
from peerscope.session import checkpoint_dir

# Target place: the caller's choice; by default the smallest place id among
# the complete cases (the first entry of the reference's selection list).
TARGET_PLACE = None
TWO_FEATURES = ("renda_media_per_capita", "ticket_medio")
KEEP = ("nome_municipio", "uf_sigla")


def candidates(spark: SparkSession, sf_dir: str, features=FEATURES) -> DataFrame:
    """Complete-case profiles, materialised in the shared checkpoint folder."""
    checkpoint_dir(spark)
    prof = to_double(place_profile_frame(tables(spark, sf_dir)))
    cand = complete_cases(prof.select("id_municipio", *KEEP, *features), features)
    return cand.checkpoint(eager=True)


def feature_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample covariances of the six features, long form.

    Each covariance is given as mantissa (9 decimals) x 10^exponent so the
    value is comparable whatever its magnitude.
    """
    prof = to_double(place_profile_frame(tables(spark, sf_dir)))
    cand = complete_cases(prof, FEATURES)
    row = cand.agg(*covariance_terms(FEATURES))
    pairs = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[i:]]
    stack = ", ".join(f"'{a}', '{b}', `cov__{a}__{b}`" for a, b in pairs)
    long = row.selectExpr(f"stack({len(pairs)}, {stack}) as (feature_a, feature_b, cov)")
    exp = F.when(F.col("cov") == 0, F.lit(0)).otherwise(F.floor(F.log10(F.abs("cov")))).cast("int")
    return long.select(
        "feature_a", "feature_b", exp.alias("cov_exponent"),
        F.round(F.col("cov") / F.pow(F.lit(10.0), exp.cast("double")), 9).alias("cov_mantissa"),
    )


def _match(spark, sf_dir, features, target=TARGET_PLACE):
    cand = candidates(spark, sf_dir, features)
    if target is None:
        target = cand.agg(F.min("id_municipio")).first()[0]
    return match_one(cand, target, "id_municipio", features, k=5, keep=KEEP), cand


def match_two_features_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N1-N6 / H1 / H4 / F15 with two features (closed-form SQL oracle)."""
    res, _ = _match(spark, sf_dir, TWO_FEATURES)
    return res.matches.select(
        "rank", "id_municipio", *KEEP,
        F.round("distancia", 6).alias("distancia"), F.round("ratio", 6).alias("ratio"), "label")


def match_place_six(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference match: six features, top 5 peers of one place."""
    res, _ = _match(spark, sf_dir, FEATURES)
    return res.matches.select(
        "rank", "id_municipio", *KEEP,
        F.round("distancia", 6).alias("distancia"), F.round("ratio", 6).alias("ratio"), "label")


def match_comparison_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and matches, one row per place and feature."""
    res, _ = _match(spark, sf_dir, FEATURES)
    return comparison_long(res, "id_municipio", FEATURES, keep=KEEP)
