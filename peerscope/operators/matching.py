"""Peer matching by Mahalanobis distance.

Plan of one match
-----------------
1. complete cases of the feature columns (D6) and the minimum-size gate;
2. one distributed aggregation of the F(F+1)/2 sample covariances (F14);
3. on the driver, a F x F inverse and its Cholesky factor ``VI = L L^T``
   (constant size, independent of the data volume);
4. distances ``||L^T (x - t)||`` to the target vector ``t`` as plain column
   arithmetic with literals: no join, no Python per row, whole-stage codegen;
5. the 10th percentile of the other candidates' distances (F15) - exact,
   from a rank sketch and an exact count of what its bracket holds;
6. top-k by (distance, id) with ``TakeOrderedAndProject`` (H1), ratio to
   the p10 and a label (N5, N6).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from peerscope.functions.columns import similarity_label
from peerscope.operators.aggregates import covariance_matrix
from peerscope.operators.filters import complete_cases, require_min_rows
from peerscope.operators.setops import stack_with_role
from peerscope.operators.topk import top_k
from peerscope.session import checkpoint_dir
from peerscope.sources.publish import Folders

# The six matching features and the one expressed in percent.
FEATURES = (
    "populacao_residente",
    "renda_media_per_capita",
    "pct_domicilios_com_internet",
    "penetracao_olist",
    "ticket_medio",
    "transacoes_pix_per_capita",
)
PERCENT_FEATURES = ("pct_domicilios_com_internet",)
DEFAULT_K = 5
P10 = 0.10

# Fewer candidates than this give no match (the selection is too narrow).
MIN_CANDIDATES = 10


class SingularCovariance(ValueError):
    """The feature covariance cannot be inverted."""


class TargetUnavailable(LookupError):
    """The target is not among the complete cases."""


@dataclass
class MahalanobisMetric:
    features: tuple[str, ...]
    cov: np.ndarray
    inverse: np.ndarray
    chol: np.ndarray  # lower triangular, inverse = chol @ chol.T
    n: int

    def target_whitened(self, x: Sequence[float]) -> list[float]:
        return list(self.chol.T @ np.asarray(x, dtype=float))

    def distance_to(self, x: Sequence[float]) -> Column:
        """Distance of every row to the fixed vector ``x``."""
        t = self.target_whitened(x)
        k = len(self.features)
        sq = None
        for j in range(k):
            terms = [F.col(self.features[i]).cast("double") * F.lit(float(self.chol[i, j])) for i in range(j, k)]
            z = terms[0]
            for term in terms[1:]:
                z = z + term
            d = z - F.lit(float(t[j]))
            sq = d * d if sq is None else sq + d * d
        return F.sqrt(sq)


def feature_matrix(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Complete cases plus the feature vector as an array column."""
    return complete_cases(df, features).withColumn(
        "features", F.array(*[F.col(f).cast("double") for f in features])
    )


def fit_metric(df: DataFrame, features: Sequence[str] = FEATURES, ridge: float = 0.0,
               max_condition: float = 1e12, min_rows: int = 0) -> MahalanobisMetric:
    """Inverse sample covariance of the (already filtered) rows.

    The same aggregation counts the rows, which serves the minimum-size
    gate (D7) without another job.
    """
    from peerscope.operators.filters import NotEnoughRows

    cov, n = covariance_matrix(df, features)
    if n < min_rows:
        raise NotEnoughRows(f"need at least {min_rows} complete rows, got {n}")
    k = len(features)
    if n <= k:
        raise SingularCovariance(f"{n} complete rows for {k} features: covariance is singular")
    if not np.all(np.isfinite(cov)):
        raise SingularCovariance("covariance has undefined entries")
    cov_r = cov + ridge * np.eye(k)
    sd = np.sqrt(np.diag(cov_r))
    if np.any(sd <= 0):
        raise SingularCovariance("a feature is constant: covariance is singular")
    # Scale-free test: the correlation matrix, not the raw covariance, whose
    # conditioning mostly reflects the units of the features.
    if np.linalg.cond(cov_r / np.outer(sd, sd)) > max_condition:
        raise SingularCovariance("features are (numerically) collinear: covariance is singular")
    try:
        inv = np.linalg.inv(cov_r)
        inv = (inv + inv.T) / 2.0
        chol = np.linalg.cholesky(inv)
    except np.linalg.LinAlgError as e:  # pragma: no cover - cond check catches it first
        raise SingularCovariance(str(e)) from e
    return MahalanobisMetric(tuple(features), cov, inv, chol, n)


# ------------------------------------------------------------------ percentile
SKETCH_SIZE = 16_384  # values a sketch keeps at least: up to so many are found from it exactly
RANK_MARGIN = 0.002  # of all ranks; five times the error of a sketch of this size


def exact_percentile(df: DataFrame, col: str, p: float) -> float | None:
    """Linear-interpolated percentile of ``col`` (F15), exact, one distributed path for any size.

    Same definition as ``numpy.percentile``: position ``p * (n - 1)`` in the
    sorted non-NULL values, interpolated between its two neighbours; a NaN among
    the values makes it NaN.

    The first pass over ``df`` counts its values and sketches their ranks (KLL);
    the sketch brackets both neighbours between two values.  The second pass
    counts what lies below the bracket and writes aside what lies in it, less
    than half a percent of the values, in which both are then found in the same
    way.  No task holds or sorts the values, and only a few numbers reach the
    driver.
    """
    vals = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    n, nans, sketch = _sketch(vals)
    if not n:
        return None
    if nans:
        return math.nan
    pos = p * (n - 1)
    below = int(math.floor(pos))
    low, high = _at_rank(vals, below, min(below + 1, n - 1), n, sketch)
    return low if low == high else low + (high - low) * (pos - below)


def _sketch(vals: DataFrame) -> tuple[int, int, bytearray]:
    """One pass: number of values and of NaNs, and a sketch of their ranks (its size is fixed)."""
    return tuple(vals.agg(F.count("v"), F.count_if(F.isnan("v")), F.kll_sketch_agg_double("v", SKETCH_SIZE)).first())


def _quantiles(spark: SparkSession, sketch: bytearray, shares: Sequence[float]) -> list[float]:
    """Values of a sketch at shares of all ranks; no job, the one row is folded."""
    at = F.array(*[F.lit(min(1.0, max(0.0, float(s)))) for s in shares])
    return spark.sql("SELECT 1").select(F.kll_sketch_get_quantile_double(F.lit(bytes(sketch)), at)).first()[0]


def _at_rank(vals: DataFrame, first: int, last: int, n: int, sketch: bytearray) -> tuple[float, float]:
    """The values at two neighbouring 0-based ranks of the ``n`` values.

    Only what lies strictly between the bracket's ends is written aside, so
    values that are repeated any number of times do not keep it large.
    """
    spark, margin, v = vals.sparkSession, RANK_MARGIN, F.col("v")
    while n > SKETCH_SIZE:
        low, high = _quantiles(spark, sketch, [first / n - margin, last / n + margin])
        low = -math.inf if first <= margin * n else low
        high = math.inf if last >= n - 1 - margin * n else high
        path = f"{checkpoint_dir(spark)}/percentile-{uuid.uuid4().hex}"
        inside = (v > low) & (v < high)
        counts = Observation(f"percentile_{uuid.uuid4().hex}")
        vals.observe(counts, F.count_if(v < low).alias("under"), F.count_if(v == low).alias("low"), F.count_if(inside).alias("inside"),
                     F.count_if(v == high).alias("high")).filter(inside).write.parquet(path)
        starts = counts.get["under"] + counts.get["low"]
        ends = starts + counts.get["inside"]
        try:
            if counts.get["under"] <= first and last < ends + (counts.get["high"] if high > low else 0):
                if last < starts:
                    return low, low
                if first >= ends:
                    return high, high
                a, b = max(first, starts) - starts, min(last, ends - 1) - starts
                found = (high, high)
                if ends > starts:
                    bracket = spark.read.schema("v double").parquet(path)
                    found = _at_rank(bracket, a, b, ends - starts, _sketch(bracket)[2])
                return low if first < starts else found[0], high if last >= ends else found[1]
        finally:
            Folders(spark).delete(path)
        margin *= 4  # the sketch was further off than it should be
    found = _quantiles(spark, sketch, [(first + 0.5) / n, (last + 0.5) / n])  # it holds every value
    return found[0], found[1]


# -------------------------------------------------------------------- matching
@dataclass
class MatchResult:
    matches: DataFrame  # rank, id, ..., distancia, ratio, label
    target: DataFrame   # the target row (features)
    metric: MahalanobisMetric
    p10: float | None


def match_one(
    df: DataFrame,
    target_id,
    id_col: str,
    features: Sequence[str] = FEATURES,
    k: int = DEFAULT_K,
    keep: Sequence[str] = (),
    metric: MahalanobisMetric | None = None,
    min_rows: int = MIN_CANDIDATES,
) -> MatchResult:
    """Top-k peers of one target.

    The minimum-size gate counts complete cases (the rows the metric is
    fitted on), not the filtered rows before ``dropna`` (T6).
    """
    cand = complete_cases(df, features)
    if metric is None:
        metric = fit_metric(cand, features, min_rows=min_rows)
    elif min_rows:
        require_min_rows(cand, min_rows)
    cols = [id_col, *[c for c in keep if c != id_col], *features]
    trow = cand.filter(F.col(id_col) == F.lit(target_id)).select(*cols).limit(2).collect()
    if not trow:
        raise TargetUnavailable(f"{target_id!r} is not among the complete cases")
    x = [float(trow[0][f]) for f in features]
    scored = cand.select(*cols).withColumn("distancia", metric.distance_to(x))
    others = scored.filter(F.col(id_col) != F.lit(target_id))
    p10 = exact_percentile(others, "distancia", P10)
    best = top_k(others, [F.asc("distancia"), F.asc(id_col)], k, rank_col="rank")
    ratio = F.try_divide(F.col("distancia"), F.lit(p10).cast("double"))
    matches = best.withColumn("ratio", ratio).withColumn("label", similarity_label(F.col("ratio")))
    target = cand.filter(F.col(id_col) == F.lit(target_id)).select(*cols)
    return MatchResult(matches, target, metric, p10)


def unavailable_targets(requested: DataFrame, candidates: DataFrame, id_col: str,
                        features: Sequence[str] = FEATURES) -> DataFrame:
    """Requested ids that are not complete cases."""
    ok = complete_cases(candidates, features).select(id_col)
    return requested.join(ok, id_col, "left_anti")


def comparison_long(result: MatchResult, id_col: str, features: Sequence[str] = FEATURES,
                    percent_features: Sequence[str] = PERCENT_FEATURES, keep: Sequence[str] = ()) -> DataFrame:
    """Target and matches, one row per (place, feature).

    Percent features are shown x100.
    """
    base = [id_col, *keep]
    t = result.target.select(*base, *features)
    m = result.matches.select(*base, *features, "rank")
    both = stack_with_role(t.withColumn("rank", F.lit(0)), m)
    scaled = both.select(
        *base, "rank", "role",
        *[(F.col(f).cast("double") * F.lit(100.0)).alias(f) if f in percent_features
          else F.col(f).cast("double").alias(f) for f in features],
    )
    return scaled.unpivot([*base, "rank", "role"], list(features), "feature", "value")


def result_table(result: MatchResult, id_col: str, name_col: str, state_col: str) -> DataFrame:
    """Rank, name, state, label and distance of each match."""
    return result.matches.select(
        "rank", id_col, name_col, state_col, "label", F.round("distancia", 4).alias("distancia"),
        F.round("ratio", 4).alias("ratio"),
    ).orderBy("rank")
