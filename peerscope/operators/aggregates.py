"""Aggregation building blocks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.functions.columns import col_of, mean_of


def mode_of(c: str | Column) -> Column:
    """Most frequent non-NULL value of a group; ties -> smallest.

    Suitable when groups are many and small (e.g. per order): the per-group
    state is a tiny value -> count map.
    """
    return F.mode(col_of(c), deterministic=True)


def mode_by_group(
    df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None
) -> DataFrame:
    """Two-phase mode (F6): most frequent non-NULL value per key, ties -> smallest.

    Phase 1 counts (key, value) pairs in a hash aggregation with map-side
    combine, so a key holding a third of all rows is reduced inside each
    map task before anything is shuffled.  Phase 2 keeps, per key, the
    value with the highest count (``min_by`` over ``(-count, value)``).
    The result is an aggregate on ``keys``: when a caller joins it on those
    keys and never reads the mode, Catalyst can drop the whole branch.
    """
    alias = alias or value
    counted = (df.filter(F.col(value).isNotNull())
               .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    best = F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
    return counted.groupBy(*keys).agg(best.alias(alias))


def modes_by_group(df: DataFrame, keys: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """Several two-phase modes on the same keys: one row per key of ``df``.

    The distinct keys are the base, so a key whose values are all NULL keeps
    its row with NULL modes (as ``GROUP BY`` with a mode aggregate would).
    """
    out = df.select(*keys).distinct()
    for value, alias in values.items():
        out = out.join(mode_by_group(df, keys, value, alias), list(keys), "left")
    return out


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Exact ``count(distinct c)`` per key for several columns.

    Kept in its own narrow aggregation: Spark evaluates several distinct
    aggregates through an ``Expand`` that copies every input row once per
    distinct column, and in a wide aggregate it also copies every other
    aggregate buffer.  Here only the key and the counted columns are
    expanded; the partial aggregation before the shuffle still dedups
    (key, value) pairs map-side, so a hot key is reduced before the shuffle.
    """
    return df.groupBy(*keys).agg(*[F.count_distinct(c).alias(a) for a, c in columns.items()])


def pivot_agg(
    cat: str | Column,
    value: str | Column,
    categories: Sequence[str],
    agg: str = "sum",
    name_fmt: str = "{}_value",
) -> list[Column]:
    """Conditional aggregates per category.

    ``sum(if(cat = c, value, NULL))``: an absent category gives NULL.  The
    category list is explicit, so no extra pass discovers the values.
    """
    fn = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg}[agg]
    c, v = col_of(cat), col_of(value)
    return [fn(F.when(c == F.lit(k), v)).alias(name_fmt.format(k)) for k in categories]


def long_to_wide(
    df: DataFrame, keys: Sequence[str], var_col: str, value_col: str,
    variables: Mapping[str, str], agg: str = "max",
) -> DataFrame:
    """Long -> wide by variable code (F5): ``max(case when var = code then value end)``."""
    fn = {"sum": F.sum, "max": F.max, "min": F.min}[agg]
    return df.groupBy(*keys).agg(
        *[fn(F.when(F.col(var_col) == F.lit(code), F.col(value_col))).alias(out) for code, out in variables.items()]
    )


def centroid(df: DataFrame, key: str | Sequence[str], coords: Mapping[str, str], exact: bool = False) -> DataFrame:
    """Mean coordinates per key (F7).  ``exact`` averages as decimal sum / count."""
    keys = [key] if isinstance(key, str) else list(key)
    agg = mean_of if exact else (lambda c: F.avg(col_of(c)))
    return df.groupBy(*keys).agg(*[agg(src).alias(out) for out, src in coords.items()])


def reaggregate(
    df: DataFrame,
    keys: Sequence[str],
    additive: Sequence[str] = (),
    carried: Sequence[str] = (),
    distinct_counts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Roll an aggregate up one level.

    Only additive columns are summed; attributes that depend on the key
    are carried with ``max`` (deterministic, F12); period coverage is a
    distinct count (F13).  Ratios must be re-derived afterwards from the
    re-aggregated totals, never averaged.
    """
    aggs = [F.sum(c).alias(c) for c in additive]
    aggs += [F.max(c).alias(c) for c in carried]
    aggs += [F.count_distinct(src).alias(out) for out, src in (distinct_counts or {}).items()]
    return df.groupBy(*keys).agg(*aggs)


def covariance_terms(features: Sequence[str]) -> list[Column]:
    """The F(F+1)/2 sample covariances of the feature columns."""
    out = []
    for i, a in enumerate(features):
        for b in features[i:]:
            out.append(F.covar_samp(a, b).alias(f"cov__{a}__{b}"))
    return out


def covariance_matrix(df: DataFrame, features: Sequence[str]):
    """Sample covariance matrix (ddof = 1) as a numpy array.

    One distributed aggregation; only F(F+1)/2 numbers reach the driver.
    """
    import numpy as np

    row = df.agg(*covariance_terms(features), F.count(F.lit(1)).alias("_n")).first()
    k = len(features)
    m = np.empty((k, k), dtype=float)
    for i, a in enumerate(features):
        for j in range(i, k):
            v = row[f"cov__{a}__{features[j]}"]
            m[i, j] = m[j, i] = float("nan") if v is None else v
    return m, int(row["_n"])


# The jobs that count in the usage report.
COUNTED_JOB_TYPE = "QUERY"
COUNTED_STATE = "DONE"


def daily_rollup(
    df: DataFrame, ts_col: str, bytes_col: str, since: Column | str,
    price_per_tib: float = 6.25, top_n: int = 15, type_col: str | None = "job_type", state_col: str | None = "state",
) -> DataFrame:
    """Daily usage rollup (F16 / H3): finished queries, their billed GB and cost per day.

    Newest ``top_n`` days; the limit is the report itself.  ``type_col`` /
    ``state_col`` name the columns of the job filter, None leaves it out.
    """
    since_c = F.lit(since).cast(df.schema[ts_col].dataType) if isinstance(since, str) else since
    cond = F.col(ts_col) >= since_c
    if type_col:
        cond = cond & (F.col(type_col) == COUNTED_JOB_TYPE)
    if state_col:
        cond = cond & (F.col(state_col) == COUNTED_STATE)
    billed = F.sum(bytes_col).cast("double")
    return (
        df.filter(cond)
        .groupBy(F.to_date(ts_col).alias("day"))
        .agg(
            F.count(F.lit(1)).alias("jobs"),
            F.round(billed / F.lit(1024.0 ** 4) * F.lit(price_per_tib), 4).alias("cost"),
            F.round(billed / F.lit(1024.0 ** 3), 2).alias("gb_billed"),
        )
        .orderBy(F.desc("day"))
        .limit(top_n)
    )


COMMON_SCHEMA = ("municipio_id", "ano_mes", "total_pedidos", "receita_total", "ticket_medio", "fonte")


def common_business_schema(sources: Mapping[str, tuple[DataFrame, DataFrame]], place: str = "municipio_id",
                           month: str = "ano_mes", order_key: str = "order_key", revenue: str = "revenue",
                           party: str = "party") -> DataFrame:
    """Q3: plug-in business sources on one monthly schema.

    Each source is its adapter's rows (party, month, order key, revenue) and a
    lookup party -> place.  The lookup comes first (broadcast when small; else
    both sides come straight from their shuffles, and AQE splits a hot party),
    then one aggregation makes one row per order and place (an order may have
    several parties), and another, on its counts, sums them up.
    """
    from functools import reduce

    parts = []
    for name, (rows, places) in sources.items():
        per_order = rows.join(places.select(party, place), party).groupBy(place, month, order_key).agg(F.sum(revenue).alias(revenue))
        parts.append(per_order.withColumn("fonte", F.lit(name)))
    both = reduce(lambda a, b: a.unionByName(b), parts)
    agg = both.groupBy(place, month, "fonte").agg(
        F.count(order_key).alias("total_pedidos"), F.sum(revenue).alias("receita_total"))
    ticket = agg["receita_total"].cast("double") / F.nullif(agg["total_pedidos"].cast("double"), F.lit(0.0))
    return agg.withColumn("ticket_medio", ticket).select(
        F.col(place).alias("municipio_id"), F.col(month).alias("ano_mes"), "total_pedidos", "receita_total",
        "ticket_medio", "fonte")
