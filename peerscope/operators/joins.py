"""Join building blocks.

All joins are equi-joins and none is hinted: a side under ``spark.sql.autoBroadcastJoinThreshold`` by its measured
size is broadcast by Spark, others are sort-merge joins.  AQE splits a skewed partition only where both sides come
straight from a shuffle of their own; where a side comes out of an aggregation or a window, or a further join would
have to be shuffled again for the split, the hot key is divided instead: by ``skew_join``, which finds the hot keys with a
heavy-hitter sketch and copies only their rows of the other side, or by ``salted_join``, which copies a small side whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.functions.columns import normalize_state, slug

# Tasks that share the rows of one key in a salted join.
SALTS = 8


def salted_join(big: DataFrame, small: DataFrame, on: str | Sequence[str], spread: str, how: str = "inner",
                salts: int = SALTS) -> DataFrame:
    """Equality join in which ``big``'s rows of one key go to ``salts`` tasks, by the hash of ``spread``.

    ``small`` is copied ``salts`` times, so it should be narrow or reduced.  ``how`` is inner or left.
    """
    keys = [on] if isinstance(on, str) else list(on)
    left = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


HEAVY_KEYS = 32  # keys a heavy-hitter sketch reports
TRACKED_KEYS = 4096  # keys it keeps counts of
HEAVY_SHARE = 1 / 128  # of all rows, from which on a key is divided


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> Column:
    """The keys with at least ``share`` of the rows as one array, a scalar subquery over the key column alone.

    A sketch of fixed size counts the frequent keys in one pass (its counts are
    off by less than rows / ``TRACKED_KEYS``, so every heavy key is found); the
    subquery runs with the query that uses it, not while the plan is built.
    """
    top = F.expr(f"approx_top_k(`{key}`, {HEAVY_KEYS}, {TRACKED_KEYS})")
    counts = df.select(key).agg(F.count(F.lit(1)).alias("n"), top.alias("top"))
    enough = F.greatest(F.lit(2), F.ceil(F.col("n") * share))
    return counts.select(F.transform(F.filter("top", lambda t: t["count"] >= enough), lambda t: t["item"])).scalar()


def skew_join(big: DataFrame, small: DataFrame, on: str, spread: str, how: str = "inner", salts: int = SALTS,
              keys_of: DataFrame | None = None, share: float = HEAVY_SHARE) -> DataFrame:
    """Equality join that divides only the heavy keys of ``big``, by the hash of ``spread``, over ``salts`` tasks.

    Of ``small`` only the rows of heavy keys are copied; all other rows join as
    in a plain join.  ``keys_of``: a cheaper frame with the same distribution of
    the key, if ``big`` is dear to compute.  ``how`` is inner or left.
    """
    heavy = heavy_keys(big if keys_of is None else keys_of, on, share)
    is_heavy = F.coalesce(F.array_contains(heavy, F.col(on)), F.lit(False))
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    left = big.withColumn("_salt", F.when(is_heavy, salt).otherwise(F.lit(0)))
    copies = F.when(is_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.withColumn("_salt", F.explode(copies))
    return left.join(right, [on, "_salt"], how).drop("_salt")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "left",
) -> DataFrame:
    """Fact-to-dimension join (E1 / E3); left keeps every fact row.

    The strategy is Spark's: a side whose estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold`` is broadcast at plan time, and
    AQE converts a shuffle join to a broadcast one at run time from the real
    size of the shuffled side.
    """
    return fact.join(dim, on, how)


def star_join(
    fact: DataFrame,
    children: Sequence[tuple[DataFrame, str | Sequence[str], str]],
) -> DataFrame:
    """Join pre-aggregated children to a fact.

    Each child must already be reduced to one row per join key (so there is
    no fan-out).  Because every child comes out of a ``groupBy`` on the join
    key, its hash partitioning already satisfies the join: only the fact
    side is shuffled, once, whatever the number of children.
    """
    out = fact
    for child, on, how in children:
        out = out.join(child, on, how)
    return out


def computed_key_join(
    left: DataFrame,
    right: DataFrame,
    left_city: str,
    left_state: str,
    right_slug: str,
    right_state: str,
    how: str = "inner",
) -> DataFrame:
    """Join on ``slug(city) = slug and upper(state) = state``.

    The keys are expressions; Spark still plans an equi-join on them.
    """
    cond = (slug(F.col(left_city)) == right[right_slug]) & (
        normalize_state(F.col(left_state)) == right[right_state]
    )
    return left.join(right, cond, how)


def geocode(
    facts: DataFrame,
    zips: DataFrame,
    places: DataFrame,
    fact_zip: str,
    zip_key: str,
    zip_city: str,
    zip_state: str,
    place_slug: str,
    place_state: str,
    how: str = "inner",
) -> DataFrame:
    """Two-hop geocode (E5): zip -> (city, state) -> place.

    With ``how="inner"`` (the models' choice) unmatched rows drop; run it
    with ``how="left"`` and ``coverage`` to measure how many.
    """
    z = zips.select(zip_key, zip_city, zip_state)
    hop1 = facts.join(z, facts[fact_zip] == z[zip_key], how)
    return computed_key_join(hop1, places, zip_city, zip_state, place_slug, place_state, how=how)


def coverage(left_geocoded: DataFrame, matched_key: str) -> DataFrame:
    """Share of rows a geocode matched (T14), as a one-row frame.

    ``left_geocoded`` is the same geocode run as a left join; one pass
    counts all rows and the rows with a matched key.
    """
    return left_geocoded.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.col(matched_key)).alias("matched"),
    ).withColumn("coverage", F.col("matched") / F.nullif(F.col("total").cast("double"), F.lit(0.0)))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key is absent from the parent.

    The parent is joined as it is (an anti join does not multiply rows), so
    AQE sees both shuffles and can split a hot child key.
    """
    keys = parent.select(F.col(parent_key or child_key).alias("_pk"))
    return child.filter(F.col(child_key).isNotNull()).join(keys, child[child_key] == keys["_pk"], "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Number of ``orphans`` as ``failures``: one row a key is joined, whatever the child's skew and width."""
    counts = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("_n"))
    return orphans(counts, parent, child_key, parent_key).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))
