"""Sort / limit / top-k (H1-H4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[str | Column], k: int, rank_col: str | None = "rank") -> DataFrame:
    """Global top-k (H1) with a 1..k position column (H4).

    ``orderBy().limit()`` plans a ``TakeOrderedAndProject``: each task keeps
    its k best rows and only k rows per task meet in the final step.
    """
    best = df.orderBy(*order).limit(k)
    if rank_col is None:
        return best
    # k rows only: a window without partition is harmless here.
    return best.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int, rank_col: str = "rank"
) -> DataFrame:
    """Top-k rows per group with their position (H1 for many targets).

    ``row_number() <= k`` gets a ``WindowGroupLimit`` on both sides of the
    shuffle, so each group ships at most k rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def newest(df: DataFrame, col: str, n: int) -> DataFrame:
    """Newest n rows by ``col`` (H3)."""
    return df.orderBy(F.desc(col)).limit(n)
