"""Filters and gates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL_VALUES = "Todos"  # fixed value: the "select all" facet entry


class NotEnoughRows(ValueError):
    """Raised by ``require_min_rows``."""


def facet_filter(df: DataFrame, selections: Mapping[str, Iterable[str]], all_token: str = ALL_VALUES) -> DataFrame:
    """AND of ``isin`` facets (D4).  An empty selection or one holding the
    all-token is no filter.  ``isin`` is pushed to the Parquet scan."""
    out = df
    for col, values in selections.items():
        vals = list(values or [])
        if not vals or all_token in vals:
            continue
        out = out.filter(F.col(col).isin(vals))
    return out


def facet_options(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-NULL values of a facet column."""
    return df.select(col).dropna().distinct().orderBy(col)


def selection_options(df: DataFrame, id_col: str, name_col: str, state_col: str) -> DataFrame:
    """Sorted "name - state" labels with their ids, for choosing a target."""
    from peerscope.functions.columns import display_label

    return (df.select(display_label(name_col, state_col).alias("label"), F.col(id_col))
            .dropDuplicates(["label", id_col]).orderBy("label", id_col))


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where every one of ``cols`` is set."""
    return df.dropna(subset=list(cols))


def require_min_rows(df: DataFrame, n: int) -> int:
    """Gate (D7): raise when ``df`` has fewer than ``n`` rows.

    Counts at most ``n`` rows (``limit``), so the gate is cheap on big input.
    """
    got = df.limit(n).count()
    if got < n:
        raise NotEnoughRows(f"need at least {n} rows, got {got}")
    return got


def exclude_self(df: DataFrame, id_col: str, target) -> DataFrame:
    """Drop the target itself."""
    return df.filter(F.col(id_col) != F.lit(target))
