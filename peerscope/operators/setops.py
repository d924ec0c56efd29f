"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_with_role(first: DataFrame, rest: DataFrame, first_role: str = "target", rest_role: str = "match",
                    role_col: str = "role") -> DataFrame:
    """One table holding the target and its matches."""
    a = first.withColumn(role_col, F.lit(first_role))
    b = rest.withColumn(role_col, F.lit(rest_role))
    return a.unionByName(b, allowMissingColumns=True)
