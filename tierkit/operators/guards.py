"""Small inspection helpers kept off the hot path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def is_empty(df: DataFrame) -> bool:
    """stops at the first row found (``count() == 0`` reads everything)."""
    return df.isEmpty()


def filter_eq(df: DataFrame, col: str, value, select=None) -> DataFrame:
    """F3 + P4: equality filter with a bound literal (pushed to the scan)."""
    out = df.where(F.col(col) == F.lit(value))
    return out.select(*select) if select else out


def preview(df: DataFrame, n: int = 5, order=None) -> DataFrame:
    """L3: first ``n`` rows; give ``order`` to make it repeatable (top-k)."""
    return (df.orderBy(*order) if order else df).limit(n)
