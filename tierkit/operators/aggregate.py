"""Gold aggregation and audit columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, keys, count_col: str, alias: str) -> DataFrame:
    """A3: ``COUNT(count_col)`` (non-NULL values) per key combination.

    NULL keys form their own group; a group of only-NULL values counts 0.
    Partial (map-side) + final hash aggregate: a hot key is pre-aggregated in
    every map task before the shuffle.
    """
    return df.groupBy(*keys).agg(F.count(F.col(count_col)).alias(alias))


def audit_columns(df: DataFrame, as_of: datetime | Column | None = None,
                  created: str = "created_at", updated: str = "updated_at") -> DataFrame:
    """Add creation/update times.

    Pass one ``as_of`` shared by every output of a run; the reference's
    ``CURRENT_TIMESTAMP()`` is re-evaluated per action, so its table and its CSV
    mirror disagree.  ``None`` -> ``current_timestamp()``.
    """
    if as_of is None:
        ts = F.current_timestamp()
    elif isinstance(as_of, Column):
        ts = as_of
    else:
        # as text: a naive time is read as wall time of the *session* zone (a
        # datetime literal would go through the Python process's zone); an
        # aware one keeps its offset
        text = as_of.isoformat(sep=" ") if as_of.tzinfo else as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
        ts = F.lit(text).cast("timestamp")
    return df.withColumn(created, ts).withColumn(updated, ts)


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """A4: number of rows as one row (partial counts per task, no column read)."""
    return df.agg(F.count(F.lit(1)).alias(alias))
