"""Incremental-snapshot operators: F1, A1, A2, J1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.control import fresh_name
from tierkit.functions.stamps import EPOCH_STAMP


def newer_than(df: DataFrame, stamp_col: str, watermark: str | None) -> DataFrame:
    """rows strictly newer than the watermark (string order = time order).

    The watermark is a literal, so on a stamp taken from a partition directory
    or ``_metadata.file_name`` Spark prunes whole files before reading them.
    """
    return df.where(F.col(stamp_col) > F.lit(watermark or EPOCH_STAMP))


def max_stamp(df: DataFrame, stamp_col: str, alias: str = "max_stamp",
              since: str | None = None) -> DataFrame:
    """A1/A2: one-row ``MAX(stamp)``, optionally over rows newer than ``since``.

    NULL when nothing qualifies.  Partial + final aggregate, no skew exposure.
    """
    src = df if since is None else newer_than(df, stamp_col, since)
    return src.agg(F.max(stamp_col).alias(alias))


def latest_snapshot(df: DataFrame, stamp_col: str, since: str | None = None) -> DataFrame:
    """All rows of the newest snapshot strictly newer than ``since``.

    Relational form: inner join with the one-row ``MAX``.  The right side is a
    global aggregate - exactly one row - so broadcasting it has a proven size
    bound.  Nothing newer (``MAX`` NULL) -> zero rows.
    """
    latest = fresh_name(df.columns, "__latest")
    mx = max_stamp(df, stamp_col, latest, since)
    return (df.join(F.broadcast(mx), F.col(stamp_col) == F.col(latest), "inner")
            .drop(latest))
