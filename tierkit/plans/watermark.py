"""The per-layer watermark as a small control dataset.

Each commit *appends* one row ``(stamp, written_at)``; the watermark is the
largest stamp.  Failures raise - the reference returns ``False`` and carries on.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tierkit.functions.stamps import default_stamp
from tierkit.control import append_rows, replace_rows, row_files, rows_of
from tierkit.sinks.versions import current_commit

WATERMARK_SCHEMA = "stamp string, written_at timestamp"


def _row(stamp: str) -> tuple:
    if not stamp or not str(stamp).strip():
        raise ValueError("refusing to commit a blank watermark")
    return str(stamp).strip(), datetime.now(timezone.utc).replace(tzinfo=None)


def read_watermark(spark: SparkSession, path: str) -> str | None:
    """Largest committed stamp, or ``None`` when nothing was ever written."""
    df = rows_of(spark, path, WATERMARK_SCHEMA)
    return None if df is None else df.agg(F.max(F.trim("stamp")).alias("m")).first()["m"]


def effective_watermark(spark: SparkSession, path: str) -> str:
    """Stored stamp, or the epoch stamp when absent or blank."""
    return default_stamp(read_watermark(spark, path))


def published_watermark(spark: SparkSession, path: str, table_path: str) -> str | None:
    """The stamp that the table at ``table_path`` was published of, by its commit and the watermark's rows.

    The commit of a table carries its stamp (``sinks.versions``).  A run that crashed after it, before its
    watermark row, is finished here: the row is written.  A row written after the commit rules, so a watermark that was
    moved back on purpose stays there.
    """
    df, commit = rows_of(spark, path, WATERMARK_SCHEMA), current_commit(spark, table_path)
    row = df.agg(F.max(F.trim("stamp")).alias("m"), F.max("written_at").alias("at")).first() if df is not None else None
    stored = row["m"] if row else None
    if commit is None or not commit.stamp:
        return stored
    at = datetime.fromtimestamp(commit.at_micros / 1_000_000, timezone.utc).replace(tzinfo=None)
    if (row and row["at"] and row["at"] >= at) or (stored or "") >= commit.stamp:
        return stored
    write_watermark(spark, path, commit.stamp)
    return commit.stamp


def write_watermark(spark: SparkSession, path: str, stamp: str) -> None:
    """K7: commit ``stamp`` (one row, one file)."""
    append_rows(spark, path, WATERMARK_SCHEMA, [_row(stamp)])


def reset_watermark(spark: SparkSession, path: str, stamp: str) -> None:
    """Move the watermark anywhere, also backwards (forces a re-run).

    A crash on the way leaves the larger of the old and the new stamp.
    """
    replace_rows(spark, path, WATERMARK_SCHEMA, [_row(stamp)])


def compact_watermark(spark: SparkSession, path: str, max_files: int = 64) -> bool:
    """Bring the dataset to one row once it holds over ``max_files`` commit files.

    The row of the largest stamp is appended before the older files go, so the
    watermark is the same at any moment.  Returns whether it compacted.
    """
    if len(row_files(spark, path)) <= max_files:
        return False
    replace_rows(spark, path, WATERMARK_SCHEMA, [_row(read_watermark(spark, path))])
    return True
