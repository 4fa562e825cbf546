"""Commit rows of the landings: which snapshots are whole, found without listing bronze.

A landing appends one file of rows (stamp, folder, rows) to ``<root>/_commits``; a stream reads that folder.
``compact_commits`` moves rows of files older than ``keep_s`` into ``<root>/_commits_kept``, a versioned dataset that no
stream reads: ``rows/`` partitioned by month and ``newest/``, one row.  So a run reads the recent files, that one row
and, to look a stamp up, the stamp's month: its work doesn't grow with the history.

Readers list ``_commits`` before they look for the kept rows, and files go after the kept rows are committed: rows may
be seen twice on the way, never not at all.  A stream that is further behind than ``keep_s`` takes the newest
snapshot from the kept rows at its first batch (``newest_commit``).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkit.control import age_s, append_file, remove, row_files, rows_of
from tierkit.sinks.versions import current_commit, current_path, replace_dataset

COMMIT_SCHEMA = "stamp string, folder string, rows long"
KEEP_S = 7 * 24 * 3600  # a stream may be that far behind


class Landing(NamedTuple):
    stamp: str
    folder: str


def commits_path(root: str) -> str:
    return f"{root.rstrip('/')}/_commits"


def kept_path(root: str) -> str:
    return f"{root.rstrip('/')}/_commits_kept"


def append_commits(rows: DataFrame, root: str) -> None:
    """Commit landings: one file of ``COMMIT_SCHEMA`` rows."""
    append_file(rows.select("stamp", "folder", "rows"), commits_path(root))


def _recent(spark: SparkSession, root: str) -> DataFrame | None:
    return rows_of(spark, commits_path(root), COMMIT_SCHEMA)


def _kept(spark: SparkSession, root: str, part: str, schema: str) -> DataFrame | None:
    if current_commit(spark, kept_path(root)) is None:
        return None
    return rows_of(spark, f"{current_path(spark, kept_path(root))}/{part}", schema)


def newest_commit(spark: SparkSession, root: str) -> Landing | None:
    """The newest committed landing, from the recent files and the kept rows' newest."""
    recent = _recent(spark, root)  # listed first
    parts = [d for d in (recent, _kept(spark, root, "newest", COMMIT_SCHEMA)) if d is not None]
    tops = [d.agg(F.max(F.struct("stamp", "folder")).alias("m")).first()["m"] for d in parts]
    return max((Landing(t["stamp"], t["folder"]) for t in tops if t is not None), default=None)


def committed_among(spark: SparkSession, root: str, stamps: list[str]) -> list[str]:
    """Those of the ``stamps`` (of one landing) that are committed; reads the recent files and the stamps' months."""
    recent = _recent(spark, root)
    kept = _kept(spark, root, "rows", COMMIT_SCHEMA + ", month string")
    found = []
    if recent is not None:
        found.append(recent.where(F.col("stamp").isin(stamps)).select("stamp"))
    if kept is not None:
        found.append(kept.where(F.col("month").isin(sorted({s[:6] for s in stamps})) & F.col("stamp").isin(stamps)).select("stamp"))
    return sorted({r["stamp"] for d in found for r in d.collect()})


def compact_commits(spark: SparkSession, root: str, max_files: int = 64, keep_s: float = KEEP_S) -> bool:
    """Move commit rows of files older than ``keep_s`` to the kept rows once there are over ``max_files`` of them.

    Two at once: the second raises, and nothing of the first is lost.  Returns whether it compacted.
    """
    old = [st for st in row_files(spark, commits_path(root)) if age_s(st) >= keep_s]
    if len(old) <= max_files:
        return False
    rows = spark.read.schema(COMMIT_SCHEMA).parquet(*[st.getPath().toString() for st in old])
    kept = _kept(spark, root, "rows", COMMIT_SCHEMA + ", month string")
    rows = (rows if kept is None else rows.unionByName(kept.select(rows.columns))).distinct()

    def write(folder: str) -> None:
        months = rows.withColumn("month", F.substring("stamp", 1, 6))
        months.hint("rebalance", "month").write.partitionBy("month").parquet(f"{folder}/rows")
        # the newest from what was written
        back = spark.read.schema(COMMIT_SCHEMA + ", month string").parquet(f"{folder}/rows")
        back.agg(F.max(F.struct("stamp", "folder", "rows")).alias("m")).select("m.*").coalesce(1).write.parquet(f"{folder}/newest")

    replace_dataset(spark, kept_path(root), write)
    remove(spark, commits_path(root), old)
    return True
