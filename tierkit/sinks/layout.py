"""K5 + L4: rewrite a table clustered by columns.

Files are range-partitioned on the cluster columns and sorted inside, so each
file covers a narrow key range and readers skip files by their min/max
statistics.  A hash of the row is the last range key: a single hot key value
can then span several files instead of landing in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierkit.control import fresh_name
from tierkit.session import TARGET_SHUFFLE_INPUT_BYTES
from tierkit.sinks.files import overwrite_table

# A task sorts a whole range in memory, and files say little of that size: compressed columns take a tenth of the
# rows' bytes or less.  So ranges are counted by rows too: 2 million rows of lineitem are about 340 MB of a task.
RANGE_ROWS = 2_000_000


def clustered(df: DataFrame, cols, num_files: int | None = None) -> DataFrame:
    """Range-partition on ``cols`` (+ row hash) and sort within partitions."""
    spread = fresh_name(df.columns, "__spread")
    keyed = df.select("*", F.xxhash64(*df.columns).alias(spread))
    parts = [F.col(c) for c in cols] + [F.col(spread)]
    ranged = (keyed.repartitionByRange(num_files, *parts) if num_files
              else keyed.repartitionByRange(*parts))
    return ranged.sortWithinPartitions(*parts).drop(spread)


def ranges_for(input_bytes: int | None = None, input_rows: int | None = None, least: int = 1) -> int:
    """Ranges of a clustered table: one per ~256 MB of input files and per ``RANGE_ROWS`` rows, whichever are more."""
    return max(least, math.ceil((input_bytes or 0) / TARGET_SHUFFLE_INPUT_BYTES), math.ceil((input_rows or 0) / RANGE_ROWS))


def cluster_layout(df: DataFrame, path: str, cols, num_files: int | None = None,
                   fmt: str = "parquet", input_bytes: int | None = None, input_rows: int | None = None,
                   min_files: int = 1) -> None:
    """Replace the table at ``path`` by ``df`` clustered by ``cols``.

    ``num_files`` fixes the number of ranges; ``input_bytes`` (e.g.
    ``table_bytes`` of the source) and ``input_rows`` let it grow with the
    input (``ranges_for``), from ``min_files`` on.  With none of these, the
    session's count applies and AQE merges small ranges.
    """
    if num_files is None and (input_bytes or input_rows or min_files > 1):
        num_files = ranges_for(input_bytes, input_rows, min_files)
    overwrite_table(clustered(df, cols, num_files), path, fmt=fmt)


def file_ranges(df: DataFrame, cols) -> DataFrame:
    """One row per file of a table read back: rows, and the smallest and largest ``cols`` tuple.

    The file's distinct tuples come first, by hashing: the minimum of a tuple is taken by a sort of all that is
    grouped, which would otherwise be a task's every row with its file's path.
    """
    key = F.struct(*[F.col(c) for c in cols])
    distinct = df.groupBy(F.col("_metadata.file_path").alias("file"), key.alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    return distinct.groupBy("file").agg(F.sum("rows").alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"))


def overlapping_files(df: DataFrame, cols) -> DataFrame:
    """One row: rows of the table, and files that reach below the end of the file before them.

    Files in key order may share the value at their border (a hot value spans
    several files), nothing more: a clustered table has no such file.  The
    window runs over one row per file.
    """
    before = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    ranges = file_ranges(df, cols).withColumn("before", before)
    return ranges.agg(F.sum("rows").alias("rows"),
                      F.count(F.when(F.col("low") < F.col("before"), 1)).alias("overlapping_files"))


def rows_scanned(df: DataFrame) -> tuple[int, int]:
    """Rows that ``df`` returns, and rows that its file scans decode for it, counted by the scans themselves.

    A scan decodes the row groups whose footer statistics may fit the pushed filters; the others are skipped unread.
    """
    plan = df._jdf.queryExecution()
    returned = plan.toRdd().count()
    leaves = plan.executedPlan().collectLeaves()
    return returned, sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
