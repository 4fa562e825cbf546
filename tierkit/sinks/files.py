"""K1-K4, K6: file sinks.

Partitioned writes are preceded by a ``REBALANCE`` on the partition columns:
each output directory is then written by few tasks (few files) while AQE
splits a partition value that holds a large share of the rows into
advisory-sized pieces and merges tiny ones.  Without it every task writes one
file into every directory it meets (tasks x partitions small files).
``require_adaptive`` refuses to write where AQE is off, since the hint is then
ignored.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkit.functions.jsonx import JSON_KEEP_NULLS
from tierkit.functions.stamps import STAMP_TEXT_REGEX, py_stamp, stamp_date_parts
from tierkit.control import age_s, create_new, delete_path, file_text, listed, path_exists, remove, rename_path
from tierkit.sinks.commits import COMMIT_SCHEMA, append_commits, committed_among
from tierkit.sinks.versions import replace_dataset, replace_set


class LeftoverError(ValueError):
    """A stamp's folder or claim of a landing that was never committed."""


def require_adaptive(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.adaptive.enabled", "true").lower() != "true":
        raise RuntimeError("set spark.sql.adaptive.enabled: partitioned writes rely on REBALANCE")


def _rebalanced(df: DataFrame, partition_by) -> DataFrame:
    if not partition_by:
        return df
    require_adaptive(df.sparkSession)
    return df.hint("rebalance", *partition_by)


def _folder(stamp):
    """A stamp's folder below the root, as a column."""
    return F.concat(*[p for n, c in stamp_date_parts(stamp).items() for p in (F.lit(f"{n}="), c, F.lit("/"))],
                    F.lit("snapshot="), stamp)


def _take(spark: SparkSession, root: str, stamp: str, folder: str, leftover: str) -> None:
    """Claim a stamp for this landing; what a crashed one left there is refused or replaced."""
    claim = f"{root}/_claims/{stamp}"
    if not create_new(spark, claim, folder):
        if leftover != "replace":
            raise LeftoverError(f"snapshot {stamp} is being landed, or its landing crashed: {claim}")
        delete_path(spark, claim)
        if not create_new(spark, claim, folder):
            raise LeftoverError(f"snapshot {stamp} is being landed by another job")


def land_json(df: DataFrame, root: str, stamp: str | None = None,
              stamp_col: str | None = None,
              max_records_per_file: int | None = None, leftover: str = "refuse") -> str | None:
    """K1: land NDJSON under ``year=/month=/day=/snapshot=<stamp>``, then commit it.

    ``stamp``: one stamp for the whole landing (default: now, UTC); or
    ``stamp_col``: a column of ``df`` giving each row's stamp (not written into
    the records).  Date parts are cut out of the stamp's text.  NULL fields are written as ``null`` (kept, like
    ``json.dumps``), non-ASCII text unescaped.  The source is evaluated once.

    Files are written to a folder of this landing alone, ``<root>/_staging/<id>``: landings side by side share no
    temporary files, and a write that fails or crashes leaves nothing among the snapshots.  Then each stamp is
    claimed (``<root>/_claims/<stamp>``: of two landings at once one raises), its folder is moved into place, and one
    row per stamp is appended to ``<root>/_commits``, the commit of all of them.  So a committed folder holds the rows
    of one landing, as many as its commit row says.  A landing that crashed between move and commit
    leaves an uncommitted folder or a claim: ``leftover="refuse"`` raises ``LeftoverError`` at them, ``"replace"``
    takes them away (the caller knows that no other job is landing there); ``recover_landings`` clears old ones.

    Landing at a stamp that is committed raises; so do no records, and stamps that are none.
    Returns the literal stamp when one was used.
    """
    if leftover not in ("refuse", "replace"):
        raise ValueError(f"unknown way with leftovers {leftover!r}")
    spark, root = df.sparkSession, root.rstrip("/")
    lit_stamp = None if stamp_col is not None else stamp or py_stamp()
    stamp_c = F.col(stamp_col) if lit_stamp is None else F.lit(lit_stamp)
    if lit_stamp is not None and committed_among(spark, root, [lit_stamp]):
        raise ValueError(f"snapshot {lit_stamp} is committed already")
    records = [c for c in df.columns if c != stamp_col]
    out = df.select(*records, *[c.alias(n) for n, c in stamp_date_parts(stamp_c).items()], stamp_c.alias("snapshot"))
    pcols, staged = ["year", "month", "day", "snapshot"], f"{root}/_staging/{uuid.uuid4().hex}"
    w = _rebalanced(out, pcols).write.partitionBy(*pcols).options(**JSON_KEEP_NULLS)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    claimed, moved = [], []
    try:
        w.json(staged)
        # counted from what was written: one row per snapshot of this landing
        lines = spark.read.schema("value string, " + ", ".join(f"{c} string" for c in pcols)).text(staged)
        counts = lines.groupBy(F.col("snapshot").alias("stamp")).agg(F.count(F.lit(1)).alias("rows")).withColumn(
            "folder", _folder(F.col("stamp"))).collect()
        if not counts:
            raise ValueError("no records to land")
        bad = [r.stamp for r in counts if not r.stamp or not re.match(STAMP_TEXT_REGEX, r.stamp)]
        if bad:
            raise ValueError(f"{stamp_col or 'stamp'} holds values that are no stamps: {bad[:3]}")
        for r in counts:
            _take(spark, root, r.stamp, r.folder, leftover)
            claimed.append(r.stamp)
        again = committed_among(spark, root, [r.stamp for r in counts])
        if again:
            raise ValueError(f"snapshots {again[:3]} are committed already")
        for r in counts:
            if path_exists(spark, f"{root}/{r.folder}"):
                if leftover != "replace":
                    raise LeftoverError(f"{root}/{r.folder} holds a landing that was never committed")
                delete_path(spark, f"{root}/{r.folder}")
            moved.append(r.folder)
            rename_path(spark, f"{staged}/{r.folder}", f"{root}/{r.folder}")
        append_commits(spark.createDataFrame([(r.stamp, r.folder, r.rows) for r in counts], COMMIT_SCHEMA), root)
        moved = []
    finally:  # after a failure nothing of this landing stays
        for folder in moved:
            delete_path(spark, f"{root}/{folder}")
        delete_path(spark, staged)
        for s in claimed:
            delete_path(spark, f"{root}/_claims/{s}")
    return lit_stamp


def recover_landings(spark: SparkSession, root: str, min_age_s: float = 24 * 3600) -> list[str]:
    """Clear what crashed landings left: staging folders, and claims with their uncommitted folders, that are older than
    ``min_age_s`` (no landing takes that long from its first file on).  Returns the stamps cleared."""
    root = root.rstrip("/")
    remove(spark, root, [st for st in listed(spark, f"{root}/_staging") if age_s(st) >= min_age_s])
    claims = [st for st in listed(spark, f"{root}/_claims") if age_s(st) >= min_age_s]
    stamps = [st.getPath().getName() for st in claims]
    done = set(committed_among(spark, root, stamps)) if stamps else set()
    for stamp in stamps:
        folder = file_text(spark, f"{root}/_claims/{stamp}")
        if stamp not in done and folder:
            delete_path(spark, f"{root}/{folder}")
    remove(spark, root, claims)
    return sorted(set(stamps) - done)


def table_writer(df: DataFrame, partition_by=None, fmt: str = "parquet", max_records_per_file: int | None = None):
    """``write(folder)`` of a table version."""
    pcols = list(partition_by or [])

    def write(folder: str) -> None:
        w = _rebalanced(df, pcols).write.format(fmt)
        if pcols:
            w = w.partitionBy(*pcols)
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", max_records_per_file)
        w.save(folder)

    return write


def csv_writer(df: DataFrame, partition_by=None, rebalance: bool = True):
    """``write(folder)`` of a CSV mirror's version."""
    pcols = list(partition_by or [])

    def write(folder: str) -> None:
        w = (_rebalanced(df, pcols) if rebalance else df).write.option("header", "true")
        if pcols:
            w = w.partitionBy(*pcols)
        w.csv(folder)

    return write


def overwrite_table(df: DataFrame, path: str, partition_by=None, fmt: str = "parquet",
                    max_records_per_file: int | None = None) -> None:
    """K2/K4: replace the whole table by a new version (``versions.py``): every
    old partition goes, also those absent from ``df``, and a failed write
    leaves the table as it was."""
    replace_dataset(df.sparkSession, path, table_writer(df, partition_by, fmt, max_records_per_file))


def export_csv(df: DataFrame, path: str, partition_by=None, rebalance: bool = True) -> None:
    """K3/K6: header CSV mirror (lossy: '' and NULL both read back as NULL),
    replaced like a table.

    ``rebalance=False`` when ``df`` is a table already written partitioned by
    the same columns: each of its files holds one partition value, so the
    mirror is written without another shuffle.
    """
    replace_dataset(df.sparkSession, path, csv_writer(df, partition_by, rebalance))


def publish(table: DataFrame, path: str, partition_by=None, fmt: str = "parquet", csv_path: str | None = None,
            stamp: str = "") -> None:
    """Replace a table, its CSV mirror and the stamp they were made of in one commit (``replace_set``).

    The mirror is read from the files of the table's new version, so nothing is computed twice.
    """
    spark = table.sparkSession
    write = table_writer(table, partition_by, fmt)
    members = {path: lambda folder, done: write(folder)}
    if csv_path:
        def mirror(folder: str, done: dict) -> None:
            back = spark.read.format(fmt).schema(table.schema).load(done[path.rstrip("/")])
            csv_writer(back, partition_by, rebalance=False)(folder)

        members[csv_path] = mirror
    replace_set(spark, members, stamp)
