"""Scan landed NDJSON snapshots with an explicit schema.

Two layouts are understood:

* ``directory`` - ours (``land_json``): ``root/year=Y/month=MM/day=DD/snapshot=STAMP/part-*.json``.
  The stamp is a partition column, so a filter on it is a *partition filter*:
  Spark lists and opens only the matching directories.
* ``file_name`` - the reference's: ``.../<name>_<STAMP>.json``.  The stamp is
  taken from the hidden ``_metadata.file_name`` column; filters on it are file
  metadata filters, which also prune files before any byte is read (the
  reference's ``input_file_name()`` blocks that).

A file without a recognisable stamp gets ``''`` and is therefore never newer
than any watermark.

The newest snapshot of the ``directory`` layout is taken from the landing's
commit rows: no listing, whatever the size of the history, and never a snapshot
whose files are still arriving.  The ``file_name`` layout has no such mark: a
snapshot is one file there, complete as soon as it appears; only the day folders
from the watermark's day on are listed.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierkit.functions.stamps import EPOCH_STAMP, FILE_STAMP_REGEX, STAMP_TEXT_REGEX
from tierkit.control import folder_bytes, fresh_name, hadoop_path
from tierkit.sinks.commits import newest_commit

PARTITION_COLS = ("year", "month", "day", "snapshot")


def _as_struct(spark: SparkSession, schema) -> StructType:
    if isinstance(schema, StructType):
        return schema
    return StructType.fromDDL(schema)


def read_snapshots(spark: SparkSession, root: str, schema, layout: str = "directory",
                   glob: str = "*/*/*/*.json", stamp_col: str = "snapshot_stamp",
                   file_regex: str = FILE_STAMP_REGEX, folders=None,
                   corrupt_col: str | None = None) -> DataFrame:
    """Scan the landed snapshots under ``root``; adds ``stamp_col``.

    ``schema``: the record schema (``StructType`` or DDL).  No inference pass.
    ``folders``: read only these folders of ``root`` (as returned by
    ``newest_snapshot``), so only they are listed; default: everything.
    ``corrupt_col``: keep a line that is no record in this column, its fields
    NULL; without it such a line fails the job.
    """
    rec = _as_struct(spark, schema)
    # lines are kept as text where broken ones are wanted, and parsed beside it
    data = StructType([StructField("value", StringType(), True)]) if corrupt_col else rec
    reader = spark.read.format("text") if corrupt_col else spark.read.format("json").option("mode", "FAILFAST")
    if folders is not None and not folders:
        raise ValueError("no folders to read")
    if layout == "directory":
        full = StructType(list(data.fields) + [
            StructField(p, StringType(), True) for p in PARTITION_COLS if p not in rec.fieldNames()
        ])
        df = reader.schema(full).option("basePath", root).load(folders or [root])
        stamp = F.when(F.col("snapshot").rlike(STAMP_TEXT_REGEX), F.col("snapshot")).otherwise(F.lit(""))
        return _parsed(df.withColumn(stamp_col, stamp), rec, corrupt_col)
    if layout == "file_name":
        if folders:
            # the glob's last part keeps selecting the files inside the folders
            last = glob.rsplit("/", 1)[-1] if glob else "*"
            df = reader.schema(data).option("pathGlobFilter", last).load(folders)
        else:
            df = reader.schema(data).load(root.rstrip("/") + ("/" + glob if glob else ""))
        return _parsed(df.withColumn(stamp_col, stamp_column(file_regex)), rec, corrupt_col)
    raise ValueError(f"unknown layout {layout!r}")


def _parsed(df: DataFrame, rec: StructType, corrupt_col: str | None) -> DataFrame:
    """Lines of text as records, with the lines that are none in ``corrupt_col``; without it unchanged."""
    if not corrupt_col:
        return df
    kept = StructType([*rec.fields, StructField(corrupt_col, StringType(), True)])
    record = F.from_json("value", kept, {"columnNameOfCorruptRecord": corrupt_col})
    rest = [c for c in df.columns if c != "value"]
    whole = fresh_name(rest, "__r")
    return df.where(F.trim("value") != "").select(record.alias(whole), *rest).select(f"{whole}.*", *rest)


class Snapshot(NamedTuple):
    """The newest snapshot: its stamp (``None``: nothing new), the folders
    holding its files, and their size in bytes (``None`` when unknown)."""
    stamp: str | None
    folders: list
    bytes: int | None = None


# the fixed schema of Spark's ``binaryFile`` source (a stream must be given it)
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def listing_columns(file_regex: str = FILE_STAMP_REGEX) -> list[Column]:
    """``stamp`` ('' when absent), ``folder`` and ``length`` of a file-name layout's files, all taken
    from ``path``/``length`` of a ``binaryFile`` row, so no file is opened."""
    return [F.regexp_extract(F.col("path"), file_regex, 1).alias("stamp"),
            F.regexp_extract(F.col("path"), r"^(.*)/[^/]*$", 1).alias("folder"), F.col("length")]


def newest_of(stamped: DataFrame, since: str | None = None) -> Snapshot:
    """The newest stamp above ``since`` in a frame of ``stamp`` / ``folder`` / ``length`` rows, in one
    job: folders and bytes are gathered per stamp (a partial aggregate: a snapshot has few folders) and
    only the top stamp comes back to the driver."""
    top = (stamped.where(F.col("stamp") > F.lit(since or EPOCH_STAMP))
           .groupBy("stamp").agg(F.collect_set("folder").alias("folders"), F.sum("length").alias("bytes"))
           .orderBy(F.col("stamp").desc()).limit(1).collect())
    if not top:
        return Snapshot(None, [], None)
    return Snapshot(top[0]["stamp"], sorted(top[0]["folders"]), top[0]["bytes"])


def newest_committed(spark: SparkSession, root: str, since: str | None = None) -> Snapshot:
    """The newest committed stamp above ``since``, its folder and the bytes there."""
    top = newest_commit(spark, root)
    if top is None or top.stamp <= (since or EPOCH_STAMP):
        return Snapshot(None, [], None)
    folder = f"{root.rstrip('/')}/{top.folder}"
    return Snapshot(top.stamp, [folder], folder_bytes(spark, folder))


def day_folders(spark: SparkSession, root: str, day_glob: str, since: str | None = None) -> list[str]:
    """The folders that ``day_glob`` names below ``root``, from the day of ``since`` on: one per day, from
    directory listings alone.  A folder whose path shows no date is kept."""
    p, fs = hadoop_path(spark, f"{root.rstrip('/')}/{day_glob}" if day_glob else root)
    found = fs.globStatus(p) or []
    first, out = (since or EPOCH_STAMP)[:8], []
    for st in found:
        path = st.getPath().toString()
        day = re.search(r"(\d{4})[^/\d]*/[^/\d]*(\d{2})[^/\d]*/[^/\d]*(\d{2})[^/\d]*$", path)
        if st.isDirectory() and (not day or "".join(day.groups()) >= first):
            out.append(path)
    return sorted(out)


def newest_snapshot(spark: SparkSession, root: str, since: str | None = None,
                    layout: str = "directory", glob: str = "*/*/*/*.json",
                    file_regex: str = FILE_STAMP_REGEX) -> Snapshot:
    """Newest stamp strictly newer than ``since``, the folders holding it and their bytes.

    ``directory``: from the commit rows (one per landing).  ``file_name``: from a listing of the day
    folders from the day of ``since`` on; no record is parsed, and no list of files reaches the driver.
    """
    if layout == "directory":
        return newest_committed(spark, root, since)
    if layout != "file_name":
        raise ValueError(f"unknown layout {layout!r}")
    day_glob, _, last = glob.rpartition("/")
    folders = day_folders(spark, root, day_glob, since)
    if not folders:
        return Snapshot(None, [], None)
    files = spark.read.format("binaryFile").option("pathGlobFilter", last or "*").load(folders)
    return newest_of(files.select(*listing_columns(file_regex)), since)


def stamp_column(file_regex: str = FILE_STAMP_REGEX) -> Column:
    """S3: stamp from the source file name (``''`` when it does not match)."""
    return F.regexp_extract(F.col("_metadata.file_name"), file_regex, 1)
