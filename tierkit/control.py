"""Small control datasets: rows are only ever appended, one file per commit.

A file is moved into place whole, so a crash leaves either the old rows or the
new ones too.  Compaction keeps to that order: it first appends the rows
that stay, then removes the older files; a crash in between leaves rows twice,
which every reader here tolerates (they take a maximum or distinct rows).
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """``path`` and its file system, as Hadoop objects of the driver."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


def listed(spark: SparkSession, path: str) -> list:
    """Hadoop file statuses directly below ``path``; none where it isn't there."""
    p, fs = hadoop_path(spark, path)
    return list(fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str, statuses: list) -> None:
    """Delete listed files by their path objects: a path's text may be encoded elsewhere, an object never is."""
    _, fs = hadoop_path(spark, path)
    for st in statuses:
        fs.delete(st.getPath(), True)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a place where nothing is; the parent is made."""
    src, fs = hadoop_path(spark, source)
    dst, _ = hadoop_path(spark, target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) or not fs.rename(src, dst):
        raise RuntimeError(f"could not move {source} to {target}")


def create_new(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a file; False where there is one already (the file system lets only one of two succeed)."""
    p, fs = hadoop_path(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    if text:
        out.write(bytearray(text.encode()))
    out.close()
    return True


def file_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; ``None`` where there is none."""
    p, fs = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def age_s(status) -> float:
    """Seconds since a listed file or folder was changed."""
    return time.time() - status.getModificationTime() / 1000


def fresh_name(columns, base: str) -> str:
    """A column name beside ``columns`` (names compare without case)."""
    have = {c.lower() for c in columns}
    while base.lower() in have:
        base = f"_{base}"
    return base


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below one folder, from the file system's summary."""
    p, fs = hadoop_path(spark, path)
    return int(fs.getContentSummary(p).getLength())


def rows_of(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The dataset's rows; ``None`` when nothing was ever written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append_file(df: DataFrame, path: str) -> None:
    """Append the rows of ``df`` as one file: written aside and moved in, so that appends side by side share no
    temporary folder and a reader sees a whole file or none."""
    spark, name = df.sparkSession, uuid.uuid4().hex
    aside = f"{path}/_aside/{name}"
    try:
        df.coalesce(1).write.parquet(aside)
        for st in row_files(spark, aside):
            rename_path(spark, f"{aside}/{st.getPath().getName()}", f"{path}/part-{name}.parquet")
    finally:
        delete_path(spark, aside)


def append_rows(spark: SparkSession, path: str, schema: str, rows: list[tuple]) -> None:
    append_file(spark.createDataFrame(rows, schema), path)


def replace_rows(spark: SparkSession, path: str, schema: str, rows: list[tuple]) -> None:
    """Append ``rows``, then remove the files that were there before."""
    old = [st for st in listed(spark, path) if _holds_rows(st)]
    append_rows(spark, path, schema, rows)
    remove(spark, path, old)  # one file per commit since the last compaction


def _holds_rows(status) -> bool:
    return status.isFile() and not status.getPath().getName().startswith(("_", "."))


def row_files(spark: SparkSession, path: str) -> list:
    """File statuses of the dataset's files: one listing, no job."""
    return [st for st in listed(spark, path) if _holds_rows(st)]
