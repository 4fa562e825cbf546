"""Table scans and sizes; S6: literal rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierkit.sinks.versions import current_path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
               text_partitions=()) -> DataFrame:
    """Current version of a table written by ``overwrite_table`` (or a plain folder of files).

    Partition values are typed by inference (``007`` would come back as 7);
    name the partition columns that hold text in ``text_partitions``, or pass
    the full ``schema``.
    """
    path = current_path(spark, path)
    if schema is None and text_partitions:
        probe = spark.read.format(fmt).load(path).schema
        schema = StructType([StructField(f.name, StringType(), True) if f.name in text_partitions
                             else f for f in probe.fields])
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``, from the listing alone (one job over
    file paths and lengths; no file is opened)."""
    total = spark.read.format("binaryFile").load(current_path(spark, path)).agg(F.sum("length").alias("b")).first()["b"]
    return int(total or 0)


def literal_rows(spark: SparkSession, rows, names) -> DataFrame:
    """In-memory rows with column names, types inferred (small inputs only)."""
    return spark.createDataFrame(rows, list(names))
