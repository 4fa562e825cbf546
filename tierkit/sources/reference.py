"""Reference CSV scan.

Read with an explicit all-string schema: inference would turn a postal code
``09020`` into the integer ``9020`` and costs an extra pass over the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tierkit.sinks.versions import current_path


def read_reference_csv(spark: SparkSession, path: str, columns=None, schema=None,
                       sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Header CSV -> DataFrame (the current version of a mirror written by ``export_csv``, or a plain
    path).  ``columns`` gives an all-string schema."""
    if schema is None:
        if columns is None:
            raise ValueError("give columns or schema: no schema inference")
        schema = StructType([StructField(c, StringType(), True) for c in columns])
    return (spark.read.schema(schema)
            .option("header", True).option("sep", sep).option("encoding", encoding)
            .option("mode", "PERMISSIVE")
            .csv(current_path(spark, path)))
