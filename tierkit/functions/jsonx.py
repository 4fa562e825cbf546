"""JSON record <-> column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# keep NULL fields as ``"f":null`` like a plain ``json.dumps`` of the record
JSON_KEEP_NULLS = {"ignoreNullFields": "false"}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_json_line(*cols, keep_nulls: bool = True) -> Column:
    """Columns -> one JSON object text (UTF-8, non-ASCII unescaped)."""
    opts = JSON_KEEP_NULLS if keep_nulls else {}
    return F.to_json(F.struct(*[_c(c) for c in cols]), opts)


def from_json_record(col, schema) -> Column:
    """JSON object text -> struct, malformed -> NULL fields."""
    return F.from_json(_c(col), schema)
