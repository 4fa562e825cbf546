"""Left enrichment from a reference table.

The reference is first made unique per key (deterministically: the smallest
attribute tuple wins), so a fact row can never be multiplied.  Its size is then
*measured* - rows and the exact bytes of the rows a broadcast would hold - and
only within ``max_broadcast_rows`` *and* ``max_broadcast_bytes`` (default: the
session's ``spark.sql.autoBroadcastJoinThreshold``) it is broadcast (no
shuffle of the facts at all); beyond either the join is a shuffle join, in one
pass over the facts, where

* fact rows with a NULL key - which can never match - get a salt beside their
  key, so they spread over the partitions instead of meeting in one;
* a hot non-NULL key is split by AQE's skew-join handling (the left side of a
  left outer join may be split, the unique right side is replicated).
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tierkit.control import fresh_name
from tierkit.session import scratch_root

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
NULL_SALTS = 4096  # partitions over which rows with a NULL key may spread


def broadcast_row_bytes(df: DataFrame) -> Column:
    """Bytes one row of ``df`` takes as a Spark ``UnsafeRow`` - the form rows
    are kept in by a broadcast hash relation: a null bitmap word per 64
    fields, 8 bytes per field, and variable-length values rounded up to 8.
    Nested values are counted by their JSON text, an over-estimate."""
    fields = df.schema.fields
    fixed = 8 * ((len(fields) + 63) // 64) + 8 * len(fields)
    size = F.lit(fixed).cast("long")
    for f in fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            var = F.octet_length(c)
        elif f.dataType.typeName() in ("array", "map", "struct"):
            var = F.octet_length(F.to_json(c))
        else:
            continue
        size = size + F.coalesce(F.ceil(var / 8) * 8, F.lit(0)).cast("long")
    return size


_BYTE_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
               "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40, "p": 1 << 50, "pb": 1 << 50}


def size_in_bytes(text: str) -> int:
    """A Spark size setting (``10485760b``, ``20MB``, ``-1``) in bytes."""
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m or m.group(2).lower() not in _BYTE_UNITS:
        raise ValueError(f"not a size: {text!r}")
    return int(m.group(1)) * _BYTE_UNITS[m.group(2).lower()]


def session_broadcast_limit(spark) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1: never broadcast)."""
    return size_in_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))


def unique_reference(ref: DataFrame, keys, attrs) -> DataFrame:
    """One row per non-NULL key; ties resolved by the smallest ``attrs`` tuple."""
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    least = fresh_name([*keys, *attrs], "__a")
    return (ref.where(not_null)
            .groupBy(*keys)
            .agg(F.min(F.struct(*[F.col(a) for a in attrs])).alias(least))
            .select(*keys, *[F.col(least)[a].alias(a) for a in attrs]))


def enrich_left(df: DataFrame, ref: DataFrame, keys, attrs,
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                strategy: str = "auto", max_broadcast_bytes: int | None = None) -> DataFrame:
    """Left join ``attrs`` of ``ref`` onto ``df`` by ``keys``; unmatched -> NULL.

    ``strategy``: ``auto`` (size check), ``broadcast`` (raises where the check fails) or ``shuffle``.
    ``max_broadcast_bytes``: ``None`` -> the session's broadcast threshold.
    """
    clash = set(attrs) & set(df.columns)
    if clash:
        raise ValueError(f"attribute columns already on the facts: {sorted(clash)}")
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    # Materialise the deduplicated reference once (reliable checkpoint in the
    # shared spark.checkpoint.dir): the size check then counts stored rows
    # instead of re-running the dedup, and in the shuffle join both inputs are
    # plain shuffle stages - the shape AQE needs to split a skewed partition.
    scratch_root(df.sparkSession)
    uref = unique_reference(ref, keys, attrs).checkpoint(eager=True)
    if strategy != "shuffle":
        if max_broadcast_bytes is None:
            max_broadcast_bytes = session_broadcast_limit(df.sparkSession)
        # one aggregate over the stored reference: its rows and their bytes
        size = uref.agg(F.count(F.lit(1)).alias("rows"),
                        F.coalesce(F.sum(broadcast_row_bytes(uref)), F.lit(0)).alias("bytes")).first()
        if size["rows"] <= max_broadcast_rows and size["bytes"] <= max_broadcast_bytes:
            return df.join(F.broadcast(uref), on=list(keys), how="left")
        if strategy == "broadcast":
            raise ValueError(f"the reference is too large to broadcast: {size['rows']} rows, {size['bytes']} bytes")
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salt = fresh_name([*df.columns, *attrs], "__salt")
    salted = df.withColumn(salt, F.when(any_null, F.pmod(F.xxhash64(*df.columns), F.lit(NULL_SALTS)) + 1)
                           .otherwise(F.lit(0)).cast("long"))
    joined = salted.join(uref.withColumn(salt, F.lit(0).cast("long")), on=[*keys, salt], how="left")
    return joined.drop(salt).select(*keys, *[c for c in df.columns if c not in keys], *attrs)
