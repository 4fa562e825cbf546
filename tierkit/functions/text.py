"""Text cleaning column functions (silver normalisation rules).

All functions take and return ``Column`` objects built from built-in Spark SQL
functions, so they stay inside whole-stage code generation.  The one exception
is the exact accent fold, which needs Unicode NFKD: an Arrow UDF whose body is
columnar (Arrow's NFKD kernel, then numpy over the value buffer).
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# --- fixed values (must equal the reference's for identical results) ---------
# default for blank / NULL text:              'unknown'
# slug: runs of characters outside a-z0-9 ->  '[^a-z0-9]+' replaced by '_'
# fold: characters outside a-z0-9_        ->  '[^a-z0-9_]' replaced by '_'
#       repeated underscores              ->  '__+' replaced by '_'
#       edge underscores stripped; NFKD, non-ASCII dropped, lower case
UNKNOWN = "unknown"
SLUG_PATTERN = "[^a-z0-9]+"
FOLD_PATTERN = "[^a-z0-9_]"
FOLD_REPEAT_PATTERN = "__+"
# -----------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_text(col) -> Column:
    """Cast anything to string."""
    return _c(col).cast("string")


def strip_spaces(col) -> Column:
    """Strip ASCII spaces only from both ends (tabs, NBSP stay)."""
    return F.trim(as_text(col))


def norm_text(col) -> Column:
    """``lower(trim(cast(c as string)))``; NULL stays NULL, blank -> ''."""
    return F.lower(strip_spaces(col))


def norm_id(col) -> Column:
    """Key text: trimmed, case kept."""
    return strip_spaces(col)


def text_or_unknown(col, default: str = UNKNOWN) -> Column:
    """X11 (X4 + X5): cleaned text, blank or NULL -> ``default``."""
    return F.coalesce(F.nullif(norm_text(col), F.lit("")), F.lit(default))


def slug(col, default: str = UNKNOWN) -> Column:
    """X12 (X6): partition-safe slug.

    ``text_or_unknown`` then every run of characters outside ``[a-z0-9]``
    becomes one ``_``.  The reference applies a second ``_+ -> _`` pass; it can
    never change the output of the first, so it is not repeated.
    """
    return F.regexp_replace(text_or_unknown(col, default), SLUG_PATTERN, "_")


def try_double(col) -> Column:
    """Text -> double, malformed -> NULL (ANSI-safe ``try_cast``)."""
    return as_text(col).try_cast("double")


# --- accent folding -----------------------------------------------------------

# The UDFs below carry their code to the Python workers (pickled by value), so
# a worker needs numpy and pyarrow but not this package on its path - whatever
# directory the job was started from, and without shipping the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# byte map applied after NFKD, once only ASCII is left: A-Z -> a-z, a-z and
# 0-9 kept, every other byte -> '_' (the fold's lower + FOLD_PATTERN steps)
_FOLD_BYTES = np.full(256, ord("_"), dtype=np.uint8)
_FOLD_BYTES[ord("0"):ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_FOLD_BYTES[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD_BYTES[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def fold_text(text: str | None) -> str | None:
    """X13 for one text, through the same byte map: the definition the columnar kernel is checked against."""
    if text is None:
        return None
    data = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").translate(_FOLD_BYTES.tobytes())
    return "_".join(w for w in data.decode("ascii").split("_") if w)


def _delete_bytes(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray):
    """Keep the bytes where ``keep`` is set; shift the string offsets to match."""
    gone = np.flatnonzero(~keep)
    if gone.size == 0:
        return data, offsets
    return data[keep], offsets - np.searchsorted(gone, offsets)


# text bytes handled at once: the kernel's temporaries are up to twenty times
# this (texts that lose most of their bytes), however large the Arrow batch
# Spark hands over; every core of an executor has a worker with its own
FOLD_SLICE_BYTES = 1024 * 1024


def fold_text_arrow(arr: pa.Array) -> pa.Array:
    """X13 on a whole Arrow string array, equal to ``fold_text`` per row.

    Arrow's NFKD kernel runs first; after it every byte >= 0x80 belongs to a
    non-ASCII code point, so "drop non-ASCII, lower, slug, collapse ``_``" are
    byte operations on the value buffer (numpy), with the string offsets
    shifted by the number of bytes deleted before them.  No per-row Python.
    Rows are taken in slices of about ``FOLD_SLICE_BYTES`` of text.
    """
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if n == 0:
        return arr
    lengths = pc.fill_null(pc.binary_length(arr), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    if ends[-1] <= FOLD_SLICE_BYTES:
        return _fold_slice(arr)
    parts, start = [], 0
    while start < n:
        # rows up to ~FOLD_SLICE_BYTES past the bytes before ``start``; at least one row
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + FOLD_SLICE_BYTES, side="right")))
        parts.append(_fold_slice(arr.slice(start, stop - start)))
        start = stop
    return pa.concat_arrays(parts)


def _fold_slice(arr: pa.Array) -> pa.Array:
    n = len(arr)
    if n == 0:
        return arr
    large = pa.types.is_large_string(arr.type)
    otype = np.int64 if large else np.int32
    s = pc.utf8_normalize(pc.fill_null(arr, ""), form="NFKD")
    bufs = s.buffers()
    offsets = np.frombuffer(bufs[1], dtype=otype)[s.offset:s.offset + n + 1].astype(np.int64)
    data = (np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None
            else np.zeros(0, dtype=np.uint8))[offsets[0]:offsets[-1]]
    offsets -= offsets[0]
    data, offsets = _delete_bytes(data, offsets, data < 0x80)
    data = _FOLD_BYTES[data]
    # an '_' right after an '_' of the same string goes
    us = data == ord("_")
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = ~(us[1:] & us[:-1])
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True  # first byte of each string stays
    data, offsets = _delete_bytes(data, offsets, keep)
    out = pa.Array.from_buffers(pa.large_string() if large else pa.string(), n,
                                [None, pa.py_buffer(offsets.astype(otype)), pa.py_buffer(data)])
    out = pc.utf8_trim(out, characters="_")
    if arr.null_count:
        out = pc.if_else(pc.is_valid(arr), out, pa.scalar(None, out.type))
    return out


fold_slug_udf = F.arrow_udf(fold_text_arrow, StringType())
fold_slug_udf.__doc__ = "U1: exact accent fold as an Arrow UDF (columnar body, NULL -> NULL)."


def fold_slug(col, null_as_text: bool = False) -> Column:
    """ASCII-fold slug, by the Arrow UDF ``fold_text_arrow`` (exact, no per-row Python).

    ``null_as_text=True`` reproduces the reference quirk ``NULL -> 'none'``.
    """
    c = as_text(col)
    out = fold_slug_udf(c)
    return F.when(c.isNull(), F.lit("none")).otherwise(out) if null_as_text else out


def register_fold_udf(spark, name: str = "fold_slug") -> None:
    """Make the exact fold callable from SQL text."""
    spark.udf.register(name, fold_slug_udf)
