"""Snapshot stamps: fixed-width text ``yyyyMMdd_HHmmss_SSSSSS`` (UTC).

Fixed width means string order equals time order, so stamps are compared and
aggregated as plain strings.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's for identical results) ---------
# stamp text format (Python strftime):  %Y%m%d_%H%M%S_%f
# the same in Spark datetime patterns:  yyyyMMdd_HHmmss_SSSSSS
# default watermark (1970-01-01 UTC):   19700101_000000_000000
# stamp inside a landed file name:      _(\d{8}_\d{6}_\d{6})\.json$
PY_STAMP_FORMAT = "%Y%m%d_%H%M%S_%f"
STAMP_PATTERN = "yyyyMMdd_HHmmss_SSSSSS"
EPOCH_STAMP = "19700101_000000_000000"
FILE_STAMP_REGEX = r"_(\d{8}_\d{6}_\d{6})\.json$"
# -----------------------------------------------------------------------------

# our own landing layout keeps the stamp in a ``snapshot=`` directory
DIR_STAMP_REGEX = r"snapshot=(\d{8}_\d{6}_\d{6})(/|$)"
STAMP_TEXT_REGEX = r"^\d{8}_\d{6}_\d{6}$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def utc_text(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.ffffff]`` of an instant in UTC, whatever the session zone.

    A timestamp without zone is taken as UTC as it stands.  No wall time of the
    session's zone is involved, so its clock changes don't matter.
    """
    t = _c(ts)
    seconds = (F.unix_micros(t.cast("timestamp")).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    since = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.when(F.typeof(t) == "timestamp_ntz", t.cast("string")).otherwise(since.cast("string"))


def stamp_format(ts) -> Column:
    """Timestamp -> stamp text, in UTC."""
    text = utc_text(ts)
    digits = F.regexp_replace(text, "[^0-9]", "")
    fraction = F.rpad(F.coalesce(F.nullif(F.substring_index(text, ".", -1), text), F.lit("")), 6, "0")
    return F.concat(F.substring(digits, 1, 8), F.lit("_"), F.substring(digits, 9, 6), F.lit("_"), fraction)


def stamp_date_parts(stamp) -> dict[str, Column]:
    """``year``, ``month`` and ``day`` cut out of a stamp's text."""
    t = _c(stamp)
    return {"year": F.substring(t, 1, 4), "month": F.substring(t, 5, 2), "day": F.substring(t, 7, 2)}


def date_parts(ts) -> dict[str, Column]:
    """``year`` as text, ``month`` and ``day`` zero-padded to 2."""
    t = _c(ts)
    return {
        "year": F.year(t).cast("string"),
        "month": F.lpad(F.month(t).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(t).cast("string"), 2, "0"),
    }


def stamp_from_file_name(path_col, regex: str = FILE_STAMP_REGEX) -> Column:
    """Stamp group from a file name; no match -> ``''`` (never newer than
    any watermark, so such files are excluded by ``newer_than``)."""
    return F.regexp_extract(_c(path_col), regex, 1)


def py_stamp(dt: datetime | None = None) -> str:
    """Driver-side stamp of one instant (the fetch time of a landing)."""
    dt = dt or datetime.now(timezone.utc)
    if dt.tzinfo is not None:
        dt = dt.astimezone(timezone.utc)
    return dt.strftime(PY_STAMP_FORMAT)


def default_stamp(value: str | None) -> str:
    """Absent or blank watermark -> the epoch stamp."""
    if value is None or not str(value).strip():
        return EPOCH_STAMP
    return str(value).strip()
