"""A paged record source, re-aimed as rows ``(page, body)``.

``body`` is the JSON array text one page request returned.  The fetcher stops
at the first empty page, so pages numbered after it are ignored.  The cut-off
is one scalar, found by a light job that only counts array elements
(``json_array_length``, no struct building), together with the first page whose
body is no JSON array (NULL, truncated, something else): such a page before
the cut-off is an error, not an end; so is a gap in the page numbers.  The cut-off is then a literal filter on
the page number, applied before the full parse and ``explode``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tierkit.control import fresh_name


class NoRecordsError(ValueError):
    """Raised when a paged source produced no record at all."""


class BadPageError(ValueError):
    """Raised when a page before the end holds no JSON array."""


def first_empty_page(pages: DataFrame, page_col: str = "page", body_col: str = "body", first_page: int = 1,
                     check_nonempty: bool = False):
    """Number of the first page whose body is an empty JSON array (``None``: no such page).

    The pages before it must be ``first_page``, ``first_page + 1`` and so on, each once, and hold a JSON array: a bad
    page, a gap, a page that comes twice or has no number raises ``BadPageError``.  ``check_nonempty``: no page before
    the end raises ``NoRecordsError``.  One aggregate; where there is an empty page a second one over the page
    numbers alone counts those before it.
    """
    n, page = F.json_array_length(F.col(body_col)), F.col(page_col)
    row = pages.agg(F.min(F.when(n == 0, page)).alias("cut"), F.min(F.when(n.isNull(), page)).alias("bad"),
                    F.count(F.when(page.isNull(), 1)).alias("unnumbered"), *_sequence(page)).first()
    cut = row["cut"]
    if row["unnumbered"]:
        raise BadPageError(f"{row['unnumbered']} pages have no number")
    if row["bad"] is not None and (cut is None or row["bad"] < cut):
        raise BadPageError(f"page {row['bad']} holds no JSON array")
    if cut is not None:
        row = pages.where(page < F.lit(cut)).agg(*_sequence(page)).first()
    if row["pages"]:
        last = row["high"] if cut is None else cut - 1
        if row["low"] != first_page or row["high"] != last or row["pages"] != last - first_page + 1 or row["numbers"] != row["pages"]:
            raise BadPageError(f"pages {first_page} to {last} are not there once each: {row['pages']} pages from {row['low']} "
                               f"to {row['high']}, {row['numbers']} of them different")
    elif cut is not None and cut != first_page:
        raise BadPageError(f"the first page is {cut}, not {first_page}")
    elif check_nonempty:
        raise NoRecordsError("the paged source returned no records")
    return cut


def _sequence(page):
    return (F.count(page).alias("pages"), F.count_distinct(page).alias("numbers"), F.min(page).alias("low"),
            F.max(page).alias("high"))


def paged_records(pages: DataFrame, record_schema, page_col: str = "page",
                  body_col: str = "body", check_nonempty: bool = True, first_page: int = 1) -> DataFrame:
    """Explode every page before the first empty one into record rows.

    ``record_schema``: the element struct (``StructType`` or DDL).  Pages must be numbered without gaps from
    ``first_page`` on (``first_empty_page``).  No records raise ``NoRecordsError``, as a source that answers with
    nothing is an error, unless ``check_nonempty`` is off.
    """
    elem = record_schema if isinstance(record_schema, StructType) else StructType.fromDDL(record_schema)
    cut = first_empty_page(pages, page_col, body_col, first_page, check_nonempty)
    kept = pages if cut is None else pages.where(F.col(page_col) < F.lit(cut))
    record = fresh_name([page_col], "__r")
    return kept.select(F.col(page_col), F.explode(F.from_json(F.col(body_col), ArrayType(elem), {"mode": "FAILFAST"})).alias(record)).select(
        page_col, f"{record}.*")
