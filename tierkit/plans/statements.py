"""The silver step as one SQL statement with a bound ``:stamp``, built from the same rule spec as the
DataFrame form (``operators.project``)."""

from __future__ import annotations

from tierkit.functions.text import SLUG_PATTERN, UNKNOWN


def _norm(c: str) -> str:
    return f"lower(trim(CAST({c} AS STRING)))"


def _known(c: str) -> str:
    return f"coalesce(nullif({_norm(c)}, ''), '{UNKNOWN}')"


_SQL = {
    "id": lambda c: f"trim(CAST({c} AS STRING))",
    "text": _norm,
    "text_or_unknown": _known,
    "slug": lambda c: f"regexp_replace({_known(c)}, '{SLUG_PATTERN}', '_')",
    "double": lambda c: f"try_cast({c} AS DOUBLE)",
    "keep": lambda c: c,
}


def silver_statement(view: str, spec: dict, key: str, stamp_col: str, tie_break: str) -> str:
    """Newest snapshot of ``view`` above ``:stamp``, one row per ``key``, cleaned by ``spec``.

    ``tie_break``: an ORDER BY list that settles ties inside the snapshot.
    """
    columns = []
    for out, rule in {**spec, stamp_col: "keep"}.items():
        name, source = (rule, out) if isinstance(rule, str) else rule
        columns.append(f"{_SQL[name](source)} AS {out}")
    return f"""
WITH fresh AS (SELECT * FROM {view} WHERE {stamp_col} > :stamp),
newest AS (SELECT max({stamp_col}) AS top FROM fresh),
ranked AS (
  SELECT fresh.*, row_number() OVER (PARTITION BY {key} ORDER BY {tie_break}) AS place
  FROM fresh JOIN newest ON {stamp_col} = top)
SELECT {', '.join(columns)} FROM ranked WHERE place = 1"""


def gold_statement(view: str, keys: list[str], count_col: str, alias: str) -> str:
    """Rows of ``view`` with a ``count_col``, counted per ``keys``, stamped with the bound ``:as_of``."""
    by = ", ".join(keys)
    stamps = ", ".join(f"CAST(:as_of AS TIMESTAMP) AS {c}" for c in ("created_at", "updated_at"))
    return f"SELECT {by}, COUNT({count_col}) AS {alias}, {stamps} FROM {view} GROUP BY {by}"
