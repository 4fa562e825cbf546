"""The silver projection driven by a rule spec instead of code.

``spec`` maps output column -> ``(rule, source column)`` (or just ``rule`` when
the source has the same name).  Rules:

``id``               trimmed text, case kept
``text``             ``lower(trim(cast))``
``text_or_unknown``  as ``text``; blank or NULL -> ``'unknown'``
``slug``             ``text_or_unknown`` then non-``[a-z0-9]`` runs -> ``_``
``fold``             ASCII-fold slug (exact, an Arrow UDF)
``double``           tolerant text -> double
``keep``             unchanged
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.functions import text as T

RULES = {
    "id": T.norm_id,
    "text": T.norm_text,
    "text_or_unknown": T.text_or_unknown,
    "slug": T.slug,
    "fold": T.fold_slug,
    "double": T.try_double,
    "keep": lambda c: F.col(c) if isinstance(c, str) else c,
}


def rule_column(rule: str, source):
    try:
        fn = RULES[rule]
    except KeyError:
        raise ValueError(f"unknown rule {rule!r}; known: {sorted(RULES)}") from None
    return fn(source)


def apply_rules(df: DataFrame, spec: dict) -> DataFrame:
    """One ``select`` computing every output column from its rule."""
    cols = []
    for out, r in spec.items():
        rule, src = (r, out) if isinstance(r, str) else r
        cols.append(rule_column(rule, src).alias(out))
    return df.select(*cols)
