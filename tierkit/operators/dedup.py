"""W1 + F2 (+ P2, P5, L1, L2): keep the first row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkit.control import fresh_name


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def first_per_key(df: DataFrame, keys, order, tie_break, keep_null_keys: bool = False,
                  normalize_key=None) -> DataFrame:
    """One row per key: the first by ``order`` then ``tie_break``.

    ``order`` / ``tie_break``: lists of Columns (use ``.desc()`` for newest
    first).  A tie-break is required so the survivor is deterministic - the
    reference's order is always tied within a snapshot.

    ``row_number() ... = 1`` lets Catalyst insert a *partial* ``WindowGroupLimit``
    before the shuffle: every map task already keeps one row per key, so a key
    holding a third of the data ships one row per task, not a third of the data.

    NULL keys form one group (one survivor), like the reference.  With
    ``keep_null_keys=True`` every NULL-key row is kept instead.
    ``normalize_key``: optional function applied to each key column first.
    """
    if not tie_break:
        raise ValueError("first_per_key needs tie_break columns for a deterministic survivor")
    key_cols = [_c(k) for k in keys]
    if normalize_key is not None:
        key_cols = [normalize_key(k) for k in key_cols]
    names = [fresh_name(df.columns, f"__k{i}") for i in range(len(key_cols))]
    rank = fresh_name(df.columns, "__rn")
    src = df.select("*", *[k.alias(n) for k, n in zip(key_cols, names)])
    w = Window.partitionBy(*names).orderBy(*[_c(o) for o in order], *[_c(t) for t in tie_break])
    if keep_null_keys:
        any_null = F.lit(False)
        for n in names:
            any_null = any_null | F.col(n).isNull()
        nulls = src.where(any_null)
        src = src.where(~any_null)
    out = (src.withColumn(rank, F.row_number().over(w))
           .where(F.col(rank) == 1).drop(rank))
    if keep_null_keys:
        out = out.unionByName(nulls)
    return out.drop(*names)
