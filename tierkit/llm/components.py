"""Connected components of a link table, by contracting it."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long ids) as ``(id, root)``: one id of each component, for all ids in links.

    Each round every id moves to the first id, in that round's order, among itself and its neighbours
    (a minimum, pre-aggregated before its shuffle, so a star of any size is one row per task), and links
    are rewritten to where their ends moved; those inside one id vanish.  The order is that of the ids
    at first, which contracts stars at once, then a new random one each round, which shortens chains by
    a constant share.  Rounds end when no link is left.
    """
    edges = saved(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "links")
    roots = None
    for turn in count():
        order = (lambda c: F.col(c)) if turn == 0 else (lambda c, t=turn: F.xxhash64(c, F.lit(t)))
        ends = edges.select("a", "b").union(edges.select("b", "a")).toDF("id", "other")
        first = ends.groupBy("id").agg(F.min(F.struct(order("other").alias("o"), F.col("other").alias("to"))).alias("m"))
        moves = saved(first.select("id", F.when(F.col("m.o") < order("id"), F.col("m.to")).otherwise(F.col("id")).alias("to")), "moves")
        if roots is None:
            roots = moves.select("id", F.col("to").alias("root"))
        else:
            roots = saved(roots.join(moves.select(F.col("id").alias("root"), "to"), "root", "left").select(
                "id", F.coalesce("to", "root").alias("root")), "roots")
        moved = edges.join(moves.toDF("a", "to_a"), "a").join(moves.toDF("b", "to_b"), "b").where("to_a <> to_b")
        edges = saved(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
        if not edges.take(1):
            return roots
